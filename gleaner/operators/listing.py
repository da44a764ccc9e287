"""Section selection and the plan of listing pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.url import page_url, resolve_url


def select_sections(catalog: DataFrame, section: str = "all") -> DataFrame:
    """All sections, or the one with that key; an unknown key is an error that lists the choices."""
    if section == "all":
        return catalog
    keys = [r.section_key for r in catalog.select("section_key").orderBy("section_ord").collect()]  # a catalog is small by nature
    if section not in keys:
        raise ValueError(f"Unknown section '{section}'. Available: {[*keys, 'all']}")
    return catalog.where(F.col("section_key") == section)


def plan_listing(catalog: DataFrame, pagers: DataFrame, max_pages: int | None = None) -> DataFrame:
    """section_ord, section_key, page_num and page_url of every listing page.

    catalog: section_ord, section_key, start_url, pager_pattern; pagers: section_key,
    template, max_page as the first page shows them.  A given pattern goes before the
    discovered one; the number of pages is always the discovered one, cut to
    max_pages if that is positive.
    """
    total = F.coalesce("max_page", F.lit(1))
    if max_pages and max_pages > 0:
        total = F.least(total, F.lit(max_pages))
    joined = catalog.join(pagers.select("section_key", "template", "max_page"), "section_key", "left")
    joined = joined.withColumns({"_template": F.coalesce(F.nullif("pager_pattern", F.lit("")), F.nullif("template", F.lit(""))), "_total": total})
    more = F.col("_template").isNotNull() & (F.col("_total") >= 2)
    pages = joined.withColumn("page_num", F.explode(F.when(more, F.sequence(F.lit(1), F.col("_total"))).otherwise(F.array(F.lit(1)))))
    later = resolve_url(F.col("start_url"), page_url(F.col("_template"), F.col("page_num")))
    return pages.select("section_ord", "section_key", "page_num", F.when(F.col("page_num") == 1, F.col("start_url")).otherwise(later).alias("page_url"))
