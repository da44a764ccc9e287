"""Pages to titles, anchors, pagers, article links and document links: one parse per page."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..markup.links import PARTS
from ..schemas import PARSED
from ..session import ship

#: Characters of HTML that are parsed between two batches of output.
BATCH_CHARS = 4 << 20


def parse_pages(pages: DataFrame, html: str = "html", url: str = "page_url", keep: tuple[str, ...] = (), want: tuple[str, ...] = PARTS, headers: str | None = None) -> DataFrame:
    """The kept columns and url of each page with ``parsed``, the wanted parts of what a crawl reads from it.

    The page itself goes no further than the parse, so no exchange carries HTML.
    html is a column of text, or, with headers, of bodies in the charset that these
    name.  A null page is an empty one.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    columns = list(dict.fromkeys([*keep, url]))
    parsed = StructType.fromDDL(f"parsed {PARSED}")["parsed"].dataType
    schema = StructType([pages.schema[c] for c in columns]).add("parsed", StructType([parsed[p] for p in PARTS if p in want]))
    kind = to_arrow_type(schema["parsed"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..markup.links import read_page
        from ..sources.fetch import body_text, content_type

        for batch in batches:
            texts, urls = batch.column(html).to_pylist(), batch.column(url).to_pylist()
            if headers:
                texts = [body_text(t, content_type(h)) for t, h in zip(texts, batch.column(headers).to_pylist(), strict=True)]
            begin, size = 0, 0
            for i, text in enumerate(texts):
                size += len(text or "")
                if size >= BATCH_CHARS or i + 1 == len(texts):
                    rows = [read_page(t, u, want) for t, u in zip(texts[begin : i + 1], urls[begin : i + 1], strict=True)]
                    part = batch.slice(begin, i + 1 - begin)
                    yield pa.record_batch([*(part.column(c) for c in columns), pa.array(rows, kind)], names=[*columns, "parsed"])
                    begin, size = i + 1, 0

    ship(pages.sparkSession)
    return pages.select(*dict.fromkeys([*columns, html, *([headers] if headers else [])])).mapInArrow(run, schema)


def _exploded(parsed: DataFrame, field: str, keep: tuple[str, ...], outer: bool = False) -> DataFrame:
    explode = F.explode_outer if outer else F.explode
    return parsed.select(*keep, explode(f"parsed.{field}").alias("_row")).select(*keep, "_row.*")


def anchors(parsed: DataFrame, keep: tuple[str, ...] = ("page_url",)) -> DataFrame:
    """One row for each anchor with a link: pos, href, text and the resolved url."""
    return _exploded(parsed, "anchors", keep)


def article_links(parsed: DataFrame, keep: tuple[str, ...] = ("page_url",)) -> DataFrame:
    """One row for each article link of a listing page, the first of each URL, in order of pos."""
    return _exploded(parsed, "articles", keep)


def document_links(parsed: DataFrame, keep: tuple[str, ...] = ("page_url",)) -> DataFrame:
    """One row for each document link of a page, the first of each URL: anchors before embedded ones."""
    return _exploded(parsed, "documents", keep)


def pager_info(parsed: DataFrame, keep: tuple[str, ...] = ("page_url",)) -> DataFrame:
    return parsed.select(*keep, "parsed.pager.template", "parsed.pager.max_page")


def carried_title(document_title: Column, listing_title: Column) -> Column:
    """A document's title is its page's, or else the one that its listing shows."""
    return F.coalesce(F.nullif(document_title, F.lit("")), listing_title)


def informative_text(text: Column) -> Column:
    """A link's text, empty if it is one of the generic ones."""
    from ..functions.rules import GENERIC_TEXTS

    return F.when(F.lower(text).isin(*GENERIC_TEXTS), F.lit("")).otherwise(text)
