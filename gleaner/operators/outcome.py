"""The outcome of a run: in-run skips, the download limit, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import COUNTERS

#: Rows of a block of the running sum.
BLOCK = 65_536


def in_run_skips(log: DataFrame) -> DataFrame:
    """log with ``skipped``: an earlier row of the key has been downloaded and is not empty, or the registry knew it.

    log: seq, kind, doc_key, ok, size, known.  Instead of a window over each key, the
    first success of a key is aggregated and joined back, so a hot key is combined on
    the map side and its rows can be split.  Rows without a key, that is, all pages and
    articles, meet nothing; they are dealt by their seq, or one task would get them all.
    """
    done = log.where("kind = 'document' and ok and size > 0 and doc_key is not null").groupBy(F.col("doc_key").alias("_key")).agg(F.min("seq").alias("_done"))
    joined = log.withColumn("_key", F.coalesce("doc_key", F.concat(F.lit("\0"), F.col("seq").cast("string")))).join(done, "_key", "left").drop("_key")
    later = F.col("doc_key").isNotNull() & F.coalesce(F.col("seq") > F.col("_done"), F.lit(False))
    return joined.withColumn("skipped", (F.col("kind") == "document") & (F.coalesce("known", F.lit(False)) | later)).drop("_done")


def numbered(rows: DataFrame, page: list[str], inner: list[str], name: str = "seq", block: int = 1024) -> DataFrame:
    """rows with their place, from 1, in the order of the columns of page, then inner; the last column of page is a number.

    Ranks within a page follow the totals of the pages before.  These are summed in two
    levels, within blocks of pages and over the blocks, so no window spans all pages.
    """
    major = [*page[:-1], "_block"]
    totals = rows.groupBy(*page).agg(F.count("*").alias("_n")).withColumn("_block", F.floor(F.col(page[-1]) / block))
    past = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = totals.groupBy(*major).agg(F.sum("_n").alias("_n")).select(*major, past(Window.orderBy(*major)).alias("_past"))
    inside = totals.select(*page, "_block", past(Window.partitionBy(*major).orderBy(page[-1])).alias("_before"))
    before = inside.join(blocks, major).select(*page, (F.col("_past") + F.col("_before")).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*page).orderBy(*inner))
    return rows.withColumn("_own", own).join(before, page).withColumn(name, (F.col("_before") + F.col("_own")).cast("long")).drop("_own", "_before")


def running_total(df: DataFrame, flag: str, name: str, block: int = BLOCK) -> DataFrame:
    """df with the number of rows with the flag before each row, by seq.

    A prefix sum in two levels: within blocks of seq, and over the blocks' totals
    (one row for 65,536); no window spans all rows.
    """
    cell = F.floor(F.col("seq") / block)
    blocks = df.groupBy(cell.alias("_block")).agg(F.sum(F.col(flag).cast("long")).alias("_n"))
    before = blocks.select("_block", F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("_block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("_block", cell).withColumn("_own", F.coalesce(F.sum(F.col(flag).cast("long")).over(inner), F.lit(0)))
    return out.join(before, "_block").withColumn(name, F.col("_own") + F.col("_before")).drop("_block", "_own", "_before")


def resolve_run(log: DataFrame, limit: int | None = None, dry_run: bool = False) -> DataFrame:
    """The rows of log that a run comes to, with their action.

    Documents are skipped, downloaded or failed (only discovered in a dry run);
    pages and articles are visited.  With a limit, a row counts only if fewer
    downloads came before it; a negative limit ends the run at once.
    """
    known = F.coalesce("known", F.lit(False))
    rows = log.withColumn("skipped", (F.col("kind") == "document") & known) if dry_run else in_run_skips(log)
    document = F.col("kind") == "document"
    ok = F.coalesce("ok", F.lit(False))
    rows = rows.withColumn("downloaded", document & ~F.col("skipped") & ok & F.lit(not dry_run))
    if limit:
        rows = running_total(rows, "downloaded", "_before").where(F.col("_before") < limit).drop("_before")
    action = (
        F.when(~document, "visited").when(F.col("skipped"), "skipped").when(F.lit(dry_run), "discovered").when(F.col("downloaded"), "downloaded").otherwise("failed")
    )
    return rows.withColumn("action", action)


def counters(resolved: DataFrame) -> DataFrame:
    """The six counters of a run, one row."""
    of = lambda kind, *actions: F.count_if((F.col("kind") == kind) & (F.col("action").isin(*actions) if actions else F.lit(True)))
    counts = of("page"), of("article"), of("document"), of("document", "downloaded"), of("document", "skipped"), of("document", "failed")
    return resolved.agg(*(c.alias(name) for c, name in zip(counts, COUNTERS, strict=True)))
