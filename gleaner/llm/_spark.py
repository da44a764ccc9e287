"""Small Spark helpers of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir, ship

_folders: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _folder(spark: SparkSession) -> str:
    """A folder of the application below the shared one; it goes when the driver's JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        path = f"{shared_dir(spark)}/gleaner-{app}-{uuid.uuid4().hex[:8]}"
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(at)
        files.deleteOnExit(at)
        _folders[app] = path
    return _folders[app]


#: Spark deletes the shuffle files of a statement at its end, instead of when the driver's garbage is collected.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, written once to the shared folder and read back: ends the lineage, survives lost executors.

    The shuffle files behind the rows go as soon as they are written.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{uuid.uuid4().hex}"
    with _cleaned(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._gleaner_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes the files of tables made by cut that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "_gleaner_path", None):
            _delete(t.sparkSession, path)


def grows(df: DataFrame) -> DataFrame:
    """A table that grows with the input, to be joined: it is sorted and merged, never broadcast, so a plan is the same at every size."""
    return df.hint("merge")


def repeated(df: DataFrame, copies: str, number: str, block: int = 4096) -> DataFrame:
    """Each row of df as often as its column copies says, numbered from 1; no array has more numbers than a block or there are blocks."""
    n, first = F.col(copies).cast("long"), F.col("_block") * block
    blocks = df.where(n > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / block))))
    return blocks.withColumn(number, F.explode(F.sequence(first + 1, F.least(n, first + block)))).drop("_block")


def fold_of(modulus: int, column: str = "doc_id"):
    """crc32 of the id as text, modulo the given number."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)
