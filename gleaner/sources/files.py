"""The files of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path (below root) and length of every file that is not empty; none if the folder is not there.  No content is read."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        return spark.createDataFrame([], "path string, length long")
    base = files.makeQualified(at).toUri().getPath().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    return found.select(F.substring_index("path", f"{base}/", -1).alias("path"), "length").where("not endswith(path, '.part')")


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder with all it holds, in whatever file system it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def replace_file(spark: SparkSession, part: str, target: str) -> None:
    """Renames a file over another one, at once, in whatever file system they are."""
    jvm, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    there, end = jvm.Path(part), jvm.Path(target)
    files = there.getFileSystem(conf)
    over = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    over[0] = jvm.Options.Rename.OVERWRITE
    jvm.FileContext.getFileContext(files.getUri(), conf).rename(files.makeQualified(there), files.makeQualified(end), over)
