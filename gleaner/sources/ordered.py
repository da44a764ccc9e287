"""One file of lines in an order, written in parallel."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import delete, replace_file

#: Bytes that a task copies at once.
PIECE = 1 << 20


def _copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies parts to their places in the file; once more does no harm."""
    for batch in batches:
        for r in batch.to_pylist():
            with open(r["part"], "rb") as source, open(r["target"], "r+b") as out:
                out.seek(r["at"])
                left = r["size"]
                while left:
                    piece = source.read(min(PIECE, left))
                    out.write(piece)
                    left -= len(piece)
        yield pa.record_batch([batch.column("at")], names=["at"])


def write_ordered(rows: DataFrame, order: str, target: str, separator: str, head: str = "", tail: str = "", ended: bool = True) -> None:
    """The texts of rows (value) in the order of a column, between head and tail, as one file that appears at once.

    Each but the last is followed by the separator, the last one too if ended.  Tasks
    write sorted ranges as parts; in a mounted file system tasks copy these to
    their places in the file, elsewhere the file system appends one after the other.  No
    row passes through the driver, only the names and sizes of the parts.
    """
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    name = uuid.uuid4().hex
    folder, part = f"{target}.parts-{name}", f"{target}.{name}.part"
    rows.orderBy(order).select("value").write.option("lineSep", separator).text(folder)
    at = jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(conf)
    parts = sorted((f.getPath().getName(), f.getLen()) for f in files.listStatus(at) if f.getPath().getName().startswith("part-") and f.getLen())
    if parts and not ended:
        parts[-1] = (parts[-1][0], parts[-1][1] - len(separator.encode()))
    begin, end = head.encode(), tail.encode()
    whole = files.makeQualified(jvm.org.apache.hadoop.fs.Path(part))
    if whole.toUri().getScheme() == "file":
        local, base = whole.toUri().getPath(), files.makeQualified(at).toUri().getPath()
        places, offset = [], len(begin)
        for f, size in parts:
            places.append((f"{base}/{f}", local, offset, size))
            offset += size
        with open(local, "wb") as f:
            f.write(begin)
            f.truncate(offset)
            f.seek(offset)
            f.write(end)
        if places:
            moves = spark.createDataFrame(places, "part string, target string, at long, size long").repartitionByRange(len(places), "at")
            moves.mapInArrow(_copy, "at long").agg(F.count("*")).collect()
        # The checksum that Spark's file system may keep of an older file of the name.
        crc = os.path.join(os.path.dirname(target.removeprefix("file:")) or ".", f".{os.path.basename(target)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    else:
        out = files.create(whole, True)
        out.write(bytearray(begin))
        for f, size in parts:
            source = files.open(jvm.org.apache.hadoop.fs.Path(f"{folder}/{f}"))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, int(size) if size < 1 << 31 else size, False)
            source.close()
        out.write(bytearray(end))
        out.close()
    replace_file(spark, part, target)
    delete(spark, folder)
