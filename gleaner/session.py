"""Makes this package importable on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's source to the Python path of the executors, once for each application.

    Spark's own file server hands it out, so no folder has to be shared.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Where none is set a local one serves, as in tests, but only if the executors run on
    this machine: on a cluster they would not see each other's files.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: it has to name a folder that the driver and all executors share")
    return f"{tempfile.gettempdir()}/gleaner-checkpoints"


def local_path(path: str) -> str:
    """A path of a mounted file system as the tasks' own file functions take it."""
    return "/" + path.split(":", 1)[1].lstrip("/") if path.startswith("file:") else path
