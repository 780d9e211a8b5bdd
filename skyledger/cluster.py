"""What a cluster needs besides the data: the package on the executors and a shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def ship(spark: SparkSession) -> None:
    """Makes this package importable where Python runs in tasks.

    It goes out once for each application, as a zip file; in local mode only where neither ``PYTHONPATH`` nor the
    working folder has it.
    """
    paths = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if _is_local(spark) and any(p and Path(p, _PACKAGE.name).is_dir() for p in paths):
        return
    sc = spark.sparkContext
    if getattr(ship, "_sent", None) == sc.applicationId:
        return
    target = Path(tempfile.mkdtemp(prefix="spark-"), f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in _PACKAGE.rglob("*.py"):
            z.write(p, p.relative_to(_PACKAGE.parent))
    sc.addPyFile(str(target))
    ship._sent = sc.applicationId


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); in local mode without one, a fresh folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if getattr(shared_dir, "_made", None) is None:
        shared_dir._made = tempfile.mkdtemp(prefix="spark-")
    return shared_dir._made


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, which outlives executors; its lineage is cut."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def unwritten(df: DataFrame) -> None:
    """Removes a table that ``written`` has made, once nothing reads it any more."""
    path, fs = hadoop_path(df.sparkSession, df._written)
    fs.delete(path, True)


def hadoop_path(spark: SparkSession, name: str):
    """A path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
