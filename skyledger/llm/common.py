"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_ROOT = Path(__file__).resolve().parents[2]


def _is_local(spark: SparkSession) -> bool:
    """Whether driver and tasks are one process on one machine."""
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where a session in local mode names none, as in tests, a fresh folder is made;
    a cluster has to name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = getattr(shared_dir, "_made", None)
    if made is None:
        made = shared_dir._made = tempfile.mkdtemp(prefix="spark-")
    return made


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a Parquet table in the shared folder and reads it again.

    Cuts the lineage; the files outlive any executor, and this process until
    ``drop_materialized`` removes them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._materialized = path
    return out


_made: list[str] = []
#: Keys that may be broadcast: 4 million pairs of numbers are 64 MB.
MAX_BROADCAST_KEYS = 4_000_000


def materialized() -> int:
    """How many tables this process has materialized and not removed."""
    return len(_made)


def discard(*tables: DataFrame) -> None:
    """Removes materialized tables that nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df._materialized)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _made.remove(name)


def unused(name: str, *taken: DataFrame | list[str]) -> str:
    """``name``, with underscores before it until no column is called so, in any case."""
    columns = {c.lower() for x in taken for c in (x if isinstance(x, list) else x.columns)}
    while name.lower() in columns:
        name = f"_{name}"
    return name


def drop_materialized(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> int:
    """Removes the tables that this process has materialized, once nothing reads them any more.

    ``since`` is an earlier ``materialized()``; the paths in ``keep`` stay.
    """
    gone = [p for p in _made[since:] if p not in keep]
    for name in gone:
        _delete(spark, name)
    return len(gone)


def release(spark: SparkSession) -> None:
    """Has the driver let go of what finished jobs left: their shuffle files, broadcasts and plans.

    Spark drops these once the driver's garbage is collected, which by itself may come
    long after; an operator of many jobs calls this between its phases.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def join_keys(df: DataFrame, keys: DataFrame, condition: str, how: str) -> DataFrame:
    """``df`` semi or anti joined with distinct keys.

    Up to MAX_BROADCAST_KEYS keys, a few numbers each, are broadcast and ``df`` stays
    where it is; beyond that both sides are shuffled.
    """
    keys = materialize(keys, "keys")
    side = F.broadcast(keys) if keys.count() <= MAX_BROADCAST_KEYS else keys
    return df.join(side, F.expr(condition), how)


#: Rows of a key up to which it is never split from the others, and the most parts that a hot key's rows are dealt to.
FEW_ROWS, MAX_PARTS = 200, 32


def hot_keys(df: DataFrame, key: str) -> dict:
    """The keys that hold more than a thousandth of the rows (a thousand at most) and more than FEW_ROWS,
    each with the number of parts to deal its rows to, MAX_PARTS at most."""
    return largest(df.groupBy(key).count())


def largest(counted: DataFrame) -> dict:
    """The same from (key, number of rows)."""
    key, n = counted.columns
    many = counted.where(F.col(n) > FEW_ROWS).orderBy(F.col(n).desc()).limit(1000).collect()
    if not many:
        return {}
    most = max(FEW_ROWS, counted.agg(F.sum(n)).first()[0] // 1000)
    return {r[0]: min(MAX_PARTS, -(-r[1] // most)) for r in many if r[1] > most}


def parts_of(spark: SparkSession, hot: dict, df: DataFrame, key: str) -> DataFrame:
    """(hot_key, parts) for a broadcast, from ``hot_keys`` of ``df``."""
    schema = T.StructType([T.StructField("hot_key", df.schema[key].dataType), T.StructField("parts", T.IntegerType())])
    return spark.createDataFrame(list(hot.items()), schema)


def with_value(df: DataFrame, key: str, values: DataFrame, hot: dict | None = None) -> DataFrame:
    """``df`` left joined with ``values`` (k, v), k unique; hot keys' values are broadcast and their rows stay in place."""
    hot = hot_keys(df, key) if hot is None else hot
    if not hot:
        return df.join(values, F.col(key) == F.col("k"), "left").drop("k")
    keys = list(hot)
    is_hot = F.coalesce(F.col(key).isin(keys), F.lit(False))
    few = F.broadcast(values.where(F.col("k").isin(keys)))  # at most a thousand rows
    rest = df.where(~is_hot).join(values, F.col(key) == F.col("k"), "left")
    return df.where(is_hot).join(few, F.col(key) == F.col("k"), "left").unionByName(rest).drop("k")


def ship(spark: SparkSession) -> None:
    """Makes this package importable on the executors.

    On a cluster the package goes out once as a zip file through ``addPyFile``, as the
    driver's folders say nothing of the executors'.  In local mode nothing is sent
    where ``PYTHONPATH`` or the working folder has it.
    """
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep) + [os.getcwd()]
    if _is_local(spark) and any(p and Path(p, __package__.split(".")[0]).is_dir() for p in paths):
        return
    sc = spark.sparkContext
    if getattr(ship, "_sent", None) == sc.applicationId:
        return
    target = Path(tempfile.mkdtemp(prefix="spark-"), "package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in (_ROOT / __package__.split(".")[0]).rglob("*.py"):
            z.write(p, p.relative_to(_ROOT))
    sc.addPyFile(str(target))
    ship._sent = sc.applicationId


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session, which hold whole texts, by bytes and rows."""
    for key, most in (("maxBytesPerBatch", 4 << 20), ("maxRecordsPerBatch", 2048)):
        name = f"spark.sql.execution.arrow.{key}"
        if int(spark.conf.get(name).rstrip("b")) > most:
            spark.conf.set(name, most)


def add_columns(
    df: DataFrame,
    inputs: list[str],
    fields: list[T.StructField],
    make: Callable[[], Callable[..., list[list]]],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Adds columns computed by Python over Arrow batches.

    ``make()`` runs once in each task and returns a function that takes the input
    columns as lists and returns one list for each new field.  Columns in ``drop``
    and columns whose name a new field has (in any case) are not passed on.
    """
    ship(df.sparkSession)
    small_batches(df.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new and f.name not in drop]
    arrow = to_arrow_schema(T.StructType(fields))
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = compute(*(part.column(c).to_pylist() for c in inputs))
                arrays = [part.column(c) for c in names] + [
                    pa.array(x, type=f.type) for x, f in zip(made, arrow, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names + [f.name for f in arrow])

    source = df.select(*[f"`{c}`" for c in dict.fromkeys(names + inputs)])
    return source.mapInArrow(run, T.StructType(kept + fields))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

