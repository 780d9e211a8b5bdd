"""A table of newest rows in buckets of keys: a batch rewrites the buckets that it touches, and no other.

A manifest for each batch tells which batch has written each bucket last, so a version of the table is a list of
folders, most of them written long before.  A batch reads and writes its own buckets, writes its manifest last, and
readers take the newest manifest; a repeated batch does the same again under the same names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..cluster import hadoop_path
from .refresh import newest

BUCKETS = 64


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Buckets:
    """The table at ``path``: ``data/batch=N/bucket=K`` and ``manifests/N.json``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def manifests(self) -> list[int]:
        folder, fs = hadoop_path(self.spark, f"{self.path}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, before: int | None = None) -> dict:
        """The newest manifest, or the newest of the batches before one: its schema, and of each bucket the batch that wrote it."""
        known = [n for n in self.manifests() if before is None or n < before]
        if not known:
            return {"buckets": BUCKETS, "schema": None, "written": {}}
        file, fs = hadoop_path(self.spark, f"{self.path}/manifests/{known[-1]}.json")
        stream = fs.open(file)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, manifest: dict | None = None, only: list[int] | None = None) -> DataFrame:
        """The rows of a version, or those of some buckets."""
        m = self.manifest() if manifest is None else manifest
        if m["schema"] is None:
            raise FileNotFoundError(f"no version of {self.path}")
        wanted = [f"{self.path}/data/batch={n}/bucket={k}" for k, n in m["written"].items() if only is None or int(k) in only]
        schema = T.StructType.fromJson(m["schema"])
        return self.spark.read.schema(schema).parquet(*wanted) if wanted else self.spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, batch_id: int, key: str, at: str, buckets: int = BUCKETS) -> dict:
        """Folds a batch into the table; gives the manifest."""
        m = self.manifest(before=batch_id)
        buckets = m["buckets"] if m["schema"] else buckets
        placed = batch.withColumn("bucket", bucket_of(F.col(key), buckets))
        touched = [r[0] for r in placed.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
        if touched:
            rows = batch
            if m["schema"]:
                rows = self.read(m, touched).unionByName(batch)
            whole = newest(rows, key, at).withColumn("bucket", bucket_of(F.col(key), buckets))
            whole.repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/batch={batch_id}")
        written = {k: n for k, n in m["written"].items() if int(k) not in touched} | {str(k): batch_id for k in touched}
        made = {"buckets": buckets, "schema": json.loads(batch.schema.json()), "written": written}
        file, fs = hadoop_path(self.spark, f"{self.path}/manifests/{batch_id}.json")
        draft, _ = hadoop_path(self.spark, f"{self.path}/manifests/_{batch_id}.json")
        stream = fs.create(draft, True)
        stream.write(bytearray(json.dumps(made).encode()))
        stream.close()
        fs.delete(file, False)
        fs.rename(draft, file)
        self._sweep(batch_id)
        return made

    def _sweep(self, batch_id: int) -> None:
        """Removes what the newest two versions do not read; a reader of the one before may be under way."""
        before = self.manifest(before=batch_id)
        used = set(self.manifest()["written"].values()) | set(before["written"].values()) | {batch_id}
        folder, fs = hadoop_path(self.spark, f"{self.path}/data")
        for s in fs.listStatus(folder) if fs.exists(folder) else []:
            if int(s.getPath().getName().removeprefix("batch=")) not in used:
                fs.delete(s.getPath(), True)
        for n in self.manifests()[:-2]:
            fs.delete(hadoop_path(self.spark, f"{self.path}/manifests/{n}.json")[0], False)


def keep_newest(stream: DataFrame, key: str, at: str, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keeps the newest row of each key of a stream in a table of buckets; a table goes with its checkpoint."""
    table = Buckets(stream.sparkSession, path)
    fold = lambda batch, batch_id: table.merge(batch, batch_id, key, at, buckets)
    return stream.writeStream.foreachBatch(lambda b, i: fold(b, i) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
