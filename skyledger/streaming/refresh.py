"""Keeps the newest row of every key current from a stream of landed rows.

The registers publish whole snapshots, so a run is a batch; where a register's rows
arrive as files in a folder, this folds each micro-batch into the served table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def newest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """The row of the latest time for each key; combines before it shuffles."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.col(at)).alias("r")).select("r.*")


def keep_newest(stream: DataFrame, key: str, at: str, path: str, checkpoint: str) -> StreamingQuery:
    """Writes one table version for every micro-batch, merged with the version before.

    Version names come from the batch id, so a repeated batch writes the same version.
    The newest two versions stay.  A table goes with its checkpoint: a new checkpoint
    starts a new table.
    """
    spark = stream.sparkSession

    def drop(version: int) -> None:
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/v={version}")
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if batch_id:
            rows = spark.read.schema(batch.schema).parquet(f"{path}/v={batch_id - 1}").unionByName(batch)
        newest(rows, key, at).write.mode("overwrite").parquet(f"{path}/v={batch_id}")
        if batch_id > 1:
            drop(batch_id - 2)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
