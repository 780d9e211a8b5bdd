"""The most frequent values, exactly, without a shuffle of every distinct one.

Each partition keeps a bounded summary of counters (Misra-Gries): with more values than counters, each gives up as much as the first one beyond them has.
A value with more than one in ``counters`` of all rows is sure to be left in some partition's summary.  The survivors are
counted again, exactly; if the last of the top has more rows than any value that was lost can have, the
answer stands, else all distinct values are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import ship

COUNTERS = 10_000


class Summary:
    """Counters of ``size`` values, twice as many for a while; summaries of parts can be put together by ``add``."""

    def __init__(self, size: int):
        self.size, self.counts, self.lost = size, {}, 0

    def add(self, counts: dict) -> None:
        for v, n in counts.items():
            self.counts[v] = self.counts.get(v, 0) + n
        if len(self.counts) > 2 * self.size:
            self.cut()

    def cut(self) -> None:
        """Takes the count of the first value beyond ``size`` from all, which leaves ``size`` values at most."""
        if len(self.counts) > self.size:
            least = sorted(self.counts.values(), reverse=True)[self.size]
            self.lost += least  # no value has lost more, and each loss took as much from more than ``size`` values
            self.counts = {v: c - least for v, c in self.counts.items() if c > least}


def survivors(values: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(value): the values that the partitions' summaries have kept; ``values`` has one text column."""
    ship(values.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Summary(counters)
        for b in batches:
            kept.add({v["values"]: v["counts"] for v in b.column(0).value_counts().to_pylist()})
        kept.cut()
        yield pa.RecordBatch.from_arrays([pa.array(list(kept.counts), pa.string())], names=["value"])

    return values.mapInArrow(run, "value string").distinct()


def top_values(df: DataFrame, columns: list[str], k: int, counters: int = COUNTERS) -> DataFrame:
    """(columns..., rows): the k most frequent combinations, ties by the columns; nulls count as values.

    ``counters`` bounds what a task holds.  A few rows come to the driver: their number, and the last of the top.
    """
    keyed = df.withColumn("_v", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    kept = survivors(keyed.select("_v"), counters).withColumnRenamed("value", "_k")
    order = [F.col("rows").desc(), *columns]
    found = keyed.join(kept, F.col("_v") == F.col("_k"), "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).orderBy(*order).limit(k)
    total = df.count()
    last = found.agg(F.min("rows").alias("least"), F.count(F.lit(1)).alias("n")).first()
    # Each partition loses at most a ``counters``-th of its rows of a value, so all of them at most this many.
    if last["n"] == k and (last["least"] or 0) > total // counters:
        return found
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).orderBy(*order).limit(k)
