"""Records of large files, cut in parallel though a cut needs what stands before it.

Spark reads a file in byte ranges, each as pieces between separators.  Whether a piece ends a
record depends on a small state (inside quotes, depth of brackets) at its beginning, which a
range cannot know.  So each range is read twice: first it tells what it does to every
possible state (one row a range), these maps are composed along the file, and with the true state
every range then cuts its records by itself.  What a range boundary cuts in two is
put together from the fragments, of which a range has two at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..cluster import ship

#: Kinds of what a range gives: a record, the end of one begun before, the begin of one ended later, the middle of one.
WHOLE, HEAD, TAIL, MIDDLE = range(4)
CUT = "file string, start long, seq long, kind int, text string"


def pieces(spark: SparkSession, path: str, separator: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, start, text): the pieces of each byte range, in order within the range."""
    text = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    read = spark.read.option("lineSep", separator).text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), text.alias("text"))


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[list[str]]]]:
    """The ranges of a partition, each as its leading columns and an iterator of lists of its pieces.

    The leading columns are read once for each range and batch: that they change shows in the first two, file and start.
    """

    def cut():
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, dtype=bool)
            for c in b.columns[:2]:
                new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            begins = [0, *np.flatnonzero(new).tolist()]
            for at, end in zip(begins, [*begins[1:], b.num_rows], strict=True):
                yield tuple(c[at].as_py() for c in b.columns[:-1]), b.columns[-1][at:end].to_pylist()

    parts = cut()
    part = next(parts, None)
    while part is not None:
        key = part[0]

        def texts(key=key):
            nonlocal part
            while part is not None and part[0][:2] == key[:2]:
                yield part[1]
                part = next(parts, None)

        yield key, texts()


def over_ranges(df: DataFrame, run: Callable[[tuple, Iterator], Iterator[tuple]], schema: str, lists: bool = False) -> DataFrame:
    """Applies ``run`` to each range of ``df``, whose last column has the pieces and whose others, file and start first, are the same within
    a range.  ``run`` gets the pieces one by one, or in ``lists`` of many."""
    ship(df.sparkSession)
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def whole(batches):
        held: list[tuple] = []
        for key, texts in _by_range(batches):
            for out in run(key, texts if lists else chain.from_iterable(texts)):
                held.append(out)
                if len(held) >= 2048:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
                    held = []
            for _ in texts:  # what ``run`` has left
                pass
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

    return df.mapInArrow(whole, schema)


def states(maps: DataFrame) -> DataFrame:
    """``maps`` (file, start, to0, to1, ...) with ``before`` and ``after``, the states 0 or 1 around each range.

    A range keeps the state, flips it or sets it.  After a range the state is that of the last one which set
    it, flipped as often as the ranges since; a file begins with 0.  All of it are running sums over a file's ranges.
    """
    in_order = Window.partitionBy("file").orderBy("start")
    flips = F.sum(((F.col("to0") == 1) & (F.col("to1") == 0)).cast("int")).over(in_order)
    out = maps.withColumn("flips", flips)
    base = F.coalesce(F.last(F.when(F.col("to0") == F.col("to1"), F.col("to0") - F.col("flips")), ignorenulls=True).over(in_order), F.lit(0))
    out = out.withColumn("after", F.pmod(base + F.col("flips"), F.lit(2)).cast("int"))
    return out.withColumn("before", F.coalesce(F.lag("after").over(in_order), F.lit(0))).drop("flips")


def with_states(df: DataFrame, known: DataFrame) -> DataFrame:
    """Pieces with their range's state columns before the text.  ``known`` has a row for each range (of 128 MB by default),
    so it is broadcast: a petabyte has eight million."""
    side = known.withColumnsRenamed({"file": "_file", "start": "_start"})
    joined = df.join(F.broadcast(side), (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")))
    return joined.select("file", "start", *[c for c in known.columns if c not in ("file", "start")], "text")


def joined_records(cut: DataFrame, separator: str) -> DataFrame:
    """(_ord, text): all records; those that ranges cut are put together.  ``_ord`` is a record's place: file, range, number."""
    place = F.struct(F.col("file").alias("f"), F.col("start").alias("s"), F.col("seq").alias("i"))
    whole = cut.where(F.col("kind") == WHOLE).select(place.alias("_ord"), "text")
    parts = cut.where(F.col("kind") != WHOLE)  # two rows a range at most
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(Window.partitionBy("file").orderBy("start", "kind"))
    parts = parts.withColumn("number", number).groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "seq", "text"))).alias("p"))
    first = F.element_at("p", 1)
    at = F.struct(F.col("file").alias("f"), first["start"].alias("s"), first["seq"].alias("i"))
    text = F.array_join(F.transform("p", lambda x: x["text"]), separator)
    return whole.unionByName(parts.select(at.alias("_ord"), text.alias("text")))
