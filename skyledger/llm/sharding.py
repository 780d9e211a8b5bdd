"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots, bytes are summed for each slot,
and a versioned map sends slots to shards.  Moving a slot is one entry of the map;
a record's slot never changes.  The map has ``n_slots`` entries whatever the data,
so it may be collected and broadcast.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, unused

MAP_SCHEMA = "version long, virtual_slot int, shard int, slot_bytes long"


def slotted(docs: DataFrame, id_col: str, text_col: str, n_slots: int) -> DataFrame:
    """Adds ``size`` (UTF-8 bytes plus 16), ``text_crc32`` and ``virtual_slot``.

    A null text has no bytes.  The slot comes from the id and the text's CRC, so
    rows without an id, and different texts under one id, spread over the slots.
    """
    return docs.withColumns(
        {
            "size": (F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).cast("long"),
            "text_crc32": F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")),
        }
    ).withColumn("virtual_slot", F.pmod(F.xxhash64(F.col(id_col), F.col("text_crc32")), F.lit(n_slots)).cast("int"))


def slot_bytes(df: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """Bytes and rows of every slot; at most ``n_slots`` rows come to the driver."""
    rows = df.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1))).collect()
    return {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}


def first_map(sizes: dict[int, int], n_slots: int, n_shards: int) -> dict[int, int]:
    """Largest slot first, each to the shard with the fewest bytes (then the fewest slots)."""
    heap = [(0, 0, s) for s in range(n_shards)]
    out = {}
    for slot in sorted(range(n_slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, count, shard = heap[0]
        out[slot] = shard
        heapq.heapreplace(heap, (load + sizes.get(slot, 0), count + 1, shard))
    return out


def rebalanced(old: dict[int, int], sizes: dict[int, int], n_shards: int, tolerance: float = 0.01) -> dict[int, int]:
    """Edits a map: slots of shards that are gone move, then the largest that fits goes from the
    fullest shard to the emptiest until they differ by at most ``tolerance`` of the mean."""
    out = dict(old)
    held: dict[int, set[int]] = {s: set() for s in range(n_shards)}
    homeless = []
    for slot, shard in old.items():
        held[shard].add(slot) if shard < n_shards else homeless.append(slot)
    load = {s: sum(sizes.get(x, 0) for x in held[s]) for s in held}

    def move(slot: int, to: int) -> None:
        if out[slot] in held:
            held[out[slot]].discard(slot)
            load[out[slot]] -= sizes.get(slot, 0)
        out[slot] = to
        held[to].add(slot)
        load[to] += sizes.get(slot, 0)

    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        move(slot, min(load, key=lambda s: (load[s], s)))
    mean = sum(load.values()) / n_shards
    for _ in range(len(out)):
        full, free = max(load, key=lambda s: (load[s], -s)), min(load, key=lambda s: (load[s], s))
        gap = load[full] - load[free]
        fits = [x for x in held[full] if 0 < sizes.get(x, 0) <= gap / 2]
        if gap <= tolerance * mean or not fits:
            break
        move(max(fits, key=lambda x: (sizes[x], -x)), free)
    return out


def save_map(spark: SparkSession, path: str, slots: dict[int, int], sizes: dict[int, int], version: int) -> None:
    rows = [(version, s, shard, sizes.get(s, 0)) for s, shard in sorted(slots.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{path}/version={version:08d}")


def load_map(spark: SparkSession, path: str) -> tuple[int, dict[int, int]] | None:
    """The newest version of the map at ``path``, if there is one."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        return None
    rows = spark.read.schema(MAP_SCHEMA).option("recursiveFileLookup", True).parquet(path)
    newest = rows.agg(F.max("version")).first()[0]
    return newest, {r["virtual_slot"]: r["shard"] for r in rows.where(F.col("version") == newest).collect()}


def shard_documents(
    docs: DataFrame,
    n_shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_slots: int = 4096,
    map_path: str | None = None,
    rows_per_bucket: int = 5000,
) -> DataFrame:
    """Adds ``size, text_crc32, virtual_slot, map_version, shard, slot`` to ``docs``.

    Shards are near equal in bytes.  With a map at ``map_path`` its newest version
    is edited for the present bytes and stored as the next one; otherwise version 1
    is made, and stored if there is a path.  ``slot`` is the row's place in its shard,
    gapless from 0.  Equal texts under different ids may lie in different shards.

    Null ids and texts are allowed (see ``slotted``).  Rows alike in id and text
    share a virtual slot and have neighbouring places.  An empty table gives an
    empty result.  Input columns with the name of an added column are replaced.
    """
    spark = docs.sparkSession
    df = slotted(docs, id_col, text_col, n_slots)
    sizes, counts = slot_bytes(df)
    stored = load_map(spark, map_path) if map_path else None
    slots = rebalanced(stored[1], sizes, n_shards) if stored else first_map(sizes, n_slots, n_shards)
    version = stored[0] + 1 if stored else 1
    if map_path:
        save_map(spark, map_path, slots, sizes, version)
    rows = [(s, shard, version) for s, shard in sorted(slots.items())]
    mapped = spark.createDataFrame(rows, "virtual_slot int, shard int, map_version long")
    df = df.drop(*[c for c in df.columns if c.lower() in ("shard", "map_version", "slot")])
    df = df.join(F.broadcast(mapped), "virtual_slot")  # n_slots rows
    part, slot_of, part_of, start, at = (unused(f"_{c}", df) for c in ("part", "slot_of", "part_of", "start", "at"))
    parts = max(1, -(-sum(counts.values()) // (n_slots * rows_per_bucket)))
    df = df.withColumn(part, F.pmod(F.xxhash64(F.col("text_crc32"), F.col(id_col)), F.lit(parts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", part).rowsBetween(Window.unboundedPreceding, -1)
    starts = df.groupBy("shard", "virtual_slot", part).count().select(
        F.col("virtual_slot").alias(slot_of), F.col(part).alias(part_of), F.coalesce(F.sum("count").over(before), F.lit(0)).alias(start)
    )
    place = Window.partitionBy("virtual_slot", part).orderBy(F.col(id_col).asc_nulls_last(), "text_crc32")
    df = df.withColumn(at, F.row_number().over(place))
    df = df.join(starts, (F.col("virtual_slot") == F.col(slot_of)) & (F.col(part) == F.col(part_of)))
    df = df.withColumn("slot", F.col(start) + F.col(at) - 1)
    added = ["size", "text_crc32", "virtual_slot", "map_version", "shard", "slot"]
    return df.select(*[f"`{c}`" for c in docs.columns if c.lower() not in added], *added)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
