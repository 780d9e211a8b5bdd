"""A source's rows to checked records, with guards before any write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import unwritten, written
from ..config import Source
from ..operators.artifact import guard_published
from ..operators.joins import GuardError, assert_consistent, assert_hits, cell, latest_snapshot, lookup_join
from ..operators.mapping import source_id, with_record
from ..operators.resolve import ROWS_PER_TASK, resolve


@dataclass
class Translation:
    records: DataFrame  # (source_id, record, _ord)
    stats: dict[str, int]
    unmatched: DataFrame  # (field, value, rows)
    failures: DataFrame  # (source_id, messages)
    kept: tuple[DataFrame, ...] = ()  # written tables that the others read

    def release(self) -> None:
        """Removes what was written on the way, after which nothing of this can be read."""
        for df in self.kept:
            unwritten(df)


def ordered(rows: DataFrame) -> DataFrame:
    """Adds ``_ord``, the rows' order, where the reader has not given it."""
    return rows if "_ord" in rows.columns else rows.withColumn("_ord", F.monotonically_increasing_id())


def mapped(source: Source, primary: DataFrame, joins: dict[str, DataFrame]) -> DataFrame:
    """(_ord, source_id, raw, record, failures, unmatched, blank): every row with its record."""
    rows = ordered(primary)
    if source.latest_snapshot_by:
        rows = latest_snapshot(rows, source.latest_snapshot_by)
    for j in source.joins:
        side = ordered(joins[j.file])
        assert_consistent(side, j)
        rows = lookup_join(rows, side, j)
    assert_hits(rows, source.joins)
    rows = rows.drop(*[f"_hit_{j.name}" for j in source.joins])
    cells = [c for c in rows.columns if c != "_ord"]
    whole = F.sha2(F.to_json(F.struct(*[cell(cells, c).alias(f"c{i}") for i, c in enumerate(cells)])), 256)
    policy = source.allowed_missing
    known = cell(cells, policy["field"]).rlike(policy["pattern"]) if policy else F.lit(False)
    return with_record(rows, source).select(
        "_ord", source_id(source, cells).alias("source_id"), whole.alias("raw"), "record", "failures", "unmatched", known.alias("known_blank")
    )


def translate(source: Source, primary: DataFrame, joins: dict[str, DataFrame], published: str | None = None) -> Translation:
    """Maps, checks and resolves a source; ``published`` is the text that states its total.

    Rows without a key are skipped within the policy's budget and fail beyond it.
    """
    # Both tables are read several times and of wide rows: written, they take no executor's memory.
    rows = written(mapped(source, primary, joins), "mapped")
    with_id = rows.where(F.col("source_id") != "")
    counts = rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("source_id") == "").alias("missing"),
        F.count_if((F.col("source_id") == "") & F.col("known_blank")).alias("allowed"),
    ).first()
    resolved = resolve(with_id.select("source_id", "_ord", "raw", "record", (F.size("failures") > 0).alias("bad")), source.merge)
    first = with_id.groupBy("source_id").agg(F.min("_ord").alias("_ord"))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-counts["total"] // ROWS_PER_TASK))
    done = written(resolved.repartition(tasks, "source_id").join(first, "source_id"), "records")
    sums = done.agg(F.count("record").alias("ok"), F.coalesce(F.sum("skipped"), F.lit(0)).alias("dup"), F.coalesce(F.sum("failed"), F.lit(0)).alias("bad")).first()
    skipped = min(counts["allowed"], (source.allowed_missing or {}).get("max", 0))
    stats = {
        "total": counts["total"],
        "ok": sums["ok"],
        "failed": sums["bad"] + counts["missing"] - skipped,
        "skipped": skipped + sums["dup"],
        "duplicate_skipped": sums["dup"],
    }
    if source.record_count and published is not None and stats["failed"] == 0:
        against = source.record_count.get("against", "translated")
        n = ordered(primary).count() if against == "parsed" else stats["ok"]
        guard_published(published, source.record_count["pattern"], n)
    records = done.where(F.col("record").isNotNull()).select("source_id", "record", "_ord")
    unmatched = (
        rows.select(F.explode("unmatched").alias("u")).groupBy("u.field", "u.value").agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.col("rows").desc(), "field", "value")
    )
    bad = rows.where(F.size("failures") > 0).select("source_id", F.col("failures").alias("messages"))
    return Translation(records, stats, unmatched, bad, (rows, done))


def assert_clean(t: Translation) -> None:
    """Any failed row stops the source."""
    if t.stats["failed"]:
        sample = [r.asDict() for r in t.failures.limit(5).collect()]
        raise GuardError(f"{t.stats['failed']} rows failed: {sample}")
