"""Cached enrichment: texts are rendered once, kept by hash, and joined back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import ship

#: Fixed values.
FIELDS = ["cancellation_reason", "airworthiness_class", "lien_status", "operational_classes"]
MAX_FAILURES = 3
BATCH = 200
MIN_RETURNED = 0.5
MIN_KEPT = 0.5
CACHE = "hash string, text string"
FAILURES = "hash string, failures int"


def text_hash(name: Column, text: Column) -> Column:
    return F.sha2(F.concat(name, F.char(F.lit(0)), text), 256)


def candidates(records: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (hash, field, text) of the translatable texts."""
    parts = []
    for f in FIELDS:
        if f not in excluded:
            c = F.col(f"record.{f}")
            parts.append(records.select(F.lit(f).alias("field"), (F.explode(c) if f == "operational_classes" else c).alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.where(F.coalesce(F.trim("text"), F.lit("")) != "")
    return out.select(text_hash(F.col("field"), F.col("text")).alias("hash"), "field", "text").dropDuplicates(["hash"])


def delta(found: DataFrame, cache: DataFrame, failures: DataFrame) -> DataFrame:
    """Candidates that are neither cached nor given up."""
    spent = failures.where(F.col("failures") >= MAX_FAILURES)
    return found.join(cache, "hash", "left_anti").join(spent, "hash", "left_anti")


def translate(wanted: DataFrame, render: Callable[[list[tuple[str, str, str]]], dict[str, str] | list[tuple[str, str]]]) -> DataFrame:
    """(hash, text, tried) of the delta: ``render`` is asked by the tasks, for batches of (hash, field, text).

    It gives (hash, text) pairs or a dictionary.  A batch counts as tried only if half of
    it came back; null stands for no answer.  Answers to questions not asked and blank
    answers are left out, of several to one question the first counts.
    """

    def ask(batch: list[tuple[str, str, str]]) -> list[tuple[str, str | None, bool]]:
        got: dict[str, str] = {}
        answers = render(list(batch))
        asked = {b[0] for b in batch}
        for h, t in answers.items() if isinstance(answers, dict) else answers:
            if h in asked and t and t.strip():
                got.setdefault(h, t)
        tried = len(got) >= MIN_RETURNED * len(batch)
        return [(h, got.get(h), tried) for h, _, _ in batch]

    ship(wanted.sparkSession)
    schema = pa.schema([("hash", pa.string()), ("text", pa.string()), ("tried", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("hash", "field", "text")), strict=True))
            for at in range(0, len(rows), BATCH):
                made = ask(rows[at : at + BATCH])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)

    return wanted.select("hash", "field", "text").mapInArrow(run, "hash string, text string, tried boolean")


def count_failures(failures: DataFrame, tried: DataFrame, came: DataFrame) -> DataFrame:
    """The failure counts after a run: an answer clears, an attempt without one adds."""
    missed = tried.select("hash").distinct().join(came, "hash", "left_anti").withColumn("more", F.lit(1))
    out = failures.join(came, "hash", "left_anti").join(missed, "hash", "full")
    n = F.coalesce("failures", F.lit(0)) + F.coalesce("more", F.lit(0))
    return out.select("hash", n.cast("int").alias("failures"))


def failure_changes(failures: DataFrame, tried: DataFrame, came: DataFrame) -> DataFrame:
    """The counts that a run changes: an answer makes a count 0, an attempt without one adds."""
    asked = tried.select("hash").unionByName(came.select("hash")).distinct()
    of = asked.join(failures, "hash", "left").join(came.select("hash", F.lit(1).alias("_came")), "hash", "left")
    n = F.when(F.col("_came").isNotNull(), F.lit(0)).otherwise(F.coalesce("failures", F.lit(0)) + 1)
    return of.where(F.col("_came").isNull() | F.col("failures").isNotNull()).select("hash", n.cast("int").alias("failures"))


def prune(cache: DataFrame, live: DataFrame, allowed: bool) -> DataFrame:
    """Drops entries no longer used, unless that would lose more than half of the cache or there are none; then ``cache`` is given back."""
    if not allowed:
        return cache
    kept = cache.join(live, "hash", "left_semi")
    before, after = cache.count(), kept.count()
    return kept if before > after and after / before >= MIN_KEPT else cache


def apply_text(df: DataFrame, field: str, column: str, cache: DataFrame) -> DataFrame:
    """Replaces a text column by its cached rendering where there is one."""
    keyed = df.withColumn("_h", text_hash(F.lit(field), F.col(column)))
    hit = cache.select(F.col("hash").alias("_k"), F.col("text").alias("_new"))
    return keyed.join(hit, F.col("_h") == F.col("_k"), "left").withColumn(column, F.coalesce("_new", column)).drop("_h", "_k", "_new")


def apply(records: DataFrame, cache: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """Renders the translatable fields of (record, _ord); source texts stay."""
    out = records
    for f in FIELDS:
        if f in excluded:
            continue
        if f == "operational_classes":
            parts = out.select("_ord", F.posexplode(f"record.{f}").alias("pos", "part"))
            done = apply_text(parts, f, "part", cache).groupBy("_ord").agg(F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("_a"))
            new = F.transform("_a", lambda x: x["part"])
            out = out.join(done, "_ord", "left").withColumn("record", F.col("record").withField(f, F.when(F.col("_a").isNull(), F.col(f"record.{f}")).otherwise(new))).drop("_a")
        else:
            out = apply_text(out.withColumn("_t", F.col(f"record.{f}")), f, "_t", cache).withColumn("record", F.col("record").withField(f, F.col("_t"))).drop("_t")
    return out


def stats(found: DataFrame, cache: DataFrame, failures: DataFrame) -> dict:
    """Candidates, cached ones and ones given up."""
    spent = failures.where(F.col("failures") >= MAX_FAILURES)
    marked = found.join(cache.select("hash", F.lit(1).alias("c")), "hash", "left").join(spent.select("hash", F.lit(1).alias("s")), "hash", "left")
    return marked.agg(F.count(F.lit(1)).alias("candidates"), F.count("c").alias("cache_hits"), F.count("s").alias("exhausted")).first().asDict()
