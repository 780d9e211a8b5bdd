"""Lookups that skip row groups, and several writers of one store."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from skyledger.operators.artifact import any_of, write_sorted
from skyledger.operators.joins import GuardError
from skyledger.plans import pipeline
from skyledger.plans.pipeline import CommitConflict, Store, localized
from skyledger.schema import RECORD
from test_engine import record


def rows_scanned(df):
    """Rows that the scan of a plan has read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    if "AdaptiveSparkPlan" in plan.nodeName():
        raise AssertionError("a plan without shuffles was expected")
    return plan.metrics().apply("numOutputRows").value()


def test_lookups_read_few_row_groups(spark, tmp_path):
    n = 40_000
    key = lambda c, salt: F.substring(F.md5(F.concat(F.lit(salt), c.cast("string"))), 1, 6)
    df = spark.range(n).select(key(F.col("id"), "h").alias("icao_hex"), F.upper(key(F.col("id"), "m")).alias("registration_key"), F.lit("x" * 20).alias("country"), F.sha2(F.col("id").cast("string"), 512).alias("body"))
    df = df.withColumn("icao_hex", F.when(F.rand(1) < 0.7, F.col("icao_hex")))
    path = str(tmp_path / "feed")
    write_sorted(df, path, "icao_hex", "registration_key", row_group_bytes=60_000)
    whole = spark.read.parquet(path)
    some = whole.where("icao_hex IS NOT NULL").limit(30).collect()
    for column, most in (("icao_hex", 0.1), ("registration_key", 0.2)):
        keys = [r[column] for r in some[:3]]
        found = whole.where(any_of(column, keys))
        assert rows_scanned(found) < most * n and {r[column] for r in found.collect()} == set(keys)
    many = [r["icao_hex"] for r in some]  # more than an IN list is tested for
    assert {r["icao_hex"] for r in whole.where(any_of("icao_hex", many)).collect()} == set(many)
    assert rows_scanned(whole.where(any_of("icao_hex", many))) < 0.5 * n
    assert whole.where(any_of("icao_hex", [])).count() == 0


def test_of_two_writers_one_wins(spark, tmp_path):
    a, b = (Store(spark, str(tmp_path / "s")) for _ in range(2))
    a.write(spark.range(1), "t")
    assert a.begun().read("t").count() == 1 and b.read("t").count() == 1
    a.write(spark.range(2), "t")  # b has read the version before
    with pytest.raises(CommitConflict, match="version 1"):
        b.write(spark.range(3), "t")
    assert issubclass(CommitConflict, GuardError) and a.read("t").count() == 2
    b = b.begun()
    b.write(b.read("t").union(spark.range(1)), "t")
    assert b.read("t").count() == 3

    def while_other_writes(df, path):
        df.write.parquet(path)
        Store(spark, str(tmp_path / "s")).write(spark.range(9), "t")

    with pytest.raises(CommitConflict):
        b.write(spark.range(4), "t", while_other_writes)
    assert Store(spark, str(tmp_path / "s")).read("t").count() == 9
    assert sum("attempt-" in p.name for p in (tmp_path / "s" / "t").rglob("*")) == 2  # the newest two; the losers' are gone


def test_translations_are_a_log(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    asked = []

    def one(text, i):
        return spark.createDataFrame([(i, json.dumps(record(lien_status=text)))], "_ord int, json string").select("_ord", F.from_json("json", RECORD).alias("record"))

    def run(text, render=lambda batch: {h: t.upper() for h, f, t in batch}):
        return localized(spark, store.begun(), one(text, 1), render, ())

    files = lambda: sorted(str(p) for p in (tmp_path / "s").rglob("*") if p.is_file())
    assert run("uno")[0].first().record.lien_status == "UNO"
    before = files()
    done, counts = run("uno", lambda batch: asked.append(batch))
    assert files() == before and not asked and counts["cache_hits"] == 1 and done.first().record.lien_status == "UNO"
    for i in range(3):
        run(f"t{i}")
    assert store.begun().batches("translations") == 4  # each run has added its own rows only
    assert [spark.read.parquet(str(p.parent)).count() for p in (tmp_path / "s" / "translations").rglob("_SUCCESS")] == [1] * 4
    # Failures count up, an answer clears them; the newest batch of a key counts.
    none = lambda batch: [(batch[0][0], " "), *[(h, t) for h, f, t in batch[1:]]]
    pair = one("lost", 1).unionByName(one("found", 2))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # one batch, of which half comes back
    localized(spark, store.begun(), pair, none, ())
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    left = store.begun().read_log("translation_failures", "hash")
    assert [r.failures for r in left.where("failures > 0").collect()] == [1]
    run("lost")
    run("found")
    assert store.begun().read_log("translation_failures", "hash").where("failures > 0").isEmpty()
    pipeline.COMPACT_AFTER, kept = 3, pipeline.COMPACT_AFTER
    try:
        whole = store.begun().read_log("translations", "hash").count()
        run("last")
    finally:
        pipeline.COMPACT_AFTER = kept
    s = store.begun()
    assert s.batches("translations") == 1 and s.read_log("translations", "hash").count() == whole + 1


def test_writers_at_once(spark, tmp_path):
    stores = [Store(spark, str(tmp_path / "s")) for _ in range(4)]
    for s in stores:
        assert s.path("t") is None
    won, lost = [], []

    def run(i):
        try:
            stores[i].write(spark.range(i + 1), "t")
            won.append(i)
        except CommitConflict:
            lost.append(i)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert len(won) == 1 and len(lost) == 3 and Store(spark, str(tmp_path / "s")).read("t").count() == won[0] + 1
