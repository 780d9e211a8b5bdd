"""Tables that rewrite what a batch touches, and the most frequent values in bounded memory."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyledger.operators.heavy import Summary, top_values
from skyledger.streaming.buckets import Buckets, bucket_of, keep_newest


def test_a_changed_key_rewrites_its_bucket(spark, tmp_path):
    table = Buckets(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    rows = [(i, 1, f"v{i}") for i in range(200)]
    of = lambda r: spark.createDataFrame(r, "k int, at int, v string")
    table.merge(of(rows), 0, "k", "at", 16)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("part-*")}
    first, before = table.manifest(), files()
    table.merge(of([(7, 2, "new"), (7, 0, "old")]), 1, "k", "at", 16)
    second = table.manifest()
    changed = [k for k in second["written"] if second["written"][k] != first["written"].get(k)]
    bucket = of(rows[7:8]).select(bucket_of(F.col("k"), 16)).first()[0]
    assert changed == [str(bucket)] and before.items() <= files().items()
    assert {p.split("bucket=")[1].split("/")[0] for p in files().keys() - before.keys()} == {str(bucket)}
    got = {r.k: r.v for r in table.read().collect()}
    assert got == {i: "new" if i == 7 else f"v{i}" for i in range(200)}
    table.merge(of([(7, 2, "new"), (7, 0, "old")]), 1, "k", "at", 16)  # the batch again
    assert table.read().count() == 200 and table.manifest() == second
    table.merge(of([]), 2, "k", "at", 16)
    assert table.manifest()["written"] == second["written"]
    table.merge(of(rows), 3, "k", "at", 16)  # all buckets anew, older rows: what the newest two versions do not read goes
    table.merge(of([(300, 1, "x")]), 4, "k", "at", 16)
    assert table.read().count() == 201 and not (tmp_path / "t" / "data" / "batch=0").exists() and table.manifests() == [3, 4]


def test_stream_into_buckets(spark, tmp_path):
    src = tmp_path / "in"
    for i, rows in enumerate([[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c"), (1, 0, "z")]]):
        spark.createDataFrame(rows, "k int, at int, v string").coalesce(1).write.mode("append").parquet(str(src / f"p={i}"))
    stream = spark.readStream.schema("k int, at int, v string").option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
    keep_newest(stream, "k", "at", str(tmp_path / "out"), str(tmp_path / "cp"), 4).awaitTermination(60)
    assert sorted((r.k, r.v) for r in Buckets(spark, str(tmp_path / "out")).read().collect()) == [(1, "c"), (2, "b")]


def test_summary_keeps_what_is_frequent():
    r = random.Random(1)
    values = [r.choice("abc") if r.random() < 0.5 else str(r.randint(0, 5000)) for _ in range(20_000)]
    s = Summary(20)
    for at in range(0, len(values), 500):
        s.add(Counter(values[at : at + 500]))
    s.cut()
    exact = Counter(values)
    assert len(s.counts) <= 20 and {"a", "b", "c"} <= set(s.counts) and s.lost <= len(values) / 20
    assert all(exact[v] - s.lost <= n <= exact[v] for v, n in s.counts.items())


def test_top_values(spark):
    r = random.Random(2)
    rows = [(r.choice(["x", None]), f"v{int(r.expovariate(0.02))}") for _ in range(5000)] + [("x", None)] * 400
    df = spark.createDataFrame(rows, "field string, value string").repartition(4)
    plain = sorted(Counter(rows).items(), key=lambda x: (-x[1], (x[0][0] is not None, x[0][0] or ""), (x[0][1] is not None, x[0][1] or "")))
    for k, counters in ((5, 200), (5, 3), (10_000, 50), (0, 5)):  # enough counters, too few for the top, more asked than there are
        got = [((x.field, x.value), x["rows"]) for x in top_values(df, ["field", "value"], k, counters).collect()]
        assert got == plain[:k]
    assert top_values(df.limit(0), ["field", "value"], 3).count() == 0
