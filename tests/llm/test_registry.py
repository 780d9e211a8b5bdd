"""The registered queries on the smallest tables, and the pipeline against its stages."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import langid, registry

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_and_sql(spark, name):
    df = registry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    sql = registry.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        got = con.execute(sql)
        names = [d[0] for d in got.description]
        other = [tuple(r[names.index(c)] for c in df.columns) for r in got.fetchall()]
        assert sorted(map(str, rows)) == sorted(map(str, other))


def test_pipeline(spark):
    """Every stage against a plain version of it on what the plain versions before have kept."""
    from test_set_ops import plain_components
    from test_text_ops import brute_hits, plain_language

    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = table.collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    folded = table.select("text", langid._fold(F.coalesce("text", F.lit("")), 2).alias("f")).collect()
    said = plain_language(
        langid.fit(table, "text", "lang", folds=2),
        {"rows": [(d.text, d.lang, d.source) for d in docs], "folds": {x.text or "": x.f for x in folded}},
    )
    known = [d for d, x in zip(docs, said, strict=True) if not x[2]]
    one = {c for (i, n, c) in plain_components([(d.doc_id, d.text) for d in known], 5, 80)}
    left = [d for d in known if d.doc_id in one and not brute_hits(d.text, items, 10)[1]]
    at = table
    for (_, stage), want in zip(corpus_pipeline.STAGES[:3], (known, [d for d in known if d.doc_id in one], left), strict=True):
        at = spark.createDataFrame(stage(spark, at, SF).collect(), table.schema)
        assert sorted(x.doc_id for x in at.collect()) == sorted(d.doc_id for d in want)
    out = corpus_pipeline.run(spark, SF).collect()
    assert {x.doc_id for x in out} <= {d.doc_id for d in left}
    sizes = sum(len(d.text.split()) for d in left)
    assert abs(sum(len(x.text.split()) for x in out) - sizes) < 0.02 * sizes
    assert {x.shard for x in out} <= set(range(40))
    names = table.columns
    assert list(out[0].__fields__[: len(names)]) == names


def test_materialized_tables_can_be_dropped(spark):
    from skyledger.llm import common

    df = common.materialize(spark.range(5).toDF("i"), "five")
    path = common._made[-1]
    assert df.count() == 5 and Path(path.removeprefix("file:")).exists()
    assert common.drop_materialized(spark) >= 1 and not Path(path.removeprefix("file:")).exists()
