"""Every registered query of the engine against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from skyledger import queries_files, queries_rules  # noqa: F401  register their queries
from skyledger.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = con.execute(SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    other = [tuple(r[names.index(c)] for c in df.columns) for r in got.fetchall()]
    assert sorted(map(str, rows)) == sorted(map(str, other))


def test_entry_lists_all():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
