import duckdb
import pytest

import __spark_entry__ as entry
from cinderlane.plans.registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame):
    cols = sorted(frame.columns)
    clean = lambda v: "null" if v is None or str(v) in ("<NA>", "nan", "NaT") else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(clean(x.tolist() if hasattr(x, "tolist") else x) for x in r) for r in frame[cols].itertuples(index=False))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = QUERIES[name](spark, DATA).toPandas(), con.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
