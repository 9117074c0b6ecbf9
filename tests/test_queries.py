"""Every query with SQL of its own gives the rows that DuckDB gives."""

import duckdb
import pytest

from lectern.plans.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(rows):
    return sorted(tuple(repr(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    rows = df.select(columns).collect()
    if name in ORACLE_SQL:
        r = db.sql(ORACLE_SQL[name])
        at = [r.columns.index(c) for c in columns]
        assert plain(rows) == plain([tuple(x[i] for i in at) for x in r.fetchall()])
    else:
        assert rows


def test_entry_has_the_flagship(spark):
    import __spark_entry__

    assert {r["lang"] for r in __spark_entry__.entry(spark).collect()} >= {"en", "de"}
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
