"""Catalog queries against their SQL on the smallest tables."""

import duckdb
import pytest

from pairloom.plans.queries import ORACLES, QUERIES, ROWS_ONLY

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == {*ORACLES, *ROWS_ONLY}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, name):
    df = QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    quoted = ", ".join(f'"{c}"' for c in cols)
    want = sorted(db.execute(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall(), key=str)
    assert got == want


@pytest.mark.parametrize("name", ["fact_counts", "link_verdicts"])
def test_rows_only(spark, name):
    assert QUERIES[name](spark, str(DATA)).count() > 0


def test_small_file_is_dealt(spark):
    """The part table is one small file, but as many tasks as the session asks for work on it."""
    from pairloom.sources.catalog import part_catalogs, parts

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert n > 1 and all(df.rdd.getNumPartitions() == n for df in (parts(spark, str(DATA)), *part_catalogs(spark, str(DATA))))
