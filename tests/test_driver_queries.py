"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith(("op", "pipeline")))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if v.__class__.__name__ == "Decimal":
        return round(float(v), 6)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    frame = entry.queries()[name](spark, SF)
    got = table(frame.columns, [tuple(r) for r in frame.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    want = table([d[0] for d in cur.description], cur.fetchall())
    assert got == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
