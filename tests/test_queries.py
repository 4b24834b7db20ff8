"""Every registered query against its SQL twin on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from quarry import catalog

SF = f"/root/testdata/{os.environ.get('QUARRY_SF', 'sf0.001')}"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    return float(v) if hasattr(v, "is_integer") or type(v).__name__ == "Decimal" else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(catalog.ORACLES[name])
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1], (list((got[1] - want[1]).items())[:4], list((want[1] - got[1]).items())[:4])
    assert sum(got[1].values()) > 0


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_other_queries_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
