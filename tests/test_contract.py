"""The driver contract: entry() smoke check and every query against its DuckDB oracle."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from starmart.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "pages"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    df = E.entry(spark)
    assert df.columns == ["state", "state_abv", "total_positive_cases", "total_deaths",
                          "avg_hospitalized"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.queries())
    assert set(REGISTRY) <= set(E.oracle_sql())


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
          "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    sql = E.oracle_sql()[name]
    res = duck.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: _TYPES.get(t, t) for c, t in sdf.dtypes} == duck_types
    assert len(s_rows) == len(d_rows)
    assert _bag(sdf.columns, s_rows) == _bag(d_cols, d_rows)
