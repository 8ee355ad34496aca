"""Every operator's query runs over the driver table; those with SQL match DuckDB."""

import math
import os
from collections import Counter

import duckdb
import pytest

from starmart.llm.queries import REGISTRY, SQL

SF = os.environ.get("LLM_SF", "/root/testdata/sf0.001")
_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert set(SQL) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, name):
    df = REGISTRY[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    n = con.execute("SELECT count(*) FROM documents").fetchone()[0]
    if name not in ("op1_pack", "op2_licenses", "op5_suffix_dedup", "op11_lexical_search", "op12_conversation_repair"):
        assert len(rows) == n
    assert {"doc_id", "conv_id"} & set(df.columns)
    if name in SQL:
        result = con.execute(SQL[name])
        columns = [d[0] for d in result.description]
        want = result.fetchall()
        assert sorted(columns) == sorted(df.columns)
        types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
        assert {c: _TYPES[t] for c, t in df.dtypes} == types
        assert _bag(df.columns, rows) == _bag(columns, want)
