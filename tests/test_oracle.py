"""Every spatial query against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from stratile.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows):
    def cell(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return "null"
        return f"{x:.10g}" if isinstance(x, float) else str(x)

    return sorted(tuple(map(cell, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    want = duck.sql(registry.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = [tuple(float(v) if type(v) is float else v for v in (r[c] for c in columns)) for r in df.collect()]
    place = [want.columns.index(c) for c in columns]
    assert plain(got) == plain([tuple(r[i] for i in place) for r in want.fetchall()])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs_without_oracle(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
