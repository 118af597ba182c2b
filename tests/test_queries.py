"""Every registered warehouse query against its SQL in DuckDB, on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from tidemark.plans import queries


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return con


def _plain(v):
    return round(v, 6) if isinstance(v, float) else v.normalize() + 0 if isinstance(v, Decimal) else v


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in queries.ORACLES])
def test_query_matches_sql(spark, data, duck, name):
    df = queries.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    want = sorted((tuple(map(_plain, r)) for r in duck.execute(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({queries.ORACLES[name]})").fetchall()), key=repr)
    assert got == want
    spark.catalog.clearCache()


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() == 2


def test_plans_have_no_python_and_no_pair_products(spark, data):
    for name in ("vw_metricas_completas", "keyed_diff", "check_overlaps", "stg_ads_unified"):
        plan = queries.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan
