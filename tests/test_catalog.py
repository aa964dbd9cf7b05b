"""The driver contract, and a few named queries against their SQL at the smallest scale."""

import importlib.util
from pathlib import Path

import pytest

from usagelake.catalog import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parent.parent
SF = Path("/root/testdata/sf0.001")


def load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_contract():
    entry = load("entry", ROOT / "__spark_entry__.py")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.items() <= entry.oracle_sql().items()
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["latest_state", "interval_owner_closed", "asof_next", "upsert_changed", "count_report", "archive_routing"])
def test_query_equals_its_sql(spark, name):
    import duckdb
    import pandas as pd

    check = load("check_oracle", ROOT / "scripts" / "check_oracle.py")
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, str(SF))
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    rel = con.execute(ORACLES[name])
    want = pd.DataFrame(rel.fetchall(), columns=[d[0] for d in rel.description], dtype=object)
    assert sorted(got.columns) == sorted(want.columns)
    assert check.canon(got) == check.canon(want)


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_entry_runs(spark):
    entry = load("entry", ROOT / "__spark_entry__.py")
    assert entry.entry(spark).count() > 0


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["asof_previous"](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("EqualTo(event_type," in line for line in scans)
    assert all("props" not in line for line in scans if "error" in line.split("PushedFilters")[1])
