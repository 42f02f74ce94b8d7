"""The driver's contract: every query runs at the smallest scale and equals its SQL."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

BASE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for f in sorted(os.listdir(BASE)):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{BASE}/{f}'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) or type(x).__name__ == "Decimal" else str(x)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, BASE)
    columns = sorted(df.columns)
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert len(duck.sql(SQL[name]).columns) == len(columns)
    got = df.select(*columns).collect()
    assert sorted(tuple(map(plain, r)) for r in got) == sorted(tuple(map(plain, r)) for r in want)


def test_flagship_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.queries())


def test_flagship_plan_reads_only_what_it_needs(spark):
    plan = entry.queries()["iter_features"](spark, BASE)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "props" not in plan


def test_anti_join_plan(spark):
    plan = entry.queries()["new_ids_left_anti"](spark, BASE)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_rest_works_without_the_llm_subpackage(monkeypatch):
    def absent(name):
        raise ModuleNotFoundError(f"No module named {name}", name="trajecta.llm")

    def broken(name):
        raise ModuleNotFoundError("No module named tiktoken", name="tiktoken")

    monkeypatch.setattr(entry.importlib, "import_module", absent)
    assert not any(n.startswith(("p5", "p6", "p7", "p8")) for n in entry.queries()) and "p4_found" in entry.queries()
    monkeypatch.setattr(entry.importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):  # a missing library doesn't shrink the queries in silence
        entry.queries()
