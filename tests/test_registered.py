"""Registered queries against DuckDB on the smallest tables."""

import ast
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as registered
from conftest import SMALL

# Statements of the text operators have their tests beside those.
NAMES = sorted(n for n in registered.oracle_sql() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"create view {file.split('.')[0]} as select * from '{SMALL}/{file}'")
    return con


def _table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(repr(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(picked)


def test_every_statement_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, duck, name):
    df = registered.queries()[name](spark, SMALL)
    cursor = duck.execute(registered.oracle_sql()[name])
    want = _table([c[0] for c in cursor.description], cursor.fetchall())
    assert _table(df.columns, [tuple(r) for r in df.collect()]) == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_loaded_columns_are_not_sorted(spark):
    """A least text beside distinct counts had every row copied per column and sorted."""
    assert "Expand" not in _plan(registered.queries()["raw_csv_load_columns"](spark, SMALL))


def test_arriving_versions_have_files_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(registered, "FILE_ROWS", 100)
    tables = registered.Tables(spark, SMALL)
    paths, path = [], tables.path
    monkeypatch.setattr(tables, "path", lambda name: paths.append(path(name)) or paths[-1])
    orders = tables.order_text
    tables.change_stream("orders", [orders, orders.limit(10)])
    count = orders.count()
    read = spark.read.parquet(paths[0]).filter("version = 1")
    assert count > 300 and read.count() == count and len(read.inputFiles()) >= count // 100


def test_model_queries_join_the_orders_once(spark):
    tables = registered.Tables(spark, SMALL)
    assert "Join" in _plan(tables.demand_train) and "Join" not in _plan(tables.demand_train_stored)
    assert "Join" not in _plan(tables.demand_scoring_stored)
    assert tables.demand_train_stored.exceptAll(tables.demand_train).isEmpty()


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_queries_without_the_text_package(tmp_path):
    """A copy without the package still lists, and checks, all other queries."""
    root = os.path.dirname(os.path.abspath(registered.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", "*.md"))
    code = "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    listed, checked = map(ast.literal_eval, done.stdout.splitlines()[-2:])
    core = [n for n in registered.queries() if not n.startswith("op") and n != "pipeline"]
    assert listed == sorted(core) and set(checked) <= set(listed)
