"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from oracle.fixtures import TABLES
from staffloom.registry import QUERIES
from staffloom.sources.fixtures import Fixtures

FOLDER = "/root/testdata/sf0.001"
GIVEN = ("nation", "customer", "orders", "lineitem", "events")
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted((tuple(map(str, r)) for r in zip(*columns)))


def _compare(ours, theirs):
    assert _rows(ours) == _rows(theirs)
    assert {f.name: str(f.type) for f in ours.schema} == {
        f.name: str(f.type) for f in theirs.schema
    }


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    _compare(QUERIES[name](spark, FOLDER).toArrow(), duck.sql(SQL[name]).to_arrow_table())


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(entry_points.queries())


def test_fixtures_agree(spark, duck):
    fx = Fixtures(spark, FOLDER)
    pairs = {
        "fx_departments": fx.departments,
        "fx_employees": fx.employees,
        "fx_employees_before": fx.employees_before,
        "fx_enriched": fx.enriched,
        "fx_rejects": fx.rejects,
        "fx_audit": fx.audit,
        "fx_staging": fx.staging,
        "fx_changes": fx.changes,
        "fx_hires": fx.hires,
    }
    ctes = ", ".join(f"{n} AS ({q})" for n, (_, q) in TABLES.items())
    for name, ours in pairs.items():
        theirs = duck.sql(f"WITH {ctes} SELECT * FROM {name}").to_arrow_table()
        _compare(ours().toArrow(), theirs)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
