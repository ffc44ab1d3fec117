"""The two reports: literal defaults, both rank paths, brute-force spot checks."""

from __future__ import annotations

from collections import Counter

import pytest

from conftest import rows_of
from staffloom import fixedvalues as V
from staffloom.plans import views
from staffloom.plans.department_dashboard import department_dashboard
from staffloom.plans.employee_report import employee_report, latest_enriched, latest_run
from staffloom.sources.fixtures import AS_OF, AS_OF_TS, Fixtures
from staffloom.sources.workspace import Workspace


@pytest.fixture(scope="module")
def inputs(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    ws = Workspace(spark)
    names = ("employees", "departments", "enriched", "rejects", "audit")
    return tuple(ws.settle(getattr(fx, n)(), n) for n in names)


CLOCK = {"as_of": AS_OF, "as_of_ts": AS_OF_TS}


def test_report_by_ranges_equals_report_by_windows(inputs, ws, request):
    small = rows_of(employee_report(*inputs, ws, **CLOCK))
    assert len(small) > 100
    assert rows_of(employee_report(*inputs, ws, **CLOCK, hot_rows=5)) == small
    request.getfixturevalue("no_broadcast")
    assert rows_of(employee_report(*inputs, ws, **CLOCK, hot_rows=5)) == small


def test_report_with_more_hot_keys_than_can_be_listed(inputs, ws, request, monkeypatch):
    from staffloom.operators import hotkeys

    small = rows_of(employee_report(*inputs, ws, **CLOCK))
    request.getfixturevalue("no_broadcast")
    monkeypatch.setattr(hotkeys, "LISTED_KEYS", 5)
    monkeypatch.setattr(hotkeys, "hot_parts_of", None)
    assert rows_of(employee_report(*inputs, ws, **CLOCK, hot_rows=5)) == small


def test_dashboard_both_ways(inputs, ws, request):
    how = {**CLOCK, "min_active_ratio_pct": 0}
    small = rows_of(department_dashboard(*inputs, ws, **how))
    staffed = Counter(r.department_id for r in inputs[0].select("department_id").collect())
    assert len(small) == sum(n >= V.DASHBOARD_MIN_EMPLOYEES for n in staffed.values())
    request.getfixturevalue("no_broadcast")
    assert rows_of(department_dashboard(*inputs, ws, **how, hot_rows=5)) == small


def test_reports_are_empty_without_a_run(inputs, ws):
    nothing = {**CLOCK, "run_status": "NEVER"}
    assert employee_report(*inputs, ws, **nothing).count() == 0
    assert department_dashboard(*inputs, ws, **nothing, min_active_ratio_pct=0).count() == 0


def test_dashboard_default_is_out_of_reach(inputs, ws):
    assert department_dashboard(*inputs, ws, **CLOCK).count() == 0


def test_view_default_status_is_never_loaded(inputs):
    employees, departments, *_ = inputs
    assert views.active_employees(employees, departments).count() == 0
    assert views.active_employees(employees, departments, "Active").count() > 0


def test_latest_run_skips_failed_runs(inputs):
    audit = inputs[4]
    row = latest_run(audit).collect()
    best = max((r.finished_at, r.run_id) for r in audit.collect() if r.status == "SUCCESS")
    assert [(r.finished_at, r.run_id) for r in row] == [best]


def test_latest_enriched_is_the_second_version(inputs):
    rows = latest_enriched(inputs[2]).collect()
    assert {r.etl_run_id for r in rows} == {"run-1"}
    assert len(rows) == inputs[2].count() // 2


def test_ranks_come_before_the_filters(inputs, ws):
    """The best paid of a department may be filtered out; nobody moves up."""
    report = employee_report(*inputs, ws, **CLOCK).select("department_id", "dept_salary_rank")
    best = report.groupBy("department_id").agg({"dept_salary_rank": "min"}).collect()
    assert any(r[1] > 1 for r in best)


def test_the_order_of_the_report(inputs, ws):
    rows = employee_report(*inputs, ws, **CLOCK).collect()
    keys = [
        (r.geo_region, r.department_name, -r.effective_salary, r.employee_name) for r in rows
    ]
    assert keys == sorted(keys)
