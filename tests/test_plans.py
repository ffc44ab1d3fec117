"""What the plans must and must not hold."""

from __future__ import annotations

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from staffloom.operators.numbering import rank_in_groups
from staffloom.plans import employee_report as report
from staffloom.plans import load, views
from staffloom.registry import QUERIES
from staffloom.sources import schemas
from staffloom.sources.fixtures import AS_OF, AS_OF_TS, RUN_ID, Fixtures

FOLDER = "/root/testdata/sf0.001"
LIBRARY = pathlib.Path(__file__).parent.parent / "staffloom"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def job(spark):
    fx = Fixtures(spark, FOLDER)
    tables = load.Tables(
        fx.employees_before(), fx.departments(), schemas.ENRICHED.empty(spark), fx.rejects()
    )
    return load.Load(fx.staging(), tables, RUN_ID, AS_OF, AS_OF_TS)


def test_no_row_scale_work_in_one_partition(job):
    for name in ("employees", "enriched"):
        assert "SinglePartition" not in plan(getattr(job, name)), name


def test_one_partition_only_after_partial_aggregates(job):
    """One-row aggregates and per-partition counts may meet in one task."""
    text = plan(job.new_rejects)
    for line_no, line in enumerate(lines := text.splitlines()):
        if "Exchange SinglePartition" in line:
            below = " ".join(lines[line_no + 1 : line_no + 3])
            assert "partial_" in below or "HashAggregate" in below, text


def test_survivors_read_no_raw_text(job):
    text = plan(load.survivors(job.judged))
    assert re.search(r"PushedFilters: \[.*kept", text)
    assert "_raw" not in re.search(r"ReadSchema: struct<([^>]*)", text).group(1)


@pytest.mark.parametrize("copies", [1, 3_000])
def test_dedupe_reads_the_settled_rows_twice(spark, ws, monkeypatch, copies):
    """Whatever the skew: one scan for the newest rows, cut before the shuffle, one for all."""
    monkeypatch.setattr("staffloom.operators.hotkeys.HOT_ROWS", 10)
    staging = Fixtures(spark, FOLDER).staging()
    one = staging.filter("source_employee_id IS NOT NULL").orderBy("source_employee_id", "ingested_at").limit(1)
    more = one.select("*", F.explode(F.array_repeat(F.lit(0), copies)).alias("i")).drop("i")
    judged = load.judge(staging.unionByName(more), load.now(AS_OF_TS), ws)
    text = plan(judged)
    assert text.count("FileScan parquet") == 2
    assert text.count("Exchange hashpartitioning(business_key") == 1
    assert "Window" not in text
    before = text.split("Exchange hashpartitioning(business_key")[1]
    assert "partial_min" in before
    rows = judged.groupBy("business_key").agg(F.count_if("is_latest").alias("n"))
    assert rows.filter("n <> 1").isEmpty() and judged.count() == staging.count() + copies


def test_reject_ids_need_no_range_shuffle_of_rows(spark, ws):
    """Only keys, times and row numbers are put in order, in a settled table of their own."""
    fx = Fixtures(spark, FOLDER)
    judged = ws.settle(load.judge(fx.staging(), load.now(AS_OF_TS), ws), "judged")
    added = load.rejects(judged, RUN_ID, load.now(AS_OF_TS), fx.rejects(), ws)
    assert "rangepartitioning" not in plan(added)
    top = max(r.reject_id for r in fx.rejects().select("reject_id").collect())
    ids = sorted(r.reject_id for r in added.select("reject_id").collect())
    assert ids == list(range(top + 1, top + 1 + len(ids))) and ids


def test_ranks_sort_no_rows(spark, ws):
    """Values are ranked; of the rows only those that straddle a border are ordered."""
    fx = Fixtures(spark, FOLDER)
    people = ws.settle(fx.employees(), "people")
    text = plan(rank_in_groups(people, "department_id", "salary", "employee_id", ws))
    assert text.count("Window") >= 1
    for part in text.split("Window ")[1:]:
        assert "row_number() windowspecdefinition(_of" in part[:200].replace("[", "")
    whole = text.split("Union")[1].split("Window ")[0]
    assert "Sort " not in whole and "Exchange hashpartitioning" not in whole


def test_latest_version_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["latest_enriched"](spark, FOLDER))
    before = text.split("Exchange hashpartitioning(employee_id")[1]
    assert "WindowGroupLimit" in before


def test_filters_and_columns_reach_the_scan(spark, ws):
    employees = ws.settle(Fixtures(spark, FOLDER).employees(), "employees")
    text = plan(views.high_earners(employees))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(salary,", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in re.findall(r"\w+:\w+", schema)} == {
        "employee_id",
        "first_name",
        "last_name",
        "salary",
    }


def test_no_python_rows_and_no_whole_results_on_the_driver():
    banned = re.compile(
        r"\.collect\(|\.toPandas\(|\.toLocalIterator\(|\.rdd\b|localCheckpoint|\budf\(|pandas_udf"
        r"|foreachPartition"
    )
    for path in LIBRARY.rglob("*.py"):
        if "llm" in path.parts:  # text operators choose their style, see their own tests
            continue
        hit = banned.search(path.read_text())
        assert hit is None, f"{path}: {hit.group()}"


def test_the_report_joins_as_planned(spark, ws):
    """One-row run beside all rows; small lookups broadcast; no rows shuffled by department."""
    fx = Fixtures(spark, FOLDER)
    names = ("employees", "departments", "enriched", "rejects", "audit")
    given = [ws.settle(getattr(fx, n)(), n) for n in names]
    text = plan(report.employee_report(*given, ws, AS_OF, AS_OF_TS))
    assert text.count("BroadcastNestedLoopJoin") == 1 and "CartesianProduct" not in text
    assert text.count("Exchange hashpartitioning(department_id") == 0
    assert "SortMergeJoin [department_id" not in text
    assert "SortMergeJoin [source_system" not in text


def test_departments_are_summed_before_they_are_named(spark, ws):
    fx = Fixtures(spark, FOLDER)
    employees = ws.settle(fx.employees(), "employees")
    text = plan(views.salary_summary(employees, fx.departments()))
    assert text.index("Join") < text.index("HashAggregate") < text.index("partial_sum(salary")
