"""The load on hand-written staging rows, and what must hold for any batch."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from staffloom import fixedvalues as V
from staffloom.plans import load
from staffloom.sources import schemas, tables
from staffloom.sources.fixtures import AS_OF, AS_OF_TS, RUN_ID, Fixtures

MORNING = dt.datetime(2024, 1, 2)
BASE = {
    "source_system": "S",
    "first_name": "Ann",
    "last_name": "Lee",
    "email": "ann@x.com",
    "hire_date_raw": "2020-01-15",
    "salary_raw": "50000",
    "department_id_raw": "1",
    "status_raw": "A",
    "ingested_at": dt.datetime(2024, 1, 1),
    "updated_at": MORNING,
}
CLOCK = {"as_of": "2024-01-15", "as_of_ts": "2024-01-31 00:00:00"}


def staged(spark, *rows):
    """Rows like BASE but for what each names; `n` is the source record id."""
    data = [{**BASE, "email": f"a{r['n']}@x.com", **r} for r in rows]
    for r in data:
        r["source_employee_id"] = str(r.pop("n"))
    return tables.literal_rows(spark, schemas.STAGING, data)


def before(spark, employees=(), departments=((1, "Sales"), (5, "HR")), enriched=None):
    people = [
        {
            "employee_id": i,
            "first_name": "Old",
            "last_name": "Name",
            "email": email,
            "hire_date": dt.date(2010, 1, 1),
            "salary": Decimal("1.00"),
            "department_id": 1,
            "status": "Active",
            "created_at": dt.datetime(2010, 1, 1),
        }
        for i, email in employees
    ]
    empty = schemas.EMPLOYEES.empty(spark)
    named = [{"department_id": i, "department_name": n} for i, n in departments]
    return load.Tables(
        tables.literal_rows(spark, schemas.EMPLOYEES, people) if people else empty,
        tables.literal_rows(spark, schemas.DEPARTMENTS, named),
        enriched if enriched is not None else schemas.ENRICHED.empty(spark),
        schemas.REJECTS.empty(spark),
    )


def run(spark, staging, tables_before=None, **how):
    return load.Load(staging, tables_before or before(spark), "r1", **{**CLOCK, **how})


def outcome(job):
    """Source record id -> list of (reason or None)."""
    out = {}
    for r in job.judged.collect():
        out.setdefault(r.source_employee_id, []).append(r.rejection_reason)
    return {k: sorted(v, key=str) for k, v in out.items()}


def test_each_field_is_judged(spark):
    cases = {
        1: ({}, None),
        2: ({"first_name": "  "}, "Missing required name fields"),
        3: ({"hire_date_raw": "15/01/2020"}, None),
        4: ({"hire_date_raw": "01-15-2020"}, None),
        5: ({"hire_date_raw": "2020/01/15"}, "Invalid or missing hire date"),
        6: ({"hire_date_raw": "2024-02-30"}, "Invalid or missing hire date"),
        7: ({"salary_raw": "$1,200.50"}, None),
        8: ({"salary_raw": "12.345"}, "Invalid salary format"),
        9: ({"salary_raw": "-5"}, "Salary cannot be negative"),
        10: ({"salary_raw": "123456789.00"}, "Invalid salary format"),
        11: ({"email": "bad"}, "Invalid email format"),
        12: ({"email": None}, None),
        13: ({"email": " ANN@X.COM "}, None),
        14: ({"last_name": None, "salary_raw": "n/a"}, "Missing required name fields"),
        15: ({"salary_raw": None}, "Invalid salary format"),
    }
    staging = staged(spark, *[{"n": n, **change} for n, (change, _) in cases.items()])
    job = run(spark, staging)
    assert outcome(job) == {str(n): [reason] for n, (_, reason) in cases.items()}
    kept = {r.source_employee_id: r for r in load.survivors(job.judged).collect()}
    assert {kept[n].hire_date for n in ("1", "3", "4")} == {dt.date(2020, 1, 15)}
    assert kept["7"].salary == Decimal("1200.50")
    assert kept["12"].business_key == "S|12|NA|Ann|Lee"
    assert kept["13"].email == "ann@x.com"


def test_duplicates(spark):
    later = {"updated_at": dt.datetime(2024, 1, 3)}
    staging = staged(
        spark,
        {"n": 15},
        {"n": 15, **later, "salary_raw": "60000"},
        {"n": 16},
        {"n": 16, **later, "salary_raw": "n/a"},
        {"n": 17, "updated_at": None, "ingested_at": dt.datetime(2024, 5, 1), "status_raw": "n"},
        {"n": 17},
        {"n": 18},
        {"n": 18},
        {"n": 18},
    )
    job = run(spark, staging)
    again = "Duplicate source record in batch"
    assert outcome(job) == {
        "15": [again, None],
        # The newest row is invalid: the older valid one goes as a duplicate.
        "16": [again, "Invalid salary format"],
        "17": [again, None],
        "18": [again, again, None],
    }
    kept = {r.source_employee_id: r for r in load.survivors(job.judged).collect()}
    assert kept["15"].salary == 60000
    assert kept["17"].standardized_status == "Inactive"


def test_departments_are_resolved(spark):
    staging = staged(
        spark,
        {"n": 18, "department_id_raw": "999", "department_name_raw": " sales "},
        {"n": 19, "department_id_raw": "999", "department_name_raw": "Brand New"},
        {"n": 20, "department_id_raw": "x", "department_name_raw": None},
        {"n": 21, "department_id_raw": "5", "department_name_raw": "Brand new"},
    )
    job = run(spark, staging)
    got = {r.source_employee_id: (r.department_id, r.department_name) for r in job.final.collect()}
    assert got == {
        "18": (1, "Sales"),
        "19": (6, "Brand New"),
        "20": (0, "Unknown"),
        "21": (5, "HR"),
    }
    assert [
        (r.department_id, r.department_name, r.location)
        for r in job.departments.orderBy("department_id").collect()
    ] == [
        (0, "Unknown", "N/A"),
        (1, "Sales", None),
        (5, "HR", None),
        (6, "Brand New", "Auto-Discovered"),
    ]


def test_a_department_name_used_twice_means_the_smallest_id(spark):
    staging = staged(spark, {"n": 1, "department_id_raw": "x", "department_name_raw": "HR"})
    tables_before = before(spark, departments=((9, "hr"), (5, "Hr")))
    job = run(spark, staging, tables_before)
    assert [(r.department_id, r.department_name) for r in job.final.collect()] == [(5, "Hr")]


def test_known_employees_keep_mail_and_creation(spark):
    staging = staged(
        spark, {"n": 1, "email": "Seven@X.com", "first_name": "New"}, {"n": 2, "email": "n@x.com"}
    )
    tables_before = before(spark, employees=((7, "SEVEN@x.com"), (8, "other@x.com")))
    job = run(spark, staging, tables_before)
    got = {r.employee_id: r for r in job.employees.collect()}
    # Numbers run over all survivors in key order: the new row is the second.
    assert sorted(got) == [7, 8, 10]
    assert (got[7].first_name, got[7].email) == ("New", "SEVEN@x.com")
    assert got[7].created_at == dt.datetime(2010, 1, 1)
    assert got[8].first_name == "Old"
    assert got[10].created_at == dt.datetime(2024, 1, 31)


def test_a_shared_new_mail_is_one_employee(spark):
    staging = staged(
        spark,
        {"n": 1, "email": "s@x.com", "salary_raw": "100"},
        {"n": 1, "email": "s@x.com", "salary_raw": "200", "source_system": "T"},
        {"n": 3, "email": None},
        {"n": 4, "email": None},
    )
    job = run(spark, staging)
    people = job.employees.orderBy("employee_id").collect()
    assert [(r.employee_id, r.email, r.salary) for r in people] == [
        (1, "s@x.com", 200),
        (2, None, 50000),
        (3, None, 50000),
    ]
    assert sorted(r.employee_id for r in job.enriched.collect()) == [1, 2, 3, 4]


def test_a_shared_known_mail_is_one_enriched_row(spark):
    staging = staged(
        spark,
        {"n": 1, "email": "s@x.com", "salary_raw": "100"},
        {"n": 1, "email": "s@x.com", "salary_raw": "200", "source_system": "T"},
    )
    job = run(spark, staging, before(spark, employees=((7, "s@x.com"),)))
    assert [(r.employee_id, r.salary, r.source_system) for r in job.enriched.collect()] == [
        (7, 200, "T")
    ]
    assert [(r.employee_id, r.salary) for r in job.employees.collect()] == [(7, 200)]


def test_enrichment(spark):
    staging = staged(
        spark,
        {"n": 1, "salary_raw": "39999.99", "hire_date_raw": "2022-01-15"},
        {"n": 2, "salary_raw": "40000", "hire_date_raw": "2022-01-16"},
        {"n": 3, "salary_raw": "150000", "department_id_raw": "5"},
        {"n": 4, "salary_raw": "0", "department_id_raw": "x"},
    )
    got = {r.source_employee_id: r for r in run(spark, staging).final.collect()}
    assert [got[n].salary_band for n in "123"] == ["L1", "L2", "L5"]
    assert (got["1"].tenure_bucket, got["2"].tenure_bucket) == ("2-4y", "0-1y")
    assert got["1"].compensation_index == Decimal("1.0000")
    assert got["2"].compensation_index == Decimal("1.0000")
    assert got["4"].compensation_index is None


def test_rejects_are_numbered_after_the_log(spark):
    old = tables.literal_rows(
        spark,
        schemas.REJECTS,
        [{"reject_id": 40, "run_id": "r0", "rejection_reason": "x", "rejected_at": MORNING}],
    )
    tables_before = before(spark)
    tables_before = load.Tables(
        tables_before.employees, tables_before.departments, tables_before.enriched, old
    )
    staging = staged(spark, {"n": 1, "email": " BAD "}, {"n": 2}, {"n": 2}, {"n": 3})
    got = run(spark, staging, tables_before).new_rejects.orderBy("reject_id").collect()
    assert [(r.reject_id, r.run_id, r.email, r.rejection_reason) for r in got] == [
        (41, "r1", "bad", "Invalid email format"),
        (42, "r1", "a2@x.com", "Duplicate source record in batch"),
    ]
    assert {r.rejected_at for r in got} == {dt.datetime(2024, 1, 31)}


def test_audit_row(spark):
    staging = staged(spark, {"n": 1}, {"n": 1}, {"n": 2, "salary_raw": "x"}, {"n": 3})
    row = run(spark, staging).audit_row.collect()
    assert len(row) == 1
    got = row[0]
    assert (got.source_row_count, got.rejected_row_count, got.loaded_row_count) == (4, 2, 2)
    assert got.status == "FAILED" and got.process_name == "employee_etl_enrichment"
    done = run(spark, staging, final_status="SUCCESS").audit_row.first()
    assert done.status == "SUCCESS"


def test_close_run_touches_only_its_run(spark):
    moment = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    audit = load.open_run(spark, "a", moment).unionByName(load.open_run(spark, "b", moment))
    counts = spark.createDataFrame([(3, 1, 2)], "_source long, _rejected long, _loaded long")
    got = {r.run_id: r for r in load.close_run(audit, "a", counts, moment).collect()}
    assert (got["a"].status, got["a"].source_row_count) == ("FAILED", 3)
    assert (got["b"].status, got["b"].source_row_count) == ("RUNNING", 0)


def test_publish_and_read_back(spark, tmp_path):
    staging = staged(spark, {"n": 1}, {"n": 2, "salary_raw": "x"})
    folder = str(tmp_path)
    run(spark, staging).publish(folder)
    audit = tables.read_table(spark, f"{folder}/etl_run_audit", schemas.RUN_AUDIT)
    log = tables.read_table(spark, f"{folder}/etl_employee_rejects", schemas.REJECTS)
    enriched = spark.read.parquet(f"{folder}/snapshots/r1/employee_enriched_target")
    assert load.run_audit_of(audit, "r1").count() == 1
    assert [r.rejection_reason for r in load.rejects_of(log, "r1").collect()] == [
        "Invalid salary format"
    ]
    assert load.newest_enriched_first(enriched).first().employee_id == 1
    with pytest.raises(ValueError, match="already published"):
        run(spark, staging).publish(folder)


def test_a_second_load_reads_what_the_first_published(spark, tmp_path):
    folder = str(tmp_path)
    nothing = load.published(spark, folder)
    assert nothing.employees.isEmpty() and nothing.departments.isEmpty()
    staging = staged(spark, {"n": 1, "email": "one@x.com"}, {"n": 2, "salary_raw": "x"})
    run(spark, staging, nothing).publish(folder)
    before = load.published(spark, folder)
    assert before.employees.count() == 1 and before.rejects.count() == 1
    again = load.Load(staging, before, "r2", "2024-01-01", "2024-02-01 00:00:00")
    again.publish(folder)
    after = load.published(spark, folder)
    assert [r.employee_id for r in after.employees.collect()] == [1]
    assert {r.etl_run_id for r in after.enriched.collect()} == {"r2"}
    assert sorted(r.reject_id for r in after.rejects.collect()) == [1, 2]


def test_a_repeated_publish_without_rejects_clears_them(spark, tmp_path):
    path = f"{tmp_path}/log"
    rows = tables.literal_rows(spark, schemas.REJECTS, [{"reject_id": 1, "run_id": "a:b/c", "rejection_reason": "x", "rejected_at": MORNING}])
    tables.replace_part(rows, path, "run_id", "a:b/c")
    tables.replace_part(rows.withColumn("run_id", F.lit("d")), path, "run_id", "d")
    read = tables.read_table(spark, path, schemas.REJECTS)
    assert sorted(r.run_id for r in read.collect()) == ["a:b/c", "d"]
    tables.replace_part(rows.limit(0), path, "run_id", "a:b/c")
    assert [r.run_id for r in tables.read_table(spark, path, schemas.REJECTS).collect()] == ["d"]


def test_few_and_many_new_departments_get_the_same_ids(spark, ws, monkeypatch):
    known = before(spark).departments
    names = spark.createDataFrame([(f"New {i % 30}",) for i in range(90)] + [(None,)], "department_name string")
    few = rows_of(load.changes.discover_departments(names, known, ws))
    monkeypatch.setattr(load.changes, "FEW_ROWS", 0)
    assert rows_of(load.changes.discover_departments(names, known, ws)) == few and len(few) == 30


def test_inserted_employees_are_counted(spark):
    tables_before = before(spark, employees=((7, "seven@x.com"),))
    staging = staged(spark, {"n": 1, "email": "seven@x.com"}, {"n": 2}, {"n": 3})
    counted = run(spark, staging, tables_before).counted_departments
    assert sum(r.employee_count for r in counted.collect()) == 2 * V.COUNTER_STEP


def test_publishing_counts_and_stamps(spark, tmp_path):
    """What row triggers would do is in what is published, and a second load goes on from it."""
    folder = str(tmp_path)
    tables_before = before(spark, employees=((7, "seven@x.com"), (8, "eight@x.com")))
    run(spark, staged(spark, {"n": 1, "email": "seven@x.com"}, {"n": 2}), tables_before).publish(folder)
    after = load.published(spark, folder)
    stamps = {r.employee_id: r.updated_at for r in after.employees.collect()}
    assert stamps == {7: dt.datetime(2024, 1, 31), 8: None, 10: None}
    counts = {r.department_id: r.employee_count for r in after.departments.collect()}
    assert counts == {0: 0, 1: V.COUNTER_STEP, 5: 0}
    more = staged(spark, {"n": 3, "email": "eight@x.com"}, {"n": 4}, {"n": 5, "department_id_raw": "5"})
    load.Load(more, after, "r2", "2024-01-01", "2024-02-01 00:00:00").publish(folder)
    last = load.published(spark, folder)
    stamps = {r.employee_id: r.updated_at for r in last.employees.collect()}
    assert stamps[7] == dt.datetime(2024, 1, 31) and stamps[8] == dt.datetime(2024, 2, 1)
    counts = {r.department_id: r.employee_count for r in last.departments.collect()}
    assert counts == {0: 0, 1: 2 * V.COUNTER_STEP, 5: V.COUNTER_STEP}


def test_run_ids(spark):
    ids = iter(["first", "second"])
    staging, tables_before = staged(spark, {"n": 1}), before(spark)
    made = [load.Load(staging, tables_before, new_run_id=lambda: next(ids)) for _ in range(2)]
    assert [job.run_id for job in made] == ["first", "second"]
    assert {job.audit_row.first().run_id for job in made} == {"first", "second"}
    assert load.Load(staging, tables_before).run_id != load.Load(staging, tables_before).run_id


def test_lookups_run_once_and_planning_takes_few_jobs(spark):
    """Resolving is settled with the ids; what reads it reads one table."""
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    enriched = schemas.ENRICHED.empty(spark)
    tables_before = load.Tables(fx.employees_before(), fx.departments(), enriched, fx.rejects())
    fx.staging()
    tracker = spark.sparkContext.statusTracker()
    for name, most in (("final", 35), ("employees", 37), ("enriched", 39)):
        started = len(tracker.getJobIdsForGroup(None))
        job = load.Load(fx.staging(), tables_before, RUN_ID, AS_OF, AS_OF_TS)
        text = getattr(job, name)._jdf.queryExecution().executedPlan().toString()
        assert len(tracker.getJobIdsForGroup(None)) - started <= most
        assert "_by_name" not in text and "_by_id" not in text


def test_a_broken_publish_is_repeated(spark, tmp_path, monkeypatch):
    staging = staged(spark, {"n": 1}, {"n": 2, "salary_raw": "x"})
    folder = str(tmp_path)
    other = tables.literal_rows(
        spark,
        schemas.REJECTS,
        [{"reject_id": 1, "run_id": "007", "rejection_reason": "x", "rejected_at": MORNING}],
    )
    alone = f"{folder}/alone"
    tables.replace_part(other, alone, "run_id", "007")
    read = tables.read_table(spark, alone, schemas.REJECTS)
    assert [r.run_id for r in load.rejects_of(read, "007").collect()] == ["007"]
    tables.replace_part(other, f"{folder}/etl_employee_rejects", "run_id", "007")

    def lost(*_):
        raise RuntimeError("lost before the audit row")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(load, "append_to", lost)
        run(spark, staging).publish(folder)
    run(spark, staging).publish(folder)
    log = tables.read_table(spark, f"{folder}/etl_employee_rejects", schemas.REJECTS)
    assert sorted(r.run_id for r in log.collect()) == ["007", "r1"]
    audit = tables.read_table(spark, f"{folder}/etl_run_audit", schemas.RUN_AUDIT)
    assert audit.count() == 1


def test_an_empty_batch(spark):
    job = run(spark, schemas.STAGING.empty(spark), before(spark, employees=((7, "a@x.com"),)))
    assert [r.employee_id for r in job.employees.collect()] == [7]
    assert job.new_rejects.count() == 0 and job.enriched.count() == 0
    assert job.audit_row.first().source_row_count == 0


@pytest.fixture(scope="module")
def fixture_job(spark):
    fx = Fixtures(spark, "/root/testdata/sf0.001")
    tables_before = load.Tables(
        fx.employees_before(),
        fx.departments(),
        schemas.ENRICHED.empty(spark),
        fx.rejects(),
    )
    job = load.Load(fx.staging(), tables_before, RUN_ID, AS_OF, AS_OF_TS, "SUCCESS")
    return fx, tables_before, job


def test_every_source_row_ends_once(fixture_job):
    fx, _, job = fixture_job
    source = fx.staging().count()
    assert load.survivors(job.judged).count() + job.new_rejects.count() == source
    assert job.judged.filter("kept = (rejection_reason IS NOT NULL)").count() == 0
    keys = job.judged.filter("is_latest").groupBy("business_key").count()
    assert keys.filter("count <> 1").count() == 0


def test_ids_are_unique(fixture_job):
    _, _, job = fixture_job
    for table, key in (
        (job.employees, "employee_id"),
        (job.enriched, "employee_id"),
        (job.departments, "department_id"),
        (job.new_rejects, "reject_id"),
    ):
        assert table.groupBy(key).count().filter("count > 1").count() == 0
    mails = job.employees.filter("email IS NOT NULL").groupBy("email").count()
    assert mails.filter("count > 1").count() == 0


def test_a_second_run_changes_nothing(spark, ws, fixture_job):
    fx, first, job = fixture_job
    employees = ws.settle(job.employees, "employees")
    mailed = fx.staging().filter("email IS NOT NULL")
    second = load.Load(
        mailed,
        load.Tables(employees, job.departments, job.enriched, first.rejects),
        RUN_ID,
        AS_OF,
        AS_OF_TS,
    )
    assert rows_of(second.employees) == rows_of(employees)
    assert second.departments.count() == job.departments.count()


def test_large_path_equals_small_path(spark, request, fixture_job):
    fx, tables_before, job = fixture_job
    expected = [rows_of(t) for t in (job.employees, job.enriched, job.new_rejects)]
    request.getfixturevalue("no_broadcast")
    large = load.Load(
        fx.staging(), tables_before, RUN_ID, AS_OF, AS_OF_TS, "SUCCESS", hot_rows=1
    )
    assert [rows_of(t) for t in (large.employees, large.enriched, large.new_rejects)] == expected


@pytest.mark.parametrize("small", [True, False])
def test_evolved_tables_keep_their_columns_and_types(spark, request, small):
    """Columns added, types widened and narrow ids survive a load."""
    if not small:
        request.getfixturevalue("no_broadcast")
    plain = before(spark, employees=((7, "seven@x.com"), (8, "eight@x.com")))
    rich = Decimal("123456789012.00")
    employees = plain.employees.withColumns(
        {
            "employee_id": F.col("employee_id").cast("int"),
            "phone_number": F.lit("5550100"),
            "salary": F.when(F.col("employee_id") == 8, rich)
            .otherwise(F.col("salary"))
            .cast("decimal(14,2)"),
        }
    )
    departments = plain.departments.withColumns(
        {"department_id": F.col("department_id").cast("int"), "employee_count": F.lit(3)}
    ).drop("manager_id")
    tables_before = load.Tables(employees, departments, plain.enriched, plain.rejects)
    staging = staged(
        spark,
        {"n": 1, "email": "seven@x.com"},
        {"n": 2, "department_id_raw": "x", "department_name_raw": "Ops"},
    )
    job = run(spark, staging, tables_before)
    assert job.employees.schema.simpleString() == employees.schema.simpleString()
    got = {r.employee_id: (r.phone_number, r.salary) for r in job.employees.collect()}
    assert got == {7: ("5550100", 50000), 8: ("5550100", rich), 10: (None, 50000)}
    assert dict(job.departments.dtypes)["department_id"] == "int"
    counts = {r.department_id: r.employee_count for r in job.departments.collect()}
    assert counts == {0: None, 1: 3, 5: 3, 6: None}


def test_publish_works_out_a_large_batch_once(spark, tmp_path, no_broadcast):
    """Counters and stamps read the changes of a batch beyond the broadcast limit as settled."""
    old = before(spark, [(7, "a1@x.com")])
    job = load.Load(staged(spark, {"n": 1}, {"n": 2}), old, "r1", **CLOCK, final_status="SUCCESS")
    assert not job.small_batch
    job.publish(str(tmp_path / "lake"))
    plan = job._employee_changes._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Relation" in plan
    after = load.published(spark, str(tmp_path / "lake"))
    assert rows_of(after.employees.select("email")) == rows_of(job.employees.select("email"))
