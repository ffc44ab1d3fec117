"""Every query by name: (session, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffloom import fixedvalues as V
from staffloom.functions import cleaning, rules, scalar
from staffloom.functions.dates import complete_months, complete_years, now, today
from staffloom.operators import aggregates, changes, checks, evolve
from staffloom.operators.latest import latest_per_key
from staffloom.operators.lookup import lookup
from staffloom.operators.numbering import rank_in_groups
from staffloom.plans import department_dashboard as dashboard
from staffloom.plans import employee_report as report
from staffloom.plans import load, views
from staffloom.sources import buckets, schemas, tables
from staffloom.sources.fixtures import AS_OF, AS_OF_TS, RUN_ID, Fixtures
from staffloom.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The checked queries use values the fixtures reach where the literal default
# (see fixedvalues) selects nothing.
ACTIVE_PCT = 20
VIEW_STATUS = "Active"
HIRED_AFTER = "1999-01-01"
BUCKETS = 16


def query(fn: Callable[[Fixtures], DataFrame]) -> Callable:
    QUERIES[fn.__name__] = lambda spark, folder: fn(Fixtures(spark, folder))
    return fn


def _day():
    return today(AS_OF)


def _moment():
    return now(AS_OF_TS)


# --- samples and views ---------------------------------------------------------


@query
def scan_all(fx):
    return fx.employees()


@query
def high_earners(fx):
    return views.high_earners(fx.employees())


@query
def dept_having(fx):
    return views.large_groups(fx.employees())


@query
def emp_dept_join(fx):
    return views.employee_departments(fx.employees(), fx.departments())


@query
def active_employees(fx):
    return views.active_employees(fx.employees(), fx.departments(), VIEW_STATUS)


@query
def active_employees_literal(fx):
    return views.active_employees(fx.employees(), fx.departments())


@query
def salary_summary(fx):
    return views.salary_summary(fx.employees(), fx.departments())


@query
def employee_tenure(fx):
    return views.employee_details(fx.employees(), fx.departments(), AS_OF)


@query
def view_by_name(fx):
    views.publish_views(fx.employees(), fx.departments(), AS_OF)
    return fx.spark.sql(
        "SELECT department_name, count(*) AS employees, max(tenure_years) AS longest "
        "FROM employee_details_with_tenure GROUP BY department_name"
    )


def _beside_average(people):
    """Employees beside their department's average, which is aggregated first.

    Those without a department are a group too, so the key is boxed: a box is not NULL.
    """
    boxed = people.withColumn("_group", F.struct("department_id"))
    averages = Workspace(people.sparkSession).settle(
        boxed.groupBy("_group").agg(F.avg("salary").alias("dept_avg_salary")), "averages"
    )
    return lookup(boxed, averages, ["_group"], "employee_id").drop("_group")


# --- functions and rules -------------------------------------------------------


def _rated(fx):
    rating = F.nullif((F.col("employee_id") % 6).cast("int"), F.lit(0))
    return fx.employees().withColumn("rating", rating)


@query
def tenure_udf(fx):
    scalar.register_functions(fx.spark)
    return fx.employees().selectExpr(
        "employee_id", f"employee_tenure(hire_date, DATE '{AS_OF}') AS tenure"
    )


@query
def bonus_udf(fx):
    scalar.register_functions(fx.spark)
    return _rated(fx).select(
        "employee_id",
        scalar.bonus(F.col("salary"), F.col("rating")).alias("bonus"),
        F.expr("employee_bonus(salary, rating)").alias("bonus_in_sql"),
    )


@query
def service_years_months(fx):
    hired = F.col("hire_date")
    return fx.employees().select(
        "employee_id",
        complete_years(hired, _day()).alias("service_years"),
        complete_months(hired, _day()).alias("service_months"),
    )


@query
def status_rules(fx):
    standard = cleaning.standard_status(F.trim("status_raw"))
    return fx.staging().select(
        "source_employee_id",
        "ingested_at",
        "updated_at",
        standard.alias("standardized_status"),
        rules.report_status(standard).alias("report_label"),
        rules.dashboard_status(standard).alias("dashboard_label"),
        rules.dashboard_status(F.col("status_raw")).alias("raw_label"),
    )


@query
def band_rules(fx):
    years = complete_years(F.col("hire_date"), _day())
    salary = F.col("salary")
    return fx.employees().select(
        "employee_id",
        rules.salary_band(salary).alias("salary_band"),
        rules.compensation_tier(salary).alias("compensation_tier"),
        rules.tenure_bucket(years).alias("tenure_bucket"),
        rules.tenure_class(years).alias("tenure_class"),
        rules.tenure_stage(years).alias("tenure_stage"),
    )


@query
def geo_rules(fx):
    return fx.departments().select(
        "department_id",
        rules.report_region(F.col("location")).alias("geo_region"),
        rules.dashboard_region(F.col("location")).alias("geo_cluster"),
    )


@query
def quality_rules(fx):
    counted = aggregates.recent_rejects(fx.rejects(), _moment(), V.REPORT_REJECT_DAYS)
    return counted.select(
        "source_system",
        "source_employee_id",
        rules.quality_band(F.col("reject_count")).alias("source_quality_band"),
    )


@query
def hr_action_rules(fx):
    """The action on every employee, its department average beside it."""
    years = complete_years(F.col("hire_date"), _day())
    salary, average = F.col("salary"), F.col("dept_avg_salary")
    quality = rules.quality_band(F.nullif((F.col("employee_id") % 8).cast("int"), F.lit(0)))
    return _beside_average(fx.employees()).select(
        "employee_id",
        rules.percent_off_average(salary, average).alias("pct_vs_dept_avg"),
        rules.employee_action(years, salary, average, quality).alias("recommended_hr_action"),
    )


@query
def risk_rules(fx):
    """Every order as the inputs of the risk score, so that all branches occur."""
    k = F.col("o_orderkey")
    score = rules.risk_score(
        k % 25, k % 101, k * 7 % 101, F.col("o_totalprice").cast("decimal(10,2)") / 10
    )
    return fx.table("orders").select(
        k.alias("order_key"),
        score.cast("int").alias("risk_score_raw"),
        rules.risk_band(score).alias("risk_band"),
        rules.department_action(k % 9, k % 7, k * 7 % 101).alias("recommended_action"),
    )


# --- aggregates, windows, latest -----------------------------------------------


@query
def dept_salary_stats(fx):
    stats = aggregates.salary_statistics(fx.employees())
    spread = F.round(F.col("dept_salary_stddev").cast("decimal(20,6)"), 2)
    return stats.withColumn("dept_salary_stddev", spread.cast("decimal(20,2)"))


def _measures(fx, ws):
    facts = dashboard.employee_facts(
        fx.employees(),
        fx.enriched(),
        fx.rejects(),
        _day(),
        _moment(),
        V.DASHBOARD_REJECT_DAYS,
        ws,
    )
    return aggregates.department_measures(facts)


@query
def dept_kpis(fx):
    spread = F.round("salary_stddev", 2).cast("decimal(20,2)")
    return _measures(fx, Workspace(fx.spark)).withColumn("salary_stddev", spread)


def _global_ranks(fx, **how):
    ws = Workspace(fx.spark)
    return dashboard.score_departments(_measures(fx, ws), ws, **how).select(
        "department_id",
        "rank_by_avg_salary",
        "rank_by_data_rejects",
        "rank_by_low_activity",
        "risk_score_raw",
        "risk_band",
        "recommended_action",
    )


@query
def dept_global_ranks(fx):
    return _global_ranks(fx)


@query
def dept_global_ranks_sliced(fx):
    """The same by ranges of the measures, as for departments beyond one task."""
    return _global_ranks(fx, hot_rows=1)


@query
def reject_stats(fx):
    return aggregates.recent_rejects(fx.rejects(), _moment(), V.REPORT_REJECT_DAYS)


@query
def reject_stats_14d(fx):
    return aggregates.recent_rejects(fx.rejects(), _moment(), 14)


@query
def latest_enriched(fx):
    return report.latest_enriched(fx.enriched())


@query
def latest_run(fx):
    return report.latest_run(fx.audit())


def _ranked(fx, **how):
    people = fx.employees().select("employee_id", "department_id", "salary")
    ranked = rank_in_groups(
        people, "department_id", "salary", "employee_id", Workspace(fx.spark), **how
    )
    position = rules.salary_position(F.col("value_rank"), F.col("value_tile"))
    return ranked.select(
        "employee_id",
        "department_id",
        F.col("value_rank").alias("dept_salary_rank"),
        F.col("value_tile").alias("dept_salary_quartile"),
        position.alias("salary_position_label"),
    )


@query
def dept_rank_quartile(fx):
    largest = fx.employees().groupBy("department_id").count().agg(F.max("count")).first()[0]
    return _ranked(fx, largest_group=largest)


@query
def dept_rank_quartile_sliced(fx):
    """The same over ranges of the departments, as for departments beyond one task."""
    return _ranked(fx)


@query
def dept_avg_window(fx):
    """Compensation index: the department average is aggregated, then looked up."""
    people = fx.employees().select("employee_id", "department_id", "salary")
    index = rules.compensation_index(F.col("salary"), F.col("dept_avg_salary"))
    return _beside_average(people).withColumn("compensation_index", index)


# --- joins ---------------------------------------------------------------------


@query
def latest_version_join(fx):
    """Every employee beside the newest enriched version, if any."""
    wanted = ("employee_id", "etl_run_id", "source_system")
    newest = report.latest_enriched(fx.enriched()).select(*wanted)
    return fx.employees().select("employee_id").join(newest, "employee_id", "left")


def _source_lookup(fx, **how):
    counted = Workspace(fx.spark).settle(
        fx.rejects()
        .groupBy("source_system", "source_employee_id")
        .agg(F.count(F.lit(1)).alias("reject_count")),
        "counts",
    )
    newest = latest_per_key(fx.enriched(), ["employee_id"], [F.col("loaded_at").desc()])
    rows = newest.select("employee_id", "source_system", "source_employee_id")
    return lookup(rows, counted, ["source_system", "source_employee_id"], "employee_id", **how)


@query
def source_key_lookup(fx):
    """Enriched rows beside the rejects of their source record, on two keys."""
    return _source_lookup(fx)


@query
def source_key_lookup_salted(fx):
    """The same as for sides beyond the broadcast limit, repeated keys spread."""
    return _source_lookup(fx, hot_rows=5, small_rows=False, small_table=False)


@query
def folded_name_lookup(fx):
    """Raw records whose department name is known in whatever case."""
    known = fx.departments().groupBy(F.lower("department_name").alias("folded")).agg(
        F.min("department_id").alias("department_id")
    )
    rows = fx.staging().select(
        "source_employee_id",
        "updated_at",
        "department_name_raw",
        F.lower("department_name_raw").alias("folded"),
    )
    return lookup(rows, known, ["folded"], "source_employee_id").drop("folded")


@query
def distinct_department_names(fx):
    return _kept(fx).filter("department_name IS NOT NULL").select("department_name").distinct()


# --- staging -------------------------------------------------------------------


_TYPED = (
    "source_system",
    "source_employee_id",
    "first_name",
    "last_name",
    "email",
    "hire_date",
    "salary",
    "department_id_from_source",
    "department_name",
    "standardized_status",
    "event_ts",
    "ingested_at",
    "business_key",
)


@query
def stg_normalized(fx):
    return load.normalise(fx.staging(), _moment()).select(*_TYPED)


@query
def stg_validated(fx):
    checked = load.validate(load.normalise(fx.staging(), _moment()))
    return checked.select("business_key", "event_ts", "ingested_at", "reject_reason")


def _judged(fx, **how):
    return load.judge(fx.staging(), _moment(), Workspace(fx.spark), **how)


def _kept(fx):
    return load.survivors(_judged(fx))


@query
def stg_survivors(fx):
    return _kept(fx)


@query
def stg_survivors_salted(fx):
    """The same with more newest rows than can be broadcast: both sides meet by row number."""
    return load.survivors(_judged(fx, large=True))


@query
def stg_rejects(fx):
    return load.rejects(_judged(fx), RUN_ID, _moment(), fx.rejects(), Workspace(fx.spark))


@query
def rejects_readback(fx):
    """A run's rejects read back out of the log they were appended to."""
    added = load.rejects(_judged(fx), RUN_ID, _moment(), fx.rejects(), Workspace(fx.spark))
    log = tables.append_rows(fx.rejects(), added, schemas.REJECTS)
    return load.rejects_of(log, RUN_ID).select("reject_id", "rejection_reason")


@query
def run_readback(fx):
    """One run of the audit."""
    return load.run_audit_of(fx.audit(), "run-2024-01-03")


@query
def target_readback(fx):
    """The enriched table, newest load first."""
    return load.newest_enriched_first(fx.enriched())


# --- departments and resolution ------------------------------------------------


@query
def default_department(fx):
    """The default department joins the table once: id 0 is taken in the second case."""
    default = changes.default_department(fx.spark)
    moved = fx.departments().withColumn("department_id", F.col("department_id") + 1)
    missing = changes.insert_absent(moved, default, "department_id")
    present = changes.insert_absent(fx.departments(), default, "department_id")
    return missing.withColumn("had_default", F.lit(False)).unionByName(
        present.withColumn("had_default", F.lit(True))
    )


@query
def unseen_departments_anti(fx):
    return changes.unseen_departments(_kept(fx), fx.departments())


@query
def new_departments(fx):
    return changes.discover_departments(_kept(fx), fx.departments(), Workspace(fx.spark))


def _loaded(fx, **how):
    target = report.latest_enriched(fx.enriched())
    before = load.Tables(fx.employees_before(), fx.departments(), target, fx.rejects())
    return load.Load(fx.staging(), before, RUN_ID, AS_OF, AS_OF_TS, **how)


@query
def employee_final(fx):
    return _loaded(fx).final.drop("business_key")


@query
def departments_after(fx):
    return _loaded(fx).departments


@query
def employees_upsert(fx):
    return _loaded(fx).employees


@query
def second_load_employees(fx):
    """The batch loaded again on what its first load published, read from files.

    Records without an e-mail, which would be new each time, come with a bad one, so
    the second load changes nothing.
    """
    ws = Workspace(fx.spark)
    first = _loaded(fx, final_status="SUCCESS", ws=ws)
    folder = f"{ws.root}/published"
    first.publish(folder)
    staging = fx.staging().withColumn("email", F.coalesce("email", F.lit("no mail")))
    before = load.published(fx.spark, folder)
    second = load.Load(staging, before, "second", AS_OF, AS_OF_TS, ws=ws)
    return second.employees.select(*schemas.EMPLOYEES.schema.names)


@query
def published_stamps(fx):
    """When the published employees were updated: those the load met, at its time."""
    return _published(fx).employees.select("employee_id", "updated_at")


@query
def published_counters(fx):
    """The published departments, inserted employees counted."""
    return _published(fx).departments


def _published(fx):
    ws = Workspace(fx.spark)
    folder = f"{ws.root}/published"
    _loaded(fx, final_status="SUCCESS", ws=ws).publish(folder)
    return load.published(fx.spark, folder)


@query
def employees_upsert_bucketed(fx):
    """The same upsert into a table in hash buckets, of which it replaces those it meets."""
    job = _loaded(fx)
    path = f"{job.ws.root}/employees-in-buckets"
    buckets.write_buckets(fx.employees_before(), path, "employee_id", BUCKETS)
    incoming = load.employee_changes(job.numbered, job.moment)
    buckets.upsert_buckets(incoming, path, "employee_id", BUCKETS, job.ws, load.EMPLOYEE_UPDATES)
    return buckets.read_buckets(fx.spark, path)


@query
def load_counters(fx):
    """Departments after the load, inserted employees counted."""
    return _loaded(fx).counted_departments


@query
def target_upsert(fx):
    return _loaded(fx).enriched


@query
def run_audit_close(fx):
    return _loaded(fx).audit_row


@query
def run_audit_new_id(fx):
    """The audit row of a run that takes its id from a given source of new ids."""
    target = report.latest_enriched(fx.enriched())
    before = load.Tables(fx.employees_before(), fx.departments(), target, fx.rejects())
    clock = {"as_of": AS_OF, "as_of_ts": AS_OF_TS}
    return load.Load(fx.staging(), before, **clock, new_run_id=lambda: RUN_ID).audit_row


@query
def run_audit_rate(fx):
    """Runs with their reject rate."""
    rate = rules.reject_rate(F.col("rejected_row_count"), F.col("source_row_count"))
    return fx.audit().select("run_id", rate.alias("reject_rate_pct"))


# --- changes -------------------------------------------------------------------


def _key(value):
    return F.col("employee_id") == value


@query
def update_key(fx):
    return changes.update(fx.employees(), _key(V.UPDATE_KEY), {"salary": F.lit(V.UPDATE_SALARY)})


@query
def update_multi(fx):
    values = {"email": F.lit(V.UPDATE_EMAIL), "salary": F.lit(0)}
    return changes.update(fx.employees(), _key(V.UPDATE_KEY), values)


def _raise(fx, **stamp):
    raised = F.col("salary") * F.lit(V.RAISE_FACTOR).cast("decimal(3,2)")
    before = F.col("hire_date") < F.lit(V.RAISE_HIRED_BEFORE).cast("date")
    return changes.update(fx.employees(), before, {"salary": raised}, **stamp)


@query
def update_bulk(fx):
    return _raise(fx)


@query
def touch_updated_at(fx):
    return _raise(fx, stamp="updated_at", now=_moment()).select(
        "employee_id", "salary", "updated_at"
    )


@query
def delete_key(fx):
    return changes.delete(fx.employees(), _key(V.DELETE_KEY))


def _hired_after(day):
    return F.col("hire_date") > F.lit(day).cast("date")


@query
def delete_range(fx):
    return changes.delete(fx.employees(), _hired_after(HIRED_AFTER))


@query
def delete_range_literal(fx):
    kept = changes.delete(fx.employees(), _hired_after(V.DELETE_HIRED_AFTER))
    return changes.delete(kept, _hired_after(V.DELETE_HIRED_AFTER_LATER))


def _low_and_gone():
    return (F.col("salary") < V.DELETE_SALARY_BELOW) & (F.col("status") == V.DELETE_STATUS)


@query
def delete_conj(fx):
    return changes.delete(fx.employees(), _low_and_gone())


@query
def deleted_log(fx):
    return changes.deleted_log(fx.employees(), _low_and_gone(), _moment())


@query
def batch_hire(fx):
    ws = Workspace(fx.spark)
    return changes.hire(fx.employees(), fx.hires(), ["email"], _day(), _moment(), ws)


@query
def departments_after_hire(fx):
    """Departments with a batch of hires counted in as they are added."""
    ws = Workspace(fx.spark)
    how = (["email"], _day(), _moment(), ws)
    return changes.hire_counted(fx.employees(), fx.departments(), fx.hires(), *how)[1]


@query
def employees_after_hire(fx):
    """The employees table with the batch of hires in it."""
    added = changes.hire(fx.employees(), fx.hires(), ["email"], _day(), _moment(), Workspace(fx.spark))
    return tables.append_rows(fx.employees(), added, schemas.EMPLOYEES)


@query
def salary_change(fx):
    return changes.change_salaries(fx.employees(), fx.changes())


@query
def salary_change_stamped(fx):
    """The same with the changed employees stamped."""
    changed = changes.change_salaries(
        fx.employees(), fx.changes(), stamp="updated_at", now=_moment()
    )
    return changed.select("employee_id", "salary", "updated_at")


@query
def salary_audit(fx):
    return changes.salary_log(fx.employees(), fx.changes(), _moment(), Workspace(fx.spark))


@query
def dept_counter(fx):
    counted = fx.departments().withColumn("employee_count", F.lit(0).cast("bigint"))
    return changes.count_inserted(counted, fx.hires())


@query
def append_log(fx):
    """Hand-written rows appended to the run audit, unnamed columns defaulted."""
    rows = [{"run_id": "run-by-hand", "process_name": V.PROCESS_NAME, "status": "RUNNING"}]
    added = tables.literal_rows(fx.spark, schemas.RUN_AUDIT, rows).withColumn(
        "started_at", _moment()
    )
    return tables.append_rows(fx.audit(), added, schemas.RUN_AUDIT)


# --- schema and quality --------------------------------------------------------


@query
def schema_evolve(fx):
    table = evolve.add_column(fx.employees(), "phone_number", "string")
    table = evolve.add_column(table, "performance_rating", "int", 0)
    table = evolve.add_column(table, "grade", "int", 0)
    table = evolve.drop_column(table, "grade")
    return evolve.change_type(table, "salary", "decimal(14,2)")


@query
def empty_table(fx):
    """A declared table that does not exist yet, filled by an append."""
    absent = tables.read_table(fx.spark, f"{fx.folder}/no-such-table", schemas.DEPARTMENTS)
    return tables.append_rows(absent, fx.departments().drop("manager_id"), schemas.DEPARTMENTS)


@query
def check_keys(fx):
    return checks.repeated_keys(fx.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_unique(fx):
    """Source record ids used by more than one raw record; missing ones are exempt."""
    return checks.repeated_keys(
        fx.staging(), ["source_system", "source_employee_id"], allow_null=True
    )


@query
def check_nulls(fx):
    return checks.missing_values(fx.staging(), schemas.STAGING.schema.names)


@query
def check_orphans(fx):
    """Salary changes of employees the employee table does not have."""
    rows = fx.changes()
    return checks.orphans(rows, "employee_id", fx.employees(), "employee_id")


@query
def check_foreign_key(fx):
    """Employees whose department, where they have one, the departments do not hold."""
    return checks.orphans(fx.employees(), "department_id", fx.departments(), "department_id")


@query
def check_lengths(fx):
    limits = {"first_name": 3, "last_name": 17, "email": 15, "status": 7}
    return checks.overlong_values(fx.employees(), limits)


@query
def check_numbers(fx):
    return checks.unfit_numbers(
        fx.table("orders"), {"o_totalprice": "decimal(7,2)", "o_orderkey": "decimal(4,0)"}
    )


@query
def check_contract(fx):
    """The typed staging rows measured against the contract of employees."""
    typed = load.normalise(fx.staging(), _moment())
    candidates = typed.select(
        F.col("source_employee_id").cast("bigint").alias("employee_id"),
        "first_name",
        "last_name",
        "email",
        "hire_date",
        "salary",
        F.col("department_id_from_source").alias("department_id"),
        F.col("standardized_status").alias("status"),
        F.col("ingested_at").alias("created_at"),
    )
    return checks.contract_report(candidates, schemas.EMPLOYEES)


# --- reports -------------------------------------------------------------------


def _report_tables(fx):
    return fx.employees(), fx.departments(), fx.enriched(), fx.rejects(), fx.audit()


@query
def employee_report(fx):
    return report.employee_report(*_report_tables(fx), Workspace(fx.spark), AS_OF, AS_OF_TS)


@query
def employee_report_sliced(fx):
    """The same over ranges of the departments, hot keys spread."""
    return report.employee_report(
        *_report_tables(fx), Workspace(fx.spark), AS_OF, AS_OF_TS, hot_rows=10
    )


@query
def department_dashboard(fx):
    return dashboard.department_dashboard(
        *_report_tables(fx),
        Workspace(fx.spark),
        AS_OF,
        AS_OF_TS,
        min_active_ratio_pct=ACTIVE_PCT,
    )


@query
def department_dashboard_literal(fx):
    return dashboard.department_dashboard(*_report_tables(fx), Workspace(fx.spark), AS_OF, AS_OF_TS)
