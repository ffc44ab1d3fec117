"""The load: a raw staging batch becomes the next employees, departments and
enriched snapshots, a reasoned reject log and a run audit row."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffloom import fixedvalues as V
from staffloom.functions import cleaning, rules
from staffloom.functions.dates import Clock, complete_years, now, today
from staffloom.operators import changes
from staffloom.operators.hotkeys import HOT_ROWS
from staffloom.operators.latest import latest_overall, mark_latest, newest_first
from staffloom.operators.lookup import lookup, lookups
from staffloom.sources import schemas
from staffloom.sources.tables import append_to, read_table, replace_part, write_snapshot
from staffloom.sources.workspace import Workspace, is_broadcastable

RAW_COLUMNS = (
    "first_name_raw",
    "last_name_raw",
    "email_raw",
    "hire_date_raw",
    "salary_raw",
    "department_id_raw",
    "department_name_raw",
    "status_raw",
)
TYPED_COLUMNS = (
    "first_name",
    "last_name",
    "email",
    "hire_date",
    "salary",
    "department_id_from_source",
    "department_name",
    "standardized_status",
)
SMALL_BATCH_ROWS = 1_000_000
EMPLOYEE_UPDATES = ("first_name", "last_name", "hire_date", "salary", "department_id", "status")


# --- clean, judge, deduplicate -----------------------------------------------


def trim_fields(staging: DataFrame, as_of_ts: Column) -> DataFrame:
    """Trim every raw field, time the record and form its business key."""
    trimmed = staging.select(
        "source_system",
        "source_employee_id",
        F.trim("first_name").alias("first_name_raw"),
        F.trim("last_name").alias("last_name_raw"),
        F.lower(F.trim("email")).alias("email_raw"),
        *[F.trim(c).alias(c) for c in RAW_COLUMNS[3:]],
        F.coalesce("updated_at", "ingested_at", as_of_ts).alias("event_ts"),
        "ingested_at",
    )
    named = (F.nullif(c, F.lit("")) for c in ("email_raw", "first_name_raw", "last_name_raw"))
    return trimmed.withColumn(
        "business_key",
        cleaning.business_key(F.col("source_system"), F.col("source_employee_id"), *named),
    )


def read_fields(trimmed: DataFrame) -> DataFrame:
    """Read the typed values out of the trimmed fields."""
    return trimmed.withColumns(
        {
            "first_name": cleaning.blank_to_null(F.col("first_name_raw")),
            "last_name": cleaning.blank_to_null(F.col("last_name_raw")),
            "email": cleaning.blank_to_null(F.col("email_raw")),
            "hire_date": cleaning.read_date(F.col("hire_date_raw")),
            "salary": cleaning.read_salary(F.col("salary_raw")),
            "department_id_from_source": cleaning.read_department_id(F.col("department_id_raw")),
            "department_name": cleaning.blank_to_null(F.col("department_name_raw")),
            "standardized_status": cleaning.standard_status(F.col("status_raw")),
        }
    )


def normalise(staging: DataFrame, as_of_ts: Column) -> DataFrame:
    return read_fields(trim_fields(staging, as_of_ts))


def validate(normalised: DataFrame) -> DataFrame:
    checked = ("first_name", "last_name", "hire_date", "salary", "email")
    return normalised.withColumn("reject_reason", cleaning.first_failure(*map(F.col, checked)))


def judge(
    staging: DataFrame, as_of_ts: Column, ws: Workspace, large: bool = False
) -> DataFrame:
    """Every staging row once, with `kept` and, where not kept, why; `row_id` numbers them.

    The newest row of a business key is found before validity is looked at, so an
    invalid newest row takes its older valid ones down as duplicates. Rows that tie
    on both times are told apart by their text; rows that tie on that too are alike,
    and any one of them stands for the others. `large` says that the newest rows are too
    many to be broadcast by their numbers.
    """
    told_apart = ("source_system", "source_employee_id", *RAW_COLUMNS)
    newest = [newest_first("event_ts"), newest_first("ingested_at"), *map(F.col, told_apart)]
    # The trimmed text is settled, read for the newest rows and read again for the outcome.
    trimmed = trim_fields(staging, as_of_ts).withColumn("row_id", F.monotonically_increasing_id())
    trimmed, rows = ws.settle_counted(trimmed, "trimmed")
    marked = mark_latest(trimmed, "business_key", newest, "row_id", large=large, total=rows)
    judged = validate(read_fields(marked))
    kept = F.col("reject_reason").isNull() & F.col("is_latest")
    reason = cleaning.rejection_reason(F.col("reject_reason"), F.col("is_latest"))
    return judged.withColumns({"kept": kept, "rejection_reason": F.when(~kept, reason)})


def survivors(judged: DataFrame, *more: str) -> DataFrame:
    return judged.filter("kept").select(
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
        *more,
    )


def rejects(
    judged: DataFrame, run_id: str, as_of_ts: Column, reject_log: DataFrame, ws: Workspace
) -> DataFrame:
    """The rows the batch adds to the reject log, ids continuing the log's.

    Ids go by business key and times; `judged` is read for these alone and once for the rows,
    so it should be settled.
    """
    refused = judged.filter("NOT kept").select(
        F.lit(run_id).alias("run_id"),
        "source_system",
        "source_employee_id",
        F.col("first_name_raw").alias("first_name"),
        F.col("last_name_raw").alias("last_name"),
        F.col("email_raw").alias("email"),
        *RAW_COLUMNS[3:],
        "rejection_reason",
        as_of_ts.alias("rejected_at"),
        "business_key",
        "event_ts",
        "ingested_at",
        "row_id",
    )
    order = ["business_key", "event_ts", "ingested_at"]
    return schemas.REJECTS.conform(
        changes.append_ids(reject_log, refused, "reject_id", order, ws, row="row_id")
    )


# --- resolve and enrich --------------------------------------------------------


def resolve(
    kept: DataFrame,
    departments: DataFrame,
    employees: DataFrame,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Find each survivor's department, by id or else by name, and employee, by e-mail.

    `small` says that the survivors are known to be within the broadcast limit.
    """
    department = F.struct("department_id", "department_name")
    by_id = departments.select(
        F.col("department_id").alias("department_id_from_source"), department.alias("_by_id")
    )
    by_name = departments.groupBy(F.lower("department_name").alias("_folded")).agg(
        F.min_by(department, F.col("department_id")).alias("_by_name")
    )
    by_email = (
        employees.filter(F.col("email").isNotNull())
        .groupBy(F.lower("email").alias("email"))
        .agg(F.min("employee_id").alias("existing_employee_id"))
    )
    folded = kept.withColumn("_folded", F.lower("department_name"))
    tables = [(by_id, ["department_id_from_source"]), (by_name, ["_folded"]), (by_email, ["email"])]
    found = lookups(folded, tables, "business_key", hot_rows, folded, small)
    return found.select(
        "source_system",
        "source_employee_id",
        "first_name",
        "last_name",
        "email",
        "hire_date",
        "salary",
        "standardized_status",
        F.coalesce(
            "_by_id.department_id", "_by_name.department_id", F.lit(V.DEFAULT_DEPARTMENT_ID)
        )
        .cast("bigint")
        .alias("department_id"),
        F.coalesce(
            "_by_id.department_name", "_by_name.department_name", F.lit(V.DEFAULT_DEPARTMENT_NAME)
        ).alias("department_name"),
        "existing_employee_id",
        "business_key",
        "row_id",
    )


def number(
    resolved: DataFrame, kept: DataFrame, employees: DataFrame, ws: Workspace, rows: int
) -> DataFrame:
    """Give every survivor its employee id: the known one, or a new one.

    All survivors are numbered, known ones too, so new ids have gaps. They are put in order
    by the keys of `kept`, the `rows` survivors as they were settled, so that resolving them
    runs once.
    """
    numbered = changes.append_ids(
        employees, resolved, "_new", ["business_key"], ws, "employee_id",
        row="row_id", keys_from=kept, total=rows,
    )
    return numbered.withColumn(
        "employee_id", F.coalesce("existing_employee_id", "_new")
    ).drop("_new")


def enrich(
    numbered: DataFrame,
    as_of: Column,
    ws: Workspace,
    hot_rows: int = HOT_ROWS,
    small: bool = False,
) -> DataFrame:
    """Add salary band, tenure and compensation index.

    `small` says that the rows are within the broadcast limit, so the averages are too.
    """
    averages = numbered.groupBy("department_id").agg(F.avg("salary").alias("_average"))
    averages = F.broadcast(averages) if small else ws.settle(averages, "department-averages")
    beside = lookup(
        numbered, averages, ["department_id"], "business_key", hot_rows, small_table=small or None
    )
    return beside.withColumn(
        "tenure_years", complete_years(F.col("hire_date"), as_of)
    ).select(
        "employee_id",
        "first_name",
        "last_name",
        "email",
        "hire_date",
        "salary",
        "department_id",
        "standardized_status",
        "source_system",
        "source_employee_id",
        "department_name",
        "tenure_years",
        rules.salary_band(F.col("salary")).alias("salary_band"),
        rules.tenure_bucket(F.col("tenure_years")).alias("tenure_bucket"),
        rules.compensation_index(F.col("salary"), F.col("_average")).alias("compensation_index"),
        "existing_employee_id",
        "business_key",
    )


# --- publish -------------------------------------------------------------------


def employee_changes(numbered: DataFrame, as_of_ts: Column) -> DataFrame:
    """One employees row per e-mail: its smallest id, the values of its last key.

    Rows without an e-mail stand for themselves.
    """
    row = numbered.select(
        "employee_id",
        "first_name",
        "last_name",
        "email",
        "hire_date",
        "salary",
        "department_id",
        F.col("standardized_status").alias("status"),
        as_of_ts.alias("created_at"),
        "business_key",
    )
    columns = schemas.EMPLOYEES.schema.names
    values = [c for c in columns if c not in ("employee_id", "email")]
    shared = (
        row.filter(F.col("email").isNotNull())
        .groupBy("email")
        .agg(
            F.min("employee_id").alias("employee_id"),
            F.max_by(F.struct(*values), F.col("business_key")).alias("_row"),
        )
        .select("employee_id", "email", "_row.*")
    )
    return row.filter(F.col("email").isNull()).select(*columns).unionByName(shared)


def enriched_changes(final: DataFrame, run_id: str, as_of_ts: Column) -> DataFrame:
    """One enriched row per employee id. Only known employees can be met twice."""
    row = final.withColumns(
        {
            "full_name": F.concat("first_name", F.lit(" "), "last_name"),
            "normalized_email": F.col("email"),
            "etl_run_id": F.lit(run_id),
            "loaded_at": as_of_ts,
        }
    )
    values = [c for c in schemas.ENRICHED.schema.names if c != "employee_id"]
    # New ids are met once, so one aggregate by the id, which the upsert needs anyway, does.
    last = row.groupBy("employee_id").agg(
        F.max_by(F.struct(*values), F.col("business_key")).alias("_row")
    )
    return schemas.ENRICHED.conform(last.select("employee_id", "_row.*"))


def open_run(spark: SparkSession, run_id: str, as_of_ts: Column) -> DataFrame:
    """The audit row of a run that has started."""
    return schemas.RUN_AUDIT.conform(
        spark.range(1).select(
            F.lit(run_id).alias("run_id"),
            F.lit(V.PROCESS_NAME).alias("process_name"),
            as_of_ts.alias("started_at"),
            F.lit("RUNNING").alias("status"),
        )
    )


def run_counts(judged: DataFrame) -> DataFrame:
    """One row: how many staging rows there were, were refused and were loaded."""
    return judged.agg(
        F.count(F.lit(1)).alias("_source"),
        F.count_if(~F.col("kept")).alias("_rejected"),
        F.count_if("kept").alias("_loaded"),
    )


def close_run(
    audit: DataFrame,
    run_id: str,
    counts: DataFrame,
    as_of_ts: Column,
    status: str = V.FINAL_STATUS,
    message: str = V.FINAL_MESSAGE,
) -> DataFrame:
    """The audit table with the run's counts, end, status and message set."""
    closed = changes.update(
        changes.with_one_row(audit, counts),
        F.col("run_id") == run_id,
        {
            "source_row_count": F.col("_source"),
            "rejected_row_count": F.col("_rejected"),
            "loaded_row_count": F.col("_loaded"),
            "finished_at": as_of_ts,
            "status": F.lit(status),
            "message": F.lit(message),
        },
    )
    return closed.select(*audit.columns)


# --- the whole load --------------------------------------------------------------


@dataclass(frozen=True)
class Tables:
    """The state before a load."""

    employees: DataFrame
    departments: DataFrame
    enriched: DataFrame
    rejects: DataFrame


def next_departments(
    departments: DataFrame, kept: DataFrame, ws: Workspace, rows: int | None = None
) -> DataFrame:
    """Departments with the default one and every name the batch of `rows` discovers."""
    base = schemas.DEPARTMENTS.complete(departments)
    base = changes.insert_absent(base, changes.default_department(ws.spark), "department_id")
    return base.unionByName(changes.align(changes.discover_departments(kept, base, ws, rows), base))


class Load:
    """One load, each part worked out when first asked for and only once.

    Judged rows, departments and numbered rows are settled, since several parts read
    them; the next snapshots are lazy and read only settled or given tables.
    """

    def __init__(
        self,
        staging: DataFrame,
        before: Tables,
        run_id: str | None = None,
        as_of: Clock = None,
        as_of_ts: Clock = None,
        final_status: str = V.FINAL_STATUS,
        ws: Workspace | None = None,
        hot_rows: int = HOT_ROWS,
        new_run_id: Callable[[], str] = lambda: str(uuid.uuid4()),
    ):
        if as_of_ts is None:
            # One clock for the whole load: a lazy current_timestamp moves per query. It is
            # the reports' clock too, see `now`.
            as_of_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.staging = staging
        self.before = before
        self.run_id = run_id or new_run_id()
        self.moment = now(as_of_ts)
        self.day = today(as_of) if as_of is not None else self.moment.cast("date")
        self.final_status = final_status
        self.ws = ws or Workspace(staging.sparkSession)
        self.hot_rows = hot_rows

    @cached_property
    def judged(self) -> DataFrame:
        """Every staging row: typed values where kept, raw text where refused."""
        rows = judge(self.staging, self.moment, self.ws)
        one_sided = {c: F.when(~F.col("kept"), F.col(c)) for c in RAW_COLUMNS}
        one_sided |= {c: F.when(F.col("kept"), F.col(c)) for c in TYPED_COLUMNS}
        rows = rows.withColumns(one_sided)
        judged, self._kept = self.ws.settle_counted(rows, "judged", F.count_if("kept"))
        return judged

    @cached_property
    def small_batch(self) -> bool:
        """Whether the survivors, by size on disk and by number, can be broadcast."""
        return is_broadcastable(survivors(self.judged)) and self._kept <= SMALL_BATCH_ROWS

    @cached_property
    def departments(self) -> DataFrame:
        """The next departments snapshot."""
        kept = survivors(self.judged)
        rows = next_departments(self.before.departments, kept, self.ws, self._kept)
        return self.ws.settle(rows, "departments")

    @cached_property
    def numbered(self) -> DataFrame:
        """The survivors with their departments and employee ids."""
        kept = survivors(self.judged, "row_id")
        resolved = resolve(
            kept, self.departments, self.before.employees, self.hot_rows, self.small_batch
        )
        numbered = number(resolved, kept, self.before.employees, self.ws, self._kept)
        return self.ws.settle(numbered, "numbered")

    @cached_property
    def final(self) -> DataFrame:
        """The survivors, resolved, numbered and enriched."""
        return enrich(self.numbered, self.day, self.ws, self.hot_rows, self.small_batch)

    def _incoming(self, rows: DataFrame, name: str) -> DataFrame:
        # An upsert reads a small batch several times, a large one once; settled, the
        # small one is also seen to be small.
        return self.ws.settle(rows, name) if self.small_batch else rows

    @cached_property
    def _employee_changes(self) -> DataFrame:
        return self._incoming(employee_changes(self.numbered, self.moment), "employee-changes")

    def _next_employees(self, **stamp) -> DataFrame:
        before = schemas.EMPLOYEES.complete(self.before.employees, self.moment)
        return changes.upsert(before, self._employee_changes, "employee_id", EMPLOYEE_UPDATES, **stamp)

    @cached_property
    def employees(self) -> DataFrame:
        """The next employees snapshot."""
        return self._next_employees()

    @cached_property
    def stamped_employees(self) -> DataFrame:
        """The next employees snapshot with `updated_at` on every employee the load updates, as
        a row trigger would set it."""
        return self._next_employees(stamp="updated_at", now=self.moment)

    @cached_property
    def counted_departments(self) -> DataFrame:
        """The next departments snapshot with `employee_count` raised, from 0 where there
        is none, for every employee the load inserts, as a row trigger would."""
        came = changes.absent(self._employee_changes, self.before.employees, "employee_id")
        return changes.count_inserted(changes.with_counter(self.departments), came)

    @cached_property
    def enriched(self) -> DataFrame:
        """The next enriched snapshot."""
        rows = enriched_changes(self.final, self.run_id, self.moment)
        return changes.upsert(
            schemas.ENRICHED.complete(self.before.enriched, self.moment),
            self._incoming(rows, "enriched-changes"),
            "employee_id",
        )

    @cached_property
    def new_rejects(self) -> DataFrame:
        """The rows to append to the reject log."""
        return rejects(self.judged, self.run_id, self.moment, self.before.rejects, self.ws)

    @cached_property
    def audit_row(self) -> DataFrame:
        """The row to append to the run audit."""
        opened = open_run(self.ws.spark, self.run_id, self.moment)
        counts = run_counts(self.judged)
        return close_run(opened, self.run_id, counts, self.moment, self.final_status)

    def publish(self, folder: str) -> None:
        """Write the outcome, counters and stamps of the row triggers included. The audit row
        comes last: it marks a whole run.

        A broken attempt is published again under its run id; what it left is
        replaced. A whole run is not published twice.
        """
        audit_path = f"{folder}/etl_run_audit"
        audit = read_table(self.ws.spark, audit_path, schemas.RUN_AUDIT)
        if not run_audit_of(audit, self.run_id).isEmpty():
            raise ValueError(f"run {self.run_id} is already published")
        if not self.small_batch:
            # Counters and stamps both read them.
            self._employee_changes = self.ws.settle(self._employee_changes, "employee-changes")
        snapshot = f"{folder}/snapshots/{self.run_id}"
        write_snapshot(self.counted_departments, f"{snapshot}/departments", replace=True)
        write_snapshot(self.stamped_employees, f"{snapshot}/employees", replace=True)
        write_snapshot(self.enriched, f"{snapshot}/employee_enriched_target", replace=True)
        log = f"{folder}/etl_employee_rejects"
        replace_part(self.new_rejects, log, "run_id", self.run_id)
        append_to(self.audit_row, audit_path)


def published(spark: SparkSession, folder: str) -> Tables:
    """What the newest published run left in `folder`, as the state before the next load.

    Only runs with an audit row are whole. Without any, the tables are empty.
    """
    audit = read_table(spark, f"{folder}/etl_run_audit", schemas.RUN_AUDIT)
    newest = [F.col("finished_at").desc(), F.col("started_at").desc(), F.col("run_id").desc()]
    run = latest_overall(audit, newest).first()
    at = f"{folder}/snapshots/{run['run_id']}" if run else f"{folder}/snapshots"
    return Tables(
        read_table(spark, f"{at}/employees", schemas.EMPLOYEES),
        read_table(spark, f"{at}/departments", schemas.DEPARTMENTS),
        read_table(spark, f"{at}/employee_enriched_target", schemas.ENRICHED),
        read_table(spark, f"{folder}/etl_employee_rejects", schemas.REJECTS),
    )


# --- read-back -------------------------------------------------------------------


def run_audit_of(audit: DataFrame, run_id: str) -> DataFrame:
    return audit.filter(F.col("run_id") == run_id)


def rejects_of(reject_log: DataFrame, run_id: str) -> DataFrame:
    return reject_log.filter(F.col("run_id") == run_id).orderBy("reject_id")


def newest_enriched_first(enriched: DataFrame) -> DataFrame:
    """A run stamps all its rows with one time, so the id is what spreads them."""
    return enriched.orderBy(F.col("loaded_at").desc(), "employee_id")
