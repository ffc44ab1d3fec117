"""Changes to a table as table in, next snapshot out.

Parquet tables take no UPDATE, DELETE or MERGE, so each operator returns what the
table holds afterwards; the caller writes it to a new path. What a row trigger
would have written comes back as a DataFrame of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffloom import fixedvalues as V
from staffloom.operators.latest import latest_per_key
from staffloom.operators.lookup import lookup
from staffloom.operators.numbering import number_rows, previous_in_order
from staffloom.sources import schemas
from staffloom.sources.workspace import Workspace, is_broadcastable

# So many rows are numbered in one task.
FEW_ROWS = 100_000


def holds(predicate: Column) -> Column:
    """Whether the predicate is true: NULL counts as not."""
    return F.coalesce(predicate, F.lit(False))


# --- update and delete -------------------------------------------------------


def update(
    table: DataFrame,
    where: Column,
    values: Mapping[str, Column],
    stamp: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Set columns on the rows where `where` holds, all from the old values.

    `stamp` names a column that gets `now` on every matched row, changed or not;
    it is added when the table has none.
    """
    hit = holds(where)
    types = {f.name: f.dataType for f in table.schema.fields}
    changed = {
        name: F.when(hit, value.cast(types[name])).otherwise(F.col(name))
        for name, value in values.items()
    }
    if stamp:
        kind = types.get(stamp, "timestamp_ntz")
        old = F.col(stamp) if stamp in types else F.lit(None).cast(kind)
        changed[stamp] = F.when(hit, now.cast(kind)).otherwise(old)
    return table.withColumns(changed)


def delete(table: DataFrame, where: Column) -> DataFrame:
    return table.filter(~holds(where))


def deleted_log(table: DataFrame, where: Column, now: Column) -> DataFrame:
    """What deleting logs: one row per deleted employee."""
    return schemas.DELETED_LOG.conform(
        table.filter(holds(where)).select(
            "employee_id",
            F.concat("first_name", F.lit(" "), "last_name").alias("name"),
            now.alias("deleted_date"),
        )
    )


# --- insert and upsert -------------------------------------------------------


def align(rows: DataFrame, table: DataFrame) -> DataFrame:
    """`rows` with the table's columns, in its order and types; absent ones NULL."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
    )


def absent(incoming: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The incoming rows whose key the table does not hold.

    For a batch within the broadcast limit only the table's key column is read and
    filtered against the batch; the table is not shuffled.
    """
    known = table.select(key)
    if is_broadcastable(incoming):
        known = known.join(incoming.select(key), key, "left_semi")
    return incoming.join(known, key, "left_anti")


def insert_absent(table: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    return table.unionByName(align(absent(incoming, table, key), table))


def upsert(
    table: DataFrame,
    incoming: DataFrame,
    key: str,
    update: Sequence[str] | None = None,
    stamp: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Insert incoming rows with new keys; on known keys set the `update` columns.

    `stamp` names a column that gets `now` on every known row that is met, as a row trigger
    on updates would set it, and nothing on new rows; it is added when the table has none.

    Without `update` all columns `incoming` has are set. Incoming values win even
    when NULL. `incoming` holds each key once; columns only the table has stay as
    they are, and are NULL on new rows. A batch within the broadcast limit leaves the
    table where it is; a larger one meets it in one full outer join.
    """
    given = [c for c in table.columns if c in incoming.columns and c != key]
    update = given if update is None else list(update)
    if stamp:
        kind = dict(table.dtypes).get(stamp, "timestamp_ntz")
        if stamp not in table.columns:
            table = table.withColumn(stamp, F.lit(None).cast(kind))
        update = [c for c in update if c != stamp]
        incoming = incoming.drop(stamp)
    columns = table.columns
    small = is_broadcastable(incoming)
    incoming = align(incoming, table)
    if small:
        fresh = incoming.select(key, F.struct(*update).alias("_in"))
        hit = F.col("_in").isNotNull()

        def kept(c: str) -> Column:
            if c == stamp:
                return F.when(hit, now.cast(kind)).otherwise(F.col(c)).alias(c)
            return F.when(hit, F.col("_in")[c]).otherwise(F.col(c)).alias(c) if c in update else F.col(c)

        changed = table.join(fresh, key, "left").select(*map(kept, columns))
        return changed.unionByName(absent(incoming, table, key).select(*columns))

    rest = [c for c in columns if c != key]
    old = table.select(key, F.struct(*rest).alias("_old"))
    new = incoming.select(key, F.struct(*rest).alias("_in"))
    both = old.join(new, key, "full_outer")

    def pick(c: str) -> Column:
        before, after = F.col("_old")[c], F.col("_in")[c]
        if c == stamp:
            met = F.col("_old").isNotNull() & F.col("_in").isNotNull()
            return F.when(met, now.cast(kind)).otherwise(before)
        if c in update:
            return F.when(F.col("_in").isNotNull(), after).otherwise(before)
        return F.when(F.col("_old").isNotNull(), before).otherwise(after)

    return both.select(*[F.col(c) if c == key else pick(c).alias(c) for c in columns])


def highest_id(table: DataFrame, key: str, alias: str) -> DataFrame:
    """One row: the highest id, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias(alias))


def with_one_row(rows: DataFrame, one: DataFrame) -> DataFrame:
    """Every row beside the single row of `one` (an aggregate or a top-1)."""
    return rows.crossJoin(F.broadcast(one))


def append_ids(
    table: DataFrame,
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    ws: Workspace,
    of: str | None = None,
    **how,
) -> DataFrame:
    """`rows` with ids in `key` that continue the table's highest, dense in `order`.

    `of` is the table's name of the id, if another; for the rest see `number_rows`.
    """
    numbered = number_rows(rows, order, "_place_after", ws, **how)
    found = with_one_row(numbered, highest_id(table, of or key, "_top"))
    return found.withColumn(key, F.col("_top") + F.col("_place_after")).drop("_top", "_place_after")


# --- departments -------------------------------------------------------------


def default_department(spark) -> DataFrame:
    return spark.range(1).select(
        F.lit(V.DEFAULT_DEPARTMENT_ID).cast("bigint").alias("department_id"),
        F.lit(V.DEFAULT_DEPARTMENT_NAME).alias("department_name"),
        F.lit(None).cast("bigint").alias("manager_id"),
        F.lit(V.DEFAULT_DEPARTMENT_LOCATION).alias("location"),
    )


def unseen_departments(names: DataFrame, departments: DataFrame) -> DataFrame:
    """Names no department has, one per case-folded name, from `department_name`."""
    found = (
        names.filter(F.col("department_name").isNotNull())
        .groupBy(F.lower("department_name").alias("_folded"))
        .agg(F.min("department_name").alias("department_name"))
    )
    known = departments.select(F.lower("department_name").alias("_folded"))
    return found.join(known, "_folded", "left_anti").select("department_name")


def discover_departments(
    names: DataFrame, departments: DataFrame, ws: Workspace, rows: int | None = None
) -> DataFrame:
    """New department rows, numbered by name after the highest id in use.

    New names are few as a rule; up to `FEW_ROWS` of them are numbered in one task, more
    by ranges. They are settled to be counted unless the caller knows that there are no more
    than so many `rows` of names.
    """
    unseen = unseen_departments(names, departments)
    if rows is None or rows > FEW_ROWS:
        unseen, rows = ws.settle_counted(unseen, "unseen")
    if rows <= FEW_ROWS:
        top = highest_id(departments, "department_id", "_top")
        place = F.row_number().over(Window.orderBy("department_name")).cast("bigint")
        numbered = with_one_row(unseen, top).withColumn("department_id", F.col("_top") + place)
    else:
        numbered = append_ids(departments, unseen, "department_id", ["department_name"], ws)
    return schemas.DEPARTMENTS.conform(
        numbered.withColumn("location", F.lit(V.DISCOVERED_LOCATION))
    )


def count_inserted(
    departments: DataFrame, inserted: DataFrame, step: int = V.COUNTER_STEP
) -> DataFrame:
    """Departments with `employee_count` raised by `step` per inserted employee."""
    arrived = inserted.groupBy("department_id").agg((F.count(F.lit(1)) * step).alias("_more"))
    return (
        departments.join(arrived, "department_id", "left")
        .withColumn("employee_count", F.col("employee_count") + F.coalesce("_more", F.lit(0)))
        .drop("_more")
    )


# --- employees ---------------------------------------------------------------


def hire(
    employees: DataFrame,
    hires: DataFrame,
    order: Sequence[str],
    as_of: Column,
    now: Column,
    ws: Workspace,
) -> DataFrame:
    """The rows a batch of hires adds: next ids in `order`, hired on `as_of`."""
    numbered = append_ids(employees, hires, "employee_id", order, ws)
    return schemas.EMPLOYEES.conform(numbered.withColumn("hire_date", as_of), now)


def hire_counted(
    employees: DataFrame,
    departments: DataFrame,
    hires: DataFrame,
    order: Sequence[str],
    as_of: Column,
    now: Column,
    ws: Workspace,
) -> tuple[DataFrame, DataFrame]:
    """The rows a batch of hires adds, and the departments with these counted in."""
    added = ws.settle(hire(employees, hires, order, as_of, now, ws), "hired")
    return added, count_inserted(with_counter(departments), added)


def with_counter(departments: DataFrame) -> DataFrame:
    """Departments with `employee_count`, 0 where there is none yet."""
    had = "employee_count" in departments.columns
    count = F.coalesce("employee_count", F.lit(0)) if had else F.lit(0)
    return departments.withColumn("employee_count", count.cast("bigint"))


def salary_log(
    employees: DataFrame, changes: DataFrame, now: Column, ws: Workspace, seq: str = "change_seq"
) -> DataFrame:
    """One row per change in `seq` order: the salary before it and after it.

    A change to an unknown employee is logged with no old salary. `changes` holds
    employee_id, new_salary and `seq`, unique per employee.
    """
    chained = previous_in_order(changes, "employee_id", seq, "new_salary", "_prior", ws)
    current = employees.select("employee_id", F.struct("salary").alias("_now"))
    seen = lookup(chained, current, ["employee_id"], spread_by=seq)
    first = F.col("_prior").isNull()
    before = F.when(first, F.col("_now.salary")).otherwise(F.col("_prior.value"))
    return schemas.SALARY_AUDIT.conform(
        seen.select(
            "employee_id",
            F.when(F.col("_now").isNotNull(), before).alias("old_salary"),
            "new_salary",
            now.alias("change_date"),
        )
    )


def change_salaries(
    employees: DataFrame,
    changes: DataFrame,
    seq: str = "change_seq",
    stamp: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Employees after the batch: the last change of each employee holds.

    `stamp` names a column that gets `now` on every employee that was changed, as a row
    trigger would set it; it is added when the table has none.
    """
    last = latest_per_key(changes, ["employee_id"], [F.col(seq).desc()]).select(
        "employee_id", F.struct(F.col("new_salary").alias("value")).alias("_to")
    )
    met = employees.join(last, "employee_id", "left")
    paid = {"salary": F.col("_to.value")}
    changed = update(met, F.col("_to").isNotNull(), paid, stamp, now)
    columns = [*employees.columns, *([stamp] if stamp and stamp not in employees.columns else [])]
    return changed.withColumn("salary", F.col("salary").cast(schemas.MONEY)).select(*columns)
