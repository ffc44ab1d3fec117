"""Declared table contracts: columns, types, keys, required columns, defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


@dataclass(frozen=True)
class Contract:
    """What a table promises; checked by `operators.checks`, not enforced on write."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def conform(self, df: DataFrame, now: Column | None = None) -> DataFrame:
        """Select the contract's columns by name and type, filling absent ones.

        A column missing from `df` takes its default; the default `NOW` stands
        for the `now` the caller passes.
        """
        return df.select(*self._columns(set(df.columns), now))

    def _columns(self, have: set[str], now: Column | None) -> list[Column]:
        return [
            (F.col(f.name) if f.name in have else self._default(f.name, now))
            .cast(f.dataType)
            .alias(f.name)
            for f in self.schema.fields
        ]

    def _default(self, name: str, now: Column | None) -> Column:
        default = self.defaults.get(name)
        if default is NOW:
            return F.lit(None) if now is None else now
        return F.lit(default)

    def complete(self, df: DataFrame, now: Column | None = None) -> DataFrame:
        """`df` as it is, with the contract's columns it lacks added and defaulted.

        Unlike `conform` this keeps columns added to a table and types widened later.
        """
        lacking = [f for f in self.schema.fields if f.name not in df.columns]
        if not lacking:
            return df
        return df.withColumns(
            {f.name: self._default(f.name, now).cast(f.dataType) for f in lacking}
        )


class _Now:
    def __repr__(self) -> str:
        return "NOW"


NOW = _Now()


def _fields(*spec: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, not required) for n, t, required in spec])


_S, _L, _I, _D, _TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DateType(),
    T.TimestampNTZType(),
)

EMPLOYEES = Contract(
    "employees",
    _fields(
        ("employee_id", _L, True),
        ("first_name", _S, True),
        ("last_name", _S, True),
        ("email", _S, False),
        ("hire_date", _D, True),
        ("salary", MONEY, False),
        ("department_id", _L, False),
        ("status", _S, False),
        ("created_at", _TS, False),
    ),
    key=("employee_id",),
    unique=("email",),
    lengths={"first_name": 50, "last_name": 50, "email": 100, "status": 20},
    defaults={"status": "Active", "created_at": NOW},
)

DEPARTMENTS = Contract(
    "departments",
    _fields(
        ("department_id", _L, True),
        ("department_name", _S, True),
        ("manager_id", _L, False),
        ("location", _S, False),
    ),
    key=("department_id",),
    lengths={"department_name": 100, "location": 100},
)

STAGING = Contract(
    "stg_employee_delta",
    _fields(
        ("source_system", _S, False),
        ("source_employee_id", _S, False),
        ("first_name", _S, False),
        ("last_name", _S, False),
        ("email", _S, False),
        ("hire_date_raw", _S, False),
        ("salary_raw", _S, False),
        ("department_id_raw", _S, False),
        ("department_name_raw", _S, False),
        ("status_raw", _S, False),
        ("ingested_at", _TS, False),
        ("updated_at", _TS, False),
    ),
)

RUN_AUDIT = Contract(
    "etl_run_audit",
    _fields(
        ("run_id", _S, True),
        ("process_name", _S, True),
        ("started_at", _TS, True),
        ("finished_at", _TS, False),
        ("status", _S, True),
        ("source_row_count", _L, False),
        ("rejected_row_count", _L, False),
        ("loaded_row_count", _L, False),
        ("message", _S, False),
    ),
    key=("run_id",),
    lengths={"run_id": 36, "process_name": 100, "status": 20, "message": 500},
    defaults={"source_row_count": 0, "rejected_row_count": 0, "loaded_row_count": 0},
)

REJECTS = Contract(
    "etl_employee_rejects",
    _fields(
        ("reject_id", _L, True),
        ("run_id", _S, True),
        ("source_system", _S, False),
        ("source_employee_id", _S, False),
        ("first_name", _S, False),
        ("last_name", _S, False),
        ("email", _S, False),
        ("hire_date_raw", _S, False),
        ("salary_raw", _S, False),
        ("department_id_raw", _S, False),
        ("department_name_raw", _S, False),
        ("status_raw", _S, False),
        ("rejection_reason", _S, True),
        ("rejected_at", _TS, True),
    ),
    key=("reject_id",),
    lengths={
        "run_id": 36,
        "source_system": 50,
        "source_employee_id": 50,
        "first_name": 50,
        "last_name": 50,
        "email": 100,
        "hire_date_raw": 50,
        "salary_raw": 50,
        "department_id_raw": 50,
        "department_name_raw": 100,
        "status_raw": 30,
        "rejection_reason": 300,
    },
    defaults={"rejected_at": NOW},
)

ENRICHED = Contract(
    "employee_enriched_target",
    _fields(
        ("employee_id", _L, True),
        ("full_name", _S, True),
        ("normalized_email", _S, False),
        ("department_id", _L, False),
        ("department_name", _S, False),
        ("standardized_status", _S, True),
        ("salary", MONEY, False),
        ("salary_band", _S, True),
        ("tenure_years", _I, True),
        ("tenure_bucket", _S, True),
        ("compensation_index", T.DecimalType(12, 4), True),
        ("source_system", _S, False),
        ("source_employee_id", _S, False),
        ("etl_run_id", _S, True),
        ("loaded_at", _TS, True),
    ),
    key=("employee_id",),
    lengths={
        "full_name": 120,
        "normalized_email": 100,
        "department_name": 100,
        "standardized_status": 20,
        "salary_band": 20,
        "tenure_bucket": 20,
        "source_system": 50,
        "source_employee_id": 50,
        "etl_run_id": 36,
    },
    defaults={"loaded_at": NOW},
)

SALARY_AUDIT = Contract(
    "salary_audit_log",
    _fields(
        ("employee_id", _L, False),
        ("old_salary", MONEY, False),
        ("new_salary", MONEY, False),
        ("change_date", _TS, False),
    ),
)

DELETED_LOG = Contract(
    "deleted_employees_log",
    _fields(("employee_id", _L, False), ("name", _S, False), ("deleted_date", _TS, False)),
)

CONTRACTS = {
    c.name: c
    for c in (
        EMPLOYEES,
        DEPARTMENTS,
        STAGING,
        RUN_AUDIT,
        REJECTS,
        ENRICHED,
        SALARY_AUDIT,
        DELETED_LOG,
    )
}
