"""Workforce tables derived from the given Parquet tables.

`oracle/fixtures.py` says the same in SQL. k is the order key, from which the
awkward shapes (blanks, bad dates, missing e-mails, ...) are spread over the rows;
no order is left out by its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staffloom.functions import rules
from staffloom.functions.dates import complete_years, today

AS_OF = "2002-01-01"
AS_OF_TS = "2024-01-31 00:00:00"
RUN_ID = "run-under-test"
# Employees whose order is older were there before the load.
KNOWN_BEFORE = "1998-06-01"
UNKNOWN_DEPARTMENT = 99


class Fixtures:
    """The derived tables of one scale folder, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> DataFrame:
        """A given table; its columns are found out once."""
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    def departments(self) -> DataFrame:
        places = F.element_at(
            F.array(*map(F.lit, ("New York", "Seattle", "London", "Pune", "  ", "Dubai", None))),
            F.col("n_nationkey") % 7 + 1,
        )
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("department_id"),
            F.col("n_name").alias("department_name"),
            F.lit(None).cast("bigint").alias("manager_id"),
            places.alias("location"),
        )

    def _orders(self) -> DataFrame:
        return self.table("orders").join(
            self.table("customer"), F.col("o_custkey") == F.col("c_custkey")
        )

    def _employees(self) -> DataFrame:
        k = F.col("o_orderkey")
        status = F.when(F.col("o_orderstatus") == "F", "Active").when(
            F.col("o_orderstatus") == "O", "Inactive"
        )
        return self._orders().select(
            k.alias("employee_id"),
            F.concat(F.lit("F"), (k % 97).cast("string")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.when(k % 10 != 9, F.concat(F.lit("u"), k.cast("string"), F.lit("@example.com")))
            .alias("email"),
            F.date_sub(F.col("o_orderdate").cast("date"), (k % 3 * 1826).cast("int"))
            .alias("hire_date"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("salary"),
            # Some have no department, some one that does not exist.
            F.when(k % 211 == 0, F.lit(None))
            .when(k % 223 == 0, F.lit(UNKNOWN_DEPARTMENT))
            .otherwise(F.col("c_nationkey"))
            .cast("bigint")
            .alias("department_id"),
            status.otherwise("On Leave").alias("status"),
            F.col("o_orderdate").alias("created_at"),
            "o_custkey",
            "o_orderpriority",
        )

    def employees(self) -> DataFrame:
        return self._employees().drop("o_custkey", "o_orderpriority")

    def employees_before(self) -> DataFrame:
        return self.employees().filter(F.col("created_at") < F.lit(KNOWN_BEFORE).cast("date"))

    def enriched(self) -> DataFrame:
        """Two versions per order. Those of the lowest priority are enriched under an id
        that no employee has, so some employees find none."""
        named = self.departments().select("department_id", "department_name")
        base = (
            self._employees()
            .join(named, "department_id", "left")
            .withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
        )
        salary = F.col("salary") * (100 + F.col("v") * 5) / 100
        base = base.withColumns(
            {
                "salary": F.round(salary, 2).cast("decimal(10,2)"),
                "years": complete_years(F.col("hire_date"), today(AS_OF)),
            }
        )
        return base.select(
            F.when(F.col("o_orderpriority") == "5-LOW", -F.col("employee_id"))
            .otherwise(F.col("employee_id"))
            .alias("employee_id"),
            F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
            F.col("email").alias("normalized_email"),
            "department_id",
            F.coalesce("department_name", F.lit("Nowhere")).alias("department_name"),
            F.col("status").alias("standardized_status"),
            "salary",
            rules.salary_band(F.col("salary")).alias("salary_band"),
            F.col("years").alias("tenure_years"),
            rules.tenure_bucket(F.col("years")).alias("tenure_bucket"),
            F.lit(1).cast("decimal(12,4)").alias("compensation_index"),
            F.concat(F.lit("sys"), (F.col("o_custkey") % 2).cast("string")).alias("source_system"),
            F.col("o_custkey").cast("string").alias("source_employee_id"),
            F.concat(F.lit("run-"), F.col("v").cast("string")).alias("etl_run_id"),
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("v"))
            .cast("timestamp_ntz")
            .alias("loaded_at"),
        )

    def rejects(self) -> DataFrame:
        """Every event as a reject, its type in the reason; many source records per user."""
        record = F.col("user_id") * 32 + F.col("event_id") % 32
        reasons = F.array(
            F.lit("Invalid email format"),
            F.lit("Invalid salary format"),
            F.lit("Invalid or missing hire date"),
        )
        return (
            self.table("events")
            .select(
                F.col("event_id").alias("reject_id"),
                F.lit("run-0").alias("run_id"),
                F.concat(F.lit("sys"), (record % 2).cast("string")).alias("source_system"),
                record.cast("string").alias("source_employee_id"),
                F.when(F.col("event_type") == "error", F.lit("Unknown rejection"))
                .otherwise(F.element_at(reasons, (F.col("event_id") % 3 + 1).cast("int")))
                .alias("rejection_reason"),
                F.col("ts").alias("rejected_at"),
            )
        )

    def audit(self) -> DataFrame:
        """One run per day of events; every fifth day's run failed."""
        day = F.col("ts").cast("date")
        daily = self.table("events").groupBy(day.alias("day")).agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("finished_at"),
            F.count(F.lit(1)).alias("source_row_count"),
            F.count_if(F.col("event_type") == "error").alias("rejected_row_count"),
        )
        return daily.select(
            F.concat(F.lit("run-"), F.col("day").cast("string")).alias("run_id"),
            F.lit("employee_etl_enrichment").alias("process_name"),
            "started_at",
            "finished_at",
            F.when(F.dayofmonth("day") % 5 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
            "source_row_count",
            "rejected_row_count",
            (F.col("source_row_count") - F.col("rejected_row_count")).alias("loaded_row_count"),
            F.lit(None).cast("string").alias("message"),
        )

    def staging(self) -> DataFrame:
        """Every order as a raw record; urgent ones are sent a second time."""
        k = F.col("o_orderkey")
        text = k.cast("string")
        copies = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit(0), F.lit(1)))
        money = F.col("o_totalprice").cast("decimal(10,2)").cast("string")
        shown = F.element_at(
            F.array(*map(F.lit, ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "yyyy-MM-dd"))),
            (k % 4 + 1).cast("int"),
        )
        hired = F.lit(None).cast("string")
        for fmt in ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy"):
            hired = F.when(shown == fmt, F.date_format("o_orderdate", fmt)).otherwise(hired)
        status = F.element_at(
            F.array(*map(F.lit, ("a", "Leave", "0", None, "whatever"))), (k % 5 + 1).cast("int")
        )
        named = F.when(k % 12 == 0, F.concat(F.lit("New Dept "), (k % 24).cast("string")))
        sent = F.col("o_orderdate") + F.make_dt_interval(F.lit(1) + F.col("v"))
        rows = self._orders().join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return rows.withColumn("v", F.explode(F.coalesce(copies, F.array(F.lit(0))))).select(
            F.when(k % 101 != 0, F.concat(F.lit("SYS"), (k % 2).cast("string"))).alias(
                "source_system"
            ),
            text.alias("source_employee_id"),
            F.when(k % 53 == 0, "   ")
            .otherwise(F.concat(F.lit(" F"), (k % 97).cast("string"), F.lit(" ")))
            .alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.when(k % 10 == 9, F.lit(None))
            .when(k % 41 == 0, "bad-mail")
            .otherwise(F.concat(F.lit("U"), text, F.lit("@Example.com ")))
            .alias("email"),
            F.when(k % 31 == 0, "2024-02-30").otherwise(hired).alias("hire_date_raw"),
            _first(
                (k % 37 == 0, F.lit("n/a")),
                (k % 43 == 0, F.concat(F.lit("-"), money)),
                (k % 5 == 0, F.concat(F.lit("$"), money)),
                (F.lit(True), money),
            ).alias("salary_raw"),
            F.when(k % 6 == 0, "x")
            .otherwise(F.col("c_nationkey").cast("string"))
            .alias("department_id_raw"),
            F.when(k % 6 == 0, F.coalesce(named, F.upper("n_name"))).alias("department_name_raw"),
            status.alias("status_raw"),
            F.col("o_orderdate").alias("ingested_at"),
            F.when((k % 8 != 0) | (F.col("v") != 0), sent).alias("updated_at"),
        )

    def changes(self) -> DataFrame:
        """Events as salary changes, several per employee, some to unknown ones."""
        return self.table("events").select(
            (F.col("user_id") * 3 - 20).alias("employee_id"),
            F.col("value").cast("decimal(10,2)").alias("new_salary"),
            F.col("event_id").alias("change_seq"),
        )

    def hires(self) -> DataFrame:
        """Customers as new hires."""
        return self.table("customer").select(
            F.concat(F.lit("H"), (F.col("c_custkey") % 89).cast("string")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.concat(F.lit("h"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
            .alias("email"),
            F.abs("c_acctbal").cast("decimal(10,2)").alias("salary"),
            F.col("c_nationkey").cast("bigint").alias("department_id"),
        )


def _first(*branches: tuple[Column, Column]) -> Column:
    return F.coalesce(*[F.when(test, value) for test, value in branches])
