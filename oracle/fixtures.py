"""The derived workforce tables in SQL; `staffloom/sources/fixtures.py` says the same."""

from __future__ import annotations

from oracle.text import below
from staffloom import fixedvalues as V

AS_OF = "DATE '2002-01-01'"
AS_OF_TS = "TIMESTAMP '2024-01-31 00:00:00'"


def months_between(start: str, end: str = AS_OF) -> str:
    """Complete months from start to end (start <= end)."""
    return (
        f"(12 * (year({end}) - year({start})) + month({end}) - month({start})"
        f" - (day({end}) < day({start}))::INT)"
    )


def years_between(start: str, end: str = AS_OF) -> str:
    return f"({months_between(start, end)} // 12)::INT"


BAND = below("salary", V.SALARY_CUTS, V.SALARY_BANDS)
BUCKET = below("years", V.TENURE_CUTS, V.TENURE_BUCKETS)

# Name -> (names it needs, query).
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_departments": (
        (),
        """
        SELECT n_nationkey::BIGINT AS department_id, n_name AS department_name,
               NULL::BIGINT AS manager_id,
               ['New York', 'Seattle', 'London', 'Pune', '  ', 'Dubai', NULL]
                   [n_nationkey % 7 + 1] AS location
        FROM nation
        """,
    ),
    "fx_wide": (
        (),
        """
        SELECT o_orderkey AS employee_id, 'F' || (o_orderkey % 97) AS first_name,
               c_name AS last_name,
               CASE WHEN o_orderkey % 10 <> 9 THEN 'u' || o_orderkey || '@example.com' END AS email,
               o_orderdate::DATE - (o_orderkey % 3 * 1826)::INT AS hire_date,
               o_totalprice::DECIMAL(10,2) AS salary,
               CASE WHEN o_orderkey % 211 = 0 THEN NULL WHEN o_orderkey % 223 = 0 THEN 99
                    ELSE c_nationkey END::BIGINT AS department_id,
               MAP {'F': 'Active', 'O': 'Inactive', 'P': 'On Leave'}[o_orderstatus] AS status,
               o_orderdate AS created_at, o_custkey, o_orderpriority
        FROM orders JOIN customer ON c_custkey = o_custkey
        """,
    ),
    "fx_employees": (
        ("fx_wide",),
        "SELECT * EXCLUDE (o_custkey, o_orderpriority) FROM fx_wide",
    ),
    "fx_employees_before": (
        ("fx_employees",),
        "SELECT * FROM fx_employees WHERE created_at < DATE '1998-06-01'",
    ),
    "fx_enriched": (
        ("fx_wide", "fx_departments"),
        f"""
        SELECT employee_id, full_name, normalized_email, department_id, department_name,
               standardized_status, salary, {BAND} AS salary_band, years AS tenure_years,
               {BUCKET} AS tenure_bucket, 1::DECIMAL(12,4) AS compensation_index,
               source_system, source_employee_id, etl_run_id, loaded_at
        FROM (
            SELECT if(o_orderpriority = '5-LOW', -employee_id, employee_id) AS employee_id,
                   first_name || ' ' || last_name AS full_name, email AS normalized_email,
                   department_id, coalesce(department_name, 'Nowhere') AS department_name,
                   status AS standardized_status,
                   (((salary * 100)::BIGINT * (100 + 5 * v) * 2 + 100) // 200
                       * 0.01::DECIMAL(3,2))::DECIMAL(10,2) AS salary,
                   {years_between("hire_date")} AS years,
                   'sys' || (o_custkey % 2) AS source_system,
                   o_custkey::VARCHAR AS source_employee_id, 'run-' || v AS etl_run_id,
                   (DATE '2024-01-01' + v)::TIMESTAMP AS loaded_at
            FROM fx_wide LEFT JOIN fx_departments USING (department_id), (VALUES (0), (1)) t(v)
        )
        """,
    ),
    "fx_rejects": (
        (),
        """
        SELECT event_id AS reject_id, 'run-0' AS run_id, 'sys' || (rec % 2) AS source_system,
               rec::VARCHAR AS source_employee_id,
               if(event_type = 'error', 'Unknown rejection',
                  ['Invalid email format', 'Invalid salary format', 'Invalid or missing hire date']
                      [event_id % 3 + 1]) AS rejection_reason,
               ts AS rejected_at
        FROM (SELECT *, user_id * 32 + event_id % 32 AS rec FROM events)
        """,
    ),
    "fx_audit": (
        (),
        """
        SELECT 'run-' || day AS run_id, 'employee_etl_enrichment' AS process_name, started_at,
               finished_at, CASE WHEN day(day) % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               n AS source_row_count, bad AS rejected_row_count, n - bad AS loaded_row_count,
               NULL::VARCHAR AS message
        FROM (SELECT ts::DATE AS day, min(ts) AS started_at, max(ts) AS finished_at,
                     count(*) AS n, count(*) FILTER (event_type = 'error') AS bad
              FROM events GROUP BY 1)
        """,
    ),
    "fx_staging": (
        (),
        """
        SELECT CASE WHEN k % 101 <> 0 THEN 'SYS' || (k % 2) END AS source_system,
               k::VARCHAR AS source_employee_id,
               if(k % 53 = 0, '   ', ' F' || (k % 97) || ' ') AS first_name, c_name AS last_name,
               CASE WHEN k % 10 = 9 THEN NULL WHEN k % 41 = 0 THEN 'bad-mail'
                    ELSE 'U' || k || '@Example.com ' END AS email,
               if(k % 31 = 0, '2024-02-30',
                  [iso, strftime(o_orderdate, '%d/%m/%Y'), strftime(o_orderdate, '%m-%d-%Y'), iso]
                      [k % 4 + 1]) AS hire_date_raw,
               CASE WHEN k % 37 = 0 THEN 'n/a' WHEN k % 43 = 0 THEN '-' || money
                    WHEN k % 5 = 0 THEN '$' || money ELSE money END AS salary_raw,
               if(k % 6 = 0, 'x', c_nationkey::VARCHAR) AS department_id_raw,
               CASE WHEN k % 12 = 0 THEN 'New Dept ' || (k % 24)
                    WHEN k % 6 = 0 THEN upper(n_name) END AS department_name_raw,
               ['a', 'Leave', '0', NULL, 'whatever'][k % 5 + 1] AS status_raw,
               o_orderdate AS ingested_at,
               CASE WHEN k % 8 <> 0 OR v = 1 THEN o_orderdate + to_days(1 + v) END AS updated_at
        FROM (SELECT *, o_orderkey AS k, o_totalprice::DECIMAL(10,2)::VARCHAR AS money,
                     strftime(o_orderdate, '%Y-%m-%d') AS iso
              FROM orders JOIN customer ON c_custkey = o_custkey
                          JOIN nation ON n_nationkey = c_nationkey),
             (VALUES (0), (1)) t(v)
        WHERE v = 0 OR o_orderpriority = '1-URGENT'
        """,
    ),
    "fx_changes": (
        (),
        """
        SELECT user_id * 3 - 20 AS employee_id, value::DECIMAL(10,2) AS new_salary,
               event_id AS change_seq
        FROM events
        """,
    ),
    "fx_hires": (
        (),
        """
        SELECT 'H' || (c_custkey % 89) AS first_name, c_name AS last_name,
               'h' || c_custkey || '@example.com' AS email,
               abs(c_acctbal)::DECIMAL(10,2) AS salary, c_nationkey::BIGINT AS department_id
        FROM customer
        """,
    ),
}
