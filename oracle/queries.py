"""One SQL query per checked query name, over the derived tables."""

from __future__ import annotations

import re

from oracle.fixtures import AS_OF, AS_OF_TS, TABLES, months_between, years_between
from oracle.text import average, below, cents, half_up, listing, mapped, quote, scaled
from staffloom import fixedvalues as V

STATUS = {word: label for words, label in V.STATUS_WORDS for word in words}


def _cities(labels):
    return {city: label for group, label in zip(V.REGION_CITIES, labels) for city in group}


REPORT_REGION = f"""
    CASE WHEN coalesce(trim(location), '') = '' THEN {quote(V.REPORT_REGION_UNKNOWN)}
         ELSE {mapped("lower(location)", _cities(V.REPORT_REGIONS), V.REPORT_REGION_OTHER)} END"""
DASHBOARD_REGION = f"""
    CASE WHEN coalesce(trim(location), '') = '' THEN {quote(V.DASHBOARD_REGION_UNKNOWN)}
         ELSE {mapped("lower(location)", _cities(V.DASHBOARD_REGIONS), V.DASHBOARD_REGION_OTHER)}
    END"""


def quality(rejects: str) -> str:
    labels = [V.QUALITY_MINOR] * 2 + [V.QUALITY_MODERATE] * 3
    return (
        f"CASE WHEN {rejects} IS NULL THEN {quote(V.QUALITY_CLEAN)}"
        f" ELSE coalesce({listing(labels)}[{rejects}], {quote(V.QUALITY_SEVERE)}) END"
    )


def steps(value: str, compare: str, points) -> str:
    """Points of a descending scale as the greatest of what each test earns."""
    cuts, floor = points
    earned = [f"if({value} {compare} {cut}, {p}, {floor})" for cut, p in cuts]
    return f"greatest({', '.join(earned)})"


def risk(rejects: str, active: str, early: str, spread: str) -> str:
    parts = (
        steps(rejects, ">=", V.RISK_REJECTS),
        steps(active, "<", V.RISK_ACTIVITY),
        steps(early, ">", V.RISK_EARLY_TENURE),
        steps(spread, ">", V.RISK_SALARY_SPREAD),
    )
    return f"({' + '.join(parts)})::INT"


def risk_band(score: str) -> str:
    labels = [V.RISK_BAND_LOW, *[band for _, band in reversed(V.RISK_BANDS)]]
    reached = " + ".join(f"({score} >= {cut})::INT" for cut, _ in V.RISK_BANDS)
    return f"{listing(labels)}[1 + {reached}]"


def dept_action(reject_rank: str, activity_rank: str, early: str) -> str:
    return f"""
        if({reject_rank} <= {V.DEPT_ACTION_RANK}, {quote(V.DEPT_ACTION_AUDIT)},
        if({activity_rank} <= {V.DEPT_ACTION_RANK}, {quote(V.DEPT_ACTION_STABILISE)},
        if({early} > {V.DEPT_ACTION_EARLY_PCT}, {quote(V.DEPT_ACTION_ONBOARD)},
           {quote(V.DEPT_ACTION_MAINTAIN)})))"""


def hr_action(years: str, salary: str, avg: str, band: str) -> str:
    return f"""
        if({years} >= {V.RETAIN_YEARS} AND {salary} >= {avg}, {quote(V.ACTION_RETAIN)},
        if({years} < {V.DEVELOP_YEARS} AND {salary} < {avg}, {quote(V.ACTION_DEVELOP)},
        if(list_contains({listing([V.QUALITY_MODERATE, V.QUALITY_SEVERE])}, {band}),
           {quote(V.ACTION_INVESTIGATE)}, {quote(V.ACTION_MONITOR)})))"""


def percent(part: str, whole: str) -> str:
    return scaled(half_up(f"({part}) * 10000", whole), 2, "DECIMAL(20,2)")


def off_average(salary: str, avg: str) -> str:
    """(salary - avg) / avg * 100 at two places, avg a decimal(14,6)."""
    micro = f"({avg} * 1000000)::HUGEINT"
    return scaled(half_up(f"({cents(salary)} * 10000 - {micro}) * 10000", micro), 2,
                  "DECIMAL(20,2)")


def index_of(salary: str, avg: str) -> str:
    micro = f"({avg} * 1000000)::HUGEINT"
    return scaled(half_up(f"{cents(salary)} * 10000 * 10000", micro), 4, "DECIMAL(12,4)")


def position(rank: str, tile: str) -> str:
    by_tile = listing([V.POSITION_LOWER, V.POSITION_MID, V.POSITION_MID, V.POSITION_UPPER])
    return f"if({rank} = 1, {quote(V.POSITION_TOP)}, {by_tile}[{tile}])"


def recent_rejects(days: int) -> str:
    return f"""
        SELECT source_system, source_employee_id, count(*) AS reject_count,
               max(rejected_at) AS last_rejected_at,
               array_to_string(list_sort(list(DISTINCT rejection_reason)), '; ') AS reject_reasons
        FROM fx_rejects WHERE rejected_at >= {AS_OF_TS} - to_days({days}) GROUP BY ALL"""


SHAPED = {
    V.DATE_SHAPES[0][0]: "%Y-%m-%d",
    V.DATE_SHAPES[1][0]: "%d/%m/%Y",
    V.DATE_SHAPES[2][0]: "%m-%d-%Y",
}
_DATES = ", ".join(
    f"if(regexp_matches(hire_date_raw, {quote(shape)}),"
    f" try_strptime(hire_date_raw, {quote(fmt)}), NULL)"
    for shape, fmt in SHAPED.items()
)
_DIGITS = "translate(salary_raw, ',$', '')"

# Steps shared by several queries: name -> (names it needs, query).
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    **TABLES,
    "trimmed": (
        ("fx_staging",),
        f"""
        SELECT source_system, source_employee_id, trim(first_name) AS first_name_raw,
               trim(last_name) AS last_name_raw, lower(trim(email)) AS email_raw,
               trim(hire_date_raw) AS hire_date_raw, trim(salary_raw) AS salary_raw,
               trim(department_id_raw) AS department_id_raw,
               trim(department_name_raw) AS department_name_raw, trim(status_raw) AS status_raw,
               coalesce(updated_at, ingested_at, {AS_OF_TS}) AS event_ts, ingested_at
        FROM fx_staging
        """,
    ),
    "typed": (
        ("trimmed",),
        f"""
        SELECT *, nullif(first_name_raw, '') AS first_name, nullif(last_name_raw, '') AS last_name,
               nullif(email_raw, '') AS email, coalesce({_DATES})::DATE AS hire_date,
               if(regexp_matches({_DIGITS}, {quote(V.SALARY_SHAPE)}),
                  try_cast({_DIGITS} AS DECIMAL(10,2)), NULL) AS salary,
               if(regexp_matches(department_id_raw, {quote(V.DEPARTMENT_ID_SHAPE)}),
                  try_cast(department_id_raw AS BIGINT), NULL) AS department_id_from_source,
               nullif(department_name_raw, '') AS department_name,
               {mapped("upper(status_raw)", STATUS, V.DEFAULT_STATUS)} AS standardized_status,
               array_to_string([coalesce(source_system, 'NA'), coalesce(source_employee_id, 'NA'),
                   coalesce(nullif(email_raw, ''), 'NA'),
                   coalesce(nullif(first_name_raw, ''), 'NA'),
                   coalesce(nullif(last_name_raw, ''), 'NA')], '|') AS business_key
        FROM trimmed
        """,
    ),
    "judged": (
        ("typed",),
        f"""
        SELECT *, list_filter([
                   if(first_name IS NULL OR last_name IS NULL, {quote(V.REASON_NAMES)}, NULL),
                   if(hire_date IS NULL, {quote(V.REASON_HIRE_DATE)}, NULL),
                   if(salary IS NULL, {quote(V.REASON_SALARY)}, NULL),
                   if(salary < 0, {quote(V.REASON_NEGATIVE)}, NULL),
                   if(NOT regexp_matches(email, {quote(V.EMAIL_SHAPE)}),
                      {quote(V.REASON_EMAIL)}, NULL)
               ], lambda r: r IS NOT NULL)[1] AS reject_reason,
               count(*) OVER newer = 1 AS is_latest
        FROM typed
        WINDOW newer AS (PARTITION BY business_key
            ORDER BY event_ts DESC NULLS LAST, ingested_at DESC NULLS LAST
            ROWS UNBOUNDED PRECEDING)
        """,
    ),
    "kept": (("judged",), "SELECT * FROM judged WHERE is_latest AND reject_reason IS NULL"),
    "refused": (
        ("judged", "fx_rejects"),
        f"""
        SELECT (SELECT max(reject_id) FROM fx_rejects) + row_number() OVER (
                   ORDER BY business_key, event_ts, ingested_at) AS reject_id,
               source_system, source_employee_id, first_name_raw AS first_name,
               last_name_raw AS last_name, email_raw AS email, hire_date_raw, salary_raw,
               department_id_raw, department_name_raw, status_raw,
               coalesce(reject_reason, {quote(V.REASON_DUPLICATE)}) AS rejection_reason
        FROM judged WHERE NOT is_latest OR reject_reason IS NOT NULL
        """,
    ),
    "unseen": (
        ("kept", "fx_departments"),
        """
        SELECT min(department_name) AS department_name FROM kept
        WHERE department_name IS NOT NULL
          AND lower(department_name) NOT IN (SELECT lower(department_name) FROM fx_departments)
        GROUP BY lower(department_name)
        """,
    ),
    "discovered": (
        ("unseen", "fx_departments"),
        f"""
        SELECT (SELECT max(department_id) FROM fx_departments)
                   + row_number() OVER (ORDER BY department_name) AS department_id,
               department_name, NULL::BIGINT AS manager_id,
               {quote(V.DISCOVERED_LOCATION)} AS location
        FROM unseen
        """,
    ),
    "departments_next": (
        ("discovered", "fx_departments"),
        """
        SELECT * FROM fx_departments UNION ALL BY NAME SELECT * FROM discovered
        UNION ALL BY NAME
        SELECT 0::BIGINT AS department_id, 'Unknown' AS department_name,
               NULL::BIGINT AS manager_id, 'N/A' AS location
        WHERE 0 NOT IN (SELECT department_id FROM fx_departments)
        """,
    ),
    "placed": (
        ("kept", "departments_next", "fx_employees_before"),
        """
        SELECT k.* EXCLUDE (department_name),
               coalesce(i.department_id, n.department_id, 0) AS department_id,
               coalesce(i.department_name, n.department_name, 'Unknown') AS department_name,
               e.employee_id AS existing_employee_id,
               row_number() OVER (ORDER BY business_key) AS seq
        FROM kept k
        LEFT JOIN departments_next i ON i.department_id = k.department_id_from_source
        LEFT JOIN (SELECT lower(department_name) AS folded, min(department_id) AS department_id,
                          arg_min(department_name, department_id) AS department_name
                   FROM departments_next GROUP BY 1) n ON n.folded = lower(k.department_name)
        LEFT JOIN (SELECT lower(email) AS email, min(employee_id) AS employee_id
                   FROM fx_employees_before GROUP BY 1) e ON e.email = k.email
        """,
    ),
    "averaged": (
        ("placed",),
        f"""
        SELECT department_id, {average("sum(salary)", "count(*)")} AS dept_average
        FROM placed GROUP BY department_id
        """,
    ),
    "final": (
        ("placed", "averaged", "fx_employees_before"),
        f"""
        SELECT coalesce(existing_employee_id,
                   seq + (SELECT max(employee_id) FROM fx_employees_before)) AS employee_id,
               first_name, last_name, email, hire_date, salary, department_id,
               standardized_status, source_system, source_employee_id, department_name,
               years AS tenure_years,
               {below("salary", V.SALARY_CUTS, V.SALARY_BANDS)} AS salary_band,
               {below("years", V.TENURE_CUTS, V.TENURE_BUCKETS)} AS tenure_bucket,
               {index_of("salary", "dept_average")} AS compensation_index, existing_employee_id
        FROM (SELECT *, {years_between("hire_date")} AS years FROM placed)
        JOIN averaged USING (department_id)
        """,
    ),
    "final_row": (
        ("final",),
        f"""
        SELECT employee_id, first_name || ' ' || last_name AS full_name, email AS normalized_email,
               department_id, department_name, standardized_status, salary, salary_band,
               tenure_years, tenure_bucket, compensation_index, source_system, source_employee_id,
               'run-under-test' AS etl_run_id, {AS_OF_TS} AS loaded_at
        FROM final
        """,
    ),
    "newest": (
        ("fx_enriched",),
        "SELECT unnest(arg_max(fx_enriched, loaded_at)) FROM fx_enriched GROUP BY employee_id",
    ),
    "last_run": (
        ("fx_audit",),
        """
        SELECT * FROM fx_audit WHERE status = 'SUCCESS'
        ORDER BY finished_at DESC, started_at DESC LIMIT 1
        """,
    ),
    "salaries": (
        ("fx_employees",),
        f"""
        SELECT department_id, count(*) AS dept_employee_count,
               {average("sum(salary)", "count(*)")} AS dept_avg_salary,
               min(salary) AS dept_min_salary, max(salary) AS dept_max_salary,
               round(stddev_pop(salary)::DECIMAL(20,6), 2)::DECIMAL(20,2) AS dept_salary_stddev
        FROM fx_employees GROUP BY department_id
        """,
    ),
    "rejects_90": (("fx_rejects",), recent_rejects(V.REPORT_REJECT_DAYS)),
    "rejects_180": (("fx_rejects",), recent_rejects(V.DASHBOARD_REJECT_DAYS)),
    "facts": (
        ("fx_employees", "newest", "rejects_180"),
        f"""
        SELECT e.department_id, years, coalesce(n.salary, e.salary) AS pay,
               upper(coalesce(n.standardized_status, e.status)) AS state,
               coalesce(n.salary_band, {below("e.salary", V.SALARY_CUTS, V.SALARY_BANDS)}) AS band,
               coalesce(n.tenure_bucket, {below("years", V.TENURE_CUTS, V.TENURE_BUCKETS)})
                   AS bucket,
               reject_count, last_rejected_at
        FROM (SELECT *, {years_between("hire_date")} AS years FROM fx_employees) e
        LEFT JOIN newest n USING (employee_id)
        LEFT JOIN rejects_180 r ON r.source_system = n.source_system
                               AND r.source_employee_id = n.source_employee_id
        """,
    ),
    "measures": (
        ("facts",),
        f"""
        SELECT *, {percent("active_employees", "total_employees")} AS active_ratio_pct,
               {percent("high_band_count", "total_employees")} AS high_salary_band_pct,
               {percent("early_tenure_count", "total_employees")} AS early_tenure_pct
        FROM (
            SELECT department_id, count(*) AS total_employees,
                   count(*) FILTER (state = 'ACTIVE') AS active_employees,
                   count(*) FILTER (state = 'ON LEAVE') AS on_leave_employees,
                   count(*) FILTER (state = 'INACTIVE') AS inactive_employees,
                   {average("sum(pay)", "count(*)")} AS avg_salary, min(pay) AS min_salary,
                   max(pay) AS max_salary, stddev_pop(pay)::DECIMAL(20,6) AS salary_stddev,
                   {scaled(half_up("sum(years) * 10000", "count(*)"), 4, "DECIMAL(14,4)")}
                       AS avg_years_of_service,
                   count(*) FILTER (list_contains({listing(V.HIGH_BANDS)}, band))
                       AS high_band_count,
                   count(*) FILTER (list_contains({listing(V.EARLY_BUCKETS)}, bucket))
                       AS early_tenure_count,
                   coalesce(sum(reject_count), 0)::BIGINT AS total_rejects,
                   max(last_rejected_at) AS last_reject_time
            FROM facts GROUP BY department_id
        )
        """,
    ),
    "scored": (
        ("measures",),
        f"""
        SELECT *, {risk_band("risk_score_raw")} AS risk_band,
               {dept_action("rank_by_data_rejects", "rank_by_low_activity", "early_tenure_pct")}
                   AS recommended_action
        FROM (
            SELECT *, (dense_rank() OVER (ORDER BY avg_salary DESC))::INT AS rank_by_avg_salary,
                   (dense_rank() OVER (ORDER BY total_rejects DESC))::INT AS rank_by_data_rejects,
                   (dense_rank() OVER (ORDER BY active_ratio_pct))::INT AS rank_by_low_activity,
                   {risk("total_rejects", "active_ratio_pct", "early_tenure_pct", "salary_stddev")}
                       AS risk_score_raw
            FROM measures
        )
        """,
    ),
    "paid": (
        ("fx_employees", "newest"),
        f"""
        SELECT e.*, n.* EXCLUDE (employee_id, department_id, department_name, salary),
               coalesce(n.salary, e.salary) AS pay,
               coalesce(standardized_status, status) AS state,
               {years_between("hire_date")} AS service_years,
               ({months_between("hire_date")})::INT AS service_months
        FROM fx_employees e LEFT JOIN newest n USING (employee_id)
        """,
    ),
    "paid_ranked": (
        ("paid",),
        """
        SELECT *, (dense_rank() OVER (PARTITION BY department_id ORDER BY pay DESC))::INT AS place,
               (ntile(4) OVER (PARTITION BY department_id ORDER BY pay, employee_id))::INT AS tile
        FROM paid
        """,
    ),
    "places": (
        ("fx_departments",),
        f"""
        SELECT *, {REPORT_REGION} AS geo_region, {DASHBOARD_REGION} AS geo_cluster
        FROM fx_departments
        """,
    ),
}

RANKED = f"""
    SELECT employee_id, department_id, dept_salary_rank, dept_salary_quartile,
           {position("dept_salary_rank", "dept_salary_quartile")} AS salary_position_label
    FROM (
        SELECT employee_id, department_id,
               (dense_rank() OVER (PARTITION BY department_id ORDER BY salary DESC))::INT
                   AS dept_salary_rank,
               (ntile(4) OVER (PARTITION BY department_id ORDER BY salary, employee_id))::INT
                   AS dept_salary_quartile
        FROM fx_employees
    )"""

DASHBOARD = f"""
    SELECT department_id, coalesce(department_name, 'Unknown') AS department_name,
           coalesce(location, 'N/A') AS location,
           coalesce(geo_cluster, {quote(V.DASHBOARD_REGION_UNKNOWN)}) AS geo_cluster,
           total_employees, active_employees, on_leave_employees, inactive_employees,
           active_ratio_pct, round(avg_salary, 2)::DECIMAL(20,2) AS avg_salary,
           min_salary::DECIMAL(20,2) AS min_salary, max_salary::DECIMAL(20,2) AS max_salary,
           round(salary_stddev, 2)::DECIMAL(20,2) AS salary_stddev,
           round(avg_years_of_service, 2)::DECIMAL(20,2) AS avg_years_of_service,
           high_band_count, high_salary_band_pct, early_tenure_count, early_tenure_pct,
           total_rejects AS total_rejects_180d, last_reject_time, rank_by_avg_salary,
           rank_by_data_rejects, rank_by_low_activity, risk_score_raw, risk_band,
           recommended_action, run_id AS latest_run_id, started_at AS latest_run_start,
           finished_at AS latest_run_end, source_row_count, rejected_row_count, loaded_row_count,
           {percent("rejected_row_count", "source_row_count")} AS latest_reject_rate_pct
    FROM scored LEFT JOIN places USING (department_id), last_run
    WHERE total_employees >= {V.DASHBOARD_MIN_EMPLOYEES}
      AND risk_band <> {quote(V.RISK_BAND_LOW)} AND active_ratio_pct >= """

REPORT = f"""
        SELECT employee_id AS employee_key, first_name || ' ' || last_name AS employee_name,
               coalesce(normalized_email, lower(email)) AS normalized_email, department_id,
               department_name, location AS department_location, geo_region, hire_date,
               service_years, service_months,
               {below("service_years", V.TENURE_CUTS, V.TENURE_CLASSES)} AS tenure_classification,
               pay AS effective_salary, salary_band,
               {below("pay", V.SALARY_CUTS, V.COMPENSATION_TIERS)} AS compensation_tier,
               place AS dept_salary_rank, tile AS dept_salary_quartile,
               {off_average("pay", "dept_avg_salary")} AS pct_vs_dept_avg, dept_avg_salary,
               dept_min_salary, dept_max_salary, state AS effective_status,
               {mapped("upper(state)", V.REPORT_STATUS_LABELS, V.REPORT_STATUS_UNKNOWN)}
                   AS status_label,
               compensation_index, source_system, source_employee_id,
               {quality("reject_count")} AS source_quality_band,
               coalesce(reject_count, 0) AS reject_count_90d, last_rejected_at, reject_reasons,
               run_id AS latest_success_run_id, started_at AS latest_run_started_at,
               finished_at AS latest_run_finished_at, source_row_count AS latest_run_source_rows,
               rejected_row_count AS latest_run_rejected_rows,
               loaded_row_count AS latest_run_loaded_rows,
               {position("place", "tile")} AS salary_position_label,
               {hr_action("service_years", "pay", "dept_avg_salary", quality("reject_count"))}
                   AS recommended_hr_action
        FROM paid_ranked
        JOIN places USING (department_id) JOIN salaries USING (department_id)
        LEFT JOIN rejects_90 USING (source_system, source_employee_id), last_run
        WHERE list_contains({listing(V.REPORT_STATUSES)}, state)
          AND pay >= {V.REPORT_MIN_SALARY} AND service_months >= {V.REPORT_MIN_MONTHS}
          AND geo_region <> {quote(V.REPORT_REGION_UNKNOWN)}
          AND coalesce(reject_count, 0) <= {V.REPORT_MAX_REJECTS}"""

SOURCE_LOOKUP = """
    SELECT employee_id, source_system, source_employee_id, reject_count
    FROM newest LEFT JOIN (SELECT source_system, source_employee_id, count(*) AS reject_count
                           FROM fx_rejects GROUP BY ALL)
    USING (source_system, source_employee_id)"""

SURVIVORS = """
    SELECT source_system, source_employee_id, first_name, last_name, email, hire_date, salary,
           department_id_from_source, department_name, standardized_status, event_ts,
           ingested_at, business_key FROM kept"""

GLOBAL_RANKS = """
        SELECT department_id, rank_by_avg_salary, rank_by_data_rejects, rank_by_low_activity,
               risk_score_raw, risk_band, recommended_action FROM scored"""

HIRED = f"""
        SELECT row_number() OVER (ORDER BY email) + (SELECT max(employee_id) FROM fx_employees)
                   AS employee_id, first_name, last_name, email, {AS_OF} AS hire_date, salary,
               department_id, 'Active' AS status, {AS_OF_TS} AS created_at
        FROM fx_hires"""

UPSERTED = f"""
        SELECT employee_id, coalesce(f.first_name, e.first_name) AS first_name,
               coalesce(f.last_name, e.last_name) AS last_name,
               if(e.employee_id IS NULL, f.email, e.email) AS email,
               coalesce(f.hire_date, e.hire_date) AS hire_date,
               coalesce(f.salary, e.salary) AS salary,
               coalesce(f.department_id, e.department_id) AS department_id,
               coalesce(f.standardized_status, e.status) AS status,
               coalesce(e.created_at, {AS_OF_TS}) AS created_at
        FROM fx_employees_before e FULL JOIN final f USING (employee_id)"""

EMPLOYEES = "SELECT * FROM fx_employees"
LOW_AND_GONE = (
    f"salary < {V.DELETE_SALARY_BELOW} AND status = {quote(V.DELETE_STATUS)}"
)
RAISED = (
    f"if(hire_date < DATE {quote(V.RAISE_HIRED_BEFORE)},"
    " (((salary * 100)::BIGINT * 110 + 50) // 100 * 0.01::DECIMAL(3,2))::DECIMAL(10,2), salary)"
)

STAGED = (
    "source_system",
    "source_employee_id",
    "first_name",
    "last_name",
    "email",
    "hire_date_raw",
    "salary_raw",
    "department_id_raw",
    "department_name_raw",
    "status_raw",
    "ingested_at",
    "updated_at",
)

QUERIES: dict[str, str] = {
    "scan_all": EMPLOYEES,
    "high_earners": f"""
        SELECT employee_id, first_name, last_name, salary FROM fx_employees
        WHERE salary > {V.HIGH_EARNER_SALARY}""",
    "dept_having": f"""
        SELECT department_id, n AS employee_count, {average("total", "n")} AS avg_salary
        FROM (SELECT department_id, count(*) AS n, sum(salary) AS total
              FROM fx_employees GROUP BY 1) WHERE n > {V.HAVING_MORE_THAN}""",
    "emp_dept_join": """
        SELECT employee_id, first_name, department_name
        FROM fx_employees JOIN fx_departments USING (department_id)""",
    "active_employees": """
        SELECT employee_id, first_name, last_name, email, salary, department_name, hire_date
        FROM fx_employees JOIN fx_departments USING (department_id) WHERE status = 'Active'""",
    "active_employees_literal": f"""
        SELECT employee_id, first_name, last_name, email, salary, department_name, hire_date
        FROM fx_employees JOIN fx_departments USING (department_id)
        WHERE status = {quote(V.VIEW_STATUS)}""",
    "salary_summary": f"""
        SELECT any_value(department_name) AS department_name, count(*) AS employee_count,
               {average("sum(salary)", "count(*)")} AS avg_salary, min(salary) AS min_salary,
               max(salary) AS max_salary, sum(salary)::DECIMAL(20,2) AS total_salary
        FROM fx_employees JOIN fx_departments USING (department_id) GROUP BY department_id""",
    "employee_tenure": f"""
        SELECT employee_id, first_name || ' ' || last_name AS full_name, email, salary,
               (year({AS_OF}) - year(hire_date))::INT AS tenure_years, department_name
        FROM fx_employees JOIN fx_departments USING (department_id)""",
    "view_by_name": f"""
        SELECT department_name, count(*) AS employees,
               (year({AS_OF}) - min(year(hire_date)))::INT AS longest
        FROM fx_employees JOIN fx_departments USING (department_id) GROUP BY 1""",
    "tenure_udf": f"""
        SELECT employee_id, (year({AS_OF}) - year(hire_date))::INT AS tenure FROM fx_employees""",
    "bonus_udf": """
        SELECT employee_id, bonus, bonus AS bonus_in_sql FROM (
            SELECT employee_id, ((round(salary, 0)::BIGINT * [25, 25, 25, 10, 15, 15]
                [employee_id % 6 + 1] + 50) // 100)::DECIMAL(10,0) AS bonus FROM fx_employees)""",
    "service_years_months": f"""
        SELECT employee_id, {years_between("hire_date")} AS service_years,
               ({months_between("hire_date")})::INT AS service_months FROM fx_employees""",
    "status_rules": f"""
        SELECT source_employee_id, ingested_at, updated_at, standardized_status,
               {mapped("upper(standardized_status)", V.REPORT_STATUS_LABELS,
                       V.REPORT_STATUS_UNKNOWN)} AS report_label,
               {mapped("upper(standardized_status)", V.DASHBOARD_STATUS_LABELS,
                       V.DASHBOARD_STATUS_UNKNOWN)} AS dashboard_label,
               {mapped("upper(status_raw)", V.DASHBOARD_STATUS_LABELS,
                       V.DASHBOARD_STATUS_UNKNOWN)} AS raw_label
        FROM (SELECT *, {mapped("upper(trim(status_raw))", STATUS, V.DEFAULT_STATUS)}
                     AS standardized_status FROM fx_staging)""",
    "band_rules": f"""
        SELECT employee_id, {below("salary", V.SALARY_CUTS, V.SALARY_BANDS)} AS salary_band,
               {below("salary", V.SALARY_CUTS, V.COMPENSATION_TIERS)} AS compensation_tier,
               {below("years", V.TENURE_CUTS, V.TENURE_BUCKETS)} AS tenure_bucket,
               {below("years", V.TENURE_CUTS, V.TENURE_CLASSES)} AS tenure_class,
               {below("years", V.TENURE_STAGE_CUTS, V.TENURE_STAGES)} AS tenure_stage
        FROM (SELECT *, {years_between("hire_date")} AS years FROM fx_employees)""",
    "geo_rules": "SELECT department_id, geo_region, geo_cluster FROM places",
    "quality_rules": f"""
        SELECT source_system, source_employee_id, {quality("reject_count")} AS source_quality_band
        FROM rejects_90""",
    "hr_action_rules": f"""
        SELECT employee_id, {off_average("salary", "dept_avg_salary")} AS pct_vs_dept_avg,
               {hr_action("years", "salary", "dept_avg_salary",
                          quality("nullif(employee_id % 8, 0)"))} AS recommended_hr_action
        FROM (SELECT *, {years_between("hire_date")} AS years FROM fx_employees) e
        JOIN salaries s ON s.department_id IS NOT DISTINCT FROM e.department_id""",
    "risk_rules": f"""
        SELECT order_key, risk_score_raw, {risk_band("risk_score_raw")} AS risk_band,
               {dept_action("order_key % 9", "order_key % 7", "order_key * 7 % 101")}
                   AS recommended_action
        FROM (SELECT o_orderkey AS order_key,
                     {risk("o_orderkey % 25", "o_orderkey % 101", "o_orderkey * 7 % 101",
                           "o_totalprice::DECIMAL(10,2) / 10")} AS risk_score_raw FROM orders)""",
    "dept_salary_stats": "SELECT * FROM salaries",
    "dept_kpis": """
        SELECT * REPLACE (round(salary_stddev, 2)::DECIMAL(20,2) AS salary_stddev)
        FROM measures""",
    "dept_global_ranks": GLOBAL_RANKS,
    "dept_global_ranks_sliced": GLOBAL_RANKS,
    "reject_stats": "SELECT * FROM rejects_90",
    "reject_stats_14d": recent_rejects(14),
    "latest_enriched": "SELECT * FROM newest",
    "latest_run": "SELECT * FROM last_run",
    "dept_rank_quartile": RANKED,
    "dept_rank_quartile_sliced": RANKED,
    "dept_avg_window": f"""
        SELECT employee_id, e.department_id, salary, dept_avg_salary,
               {index_of("salary", "dept_avg_salary")} AS compensation_index
        FROM fx_employees e
        JOIN salaries s ON s.department_id IS NOT DISTINCT FROM e.department_id""",
    "latest_version_join": """
        SELECT employee_id, etl_run_id, source_system
        FROM fx_employees LEFT JOIN newest USING (employee_id)""",
    "source_key_lookup": SOURCE_LOOKUP,
    "source_key_lookup_salted": SOURCE_LOOKUP,
    "folded_name_lookup": """
        SELECT source_employee_id, updated_at, department_name_raw, department_id
        FROM fx_staging LEFT JOIN fx_departments
        ON lower(department_name) = lower(department_name_raw)""",
    "distinct_department_names": """
        SELECT DISTINCT department_name FROM kept WHERE department_name IS NOT NULL""",
    "stg_normalized": """
        SELECT source_system, source_employee_id, first_name, last_name, email, hire_date, salary,
               department_id_from_source, department_name, standardized_status, event_ts,
               ingested_at, business_key FROM typed""",
    "stg_validated": "SELECT business_key, event_ts, ingested_at, reject_reason FROM judged",
    "stg_survivors": SURVIVORS,
    "stg_survivors_salted": SURVIVORS,
    "stg_rejects": f"""
        SELECT *, 'run-under-test' AS run_id, {AS_OF_TS} AS rejected_at FROM refused""",
    "run_readback": "SELECT * FROM fx_audit WHERE run_id = 'run-2024-01-03'",
    "target_readback": "SELECT * FROM fx_enriched",
    "rejects_readback": "SELECT reject_id, rejection_reason FROM refused",
    "default_department": """
        SELECT department_id + 1 AS department_id, * EXCLUDE (department_id), false AS had_default
        FROM fx_departments
        UNION ALL BY NAME
        SELECT 0 AS department_id, 'Unknown' AS department_name, NULL AS manager_id,
               'N/A' AS location, false AS had_default
        UNION ALL BY NAME
        SELECT *, true AS had_default FROM fx_departments""",
    "unseen_departments_anti": "SELECT * FROM unseen",
    "new_departments": "SELECT * FROM discovered",
    "departments_after": "SELECT * FROM departments_next",
    "employee_final": "SELECT * FROM final",
    "employees_upsert": UPSERTED,
    "employees_upsert_bucketed": UPSERTED,
    "second_load_employees": UPSERTED,
    "published_stamps": f"""
        SELECT employee_id,
               CASE WHEN e.employee_id IS NOT NULL AND f.employee_id IS NOT NULL THEN {AS_OF_TS} END
                   AS updated_at
        FROM fx_employees_before e FULL JOIN final f USING (employee_id)""",
    "load_counters": f"""
        SELECT d.*, {V.COUNTER_STEP} * (SELECT count(*) FROM final f
            WHERE f.department_id = d.department_id
              AND f.employee_id NOT IN (SELECT employee_id FROM fx_employees_before))
            AS employee_count FROM departments_next d""",
    "published_counters": f"""
        SELECT d.*, {V.COUNTER_STEP} * (SELECT count(*) FROM final f
            WHERE f.department_id = d.department_id
              AND f.employee_id NOT IN (SELECT employee_id FROM fx_employees_before))
            AS employee_count FROM departments_next d""",
    "target_upsert": """
        SELECT * FROM final_row UNION ALL
        SELECT * FROM newest WHERE employee_id NOT IN (SELECT employee_id FROM final_row)""",
    "run_audit_close": f"""
        SELECT 'run-under-test' AS run_id, {quote(V.PROCESS_NAME)} AS process_name,
               {AS_OF_TS} AS started_at, {AS_OF_TS} AS finished_at,
               {quote(V.FINAL_STATUS)} AS status, count(*) AS source_row_count,
               count(*) - (SELECT count(*) FROM kept) AS rejected_row_count,
               (SELECT count(*) FROM kept) AS loaded_row_count,
               {quote(V.FINAL_MESSAGE)} AS message
        FROM judged""",
    "run_audit_new_id": f"""
        SELECT 'run-under-test' AS run_id, {quote(V.PROCESS_NAME)} AS process_name,
               {AS_OF_TS} AS started_at, {AS_OF_TS} AS finished_at,
               {quote(V.FINAL_STATUS)} AS status, count(*) AS source_row_count,
               count(*) - (SELECT count(*) FROM kept) AS rejected_row_count,
               (SELECT count(*) FROM kept) AS loaded_row_count,
               {quote(V.FINAL_MESSAGE)} AS message
        FROM judged""",
    "run_audit_rate": f"""
        SELECT run_id, {percent("rejected_row_count", "source_row_count")} AS reject_rate_pct
        FROM fx_audit""",
    "update_key": f"""
        SELECT * REPLACE (if(employee_id = {V.UPDATE_KEY}, {V.UPDATE_SALARY}, salary)
            ::DECIMAL(10,2) AS salary) FROM fx_employees""",
    "update_multi": f"""
        SELECT * REPLACE (if(employee_id = {V.UPDATE_KEY}, 0, salary)::DECIMAL(10,2) AS salary,
            if(employee_id = {V.UPDATE_KEY}, {quote(V.UPDATE_EMAIL)}, email) AS email)
        FROM fx_employees""",
    "update_bulk": f"SELECT * REPLACE ({RAISED} AS salary) FROM fx_employees",
    "touch_updated_at": f"""
        SELECT employee_id, {RAISED} AS salary,
               CASE WHEN hire_date < DATE {quote(V.RAISE_HIRED_BEFORE)} THEN {AS_OF_TS} END
                   AS updated_at FROM fx_employees""",
    "delete_key": f"SELECT * FROM fx_employees WHERE employee_id <> {V.DELETE_KEY}",
    "delete_range": "SELECT * FROM fx_employees WHERE hire_date <= DATE '1999-01-01'",
    "delete_range_literal": f"""
        SELECT * FROM fx_employees WHERE hire_date <= DATE {quote(V.DELETE_HIRED_AFTER)}""",
    "delete_conj": f"SELECT * FROM fx_employees WHERE ({LOW_AND_GONE}) IS NOT TRUE",
    "deleted_log": f"""
        SELECT employee_id, first_name || ' ' || last_name AS name, {AS_OF_TS} AS deleted_date
        FROM fx_employees WHERE {LOW_AND_GONE}""",
    "batch_hire": HIRED,
    "employees_after_hire": f"SELECT * FROM fx_employees UNION ALL BY NAME ({HIRED})",
    "salary_change": """
        SELECT * EXCLUDE (new_salary) REPLACE (coalesce(new_salary, salary) AS salary)
        FROM fx_employees LEFT JOIN (
            SELECT employee_id, arg_max(new_salary, change_seq) AS new_salary
            FROM fx_changes GROUP BY 1) USING (employee_id)""",
    "salary_change_stamped": f"""
        SELECT e.employee_id, coalesce(new_salary, salary) AS salary,
               CASE WHEN c.employee_id IS NOT NULL THEN {AS_OF_TS} END AS updated_at
        FROM fx_employees e LEFT JOIN (
            SELECT employee_id, arg_max(new_salary, change_seq) AS new_salary
            FROM fx_changes GROUP BY 1) c ON c.employee_id = e.employee_id""",
    "salary_audit": f"""
        SELECT c.employee_id, CASE WHEN e.employee_id IS NOT NULL THEN coalesce(
                   lag(new_salary) OVER (PARTITION BY c.employee_id ORDER BY change_seq), salary)
               END AS old_salary, new_salary, {AS_OF_TS} AS change_date
        FROM fx_changes c LEFT JOIN fx_employees e USING (employee_id)""",
    "dept_counter": f"""
        SELECT *, {V.COUNTER_STEP} * (SELECT count(*) FROM fx_hires h
            WHERE h.department_id = d.department_id) AS employee_count FROM fx_departments d""",
    "departments_after_hire": f"""
        SELECT *, {V.COUNTER_STEP} * (SELECT count(*) FROM fx_hires h
            WHERE h.department_id = d.department_id) AS employee_count FROM fx_departments d""",
    "append_log": f"""
        SELECT * FROM fx_audit UNION ALL BY NAME
        SELECT 'run-by-hand' AS run_id, {quote(V.PROCESS_NAME)} AS process_name,
               {AS_OF_TS} AS started_at, NULL::TIMESTAMP AS finished_at, 'RUNNING' AS status,
               0 AS source_row_count, 0 AS rejected_row_count, 0 AS loaded_row_count,
               NULL AS message""",
    "schema_evolve": """
        SELECT * REPLACE (salary::DECIMAL(14,2) AS salary), NULL::VARCHAR AS phone_number,
               0::INT AS performance_rating FROM fx_employees""",
    "empty_table": "SELECT * FROM fx_departments",
    "check_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "check_unique": """
        SELECT source_system, source_employee_id, count(*) AS row_count FROM fx_staging
        WHERE source_system IS NOT NULL AND source_employee_id IS NOT NULL
        GROUP BY ALL HAVING count(*) > 1""",
    "check_nulls": " UNION ALL ".join(
        f"SELECT {quote(c)} AS column_name, count(*) - count({c}) AS null_rows FROM fx_staging"
        for c in STAGED
    ),
    "check_contract": """
        SELECT 'required' AS check_name, * FROM (
            UNPIVOT (SELECT 0::BIGINT AS employee_id, count(*) - count(first_name) AS first_name,
                            count(*) - count(last_name) AS last_name,
                            count(*) - count(hire_date) AS hire_date FROM typed)
            ON COLUMNS(*) INTO NAME column_name VALUE bad_rows)
        UNION ALL BY NAME
        SELECT 'length' AS check_name, * FROM (
            UNPIVOT (SELECT count(*) FILTER (length(first_name) > 50) AS first_name,
                            count(*) FILTER (length(last_name) > 50) AS last_name,
                            count(*) FILTER (length(email) > 100) AS email,
                            count(*) FILTER (length(standardized_status) > 20) AS status FROM typed)
            ON COLUMNS(*) INTO NAME column_name VALUE bad_rows)
        UNION ALL BY NAME
        SELECT 'type' AS check_name, 'salary' AS column_name, 0::BIGINT AS bad_rows
        UNION ALL BY NAME
        SELECT 'key' AS check_name, 'employee_id' AS column_name, count(*) AS bad_rows
        FROM (SELECT 1 FROM typed GROUP BY source_employee_id HAVING count(*) > 1)
        UNION ALL BY NAME
        SELECT 'unique' AS check_name, 'email' AS column_name, count(*) AS bad_rows
        FROM (SELECT 1 FROM typed WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1)""",
    "check_orphans": """
        SELECT employee_id, count(*) AS row_count FROM fx_changes
        WHERE employee_id NOT IN (SELECT employee_id FROM fx_employees) GROUP BY 1""",
    "check_foreign_key": """
        SELECT department_id, count(*) AS row_count FROM fx_employees
        WHERE department_id NOT IN (SELECT department_id FROM fx_departments) GROUP BY 1""",
    "check_lengths": """
        UNPIVOT (SELECT count(*) FILTER (length(first_name) > 3) AS first_name,
                        count(*) FILTER (length(last_name) > 17) AS last_name,
                        count(*) FILTER (length(email) > 15) AS email,
                        count(*) FILTER (length(status) > 7) AS status FROM fx_employees)
        ON COLUMNS(*) INTO NAME column_name VALUE overlong_rows""",
    "check_numbers": """
        UNPIVOT (SELECT count(*) FILTER (o_totalprice >= 99999.995) AS o_totalprice,
                        count(*) FILTER (o_orderkey > 9999) AS o_orderkey FROM orders)
        ON COLUMNS(*) INTO NAME column_name VALUE unfit_rows""",
    "employee_report": REPORT,
    "employee_report_sliced": REPORT,
    "department_dashboard": DASHBOARD + "20",
    "department_dashboard_literal": DASHBOARD + str(V.DASHBOARD_MIN_ACTIVE_PCT),
}


def _needs(text: str) -> set[str]:
    return {name for name in STEPS if re.search(rf"\b{name}\b", text)}


def _in_order(names: set[str]) -> list[str]:
    out: list[str] = []

    def visit(name: str) -> None:
        for needed in STEPS[name][0]:
            visit(needed)
        if name not in out:
            out.append(name)

    for name in STEPS:
        if name in names:
            visit(name)
    return out


def statement(text: str) -> str:
    """The query with the steps it needs in front."""
    steps_needed = _in_order(_needs(text))
    if not steps_needed:
        return text
    ctes = ",\n".join(f"{name} AS ({STEPS[name][1]})" for name in steps_needed)
    return f"WITH {ctes}\n{text}" if not text.lstrip().startswith("UNPIVOT") else (
        f"WITH {ctes}\nSELECT * FROM ({text})"
    )


def oracle_sql() -> dict[str, str]:
    return {name: statement(text) for name, text in QUERIES.items()}
