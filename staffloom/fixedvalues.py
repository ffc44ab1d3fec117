"""Values that must equal the specification's for results to be right.

Fixed values: word lists, thresholds, labels, text patterns and date formats.
Every rule in `staffloom.functions` takes its values from here, so a threshold
is written once.
"""

# Status words (upper case) and the status each stands for; anything else, NULL
# included, is DEFAULT_STATUS.
STATUS_WORDS = (
    (("ACTIVE", "A", "1", "Y", "TRUE"), "Active"),
    (("INACTIVE", "I", "0", "N", "FALSE"), "Inactive"),
    (("ON_LEAVE", "LEAVE", "PAUSED"), "On Leave"),
)
DEFAULT_STATUS = "Active"

# Shape of a raw date and the format that reads it. '/' means day first, '-' with
# the year last means month first.
DATE_SHAPES = (
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
    (r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "dd/MM/yyyy"),
    (r"^[0-9]{2}-[0-9]{2}-[0-9]{4}$", "MM-dd-yyyy"),
)
SALARY_NOISE = ",$"
SALARY_SHAPE = r"^-?[0-9]+(\.[0-9]{1,2})?$"
SALARY_TYPE = "decimal(10,2)"
DEPARTMENT_ID_SHAPE = r"^[0-9]+$"
EMAIL_SHAPE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# Business key.
KEY_SEPARATOR = "|"
KEY_MISSING = "NA"

# Rejection reasons.
REASON_NAMES = "Missing required name fields"
REASON_HIRE_DATE = "Invalid or missing hire date"
REASON_SALARY = "Invalid salary format"
REASON_NEGATIVE = "Salary cannot be negative"
REASON_EMAIL = "Invalid email format"
REASON_DUPLICATE = "Duplicate source record in batch"
REASON_UNKNOWN = "Unknown rejection"

# Ascending cut-offs: the label of the first cut-off the value is below; the last
# label is for everything else, NULL included.
SALARY_CUTS = (40000, 70000, 100000, 150000)
SALARY_BANDS = ("L1", "L2", "L3", "L4", "L5")
COMPENSATION_TIERS = ("Entry", "Associate", "Specialist", "Lead", "Executive")
TENURE_CUTS = (2, 5, 10)
TENURE_BUCKETS = ("0-1y", "2-4y", "5-9y", "10y+")
TENURE_CLASSES = ("New Hire", "Growing Contributor", "Experienced Core", "Long Tenure")
TENURE_STAGE_CUTS = (2, 7, 13)
TENURE_STAGES = ("Early Career", "Mid Career", "Senior Core", "Legacy Expert")

# City lists (lower case) and their region in the report and in the dashboard.
REGION_CITIES = (
    ("new york", "nyc", "manhattan"),
    ("san francisco", "bay area", "seattle"),
    ("london", "berlin", "paris", "amsterdam"),
    ("bangalore", "pune", "hyderabad", "delhi"),
)
REPORT_REGIONS = ("US-East", "US-West", "Europe", "India")
REPORT_REGION_UNKNOWN = "Unknown Region"
REPORT_REGION_OTHER = "Other Region"
DASHBOARD_REGIONS = (
    "North America - East",
    "North America - West",
    "Europe Cluster",
    "India Cluster",
)
DASHBOARD_REGION_UNKNOWN = "Unknown Geography"
DASHBOARD_REGION_OTHER = "Other Geography"

# Status labels, by upper-case status.
REPORT_STATUS_LABELS = {
    "ACTIVE": "Working",
    "INACTIVE": "Separated",
    "ON LEAVE": "Temporarily Away",
}
REPORT_STATUS_UNKNOWN = "Unknown Status"
DASHBOARD_STATUS_LABELS = {
    "ACTIVE": "Employee is Active",
    "INACTIVE": "Employee is Inactive",
    "ON LEAVE": "Employee is on Leave",
}
DASHBOARD_STATUS_UNKNOWN = "Employee status Unknown"

# Source quality by reject count: no rejects, 1-2, 3-5, anything else.
QUALITY_CLEAN = "Clean Feed"
QUALITY_MINOR = "Minor Data Issues"
QUALITY_MODERATE = "Moderate Data Issues"
QUALITY_SEVERE = "Severe Data Issues"

# Salary position in the department.
POSITION_TOP = "Top Earner in Department"
POSITION_UPPER = "Upper Salary Quartile"
POSITION_LOWER = "Lower Salary Quartile"
POSITION_MID = "Mid Salary Band"

# Recommended action for an employee.
ACTION_RETAIN = "Retain-HighPriority"
ACTION_DEVELOP = "Develop-NewTalent"
ACTION_INVESTIGATE = "Investigate-DataQuality"
ACTION_MONITOR = "Monitor-Regular"
RETAIN_YEARS = 10
DEVELOP_YEARS = 2

# Department risk: descending cut-offs with the points they earn, then the floor.
RISK_REJECTS = (((20, 40), (10, 25), (5, 15)), 5)  # count at least
RISK_ACTIVITY = (((65, 30), (80, 20), (90, 10)), 2)  # percent below
RISK_EARLY_TENURE = (((60, 20), (40, 12), (25, 7)), 3)  # percent above
RISK_SALARY_SPREAD = (((35000, 15), (20000, 10), (10000, 5)), 2)  # deviation above
RISK_BANDS = ((85, "Critical Risk"), (60, "High Risk"), (35, "Medium Risk"))
RISK_BAND_LOW = "Low Risk"
HIGH_BANDS = ("L4", "L5")
EARLY_BUCKETS = ("0-1y", "2-4y")

# Recommended action for a department.
DEPT_ACTION_AUDIT = "Audit ETL Mapping + Source Data Contracts"
DEPT_ACTION_STABILISE = "Workforce Stabilization Plan"
DEPT_ACTION_ONBOARD = "Strengthen Onboarding and Mentoring"
DEPT_ACTION_MAINTAIN = "Maintain Current Governance"
DEPT_ACTION_RANK = 3
DEPT_ACTION_EARLY_PCT = 50

# Bonus: least rating and rate, then the rate of every other rating, NULL included.
BONUS_RATES = ((4, "0.15"), (3, "0.10"))
BONUS_OTHER_RATE = "0.25"

# Load.
PROCESS_NAME = "employee_etl_enrichment"
FINAL_STATUS = "FAILED"
FINAL_MESSAGE = "ETL completed with cleansing, dedupe, enrichment, and upsert."
DEFAULT_DEPARTMENT_ID = 0
DEFAULT_DEPARTMENT_NAME = "Unknown"
DEFAULT_DEPARTMENT_LOCATION = "N/A"
DISCOVERED_LOCATION = "Auto-Discovered"

# Reports, views and samples.
RUN_STATUS = "SUCCESS"
REPORT_REJECT_DAYS = 90
REPORT_STATUSES = ("Active", "ACTIVE", "On Leave", "ON LEAVE")
REPORT_MIN_SALARY = 100
REPORT_MIN_MONTHS = 6
REPORT_MAX_REJECTS = 10
DASHBOARD_REJECT_DAYS = 180
DASHBOARD_MIN_EMPLOYEES = 2
DASHBOARD_MIN_ACTIVE_PCT = 400
REASON_SEPARATOR = "; "
VIEW_STATUS = "In-progress"
HIGH_EARNER_SALARY = 70000
HAVING_MORE_THAN = 5

# Sample changes, triggers and schema changes.
UPDATE_KEY = 1001
UPDATE_SALARY = 505050
UPDATE_EMAIL = "john.d.doe@company.com"
RAISE_FACTOR = "1.10"
RAISE_HIRED_BEFORE = "2000-01-01"
DELETE_KEY = 1003
DELETE_HIRED_AFTER = "2025-06-01"
DELETE_HIRED_AFTER_LATER = "2026-06-01"
DELETE_SALARY_BELOW = 50000
DELETE_STATUS = "Inactive"
COUNTER_STEP = 100
