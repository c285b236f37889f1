"""Fixed values that decide results.

Everything here is data that has to be equal wherever these tables are built: word lists, cut-offs, labels, lookup rows and
output column names.
"""

# Texts that mean "missing" in landed files (compared in lower case, not trimmed).
MISSING_TOKENS = ("nan", "null", "")

# Age bands, both ends included; anything else is AGE_BAND_DEFAULT.
AGE_BANDS = (
    (0, 17, "0-17"),
    (18, 24, "18-24"),
    (25, 34, "25-34"),
    (35, 44, "35-44"),
    (45, 54, "45-54"),
    (55, 64, "55-64"),
    (65, 200, "65+"),
)
AGE_BAND_DEFAULT = "unknown"

# BMI categories: below the cut-off; at or above the last one is BMI_DEFAULT.
BMI_CUTS = ((18.5, "Underweight"), (25.0, "Normal"), (30.0, "Overweight"))
BMI_DEFAULT = "Obese"

# Plan lookup.
PLAN_SCHEMA = "plan_key int, plan_name string, deductible_usd int, copay_usd int, coverage_tier string"
PLAN_ROWS = (
    (1, "Bronze", 6000, 60, "Basic"),
    (2, "Silver", 3000, 40, "Standard"),
    (3, "Gold", 1000, 20, "Premium"),
    (4, "Platinum", 500, 10, "Premium+"),
)

# Provider lookup.
PROVIDER_SCHEMA = "provider_code string, provider_name string, plan_tier string, active boolean"
PROVIDER_ROWS = (
    ("P001", "Blue Ridge Health", "Gold", True),
    ("P002", "Cville Care Network", "Silver", True),
    ("P003", "Piedmont Clinic", "Bronze", True),
)

# Event rows: provider by id % 3 (remainders 0, 1, 2), plan by id % 4 + 1, date by start + id % days.
EVENT_PROVIDERS = ("P003", "P001", "P002")
EVENT_PLANS = 4
EVENT_ID_PREFIX = "E"
EVENT_ID_WIDTH = 6
EVENT_START, EVENT_DAYS = "2025-01-01", 365
BATCH_START, BATCH_DAYS = "2019-01-01", 1461
CLAIM_YEAR = 2010
INCREMENT_PREFIX = "INC_"
INCREMENT_ROWS = 25
INTERVALS = 3

# Calendar wording.
QUARTER_NAMES = ("First", "second", "third", "fourth")
HOLIDAYS = ((12, 25, "Christmas"),)
SPECIAL_DAYS = ((2, 14, "Valentines Day"),)
CALENDAR_START, CALENDAR_END = "2000-01-01", "2010-12-31"

# Silver fact columns, in order.
SILVER_COLUMNS = (
    "event_id", "member_id", "provider_code", "event_date", "charge_amount", "sex", "smoker", "region", "region_key",
    "provider_key", "network_tier", "preferred_provider", "plan_key", "plan_name", "coverage_tier", "date_key", "fact_key",
)

# Seven attributes that identify an insured person.
INSURED_COLUMNS = ("age", "age_band", "sex", "smoker", "bmi", "bmi_category", "children")

# Landing schema of the insurance rows: text first, typed after cleaning.
INSURANCE_SCHEMA = "age string, sex string, bmi string, children string, smoker string, region string, charges string"

# Event file schema.
EVENT_SCHEMA = (
    "event_id string, member_id bigint, plan_key int, provider_code string, event_date string, charge_amount double"
)
