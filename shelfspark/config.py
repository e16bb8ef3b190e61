"""Fixed values that must equal the reference pipeline's for identical results.

Everything here is a business constant (thresholds, labels, calendar,
patterns).  Keep values in their natural order; change them only when the
business rule changes.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES (business rules of the reference pipeline)
# ---------------------------------------------------------------------------

# Calendar dimension: first day and the exclusive end day of the spine.
CALENDAR_START = _dt.date(2024, 4, 1)
CALENDAR_END_EXCLUSIVE = _dt.date(2024, 9, 28)

# Holiday days flagged in the calendar dimension.
HOLIDAYS = (
    _dt.date(2024, 5, 27),
    _dt.date(2024, 6, 19),
    _dt.date(2024, 7, 4),
    _dt.date(2024, 9, 2),
)

# Seasons by month number.
SEASONS = (
    ("Winter", (12, 1, 2)),
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
    ("Fall", (9, 10, 11)),
)

# Order statuses that count as completed sales (compared lower-cased).
COMPLETED_STATUSES = ("completed", "delivered")

# Time-of-day bands on the order hour: [start, end) hours; everything else is Night.
TIME_OF_DAY_BANDS = (
    ("Morning", 5, 12),
    ("Afternoon", 12, 17),
    ("Evening", 17, 22),
)
TIME_OF_DAY_DEFAULT = "Night"

# Customer age bands (inclusive bounds); older than the last bound is Senior.
AGE_BANDS = (
    ("Young", 18, 35),
    ("Middle-aged", 36, 55),
)
AGE_BAND_SENIOR = ("Senior", 56)

# Store size bands on square feet.
STORE_SIZE_SMALL_BELOW = 5000
STORE_SIZE_LARGE_ABOVE = 10000
STORE_SIZE_LABELS = ("Small", "Medium", "Large")

# A store under this target achievement percentage is flagged.
UNDERPERFORMING_BELOW_PCT = 90

# Snapshot gap: more than this many days between snapshots is a gap.
SNAPSHOT_GAP_DAYS = 1

# Stock turnover categories.
TURNOVER_LABELS = ("No Turnover Data", "No Movement", "High Turnover", "Low Turnover")
TURNOVER_HIGH_AT = 1

# Product movement categories over turnover quartiles.
MOVEMENT_LABELS = ("No Movement", "Slow-Moving", "Fast-Moving", "Medium-Moving")
MOVEMENT_QUARTILES = 4

# Supplier concentration bands on purchase share percentage (lower bounds).
CONCENTRATION_BANDS = (
    ("Very High", 50),
    ("High", 30),
    ("Medium", 15),
)
CONCENTRATION_DEFAULT = "Low"

# Supply status labels.
SUPPLY_DELAYED = "Delayed"
SUPPLY_ON_TIME = "On Time"

# Delivery status labels.
DELIVERY_ON_TIME = "On Time"
DELIVERY_DELAYED = "Delayed"
DELIVERY_POTENTIALLY_DELAYED = "Potentially Delayed"
DELIVERY_IN_TRANSIT = "In Transit"

# Snapshot date inside a landing file name, and the supplier-feed variant
# whose day part only accepts the digits 0-2 twice.
FILE_DATE_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
SUPPLIER_FILE_DATE_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-2]{2}"

# E-mail shape check.  The reference writes the dot as an escaped dot inside
# a quoted literal, which its dialect turns into "any character"; the
# lenient form reproduces that, the strict one checks for a real dot.
EMAIL_PATTERN_STRICT = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
EMAIL_PATTERN_LENIENT = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+.[A-Za-z]{2,}$"

# Characters after which title case starts a new word (the warehouse
# dialect's default word delimiters; the apostrophe is not one of them).
TITLE_CASE_BREAKS = " \t\n\r\f\v!?@\"^#$&~_,.:;+-*%/|\\[](){}<>="

# Placeholder hashed for a NULL part of a surrogate key, and the separator.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# Source freshness thresholds, hours.
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48
# FIXED VALUES: source -> the payload field that says when a record was loaded.
FRESHNESS_FIELDS = {
    "campaigns": "start_date",
    "customers": "last_modified_date",
    "employees": "last_modified_date",
    "orders": "order_date",
    "products": "last_modified_date",
    "stores": "last_modified_date",
    "suppliers": "last_modified_date",
}

# Increment default high-water mark.
HIGH_WATERMARK_DEFAULT = _dt.date(1900, 1, 1)

# Landing table naming: EXT_ + folder upper-cased with '-' and ' ' as '_'.
LANDING_TABLE_PREFIX = "EXT_"

# ---------------------------------------------------------------------------
# Scale knobs (not business rules)
# ---------------------------------------------------------------------------

# Largest row count a side may have to be broadcast by the checked helpers.
BROADCAST_MAX_ROWS = 2_000_000
