"""Words, limits and formats that results depend on.

These are given by the business rules. Change one and the numbers change.
"""

# Product keywords, in order: the first class with a matching keyword wins.
ASSET_CLASS_RULES = (
    ("Saham", ("saham",)),
    ("Ekuitas", ("ekuitas",)),
    ("Obligasi", ("obligasi", "bond")),
    ("Campuran", ("campuran",)),
    ("Penyertaan Terbatas", ("penyertaan terbatas",)),
    ("Syariah", ("syariah",)),
    ("Terproteksi", ("terproteksi",)),
    ("Money Market", ("pasar uang", "money market")),
)
UNKNOWN_CLASS = "Unknown"

# Display label per asset class; anything else shows as "Unknown".
ASSET_CLASS_LABELS = {
    "Saham": "Equity / Saham",
    "Ekuitas": "Equity / Ekuitas",
    "Obligasi": "Fixed Income / Obligasi",
    "Campuran": "Balanced / Campuran",
    "Penyertaan Terbatas": "Limited / Penyertaan Terbatas",
    "Syariah": "Syariah",
    "Terproteksi": "Protected / Terproteksi",
    "Money Market": "Money Market / Pasar Uang",
}

# Classes in the fixed-income bucket; every other class, "Unknown" included, is equity.
FIXED_INCOME_CLASSES = ("Obligasi", "Terproteksi", "Penyertaan Terbatas", "Money Market")
FIXED_INCOME = "fixed_income"
EQUITY = "equity_campuran"

CURRENCY = "IDR"
AGENT_NAME_PREFIX = "Agent "

# A customer is core when the month-end total is strictly above this.
CORE_CUSTOMER_THRESHOLD = 100_000_000
# Share from which a portfolio counts as heavy in one bucket.
HEAVY_SHARE = 0.6
PROFILE_NONE = "No AUM"
PROFILE_FIXED_INCOME = "Fixed Income Heavy"
PROFILE_EQUITY = "Equity Heavy"
PROFILE_BALANCED = "Balanced"

# Source clocks run 15 hours behind the business clock.
BUSINESS_SHIFT_HOURS = 15

# Incremental runs recompute months after (newest month - lookback).
LOOKBACK_DAYS = 90
FIRST_DATE = "1900-01-01"

TOP_AGENTS = 5
CATALOGUE_SIZE = 10
RECONCILE_TOLERANCE = 1.0
MISSING_COUNT = -1

# Business-key hash: text for a NULL part, and the separator between parts.
NULL_KEY_PART = "__NULL__"
KEY_SEPARATOR = "\x1f"

# Key detection: distinct share of a single key, and of one part of a composite key.
SINGLE_KEY_RATIO = 0.95
COMPOSITE_KEY_RATIO = 0.1

# Snapshot date in a file name: ISO first, then compact, never inside a longer number.
ISO_DATE = (r"(?<!\d)(\d{4}-\d{2}-\d{2})(?!\d)", "yyyy-MM-dd")
COMPACT_DATE = (r"(?<!\d)(\d{8})(?!\d)", "yyyyMMdd")

# CSV fields read as NULL (the default list of pandas.read_csv).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters stripped from both ends of text (Python's str.strip).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
