"""Business rules every layer shares.

All of these are defaults only: each operator takes its rule as a keyword argument.
"""

from __future__ import annotations

# ---- Fixed values ---------------------------------------------------------------------
# Results depend on these literally, so they are stated as plain text.

# Logical field -> accepted headers, in priority order (compared case-insensitively).
FIELD_ALIASES = {
    "transaction_id": ["transaction_id", "objectid", "object_id", "id"],
    "agency_name": ["agency_name", "agency", "department", "dept"],
    "vendor_name": ["vendor_name", "merchant_name", "supplier", "vendor"],
    "mcc_description": ["merchant_category", "mcc_description", "category", "merchant_category_description"],
    "transaction_date_raw": ["transaction_date", "date", "purchase_date", "posted_date"],
    "amount_raw": ["amount", "transaction_amount", "amt", "dollars"],
    "description": ["description", "transaction_description", "item_description"],
}
REQUIRED_FIELDS = ["transaction_id", "agency_name", "vendor_name", "transaction_date_raw", "amount_raw"]

# Category group -> substrings of the lower-cased merchant category; first group that hits wins.
CATEGORY_KEYWORDS = {
    "Travel": ["travel", "air", "hotel", "car"],
    "IT": ["software", "computer", "it", "electronics"],
    "Office": ["office", "stationery", "supplies"],
    "Meals": ["food", "restaurant", "catering"],
}
OTHER_CATEGORY = "Other"

# (exclusive upper limit, label); amounts beyond the last limit get TOP_BUCKET.
AMOUNT_BUCKETS = [(100, "<100"), (500, "100-499"), (2000, "500-1999")]
TOP_BUCKET = ">=2000"

OUTLIER_SIGMAS = 3
HIGH_AMOUNT = 2000

# Points of the two risk models. The monthly model uses the first two only.
OUTLIER_POINTS = 70
NEW_VENDOR_POINTS = 30
SPEND_RANK_POINTS = 20
OUTLIER_RATE_POINTS = 10
MAX_RISK = 100.0

MONEY = "decimal(18,2)"

# Columns that the all-time risk model reads -> accepted names, in priority order.
RISK_ALIASES = {
    "vendor_name": ["vendor_name", "vendor_name_clean"],
    "amount": ["amount"],
    "is_outlier": ["is_outlier"],
    "is_new_vendor_month": ["is_new_vendor_month"],
}

# Columns and types of the stage tables.
STAGE_SILVER = {
    "transaction_id": "string",
    "agency_name": "string",
    "vendor_name": "string",
    "mcc_description": "string",
    "description": "string",
    "transaction_date": "date",
    "year": "int",
    "month": "int",
    "yyyymm": "int",
    "amount": MONEY,
    "category_group": "string",
    "amount_bucket": "string",
    "day_of_week": "int",
    "is_weekend": "boolean",
}
STAGE_VENDOR_MONTHLY = {
    "year": "int",
    "month": "int",
    "vendor_name": "string",
    "txn_count": "bigint",
    "total_spend": MONEY,
}
STAGE_AGENCY_CATEGORY = {
    "year": "int",
    "month": "int",
    "agency_name": "string",
    "category_group": "string",
    "txn_count": "bigint",
    "total_spend": MONEY,
}
STAGE_ANOMALY = {
    "transaction_id": "string",
    "transaction_date": "date",
    "agency_name": "string",
    "vendor_name": "string",
    "merchant_category": "string",
    "category_group": "string",
    "amount": MONEY,
    "mean_amount": MONEY,
    "std_amount": MONEY,
    "is_outlier": "int",
    "is_new_vendor_month": "int",
    "year": "int",
    "month": "int",
}

# Unique keys and required columns of the star's tables; a table may have several keys.
KEYS = {
    "dim_agency": [["agency_id"], ["agency_name"]],
    "dim_vendor": [["vendor_id"], ["vendor_key"]],
    "fact_transactions_clean": [["transaction_id"]],
    "vendor_monthly_spend": [["yyyymm", "vendor_id"]],
    "agency_category_spend": [["yyyymm", "agency_id", "category_group"]],
    "transaction_anomaly": [["transaction_id"]],
    "vendor_risk_scores": [["yyyymm", "vendor_id"]],
}
REQUIRED_COLUMNS = {
    "dim_agency": ["agency_id", "agency_name"],
    "dim_vendor": ["vendor_id", "vendor_key", "vendor_name_clean"],
    "fact_transactions_clean": [
        "transaction_id", "agency_id", "vendor_id", "transaction_date", "year", "month", "yyyymm", "amount",
    ],
    "vendor_monthly_spend": [
        "yyyymm", "year", "month", "vendor_id", "vendor_name_clean", "txn_count", "total_spend", "avg_spend",
    ],
    "agency_category_spend": [
        "yyyymm", "year", "month", "agency_id", "agency_name", "category_group", "txn_count", "total_spend", "avg_spend",
    ],
    "transaction_anomaly": [
        "transaction_id", "yyyymm", "transaction_date", "amount", "agency_id", "vendor_id",
        "is_outlier", "is_high_amount", "is_new_vendor",
    ],
    "vendor_risk_scores": ["yyyymm", "vendor_id", "vendor_name_clean", "outlier_txn", "new_vendor_txn", "risk_score"],
}
# ---------------------------------------------------------------------------------------
