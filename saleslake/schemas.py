"""Table schemas, column defaults (I11) and the fixed business values."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference's for right results.
# ---------------------------------------------------------------------------
HIGH_DATE = _dt.date(9999, 12, 31)          # open-version sentinel
EXCLUDED_STATUSES = ("VOID", "CANCELLED", "TEST")
COMPLETED = "COMPLETED"
PENDING = "PENDING"
LOADED = "LOADED"
DEFAULT_CURRENCY = "GBP"
RELABELLED_CURRENCIES = ("USD", "EUR")      # relabelled to GBP, amounts unchanged
DEFAULT_LOYALTY_TIER = "STANDARD"
BASKET_TIERS = (("PREMIUM", 500), ("STANDARD", 100))   # gross > bound, else BASIC
BASKET_TIER_ELSE = "BASIC"
VALUE_SEGMENTS = (("HIGH_VALUE", 5000), ("MID_VALUE", 1000), ("LOW_VALUE", 100))
VALUE_SEGMENT_ELSE = "PROSPECT"
CHURN_BANDS = (("HIGH", 180), ("MEDIUM", 90))          # days > bound, else LOW
CHURN_ELSE = "LOW"
CHURN_UNKNOWN = "UNKNOWN"
MISSING_PRODUCT_DEFAULTS = {
    "product_code": "UNKNOWN",
    "product_name": "UNKNOWN PRODUCT",
    "category_code": "UNCATEGORISED",
    "subcategory_code": "NONE",
}
CHANGE_SENTINEL_TEXT = "X"                  # NVL(col,'X') in change tests
CHANGE_SENTINEL_NUMBER = 0                  # NVL(col,0) in change tests
TAX_RATE = Decimal("0.20")
KEY_START = 1000                            # sequences start with 1000, step 1
MIN_ROWS_PER_SLICE = 100
MIN_DAY_RATIO = Decimal("0.80")
MAX_REJECTED_ROWS = 50
RETENTION_DAYS = 730
STALENESS_DAYS = 7
DQ_DEFAULT_THRESHOLD = 0.01                 # threshold 0 or NULL means 0.01
ETL_USER = "ETL_PROCESS"

# ---------------------------------------------------------------------------
# Schemas (Spark types for the columns of the source warehouse)
# ---------------------------------------------------------------------------
MONEY = T.DecimalType(12, 4)
QTY = T.DecimalType(8, 2)
PCT = T.DecimalType(5, 2)
AMOUNT = T.DecimalType(16, 4)

STG_PRODUCT = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_code", T.StringType(), False),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("category_code", T.StringType(), True),
    T.StructField("subcategory_code", T.StringType(), True),
    T.StructField("supplier_id", T.LongType(), True),
    T.StructField("cost_price", MONEY, True),
    T.StructField("list_price", MONEY, True),
    T.StructField("tax_class_code", T.StringType(), True),
    T.StructField("weight_kg", T.DecimalType(8, 3), True),
    T.StructField("is_active", T.StringType(), True),
    T.StructField("effective_date", T.DateType(), True),
    T.StructField("expiry_date", T.DateType(), True),
    T.StructField("load_date", T.DateType(), True),
])

STG_CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("customer_code", T.StringType(), True),
    T.StructField("first_name", T.StringType(), True),
    T.StructField("last_name", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
    T.StructField("phone", T.StringType(), True),
    T.StructField("region_code", T.StringType(), True),
    T.StructField("loyalty_tier", T.StringType(), True),
    T.StructField("lifetime_value", T.DecimalType(14, 2), True),
    T.StructField("registration_date", T.DateType(), True),
    T.StructField("last_purchase_date", T.TimestampNTZType(), True),
    T.StructField("load_date", T.DateType(), True),
])

# declared widths of VARCHAR2 columns, audited by I12 (Spark does not enforce them)
DECLARED_WIDTHS = {
    "stg_sales": {"region_code": 10, "currency_code": 3, "payment_method": 20,
                  "pos_terminal_id": 20, "source_file_name": 200, "etl_status": 20},
    "dim_product": {"product_code": 20, "product_name": 200, "category_code": 10,
                    "subcategory_code": 10},
    "dim_customer": {"customer_code": 20, "full_name": 200, "email": 200,
                     "region_code": 10, "loyalty_tier": 20},
}
NOT_NULL = {
    "stg_sales": ("transaction_id", "customer_id", "product_id", "store_id",
                  "transaction_date", "region_code"),
    "dim_product": ("dim_product_key", "product_id", "valid_from"),
    "dim_customer": ("dim_customer_key", "customer_id", "valid_from"),
}

# Column defaults applied before a write
DEFAULTS = {
    "stg_sales": {"discount_amt": Decimal("0"), "discount_pct": Decimal("0"),
                  "currency_code": DEFAULT_CURRENCY, "etl_status": PENDING},
    "dim": {"valid_to": HIGH_DATE, "is_current": "Y", "version_num": 1},
    "fact": {"currency_code": DEFAULT_CURRENCY},
}
