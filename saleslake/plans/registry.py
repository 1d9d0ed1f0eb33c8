"""Operator ids of SURVEY §2 -> the check that covers them and the columns
each one selects from it.  ``None`` selects every column of the check."""

from __future__ import annotations

OPERATORS: list[tuple[str, str, list[str] | None]] = [
    ("a2", "scan_txn_day_region", None),
    ("b4", "scan_txn_day_region", ["transaction_id", "transaction_date", "region_code", "quantity", "load_batch_id"]),
    ("a3", "dim_product_current", None),
    ("b1", "extract_sales", None),
    ("b2", "extract_sales", ["transaction_id", "transaction_date", "region_code", "quantity", "unit_price"]),
    ("b3", "extract_sales", ["transaction_id", "unit_price", "discount_amt", "discount_pct"]),
    ("b20", "extract_sales", ["transaction_id", "load_date", "load_batch_id", "source_file_name", "etl_status"]),
    ("b5", "valid_sales", None),
    ("b5", "reject_sales", ["transaction_id", "region_code", "transaction_date"]),
    ("b6", "reject_sales", None),
    ("b7", "enrich_sales", ["transaction_id", "quantity", "unit_price", "gross_amount"]),
    ("b8", "enrich_sales", ["transaction_id", "gross_amount", "discount_amt", "net_amount"]),
    ("b12", "enrich_sales", ["transaction_id", "region_code"]),
    ("b13", "enrich_sales", ["transaction_id", "currency_code"]),
    ("b14", "enrich_sales", ["transaction_id", "gross_amount", "basket_tier"]),
    ("b15", "enrich_sales", ["transaction_id", "discount_amt"]),
    ("c4", "join_product_left", None),
    ("b22", "join_product_left", ["transaction_id", "product_id", "product_code", "product_name",
                                  "category_code", "subcategory_code"]),
    ("c5", "unmatched_product", None),
    ("d2", "category_rollup", None),
    ("d3", "category_rollup", ["region_code", "summary_date", "category_code", "distinct_customers",
                               "distinct_products", "distinct_stores"]),
    ("a9", "summary_column_mapping", None),
    ("i9", "fact_load", None),
    ("b9", "fact_load", ["dim_product_key", "dim_customer_key", "transaction_date", "net_amount", "tax_amount"]),
    ("b10", "fact_load", ["dim_product_key", "dim_customer_key", "transaction_date", "fiscal_year",
                          "fiscal_month", "fiscal_week"]),
    ("b21", "fact_load", ["dim_product_key", "dim_customer_key", "dim_store_key", "transaction_date", "region_code",
                          "load_date", "load_batch_id"]),
    ("c1", "fact_load", ["dim_product_key", "transaction_date", "region_code", "quantity", "unit_price"]),
    ("c2", "fact_load", ["dim_customer_key", "transaction_date", "region_code", "quantity", "unit_price"]),
    ("c3", "fact_load", ["dim_store_key", "transaction_date", "region_code", "quantity", "unit_price"]),
    ("i4", "dropped_by_dims", None),
    ("i8", "surrogate_keys", None),
    ("d1", "regional_summary", None),
    ("d4", "product_rankings", ["region_code", "dim_product_key", "fiscal_year", "fiscal_month",
                                "total_revenue", "total_units", "transaction_count", "avg_transaction_value"]),
    ("e1", "product_rankings", ["region_code", "dim_product_key", "fiscal_year", "fiscal_month", "revenue_rank"]),
    ("e2", "product_rankings", ["region_code", "dim_product_key", "fiscal_year", "fiscal_month",
                                "revenue_dense_rank"]),
    ("e3", "product_rankings", ["region_code", "dim_product_key", "fiscal_year", "fiscal_month",
                                "revenue_pct_share"]),
    ("d5", "daily_summary", ["region_code", "transaction_date", "fiscal_year", "fiscal_month",
                             "total_transactions", "daily_revenue", "daily_units", "avg_basket",
                             "total_discounts", "unique_customers", "unique_products"]),
    ("e4", "daily_summary", ["region_code", "transaction_date", "daily_revenue", "running_revenue_ytd"]),
    ("e5", "daily_summary", ["region_code", "transaction_date", "daily_revenue", "revenue_vs_prev_day"]),
    ("i3", "customer_upsert", None),
    ("b19", "customer_upsert", ["customer_id", "email", "loyalty_tier"]),
    ("c6", "customer_upsert", ["customer_id", "last_purchase_date", "load_date"]),
    ("c7", "customer_upsert", ["customer_id", "loyalty_tier", "lifetime_value"]),
    ("e6", "customer_upsert", ["customer_id", "last_purchase_date"]),
    ("c8", "customer_ytd_spend", None),
    ("d6", "customer_ytd_spend", ["customer_id", "txn_count_ytd"]),
    ("b16", "customer_segments", ["customer_id", "lifetime_value", "clv_segment"]),
    ("b17", "customer_segments", ["customer_id", "last_purchase_date", "churn_risk"]),
    ("b23", "customer_segments", None),
    ("b11", "fiscal_parts", None),
    ("c12", "scd2_change_class", None),
    ("i1", "scd2_product", None),
    ("c11", "scd2_product", ["dim_product_key", "product_id", "version_num", "is_current"]),
    ("i2", "scd2_customer", None),
    ("c9", "scd2_customer", ["dim_customer_key", "customer_id", "valid_from", "is_current", "version_num"]),
    ("c10", "scd2_customer", ["dim_customer_key", "customer_id", "valid_to", "is_current"]),
    ("i7", "purge_expired", None),
    ("d11", "distinct_suppliers", None),
]


def key_of(op_id: str, check: str) -> str:
    return f"{op_id}_{check}".lower()

OPERATORS += [
    ("i5", "category_rules", None),
    ("i6", "supplier_enrich", None),
    ("d7", "staging_metrics", None),
    ("g1", "staging_metrics", None),
    ("d8", "row_count_gate", None),
    ("d9", "day_ratio_gate", None),
    ("a10", "audit_counts", None),
    ("d10", "dq_results", ["rule_id", "check_date", "total_rows", "failed_rows", "fail_pct"]),
    ("j1", "dq_results", None),
    ("j2", "dq_results", None),
    ("j4", "dq_results", None),
    ("j5", "dq_results", None),
    ("j6", "dq_results", None),
    ("j7", "dq_results", None),
    ("a15", "dq_results", ["rule_id", "rule_name", "target_table", "rule_type", "severity", "check_date"]),
    ("f1", "dq_results", ["rule_id", "rule_name", "check_date", "status"]),
    ("j3", "dq_referential", None),
    ("j8", "dq_summary", None),
    ("i12", "audit_pk", None),
    ("i12", "audit_fk", None),
    ("i10", "entry", None),
]

OPERATORS += [
    ("a6", "reject_sink", None),
    ("a7", "unmatched_sink", None),
    ("a8", "fact_append", None),
    ("a11", "analytical_outputs", None),
    ("a12", "staging_reload", None),
    ("a13", "summary_refresh", None),
    ("a14", "dq_result_sink", None),
]

OPERATORS += [
    ("b18", "scd2_customer", ["customer_id", "full_name", "is_current", "version_num"]),
    ("k1", "incremental_load", None),
]

OPERATORS += [
    ("d8", "source_availability", None),
]

OPERATORS += [
    ("a4", "product_master_csv", None),
    ("a5", "product_file_reconcile", None),
]

OPERATORS += [
    ("k1", "incremental_summary", None),
    ("i9", "daily_runs_fact", None),
    ("i10", "daily_runs_slices", None),
    ("a13", "emptied_slice", None),
    ("i8", "parallel_regions", None),
    ("a16", "region_routed", None),
    ("i11", "column_defaults", None),
]

#: Operators that share a check and differ in the rows they answer for (a predicate both engines read).
ROWS = {
    "g1": "metric IN ('DISTINCT_STORES', 'DISTINCT_PRODUCTS')",
    "j1": "rule_type = 'NULL_CHECK'",
    "j2": "rule_type = 'RANGE_CHECK'",
    "j4": "rule_type = 'THRESHOLD_COUNT'",
    "j5": "rule_type = 'GENERIC'",
    "j7": "rule_id <= 3",
}
