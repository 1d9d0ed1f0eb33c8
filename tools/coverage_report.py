"""Write COVERAGE.md: every operator id of SURVEY §2 -> implementation ->
checked query keys (DuckDB-compared) and/or pytest coverage.

    python tools/coverage_report.py > COVERAGE.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from saleslake.plans.registry import OPERATORS, key_of  # noqa: E402

IMPL = {
    "A1": "sources/ingest.py `jdbc_options`, `read_query`", "A2": "operators/clean.py `scan_transactions`",
    "A3": "operators/joins.py `product_lookup`", "A4": "sources/ingest.py `parse_product_csv`, `ingest_product_csv`",
    "A5": "sources/ingest.py `reconciliation`, `reconcile_file`", "A6": "sources/store.py `write_delimited`",
    "A7": "sources/store.py `write_delimited`", "A8": "sources/store.py `append_fact`",
    "A9": "operators/rollups.py `summary_column_mapping`", "A10": "operators/quality.py `audit_counts`",
    "A11": "sources/store.py `write_analytics`; plans/run.py `run_analytics`",
    "A12": "sources/store.py `reload_staging`", "A13": "sources/store.py `refresh_summary`",
    "A14": "sources/store.py `write_dq_results`", "A15": "operators/quality.py `load_rules`; rules.py `active_rules`",
    "A16": "sources/ingest.py `region_table`",
    "B1": "operators/clean.py `extract_sales`", "B2": "operators/clean.py `extract_predicate`",
    "B3": "functions/columns.py `discount_pct`", "B4": "operators/clean.py `scan_transactions`",
    "B5": "operators/clean.py `split_valid`, `is_valid`", "B6": "operators/clean.py `reject_records`",
    "B7": "functions/columns.py `gross_amount`", "B8": "functions/columns.py `net_amount`",
    "B9": "functions/columns.py `tax_amount`", "B10": "functions/columns.py `fiscal_year/month/week`",
    "B11": "functions/columns.py `fiscal_quarter`", "B12": "functions/columns.py `normalise_region`",
    "B13": "functions/columns.py `relabel_currency`", "B14": "functions/columns.py `basket_tier`",
    "B15": "functions/columns.py `nvl`", "B16": "functions/columns.py `value_segment`",
    "B17": "functions/columns.py `churn_risk`", "B18": "functions/columns.py `full_name`",
    "B19": "operators/joins.py `customer_source`", "B20": "functions/columns.py `batch_id_of`, `source_tag`",
    "B21": "operators/fact.py `fact_rows` (column pruning)", "B22": "operators/joins.py `join_product_left`",
    "B23": "operators/rollups.py `customer_segments`",
    "C1": "operators/joins.py `dimension_keys`", "C2": "operators/joins.py `dimension_keys`",
    "C3": "operators/joins.py `dimension_keys`", "C4": "operators/joins.py `join_product_left`",
    "C5": "operators/joins.py `unmatched_product`", "C6": "operators/joins.py `sales_customers`",
    "C7": "operators/joins.py `customer_source`", "C8": "operators/joins.py `ytd_spend`",
    "C9": "operators/scd.py `scd2_merge`", "C10": "operators/scd.py `scd2_merge`",
    "C11": "operators/scd.py `scd2_merge` (max version aggregate)", "C12": "operators/scd.py `change_class`",
    "D1": "operators/rollups.py `regional_summary`", "D2": "operators/rollups.py `category_rollup`",
    "D3": "operators/rollups.py `category_rollup`", "D4": "operators/rollups.py `product_performance`",
    "D5": "operators/rollups.py `daily_summary`", "D6": "operators/joins.py `ytd_spend`",
    "D7": "operators/quality.py `staging_metrics`", "D8": "operators/quality.py `row_count_gate`, `source_availability`; plans/run.py",
    "D9": "operators/quality.py `day_ratio_gate`", "D10": "operators/quality.py `_rule_columns` (`count_if`)",
    "D11": "operators/rollups.py `distinct_suppliers`",
    "E1": "operators/keys.py `distributed_rank`", "E2": "operators/keys.py `distributed_rank`",
    "E3": "operators/rollups.py `product_rankings`", "E4": "operators/rollups.py `daily_summary`",
    "E5": "operators/rollups.py `daily_summary`", "E6": "operators/joins.py `sales_customers`",
    "F1": "operators/quality.py `load_rules`", "G1": "operators/quality.py `staging_metrics` (`inline`)",
    "I1": "operators/scd.py `load_dim_product`", "I2": "operators/scd.py `load_dim_customer`",
    "I3": "operators/scd.py `upsert`", "I4": "operators/scd.py `mark_loaded`; fact.py `dropped_by_dims`",
    "I5": "operators/rules.py `apply_category_rules`", "I6": "operators/rules.py `enrich_from_suppliers`",
    "I7": "operators/scd.py `purge_expired`", "I8": "operators/keys.py `assign_dense_keys`",
    "I9": "operators/fact.py `load_fact`", "I10": "plans/pipeline.py `daily_load`; plans/run.py `run_daily`",
    "I11": "sources/ingest.py `apply_defaults` (plans/run.py: staging and fact writes)", "I12": "operators/quality.py `constraint_audit`, `foreign_key_audit`",
    "J1": "operators/quality.py `_rule_columns` NULL_CHECK", "J2": "operators/quality.py RANGE_CHECK",
    "J3": "operators/quality.py REFERENTIAL_CHECK", "J4": "operators/quality.py THRESHOLD_COUNT",
    "J5": "operators/quality.py generic", "J6": "operators/quality.py `run_checks`",
    "J7": "operators/quality.py `BUILTIN_RULES`", "J8": "operators/quality.py `dq_summary`, `dq_gate`",
    "K1": "streaming/incremental.py `incremental_load`, `fact_and_summary`",
}
TESTS = {
    "A1": "test_store_ingest_stream::test_jdbc_options_region_table_defaults",
    "A4": "test_store_ingest_stream::test_csv_ingest_bad_rows_and_reconcile",
    "A5": "test_store_ingest_stream::test_csv_ingest_bad_rows_and_reconcile; "
          "test_store_ingest_stream::test_reconciliation_over_part_files",
    "A6": "test_store_ingest_stream::test_delimited_error_files_replace_a_rerun_slice",
    "A7": "test_store_ingest_stream::test_delimited_error_files_replace_a_rerun_slice",
    "A8": "test_store_ingest_stream::test_slice_writes_are_idempotent; test_store_ingest_stream::test_writer_tasks_follow_rows_and_slices",
    "A11": "test_store_ingest_stream::test_analytics_rerun_is_idempotent",
    "A12": "test_store_ingest_stream::test_staging_reload_keeps_loaded_rows",
    "A13": "test_store_ingest_stream::test_summary_refresh_replaces_only_touched_slices; test_store_ingest_stream::test_summary_months",
    "A16": "test_store_ingest_stream::test_jdbc_options_region_table_defaults",
    "B3": "test_functions", "B5": "test_clean::test_split_is_total; test_invariants",
    "B18": "test_functions::test_full_name_keeps_stray_space", "B11": "test_functions",
    "D4": "test_rollups::test_rank_shares_sum_to_100_per_region_month",
    "D5": "test_rollups::test_daily_windows_running_total_and_previous_day",
    "E3": "test_rollups::test_rank_shares_sum_to_100_per_region_month",
    "E4": "test_rollups::test_daily_windows_running_total_and_previous_day",
    "E5": "test_rollups::test_daily_windows_running_total_and_previous_day",
    "E1": "test_keys::test_distributed_rank_matches_window_with_ties_and_hot_group",
    "E2": "test_keys::test_distributed_rank_matches_window_with_ties_and_hot_group",
    "I1": "test_scd; test_invariants; test_store_ingest_stream::test_dimension_versions_share_closed_folders", "I2": "test_scd::test_customer_scd2_and_upsert",
    "I3": "test_scd::test_customer_scd2_and_upsert; test_store_ingest_stream::test_a_commit_names_the_version_it_was_computed_from", "I4": "test_scd::test_mark_loaded_and_purge",
    "I5": "test_quality_rules::test_category_rules_ordered_isolated_and_cross_category; test_quality_rules::test_rules_run_together_and_failing_ones_are_found",
    "I6": "test_quality_rules::test_supplier_enrichment_latest_effective", "I7": "test_scd::test_mark_loaded_and_purge; test_store_ingest_stream::test_dimension_versions_share_closed_folders",
    "I8": "test_keys", "I10": "test_run::test_daily_run_is_idempotent; test_store_ingest_stream::test_a_running_batch_is_not_taken_over",
    "I11": "test_store_ingest_stream::test_jdbc_options_region_table_defaults; test_run::test_daily_run_is_idempotent",
    "J6": "test_quality_rules", "J8": "test_quality_rules", "D7": "test_quality_rules::test_staging_metrics_and_gates",
    "D9": "test_quality_rules::test_staging_metrics_and_gates",
    "B1": "test_clean::test_extract_filters_and_defaults",
    "B2": "test_clean::test_extract_slice_parameters; test_clean::test_region_and_day_reach_the_scan",
    "B6": "test_clean::test_split_is_total",
    "B9": "test_functions::test_tax_rounds_unrounded_net",
    "B10": "test_functions::test_iso_week_at_year_end_and_quarter",
    "B13": "test_functions::test_currency_label_and_basket_tier",
    "B14": "test_functions::test_currency_label_and_basket_tier",
    "B16": "test_functions::test_segments_and_churn",
    "B17": "test_functions::test_segments_and_churn",
    "B20": "test_clean::test_extract_filters_and_defaults",
    "C9": "test_scd::test_customer_scd2_and_upsert",
    "C10": "test_scd::test_customer_scd2_and_upsert",
    "C11": "test_scd::test_new_changed_same_absent_and_inactive; test_invariants",
    "C12": "test_scd::test_new_changed_same_absent_and_inactive; test_functions::test_sentinel_vs_null_safe",
    "D1": "test_invariants::test_split_and_summary_totals; test_rollups::test_distinct_counts_copy_no_rows",
    "D8": "test_quality_rules::test_staging_metrics_and_gates",
    "G1": "test_quality_rules::test_staging_metrics_and_gates",
    "A15": "test_quality_rules::test_dq_rules_one_scan_bad_rule_isolated_thresholds",
    "F1": "test_quality_rules::test_dq_rules_one_scan_bad_rule_isolated_thresholds",
    "D10": "test_quality_rules::test_dq_rules_one_scan_bad_rule_isolated_thresholds",
    "J1": "test_quality_rules::test_dq_rules_one_scan_bad_rule_isolated_thresholds",
    "J2": "test_quality_rules::test_dq_rules_one_scan_bad_rule_isolated_thresholds",
    "J4": "test_quality_rules::test_dq_rules_one_scan_bad_rule_isolated_thresholds",
    "J7": "test_quality_rules::test_dq_rules_one_scan_bad_rule_isolated_thresholds",
    "J3": "test_quality_rules::test_referential_and_generic_rules; test_quality_rules::test_subquery_rules_query_the_frames_given",
    "J5": "test_quality_rules::test_referential_and_generic_rules",
    "I12": "test_quality_rules::test_constraint_and_foreign_key_audits",
    "D2": "test_rollups::test_category_rollup_exact_distincts_and_average",
    "D3": "test_rollups::test_category_rollup_exact_distincts_and_average",
    "B22": "test_invariants::test_product_join_matched_plus_unmatched_is_input",
    "C8": "test_rollups::test_ytd_spend_sums_every_version_of_a_customer_within_the_year",
    "D6": "test_rollups::test_ytd_spend_sums_every_version_of_a_customer_within_the_year",
    "I9": "test_fact::test_fact_inner_joins_product_and_customer_left_joins_store",
    "C1": "test_fact::test_fact_inner_joins_product_and_customer_left_joins_store; test_skew",
    "C2": "test_fact::test_fact_inner_joins_product_and_customer_left_joins_store",
    "C3": "test_fact::test_fact_inner_joins_product_and_customer_left_joins_store",
    "B7": "test_fact::test_fact_inner_joins_product_and_customer_left_joins_store",
    "B8": "test_fact::test_fact_inner_joins_product_and_customer_left_joins_store",
    "B21": "test_fact::test_fact_inner_joins_product_and_customer_left_joins_store",
    "C6": "test_fact::test_sales_customers_and_customer_source",
    "C7": "test_fact::test_sales_customers_and_customer_source",
    "E6": "test_fact::test_sales_customers_and_customer_source",
    "B19": "test_fact::test_sales_customers_and_customer_source",
    "B12": "test_clean::test_extract_filters_and_defaults",
    "A9": "test_rollups::test_summary_mapping_audit_counts_and_cursor_suppliers",
    "A10": "test_rollups::test_summary_mapping_audit_counts_and_cursor_suppliers",
    "D11": "test_rollups::test_summary_mapping_audit_counts_and_cursor_suppliers",
    "A2": "test_clean::test_scan_transactions_slice_status_and_lookup_pruning; test_clean::test_region_and_day_reach_the_scan",
    "B4": "test_clean::test_scan_transactions_slice_status_and_lookup_pruning",
    "A3": "test_clean::test_scan_transactions_slice_status_and_lookup_pruning",
    "A14": "test_rollups::test_customer_segments_and_dq_result_append",
    "B15": "test_rollups::test_customer_segments_and_dq_result_append",
    "B23": "test_rollups::test_customer_segments_and_dq_result_append",
    "K1": "test_store_ingest_stream::test_incremental_load_consumes_each_file_once; test_store_ingest_stream::test_a_load_reads_only_its_own_facts",
    "C4": "test_invariants::test_product_join_matched_plus_unmatched_is_input; test_skew",
    "C5": "test_invariants::test_product_join_matched_plus_unmatched_is_input",
}


def main() -> None:
    keys: dict[str, list[str]] = {}
    for op, check, _cols in OPERATORS:
        keys.setdefault(op.upper(), []).append(key_of(op, check))
    order = sorted(IMPL, key=lambda k: (k[0], int(k[1:])))
    print("# Coverage of SURVEY §2\n")
    print("Every operator id, the code that implements it, the `queries()` keys that check it against DuckDB "
          "(`oracle_sql()`, sf0.01), and the pytest cases for edge cases. Generated by "
          "`tools/coverage_report.py`.\n")
    print("| id | implementation | DuckDB-checked keys | pytest |")
    print("|---|---|---|---|")
    for op in order:
        ks = ", ".join(f"`{k}`" for k in keys.get(op, [])) or "—"
        print(f"| {op} | {IMPL[op]} | {ks} | {TESTS.get(op, '')} |")


if __name__ == "__main__":
    main()
