"""Aggregations (D1-D6, D11) and the analytical windows.

All aggregates are plain ``groupBy().agg()``: Catalyst splits them into a
partial (map-side) and a final aggregate, so a hot region or day is combined
before the shuffle.  Averages are returned as ``double(sum) / double(count)``
on exact decimal sums.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from .keys import distributed_rank, stored
from .states import grouped_with_distincts


def _avg(sum_col: str, count_col: str):
    return F.try_divide(F.col(sum_col).cast("double"), F.col(count_col).cast("double"))


SUMMARY_COLUMNS = ("region_code", "transaction_date", "quantity", "net_amount", "dim_customer_key", "dim_product_key")


def regional_summary(fact: DataFrame, is_stored: bool = False) -> DataFrame:
    """Per region and day (TOTAL_REVENUE = sum of net, defect 3).  ``is_stored``: reading ``fact`` again costs no join."""
    return (grouped_with_distincts(
                fact.select(*SUMMARY_COLUMNS), ["region_code", F.col("transaction_date").alias("summary_date")],
                [F.count(F.lit(1)).alias("total_transactions"),
                 F.sum("quantity").alias("total_quantity"),
                 F.sum("net_amount").alias("total_revenue")],
                {"distinct_customers": "dim_customer_key", "distinct_products": "dim_product_key"}, is_stored)
            .withColumn("avg_basket_size", _avg("total_revenue", "total_transactions")))


ROLLUP_KEYS = ("region_code", "transaction_date", "category_code", "fiscal_year", "fiscal_month")


def category_rollup(joined: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """D2 + D3: the graph's rollup by region, day, category, fiscal year, month.
    Distinct counts are exact (the reference's intent); ``approx_distinct`` uses
    HyperLogLog sketches instead for very large slices."""
    distinct = {"distinct_customers": "customer_id", "distinct_products": "product_id", "distinct_stores": "store_id"}
    totals = [F.count(F.lit(1)).alias("total_transactions"),
              F.sum("quantity").alias("total_quantity"),
              F.sum("gross_amount").alias("total_gross_revenue"),
              F.sum("net_amount").alias("total_net_revenue"),
              F.sum("discount_amt").alias("total_discount_amount")]
    grouped = (joined.groupBy(*ROLLUP_KEYS).agg(*totals, *[F.approx_count_distinct(c).alias(n) for n, c in distinct.items()])
               if approx_distinct else grouped_with_distincts(joined.select(*ROLLUP_KEYS, "quantity", "gross_amount", "net_amount",
                                                                            "discount_amt", *distinct.values()),
                                                              list(ROLLUP_KEYS), totals, distinct))
    return (grouped
            .withColumnRenamed("transaction_date", "summary_date")
            .withColumn("avg_basket_value",
                        F.col("total_net_revenue").cast("double")
                        / F.greatest(F.col("total_transactions"), F.lit(1)).cast("double")))


def summary_column_mapping(rollup: DataFrame) -> DataFrame:
    """Rename to the summary table's columns.  TOTAL_REVENUE is net
    (defect 3); gross keeps its own column; discount, stores and fiscal parts
    are dropped."""
    return rollup.select(
        "region_code", "summary_date", "category_code", "total_transactions", "total_quantity",
        F.col("total_net_revenue").alias("total_revenue"),
        F.col("total_gross_revenue").alias("gross_revenue"),
        F.col("avg_basket_value").alias("avg_basket_size"),
        "distinct_customers", "distinct_products")


def product_performance(fact: DataFrame) -> DataFrame:
    """Per region, product, fiscal year and month."""
    return (fact.groupBy("region_code", "dim_product_key", "fiscal_year", "fiscal_month")
            .agg(F.sum("net_amount").alias("total_revenue"),
                 F.sum("quantity").alias("total_units"),
                 F.count(F.lit(1)).alias("transaction_count"))
            .withColumn("avg_transaction_value", _avg("total_revenue", "transaction_count")))


RANK_PARTITION = ["region_code", "fiscal_year", "fiscal_month"]


def product_rankings(fact: DataFrame) -> DataFrame:
    """D4 + E1 + E2 + E3.  rank / dense_rank by revenue (desc) inside region,
    year and month, and the total of each, are computed by ``distributed_rank`` (no partition is held in
    one task).  The product aggregate is stored once, so the fact is scanned once for ranks and the join back."""
    perf = stored(product_performance(fact))
    ranked = distributed_rank(perf, RANK_PARTITION, "total_revenue", descending=True,
                              rank_col="revenue_rank", dense_rank_col="revenue_dense_rank", total_col="_part_total")
    return (ranked
            .withColumn("revenue_pct_share",
                        F.try_divide(F.col("total_revenue").cast("double"),
                                     F.col("_part_total").cast("double")) * 100)
            .drop("_part_total"))


DAILY_KEYS = ("region_code", "transaction_date", "fiscal_year", "fiscal_month")


def daily_summary(fact: DataFrame, ytd_by_year: bool = False, is_stored: bool = False) -> DataFrame:
    """D5 + E4 + E5: daily measures, running revenue and delta to the previous day.

    The windows run on the aggregated rows (one per region and day), so a
    window partition holds at most one row per calendar day of the range --
    bounded by the calendar, not by the data volume.  ``ytd_by_year`` restarts
    the running sum each year."""
    daily = (grouped_with_distincts(
                 fact.select(*DAILY_KEYS, "net_amount", "quantity", "discount_amt", "dim_customer_key", "dim_product_key"),
                 list(DAILY_KEYS),
                 [F.count(F.lit(1)).alias("total_transactions"),
                  F.sum("net_amount").alias("daily_revenue"),
                  F.sum("quantity").alias("daily_units"),
                  F.sum("discount_amt").alias("total_discounts")],
                 {"unique_customers": "dim_customer_key", "unique_products": "dim_product_key"}, is_stored)
             .withColumn("avg_basket", _avg("daily_revenue", "total_transactions")))
    part = ["region_code", "fiscal_year"] if ytd_by_year else ["region_code"]
    w = Window.partitionBy(*part).orderBy("transaction_date")
    return (daily
            .withColumn("running_revenue_ytd",
                        F.sum("daily_revenue").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("revenue_vs_prev_day",
                        F.col("daily_revenue") - F.lag("daily_revenue", 1).over(Window.partitionBy("region_code").orderBy("transaction_date"))))


def customer_segments(stg_customer: DataFrame, ytd: DataFrame, load_date: _dt.date,
                      staleness_days: int = S.STALENESS_DAYS) -> DataFrame:
    """B16 + B17 + B23 + C8: value segment and churn risk of recently staged
    customers, beside their year-to-date spend."""
    recent = stg_customer.where(F.col("load_date") >= F.date_sub(F.lit(load_date), staleness_days))
    return (recent.join(ytd, "customer_id", "left")
            .select("customer_id", "customer_code", "region_code", "loyalty_tier",
                    "lifetime_value", "last_purchase_date", "total_spend_ytd", "txn_count_ytd",
                    C.value_segment("lifetime_value").alias("clv_segment"),
                    C.churn_risk("last_purchase_date", load_date).alias("churn_risk")))


def distinct_suppliers(dim_product: DataFrame, load_date: _dt.date) -> DataFrame:
    """Suppliers of current versions opened on the load date (the
    enrichment cursor)."""
    return (dim_product.where((F.col("is_current") == "Y") & (F.col("valid_from") == F.lit(load_date))
                              & F.col("supplier_id").isNotNull())
            .select("supplier_id").distinct())


def fiscal_parts(staged: DataFrame) -> DataFrame:
    """B10 + B11 per business date present in the data."""
    d = staged.select("transaction_date").distinct()
    return d.select("transaction_date", C.fiscal_year().alias("fiscal_year"),
                    C.fiscal_month().alias("fiscal_month"), C.fiscal_week().alias("fiscal_week"),
                    C.fiscal_quarter().alias("fiscal_quarter"))
