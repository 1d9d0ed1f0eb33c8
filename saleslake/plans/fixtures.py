"""Retail inputs derived from the driver's TPC-H-style tables.

The reference ships no data.  These frames map the driver's tables onto the
retail schemas (FIXTURES.md).  The driver's tables hold no NULLs, orphans or
zero prices, so such cases are injected deterministically by key residue; the
residues only choose *which* rows carry an edge case -- every frame still
covers whole tables.  ``saleslake.plans.oracle`` holds the same definitions in
SQL for the DuckDB check.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sent_if_few
from ..schemas import HIGH_DATE
from ..sources.tables import Tables

# fixture load date (business date of the checked batch)
LOAD_DATE = _dt.date(1998, 1, 1)


def _dec(c: Column | str, p: int, s: int) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({p},{s})")


def supplier_region(t: Tables) -> DataFrame:
    """supplier -> region name.  nation and region are fixed-size code tables
    (25 and 5 rows by definition), so broadcasting them is size-safe."""
    geo = F.broadcast(
        t.nation.select("n_nationkey", "n_regionkey")
        .join(F.broadcast(t.region.select("r_regionkey", "r_name")),
              F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name"))
    return (t.supplier.select("s_suppkey", "s_nationkey")
            .join(geo, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "r_name"))


def customer_region(t: Tables) -> DataFrame:
    geo = F.broadcast(
        t.nation.select("n_nationkey", "n_regionkey")
        .join(F.broadcast(t.region.select("r_regionkey", "r_name")),
              F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name"))
    return (t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
            .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
            .drop("c_nationkey", "n_nationkey"))


def sales_txn(t: Tables) -> DataFrame:
    """Source sales (SOURCE_OPS.SALES_TXN): one row per line item.  The regions of suppliers are sent, whatever their size is
    estimated at, so that looking them up doesn't shuffle the line items."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_discount")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    p = t.part.select("p_partkey", "p_retailprice")
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(p, F.col("l_partkey") == F.col("p_partkey"))
         .join(sent_if_few(supplier_region(t), t.supplier), F.col("l_suppkey") == F.col("s_suppkey")))
    price = _dec("p_retailprice", 12, 4)
    status = (F.when(F.col("o_orderkey") % 31 == 0, "VOID")
              .when(F.col("o_orderkey") % 37 == 0, "CANCELLED")
              .when(F.col("o_orderkey") % 41 == 0, "TEST")
              .when(F.col("o_orderkey") % 43 == 0, F.lit(None))
              .otherwise("COMPLETED"))
    currency = (F.when(F.col("o_orderkey") % 4 == 0, "USD")
                .when(F.col("o_orderkey") % 4 == 1, "EUR")
                .when(F.col("o_orderkey") % 4 == 2, F.lit(None))
                .otherwise("GBP"))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
        F.col("o_custkey").alias("cust_id"),
        F.when(F.col("l_partkey") % 97 == 0, F.lit(None)).otherwise(F.col("l_partkey")).alias("prod_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("o_orderdate").alias("txn_datetime"),
        F.when(F.col("l_orderkey") % 53 == 0, F.lit(0).cast("decimal(8,2)"))
         .otherwise(_dec("l_quantity", 8, 2)).alias("sold_qty"),
        F.when(F.col("l_partkey") % 89 == 0, F.lit(0).cast("decimal(12,4)"))
         .otherwise(price).alias("unit_sell_price"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("decimal(12,4)"))
         .otherwise((_dec("l_discount", 5, 2) * price).cast("decimal(12,4)")).alias("disc_amount"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit(" "), F.lower("r_name"), F.lit(" ")))
         .otherwise(F.col("r_name")).alias("store_region_cd"),
        currency.alias("currency"),
        F.col("o_orderpriority").alias("payment_type_cd"),
        F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("terminal_ref"),
        status.alias("txn_status_cd"),
    )


def stg_product(t: Tables, load_date: _dt.date = LOAD_DATE) -> DataFrame:
    """Staged product master for the load date: price change every 7th,
    NULL name every 13th, inactive every 17th."""
    retail = _dec("p_retailprice", 12, 4)
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_code"),
        F.when(F.col("p_partkey") % 13 == 0, F.lit(None)).otherwise(F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category_code"),
        F.col("p_brand").alias("subcategory_code"),
        (F.col("p_partkey") % 100).alias("supplier_id"),
        (retail * F.lit(0.7).cast("decimal(2,1)")).cast("decimal(12,4)").alias("cost_price"),
        (retail + F.when(F.col("p_partkey") % 7 == 0, 10).otherwise(0)).cast("decimal(12,4)").alias("list_price"),
        F.lit(None).cast("string").alias("tax_class_code"),
        F.when(F.col("p_partkey") % 17 == 0, "N").otherwise("Y").alias("is_active"),
        F.lit(load_date).alias("load_date"),
    )


def product_master_file(t: Tables, load_date: _dt.date = LOAD_DATE) -> DataFrame:
    """The product master as the CSV rows a supplier would send (every part,
    all values as text, columns in file order): the staged product of
    ``stg_product`` with an unparseable product id every 499th product (a bad
    row), a padded name every 19th and a blank active flag every 23rd."""
    sp = stg_product(t, load_date)
    pid = F.col("product_id").cast("string")
    return sp.select(
        F.when(F.col("product_id") % 499 == 0, F.concat(F.lit("x"), pid)).otherwise(pid).alias("product_id"),
        "product_code",
        F.when(F.col("product_id") % 19 == 0, F.concat(F.lit("  "), "product_name", F.lit(" ")))
         .otherwise(F.col("product_name")).alias("product_name"),
        "category_code", "subcategory_code",
        F.col("supplier_id").cast("string").alias("supplier_id"),
        F.col("cost_price").cast("string").alias("cost_price"),
        F.col("list_price").cast("string").alias("list_price"),
        "tax_class_code",
        F.lit(None).cast("string").alias("weight_kg"),
        F.when(F.col("product_id") % 23 == 0, F.lit(" ")).otherwise(F.col("is_active")).alias("is_active"),
        F.lit(load_date.isoformat()).alias("effective_date"),
        F.lit(None).cast("string").alias("expiry_date"),
    )


def dim_product(t: Tables) -> DataFrame:
    """Product dimension before the load: every 11th product missing, every 5th
    has a closed version 1 and an open version 2."""
    retail = _dec("p_retailprice", 12, 4)
    base = t.part.where(F.col("p_partkey") % 11 != 0)
    fifth = F.col("p_partkey") % 5 == 0
    current = base.select(
        (F.col("p_partkey") * 2 + 1001).cast("bigint").alias("dim_product_key"),
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_code"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_code"),
        F.col("p_brand").alias("subcategory_code"),
        (F.col("p_partkey") % 100).alias("supplier_id"),
        (retail * F.lit(0.7).cast("decimal(2,1)")).cast("decimal(12,4)").alias("cost_price"),
        retail.alias("list_price"),
        F.when(fifth, F.lit(_dt.date(1996, 1, 1))).otherwise(F.lit(_dt.date(1995, 1, 1))).alias("valid_from"),
        F.lit(HIGH_DATE).alias("valid_to"),
        F.lit("Y").alias("is_current"),
        F.when(fifth, 2).otherwise(1).alias("version_num"),
    )
    closed = base.where(fifth).select(
        (F.col("p_partkey") * 2 + 1000).cast("bigint").alias("dim_product_key"),
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_code"),
        F.concat(F.lit("old "), F.col("p_name")).alias("product_name"),
        F.col("p_type").alias("category_code"),
        F.col("p_brand").alias("subcategory_code"),
        (F.col("p_partkey") % 100).alias("supplier_id"),
        F.lit(1).cast("decimal(12,4)").alias("cost_price"),
        F.lit(2).cast("decimal(12,4)").alias("list_price"),
        F.lit(_dt.date(1995, 1, 1)).alias("valid_from"),
        F.lit(_dt.date(1995, 12, 31)).alias("valid_to"),
        F.lit("N").alias("is_current"),
        F.lit(1).alias("version_num"),
    )
    return current.unionByName(closed).withColumn("tax_class_code", F.lit(None).cast("string"))


def loyalty_profile(t: Tables) -> DataFrame:
    return t.customer.where(F.col("c_custkey") % 4 != 0).select(
        F.col("c_custkey").alias("cust_id"),
        F.col("c_mktsegment").alias("tier_cd"),
        _dec("c_acctbal", 14, 2).alias("lifetime_spend"))


def stg_customer(t: Tables, load_date: _dt.date = LOAD_DATE) -> DataFrame:
    """Staged customers for the load date (input of the customer SCD2)."""
    lp = loyalty_profile(t)
    c = customer_region(t)
    return (c.join(lp, F.col("c_custkey") == F.col("cust_id"), "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_code"),
                F.substring("c_name", 1, 8).alias("first_name"),
                F.when(F.col("c_custkey") % 19 == 0, F.lit(None))
                 .otherwise(F.substring("c_name", 10, 9)).alias("last_name"),
                F.lower("c_name").alias("email"),
                F.col("r_name").alias("region_code"),
                F.coalesce(F.col("tier_cd"), F.lit("STANDARD")).alias("loyalty_tier"),
                F.col("lifetime_spend").alias("lifetime_value"),
                F.lit(load_date).alias("load_date")))


def dim_customer(t: Tables) -> DataFrame:
    """Customer dimension before the load: every 11th customer missing, tier
    differs for every 6th."""
    s = stg_customer(t)
    return s.where(F.col("customer_id") % 11 != 0).select(
        (F.col("customer_id") + 1000).cast("bigint").alias("dim_customer_key"),
        "customer_id", "customer_code",
        F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "),
                 F.coalesce("last_name", F.lit(""))).alias("full_name"),
        "email", "region_code",
        F.when(F.col("customer_id") % 6 == 0, "BRONZE").otherwise(F.col("loyalty_tier")).alias("loyalty_tier"),
        F.lit(_dt.date(1995, 1, 1)).alias("valid_from"),
        F.lit(HIGH_DATE).alias("valid_to"),
        F.lit("Y").alias("is_current"),
        F.lit(1).alias("version_num"),
    )


def dim_store(t: Tables) -> DataFrame:
    return t.supplier.where(F.col("s_suppkey") % 10 != 0).select(
        (F.col("s_suppkey") + 1000).cast("bigint").alias("dim_store_key"),
        F.col("s_suppkey").alias("store_id"),
        F.lit("Y").alias("is_current"))


def supplier_feed(t: Tables) -> DataFrame:
    """Supplier price feeds (one frame with supplier_id instead of one table per
    supplier): two effective dates for every 4th product."""
    a = t.part.where(F.col("p_partkey") % 2 == 0).select(
        (F.col("p_partkey") % 100).alias("supplier_id"), F.col("p_partkey").alias("product_id"),
        (F.col("p_retailprice") + 5).cast("decimal(12,4)").alias("list_price"),
        F.lit(600).cast("decimal(12,4)").alias("cost_price"),
        F.lit(_dt.date(1997, 6, 1)).alias("effective_date"))
    b = t.part.where(F.col("p_partkey") % 4 == 0).select(
        (F.col("p_partkey") % 100).alias("supplier_id"), F.col("p_partkey").alias("product_id"),
        (F.col("p_retailprice") + 6).cast("decimal(12,4)").alias("list_price"),
        F.lit(610).cast("decimal(12,4)").alias("cost_price"),
        F.lit(_dt.date(1997, 12, 1)).alias("effective_date"))
    return a.unionByName(b).withColumn("weight_kg", F.lit(None).cast("decimal(8,3)"))


def src_customer(t: Tables) -> DataFrame:
    """Source customer master (SOURCE_OPS.CUSTOMER)."""
    c = customer_region(t)
    return c.select(
        F.col("c_custkey").alias("cust_id"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("cust_ref_cd"),
        F.substring("c_name", 1, 8).alias("first_nm"),
        F.when(F.col("c_custkey") % 19 == 0, F.lit(None))
         .otherwise(F.substring("c_name", 10, 9)).alias("last_nm"),
        F.col("c_name").alias("email_addr"),
        F.concat(F.lit("07"), F.col("c_custkey").cast("string")).alias("mobile_phone"),
        F.col("r_name").alias("home_region_cd"),
        F.date_add(F.lit(_dt.date(1994, 1, 1)), (F.col("c_custkey") % 365).cast("int")).alias("reg_date"))


def stg_customer_prev(t: Tables) -> DataFrame:
    """Shared customer staging as it stood before the day's upsert: customers
    new to the warehouse (every 11th, as in the dimension) are not there yet."""
    s = stg_customer(t)
    return s.where(F.col("customer_id") % 11 != 0).select(
        "customer_id", "customer_code", "first_name", "last_name", "email",
        F.lit(None).cast("string").alias("phone"), "region_code", "loyalty_tier",
        "lifetime_value", F.lit(None).cast("date").alias("registration_date"),
        F.lit(None).cast("timestamp_ntz").alias("last_purchase_date"), "load_date")


# ---------------------------------------------------------------- rule tables
# Config rows (a handful), not data: the queries that use them read whole tables.
CATEGORY_RULE_ROWS = [
    # category_code, rule_name, col_target, rule_expr, is_active, execution_order
    ("PROMO", "promo_list_price", "list_price", "round(list_price * 0.90, 4)", "Y", 1),
    ("PROMO", "promo_name", "product_name", "'PROMO ' || product_name", "Y", 2),
    ("ECONOMY", "economy_cost", "cost_price", "round(cost_price * 0.95, 4)", "Y", 1),
    ("ECONOMY", "economy_broken", "cost_price", "no_such_column * 2", "Y", 2),
    ("LARGE", "large_inactive", "list_price", "list_price * 100", "N", 1),
    ("SMALL", "small_subcategory", "subcategory_code", "subcategory_code || '-S'", "Y", 1),
    ("STANDARD", "standard_bad_target", "dim_product_key", "0", "Y", 1),
]


def category_rules(spark) -> DataFrame:
    return spark.createDataFrame(
        CATEGORY_RULE_ROWS,
        "category_code string, rule_name string, col_target string, rule_expr string, "
        "is_active string, execution_order int")


# DQ rules of the checked run: the built-in three, a generic metric, a broken
# rule and referential rules (by expression and by parent key).
def dq_rule_rows() -> list[tuple]:
    from ..operators.quality import BUILTIN_RULES
    return list(BUILTIN_RULES) + [
        (4, "ZERO_PRICE_LINES", "FACT_DAILY_SALES", "GENERIC", "count_if(unit_price = 0)", 5.0, "WARNING"),
        (5, "BROKEN_RULE", "FACT_DAILY_SALES", "RANGE_CHECK", "no_such_column > 0", 0.0, "WARNING"),
        (6, "SUMMARY_HAS_REVENUE", "FACT_REGIONAL_SUMMARY", "RANGE_CHECK", "total_revenue > 0", 0.0, "WARNING"),
    ]


def dq_referential_rows() -> list[tuple]:
    return [
        (11, "FACT_STORE_KEY_SET", "FACT_DAILY_SALES", "REFERENTIAL_CHECK", "dim_store_key", 50.0, "WARNING"),
        (12, "FACT_PRODUCT_FK", "FACT_DAILY_SALES", "REFERENTIAL_CHECK", "dim_product_key", 0.0, "CRITICAL",
         "DIM_PRODUCT", "dim_product_key"),
        (13, "FACT_STORE_FK", "FACT_DAILY_SALES", "REFERENTIAL_CHECK", "dim_store_key", 10.0, "WARNING",
         "DIM_STORE", "dim_store_key"),
    ]
