"""Dimension lookups and enrichment joins.

Joins are written declaratively; the planner and AQE choose the strategy.  A
dimension is broadcast only when its *measured* size at run time is below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` (AQE converts the sort-merge
join then); beyond that it stays a shuffle join, so growth never breaks it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import trim_to_null
from .clean import business_day, in_region
from . import skew

LOOKUP_COLUMNS = ("product_id", "product_code", "product_name", "category_code",
                  "subcategory_code", "list_price", "is_current", "valid_from", "valid_to")


def current(dim: DataFrame) -> DataFrame:
    """Open versions only (``is_current = 'Y'``); pushed into the dimension scan."""
    return dim.where(F.col("is_current") == "Y")


def product_lookup(dim_product: DataFrame) -> DataFrame:
    """A3: current product rows, lookup columns only (column pruning)."""
    return current(dim_product).select(*LOOKUP_COLUMNS)


#: The staged keys that the dimension joins use, with the heavy values of each (``skew.heavy_keys``).
Heavy = dict[str, skew.Heavy]


def heavy_dimension_keys(staged: DataFrame) -> Heavy:
    """The products and customers that hold so many staged rows that a join has to deal them over several tasks; one
    pass over two columns, meant for stored rows."""
    keys = ("product_id", "customer_id")
    return dict(zip(keys, skew.heavy_keys(staged, *[[k] for k in keys])))


#: Rows of a lookup table of a key and one value that are sent to all tasks at most; 7.2 million take 311 MiB there.
KEYS_SENT = 1 << 23


def sent_if_small(dim: DataFrame) -> DataFrame:
    """The dimension, marked for broadcast where it is counted to have up to ``KEYS_SENT`` current versions, so that a lookup of
    its keys doesn't shuffle the sales.  For ``dimension_keys``, which takes two columns of it; a larger one is joined as before."""
    return sent_if_few(dim, current(dim))


def sent_if_few(lookup: DataFrame, counted: DataFrame) -> DataFrame:
    """``lookup``, marked for broadcast where ``counted``, the rows it is made of, are up to ``KEYS_SENT``."""
    return F.broadcast(lookup) if counted.count() <= KEYS_SENT else lookup


def _lookup(rows: DataFrame, dim: DataFrame, key: str, how: str, heavy: Heavy | None) -> DataFrame:
    """Join with one dimension row per key: plain (AQE picks the strategy and splits skew), or with the heavy
    values known, which also deals rows without a key evenly."""
    if heavy is None:
        return rows.join(dim, key, how)
    return skew.heavy_hitter_join(rows, dim, [key], how, spread=["transaction_id"], heavy=heavy[key])


def join_product_left(enriched: DataFrame, dim_product: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """C4 + B22: left-outer product enrichment with defaults for a missing product."""
    lk = product_lookup(dim_product).select(
        "product_id", *[F.col(c).alias(f"_dp_{c}") for c in S.MISSING_PRODUCT_DEFAULTS])
    j = _lookup(enriched, lk, "product_id", "left", heavy)
    filled = [F.coalesce(F.col(f"_dp_{c}"), F.lit(d)).alias(c) for c, d in S.MISSING_PRODUCT_DEFAULTS.items()]
    return j.select(
        "transaction_id", "customer_id", "product_id", *filled, "store_id", "transaction_date",
        "quantity", "unit_price", "discount_amt", "gross_amount", "net_amount", "region_code",
        "currency_code", "basket_tier", "fiscal_year", "fiscal_month")


def unmatched_product(enriched: DataFrame, dim_product: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """Rows with no current product (the join's unmatched port)."""
    return _lookup(enriched, current(dim_product).select("product_id"), "product_id", "left_anti", heavy)


def dimension_keys(staged: DataFrame, dim_product: DataFrame, dim_customer: DataFrame,
                   dim_store: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """C1-C3 as one left-joined frame: current product, customer and store keys
    beside each staged row (NULL where no current version exists).  The fact is
    the rows with both product and customer keys (C1, C2 are inner joins; the
    optimizer turns left join + not-null filter into an inner join), the rows
    dropped by those joins are the rest (I4).  ``heavy``: ``heavy_dimension_keys`` of the rows."""
    dp = current(dim_product).select("product_id", "dim_product_key")
    dc = current(dim_customer).select("customer_id", "dim_customer_key")
    ds = current(dim_store).select("store_id", "dim_store_key")
    keyed = _lookup(_lookup(staged, dp, "product_id", "left", heavy), dc, "customer_id", "left", heavy)
    return keyed.join(ds, "store_id", "left")


def sales_customers(src_sales: DataFrame, date_from: _dt.date | None, date_to: _dt.date | None,
                    region: str | None = None, spellings: dict[str, list[str]] | None = None) -> DataFrame:
    """C6 + E6: customers with sales in the window, with their latest purchase.
    The partition max of the reference collapses to a grouped max (one row per
    customer, partial aggregation first)."""
    cond = business_day(src_sales, date_from, date_to) & in_region(region, spellings)
    return (src_sales.where(cond).groupBy("cust_id")
            .agg(F.max("txn_datetime").alias("last_purchase_date")))


def customer_source(src_customer: DataFrame, loyalty: DataFrame, buyers: DataFrame,
                    load_date: _dt.date) -> DataFrame:
    """C6 + C7 + B19: the upsert source rows (12 staging columns)."""
    return (src_customer.join(buyers, "cust_id")
            .join(loyalty, "cust_id", "left")
            .select(
                F.col("cust_id").alias("customer_id"),
                trim_to_null("cust_ref_cd").alias("customer_code"),
                trim_to_null("first_nm").alias("first_name"),
                trim_to_null("last_nm").alias("last_name"),
                F.lower(trim_to_null("email_addr")).alias("email"),
                trim_to_null("mobile_phone").alias("phone"),
                F.col("home_region_cd").alias("region_code"),
                F.coalesce(F.col("tier_cd"), F.lit(S.DEFAULT_LOYALTY_TIER)).alias("loyalty_tier"),
                F.col("lifetime_spend").alias("lifetime_value"),
                F.col("reg_date").alias("registration_date"),
                F.col("last_purchase_date"),
                F.lit(load_date).alias("load_date")))


def ytd_spend(fact: DataFrame, dim_customer: DataFrame, year: int) -> DataFrame:
    """C8 + D6: year-to-date spend and count per natural customer id.

    The fact is aggregated by surrogate key first (partial aggregation below the
    join), mapped to the natural id through the dimension (every version, since
    a fact keeps the key current at its load), then summed per customer.  The
    year test is a date range, so it prunes a date-partitioned fact."""
    y = fact.where((F.col("transaction_date") >= F.lit(_dt.date(year, 1, 1)))
                   & (F.col("transaction_date") <= F.lit(_dt.date(year, 12, 31))))
    by_key = y.groupBy("dim_customer_key").agg(
        F.sum("net_amount").alias("_spend"), F.count(F.lit(1)).alias("_n"))
    keys = dim_customer.select("dim_customer_key", "customer_id")
    return (by_key.join(keys, "dim_customer_key").groupBy("customer_id")
            .agg(F.sum("_spend").alias("total_spend_ytd"), F.sum("_n").alias("txn_count_ytd")))
