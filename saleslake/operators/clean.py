"""Extract, validate and enrich a day's sales."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C


def _slice_filter(date_col: Column, region_col: Column, load_date, region,
                  date_from=None, date_to=None) -> Column:
    """Slice predicate.  ``None`` means 'all' (a backfill of many slices in one
    job); equality on the date and region columns reaches the Parquet scan as a
    pushed filter and prunes partitions of a partitioned staging table."""
    cond = F.lit(True)
    if load_date is not None:
        cond = cond & (date_col == F.lit(load_date))
    if date_from is not None:
        cond = cond & (date_col >= F.lit(date_from))
    if date_to is not None:
        cond = cond & (date_col <= F.lit(date_to))
    if region is not None:
        cond = cond & (region_col == F.lit(region))
    return cond


def business_day(src: DataFrame, first=None, last=None, col: str = "txn_datetime") -> Column:
    """``first <= day <= last`` (None: open) as a range of the timestamp itself, which reaches the scan as pushed filters."""
    kind, cond = src.schema[col].dataType, F.lit(True)
    if first is not None:
        cond = cond & (F.col(col) >= F.lit(first).cast(kind))
    if last is not None:
        cond = cond & (F.col(col) < F.lit(last + _dt.timedelta(days=1)).cast(kind))
    return cond


#: Spellings of region codes that are pushed at most.
MOST_SPELLINGS = 1000


def region_spellings(src: DataFrame, col: str = "store_region_cd") -> dict[str, list[str]] | None:
    """Normalised region -> the spellings it has in ``src`` (one pass over one column, a few rows come back); None if there
    are more than MOST_SPELLINGS, so that nothing is pushed.  Found once per load and passed to its scans."""
    found = src.select(F.col(col).alias("raw"), C.normalise_region(col).alias("region")).where("region is not null").distinct()
    rows = found.limit(MOST_SPELLINGS + 1).collect()
    if len(rows) > MOST_SPELLINGS:
        return None
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["region"], []).append(r["raw"])
    return out


def in_region(region: str | None, spellings: dict[str, list[str]] | None = None, col: str = "store_region_cd") -> Column:
    """Rows whose normalised code is ``region`` (None: all).  With the spellings of the source an IN filter on the raw
    column stands beside the exact test and reaches the scan."""
    if region is None:
        return F.lit(True)
    exact = C.normalise_region(col) == F.lit(region)
    return exact if spellings is None else F.col(col).isin(sorted(spellings.get(region, []))) & exact


def extract_predicate(src: DataFrame, load_date=None, region=None, spellings: dict[str, list[str]] | None = None) -> Column:
    """B2: date, region, status NOT IN (VOID, CANCELLED, TEST), qty > 0, price >= 0.
    A NULL status fails NOT IN, as in SQL."""
    return (business_day(src, load_date, load_date) & in_region(region, spellings)
            & ~C.trim_to_null("txn_status_cd").isin(*S.EXCLUDED_STATUSES)
            & (F.col("sold_qty") > 0)
            & (F.col("unit_sell_price") >= 0))


def extract_sales(src: DataFrame, load_date: _dt.date | None = None, region: str | None = None,
                  batch_id: int | None = None, spellings: dict[str, list[str]] | None = None) -> DataFrame:
    """B1 + B2 + B3 + B20: source transactions -> staging rows (PENDING).

    Text columns are trimmed and blank text becomes NULL (the source database
    stores '' as NULL), so a blank currency defaults to GBP and a blank status
    fails NOT IN like a NULL one.

    With ``load_date=None`` every day is extracted as its own slice: load date,
    batch id (yyyymmdd) and source tag are taken per slice.  The region code is
    normalised once here (upper/trim), so every later step compares clean codes.
    """
    staged_date = F.col("txn_datetime").cast("date")
    slice_date = F.lit(load_date) if load_date is not None else staged_date
    region_code = C.normalise_region("store_region_cd")
    return (src.where(extract_predicate(src, load_date, region, spellings))
            .select(
                F.col("txn_id").alias("transaction_id"),
                F.col("cust_id").alias("customer_id"),
                F.col("prod_id").alias("product_id"),
                F.col("store_id"),
                staged_date.alias("transaction_date"),
                F.col("sold_qty").alias("quantity"),
                F.col("unit_sell_price").alias("unit_price"),
                C.nvl("disc_amount", F.lit(0).cast("decimal(12,4)")).alias("discount_amt"),
                C.discount_pct("disc_amount", "unit_sell_price").alias("discount_pct"),
                region_code.alias("region_code"),
                C.nvl(C.trim_to_null("currency"), S.DEFAULT_CURRENCY).alias("currency_code"),
                C.trim_to_null("payment_type_cd").alias("payment_method"),
                C.trim_to_null("terminal_ref").alias("pos_terminal_id"),
                slice_date.alias("load_date"),
                (F.lit(batch_id).cast("bigint") if batch_id is not None
                 else C.batch_id_of(slice_date)).alias("load_batch_id"),
                C.source_tag(region_code, slice_date).alias("source_file_name"),
                F.lit(S.PENDING).alias("etl_status"),
            ))


def split_duplicates(staged: DataFrame, key: tuple[str, ...] = ("transaction_id", "transaction_date", "region_code"),
                     ) -> tuple[DataFrame, DataFrame]:
    """Enforce the staging key: (one row per transaction of a slice, the other rows).

    Of rows that share a key the first in the order of all columns stays, so
    reruns choose alike.  The windows hold one transaction each."""
    order = [F.col(c).asc_nulls_first() for c in staged.columns if c not in key]
    nth = staged.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return nth.where("_nth = 1").drop("_nth"), nth.where("_nth > 1").drop("_nth")


def scan_transactions(src: DataFrame, load_date=None, region=None,
                      status: str = S.COMPLETED, batch_id: int | None = None,
                      spellings: dict[str, list[str]] | None = None) -> DataFrame:
    """A2 + B4: the graph's own parameterised scan of the source: date, region,
    ``status = COMPLETED``, quantity > 0 -> ``stg_sales_record`` (13 fields)."""
    d = F.col("txn_datetime").cast("date")
    pred = (business_day(src, load_date, load_date) & in_region(region, spellings)
            & (C.trim_to_null("txn_status_cd") == status) & (F.col("sold_qty") > 0))
    return src.where(pred).select(
        F.col("txn_id").alias("transaction_id"),
        F.col("cust_id").alias("customer_id"),
        F.col("prod_id").alias("product_id"),
        "store_id",
        d.alias("transaction_date"),
        F.col("sold_qty").alias("quantity"),
        F.col("unit_sell_price").alias("unit_price"),
        F.col("disc_amount").alias("discount_amt"),
        C.discount_pct("disc_amount", "unit_sell_price").alias("discount_pct"),
        F.col("store_region_cd").alias("region_code"),
        F.col("currency").alias("currency_code"),
        F.col("payment_type_cd").alias("payment_method"),
        (F.lit(batch_id).cast("bigint") if batch_id is not None else C.batch_id_of(d)).alias("load_batch_id"),
    )


def pending(staged: DataFrame, load_date=None, region=None) -> DataFrame:
    """Staged rows of a slice still waiting to be loaded."""
    return staged.where(_slice_filter(F.col("transaction_date"), F.col("region_code"),
                                      load_date, region)
                        & (F.col("etl_status") == S.PENDING))


def is_valid(c_qty="quantity", c_price="unit_price", c_product="product_id") -> Column:
    """B5 keep predicate made total: NULL counts as a reject (coalesce to false)."""
    return F.coalesce((F.col(c_qty) > 0) & (F.col(c_price) > 0) & F.col(c_product).isNotNull(),
                      F.lit(False))


def split_valid(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, reject) on one flag; keep + reject = input, always."""
    flagged = staged.withColumn("_valid", is_valid())
    return (flagged.where("_valid").drop("_valid"), flagged.where(~F.col("_valid")).drop("_valid"))


def rejection_reason() -> Column:
    """B6 reason text: every failed condition, '; '-separated."""
    return F.concat_ws(
        "; ",
        F.when(F.coalesce(F.col("quantity") <= 0, F.lit(True)), F.lit("INVALID_QUANTITY")),
        F.when(F.coalesce(F.col("unit_price") <= 0, F.lit(True)), F.lit("INVALID_PRICE")),
        F.when(F.col("product_id").isNull(), F.lit("MISSING_PRODUCT")))


def reject_records(rejects: DataFrame, rejected_at: _dt.datetime) -> DataFrame:
    """``rejected_record`` rows; the run timestamp is a parameter so reruns repeat."""
    return rejects.select(
        "transaction_id", "region_code", "transaction_date",
        rejection_reason().alias("rejection_reason"),
        F.lit(rejected_at.strftime("%Y-%m-%d %H:%M:%S")).alias("rejected_at"))


def enrich_sales(valid: DataFrame) -> DataFrame:
    """The graph's reformat step."""
    gross = C.gross_amount("quantity", "unit_price")
    return valid.select(
        "transaction_id", "customer_id", "product_id", "store_id", "transaction_date",
        "quantity", "unit_price",
        C.nvl("discount_amt", F.lit(0).cast("decimal(12,4)")).alias("discount_amt"),
        gross.alias("gross_amount"),
        C.net_amount("quantity", "unit_price", "discount_amt").alias("net_amount"),
        C.fiscal_year().alias("fiscal_year"),
        C.fiscal_month().alias("fiscal_month"),
        C.normalise_region("region_code").alias("region_code"),
        C.relabel_currency("currency_code").alias("currency_code"),
        C.basket_tier(gross).alias("basket_tier"),
    )
