"""Fact load (I9) and the rows it drops (I4)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from .joins import dimension_keys
from .keys import assign_dense_keys

FACT_COLUMNS = ("dim_product_key", "dim_customer_key", "dim_store_key", "transaction_date",
                "fiscal_year", "fiscal_month", "fiscal_week", "quantity", "unit_price",
                "discount_amt", "gross_amount", "net_amount", "tax_amount", "region_code",
                "currency_code", "load_date", "load_batch_id")


def fact_rows(keyed: DataFrame, tax_rate: Decimal = S.TAX_RATE) -> DataFrame:
    """B7-B10 on rows that found a current product and customer."""
    gross = C.gross_amount("quantity", "unit_price")
    net = gross - F.col("discount_amt")          # discount is NVL'd at extract (defect 14)
    return (keyed.where(F.col("dim_product_key").isNotNull() & F.col("dim_customer_key").isNotNull())
            .select(
                "dim_product_key", "dim_customer_key", "dim_store_key", "transaction_date",
                C.fiscal_year().alias("fiscal_year"), C.fiscal_month().alias("fiscal_month"),
                C.fiscal_week().alias("fiscal_week"),
                "quantity", "unit_price", "discount_amt",
                F.round(gross, 4).cast(S.AMOUNT).alias("gross_amount"),
                F.round(net, 4).cast(S.AMOUNT).alias("net_amount"),
                C.tax_amount(net, tax_rate).alias("tax_amount"),
                "region_code", C.nvl("currency_code", S.DEFAULT_CURRENCY).alias("currency_code"),
                "load_date", "load_batch_id"))


def load_fact(pending: DataFrame, dim_product: DataFrame, dim_customer: DataFrame,
              dim_store: DataFrame, tax_rate: Decimal = S.TAX_RATE,
              key_start: int | None = None, heavy=None) -> DataFrame:
    """Pending staged rows -> fact rows at the current dimension keys.
    With ``key_start`` the rows also get dense ``fact_sales_key`` values (I8),
    numbered in place (no sort of the day's facts)."""
    facts = fact_rows(dimension_keys(pending, dim_product, dim_customer, dim_store, heavy), tax_rate)
    if key_start is None:
        return facts
    return assign_fact_keys(facts, key_start, ordered=False)


def assign_fact_keys(facts: DataFrame, key_start: int, ordered: bool = True) -> DataFrame:
    """I8 on the fact.  ``ordered``: keys follow a total order over every fact
    column, so rows that tie are identical and the keyed result is
    deterministic (what the check compares); otherwise rows are numbered in
    place, which avoids a global sort of the batch."""
    order = [F.col(c).asc_nulls_first() for c in FACT_COLUMNS] if ordered else None
    keyed = assign_dense_keys(facts, "fact_sales_key", order, key_start)
    return keyed.select("fact_sales_key", *FACT_COLUMNS)


def dropped_by_dims(pending: DataFrame, dim_product: DataFrame, dim_customer: DataFrame,
                    dim_store: DataFrame, heavy=None) -> DataFrame:
    """I4 report: staged rows marked LOADED although no fact row was written,
    because product or customer had no current version."""
    k = dimension_keys(pending, dim_product, dim_customer, dim_store, heavy)
    reason = F.concat_ws("; ",
                         F.when(F.col("dim_product_key").isNull(), F.lit("NO_CURRENT_PRODUCT")),
                         F.when(F.col("dim_customer_key").isNull(), F.lit("NO_CURRENT_CUSTOMER")))
    return (k.where(F.col("dim_product_key").isNull() | F.col("dim_customer_key").isNull())
            .select("transaction_id", "product_id", "customer_id", "region_code",
                    "transaction_date", reason.alias("drop_reason")))
