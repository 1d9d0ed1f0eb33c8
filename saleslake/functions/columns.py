"""Column-level business functions.  Each returns a Spark ``Column`` built from
built-in functions only, so it stays inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S

__all__ = [
    "col_", "nvl", "trim_to_null", "oracle_concat", "full_name", "discount_pct",
    "gross_amount", "net_amount", "tax_amount", "fiscal_year", "fiscal_month",
    "fiscal_week", "fiscal_quarter", "normalise_region", "relabel_currency",
    "basket_tier", "value_segment", "churn_risk", "sentinel_differs",
    "null_safe_differs", "batch_id_of", "source_tag",
]


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nvl(c: Column | str, default) -> Column:
    """NVL / B15: ``coalesce(col, default)``."""
    return F.coalesce(col_(c), default if isinstance(default, Column) else F.lit(default))


def trim_to_null(c: Column | str) -> Column:
    """The source database stores '' as NULL: trim and turn empty strings into NULL."""
    t = F.trim(col_(c))
    return F.when(t == "", F.lit(None)).otherwise(t)


def oracle_concat(*parts: Column | str) -> Column:
    """Source-database ``a || b``: a NULL part acts as ''."""
    return F.concat(*[F.coalesce(col_(p), F.lit("")) for p in parts])


def full_name(first: Column | str = "first_name", last: Column | str = "last_name") -> Column:
    """FIRST || ' ' || LAST with the source database's NULL rules (keeps the stray space)."""
    return oracle_concat(first, F.lit(" "), last)


def discount_pct(disc: Column | str = "disc_amount", price: Column | str = "unit_sell_price") -> Column:
    """Price > 0 ? round(nvl(disc,0)/price*100, 2) : 0, exact decimal, per unit."""
    d = nvl(disc, F.lit(0).cast("decimal(12,4)"))
    p = col_(price)
    return (F.when(p > 0, F.round(d / p * 100, 2))
            .otherwise(F.lit(0)).cast(S.PCT))


def gross_amount(qty: Column | str = "quantity", price: Column | str = "unit_price") -> Column:
    """Quantity x unit price (decimal, scale 6 -- not rounded until stored)."""
    return col_(qty) * col_(price)


def net_amount(qty: Column | str = "quantity", price: Column | str = "unit_price",
               disc: Column | str = "discount_amt") -> Column:
    """Gross - nvl(discount, 0)."""
    return gross_amount(qty, price) - nvl(disc, F.lit(0).cast("decimal(12,4)"))


def tax_amount(net: Column, rate: Decimal = S.TAX_RATE) -> Column:
    """round(net x rate, 4) on the unrounded net."""
    return F.round(net * F.lit(rate), 4).cast("decimal(12,4)")


def fiscal_year(d: Column | str = "transaction_date") -> Column:
    return F.year(col_(d)).cast("bigint")


def fiscal_month(d: Column | str = "transaction_date") -> Column:
    return F.month(col_(d)).cast("bigint")


def fiscal_week(d: Column | str = "transaction_date") -> Column:
    """ISO week (TO_CHAR(d,'IW')), kept beside the calendar year as the reference does."""
    return F.weekofyear(col_(d)).cast("bigint")


def fiscal_quarter(d: Column | str = "transaction_date") -> Column:
    """Q1..Q4 by calendar month."""
    return F.concat(F.lit("Q"), F.quarter(col_(d)).cast("string"))


def normalise_region(c: Column | str = "region_code") -> Column:
    """upper(trim(region))."""
    return F.upper(F.trim(col_(c)))


def relabel_currency(c: Column | str = "currency_code") -> Column:
    """USD, EUR -> GBP.  A label change only: amounts are not converted."""
    cc = col_(c)
    return F.when(cc.isin(*S.RELABELLED_CURRENCIES), F.lit(S.DEFAULT_CURRENCY)).otherwise(cc)


def _band(value: Column, bands, otherwise: str) -> Column:
    expr = None
    for label, bound in bands:
        expr = F.when(value > bound, label) if expr is None else expr.when(value > bound, label)
    return expr.otherwise(otherwise)


def basket_tier(gross: Column) -> Column:
    """Gross > 500 PREMIUM, > 100 STANDARD, else BASIC."""
    return _band(gross, S.BASKET_TIERS, S.BASKET_TIER_ELSE)


def value_segment(lifetime_value: Column | str = "lifetime_value") -> Column:
    """> 5000 HIGH, > 1000 MID, > 100 LOW, else (NULL included) PROSPECT."""
    return _band(col_(lifetime_value), S.VALUE_SEGMENTS, S.VALUE_SEGMENT_ELSE)


def churn_risk(last_purchase: Column | str, as_of: _dt.date) -> Column:
    """NULL -> UNKNOWN; days since purchase > 180 HIGH, > 90 MEDIUM, else LOW."""
    lp = col_(last_purchase)
    days = F.datediff(F.lit(as_of), lp.cast("date"))
    return F.when(lp.isNull(), S.CHURN_UNKNOWN).otherwise(_band(days, S.CHURN_BANDS, S.CHURN_ELSE))


def sentinel_differs(a: Column, b: Column, numeric: bool = False) -> Column:
    """Reference change test ``NVL(a,'X') <> NVL(b,'X')`` (NULL equals the sentinel)."""
    s = F.lit(S.CHANGE_SENTINEL_NUMBER) if numeric else F.lit(S.CHANGE_SENTINEL_TEXT)
    return F.coalesce(a, s) != F.coalesce(b, s)


def null_safe_differs(a: Column, b: Column, numeric: bool = False) -> Column:
    """Strict alternative: NULL differs from every value, NULL equals NULL."""
    return ~a.eqNullSafe(b)


def batch_id_of(d: Column | str) -> Column:
    """Batch id of a slice: its date as yyyymmdd."""
    return F.date_format(col_(d), "yyyyMMdd").cast("bigint")


def source_tag(region: Column | str, d: Column | str) -> Column:
    """B20: '<region>_txn_<yyyy-mm-dd>'."""
    return F.concat(col_(region), F.lit("_txn_"), F.date_format(col_(d), "yyyy-MM-dd"))

