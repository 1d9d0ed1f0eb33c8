"""Rule-driven product dimension operators: category rules (I5) and supplier
price enrichment (I6).

Rules are rows of data (``category_code, rule_name, col_target, rule_expr,
is_active, execution_order``).  They are few, so they are collected to build
the plan; the data itself is never collected.  Each rule becomes one
``when(...).otherwise(...)`` projection, in order, so rule *n* sees the result
of rule *n-1* -- all in one stage, no shuffle.
"""

from __future__ import annotations

import datetime as _dt
import logging
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import freeze

log = logging.getLogger(__name__)

PROTECTED_COLUMNS = ("dim_product_key", "product_id", "valid_from", "valid_to", "is_current",
                     "version_num")


@dataclass
class RuleOutcome:
    category_code: str
    rule_name: str
    applied: bool
    message: str


def active_rules(rules: DataFrame) -> DataFrame:
    """A15 + F1: active rules, ordered by category and execution order."""
    return rules.where(F.col("is_active") == "Y").orderBy("category_code", "execution_order", "rule_name")


def apply_category_rules(dim: DataFrame, rules: DataFrame, load_date: _dt.date,
                         outcomes: list[RuleOutcome] | None = None) -> DataFrame:
    """Apply each active rule of a category to the current versions of that
    category that began on ``load_date``.

    A rule whose target is not an updatable column of the dimension, or whose
    expression does not analyse against it (unknown column, bad syntax, wrong
    type), is skipped with a warning and the rest continue; so is a rule that
    fails while it runs.  All rules are compiled into one chain of expressions and tried in one job over the
    rows they would change (the versions of a category and day); only if that fails, the first failing
    rule is searched by halving and left out: the number of jobs follows the number of rules that fail, not that of rules.
    A category with no rules is left as it is.
    """
    out = freeze(dim)
    allowed = [c for c in dim.columns if c not in PROTECTED_COLUMNS]
    good = []
    for r in active_rules(rules).collect():
        if r["col_target"] not in allowed:
            _note(outcomes, r, False, f"target column {r['col_target']!r} not updatable")
            continue
        try:
            _applied(out, [r], load_date).schema                      # analyses alone
            good.append(r)
        except PySparkException as e:
            _note(outcomes, r, False, f"skipped: {str(e).splitlines()[0][:200]}")
    tried = 0                                                          # rules before this place run together
    while (error := _failure(out, good, load_date)) is not None:
        low, high = tried, len(good)                                   # the first low rules run, the first high fail
        while high - low > 1:
            middle = (low + high) // 2
            failed = _failure(out, good[:middle], load_date)
            low, high, error = (low, middle, failed) if failed is not None else (middle, high, error)
        _note(outcomes, good.pop(high - 1), False, f"skipped: {str(error).splitlines()[0][:200]}")
        tried = high - 1
    for r in good:
        _note(outcomes, r, True, "applied")
    return _applied(out, good, load_date)


def _applied(dim: DataFrame, rules: list, load_date: _dt.date) -> DataFrame:
    """The rules in order, each over the result of those before it."""
    for r in rules:
        target = r["col_target"]
        hit = ((F.col("category_code") == F.lit(r["category_code"])) & (F.col("is_current") == "Y")
               & (F.col("valid_from") == F.lit(load_date)))
        new = F.expr(r["rule_expr"]).cast(dim.schema[target].dataType)
        dim = dim.withColumn(target, F.when(F.coalesce(hit, F.lit(False)), new).otherwise(F.col(target)))
    return dim


def _failure(dim: DataFrame, rules: list, load_date: _dt.date) -> PySparkException | None:
    """What running the rules raises, from one job over the rows that rules may change."""
    targets = sorted({r["col_target"] for r in rules})
    if not targets:
        return None
    rows = dim.where((F.col("is_current") == "Y") & (F.col("valid_from") == F.lit(load_date)))
    try:
        _applied(rows, rules, load_date).agg(F.bit_xor(F.xxhash64(*targets))).collect()
    except PySparkException as e:
        return e
    return None


def _note(outcomes, r, applied: bool, msg: str) -> None:
    if not applied:
        log.warning("rule %s/%s %s", r["category_code"], r["rule_name"], msg)
    if outcomes is not None:
        outcomes.append(RuleOutcome(r["category_code"], r["rule_name"], applied, msg))


def enrich_from_suppliers(dim: DataFrame, feed: DataFrame, load_date: _dt.date,
                          match_supplier: bool = True) -> DataFrame:
    """Price and cost of current products from their supplier feeds.

    Suppliers considered are those with versions opened on ``load_date`` (D11);
    any current product found in such a supplier's feed with an effective date
    on or before ``load_date`` takes the latest effective row's list and cost
    price (one row per product, so the update is unambiguous).  With
    ``match_supplier`` the feed's supplier must be the product's supplier;
    ``False`` reproduces the reference's product-only match.  Weight is read,
    never written.  All in one pass: a semi join, one aggregate, one left join.
    """
    suppliers = (dim.where((F.col("is_current") == "Y") & (F.col("valid_from") == F.lit(load_date))
                           & F.col("supplier_id").isNotNull())
                 .select("supplier_id").distinct())
    eligible = (feed.where(F.col("effective_date") <= F.lit(load_date))
                .join(suppliers, "supplier_id", "left_semi"))
    keys = ["product_id", "supplier_id"] if match_supplier else ["product_id"]
    latest = (eligible.groupBy(*keys)
              .agg(F.max(F.struct("effective_date", "list_price", "cost_price")).alias("_l"))
              .select(*[F.col(k).alias(f"_f_{k}") for k in keys],
                      F.col("_l.list_price").alias("_f_list"), F.col("_l.cost_price").alias("_f_cost")))
    cond = [dim[k] == latest[f"_f_{k}"] for k in keys] + [dim["is_current"] == F.lit("Y")]
    j = dim.join(latest, cond, "left")
    hit = F.col("_f_product_id").isNotNull()
    return (j.withColumn("list_price", F.when(hit, F.col("_f_list")).otherwise(F.col("list_price"))
                         .cast(dim.schema["list_price"].dataType))
            .withColumn("cost_price", F.when(hit, F.col("_f_cost")).otherwise(F.col("cost_price"))
                        .cast(dim.schema["cost_price"].dataType))
            .select(*dim.columns))
