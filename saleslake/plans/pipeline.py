"""Daily load (I9, I10): products first, then customers, then the fact and its
summary.  ``load_dimensions`` and ``load_facts`` are the one composition: the
store-backed job (``run.py``) writes a snapshot between them, ``daily_load``
chains them in one lazily planned batch.  Row counts come from ``observe``
metrics collected by the writes, not from extra ``count()`` jobs."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import clean, fact as factop, joins, rollups, rules, scd


@dataclass
class FactLoad:
    fact: DataFrame
    fact_rows: Observation
    dropped: DataFrame


@dataclass
class SliceOutputs:
    """What the graph writes of a slice, from all its staged rows."""
    rejects: DataFrame
    unmatched: DataFrame
    rollup: DataFrame
    summary: DataFrame


@dataclass
class DailyLoad:
    dim_product: DataFrame
    dim_customer: DataFrame
    facts: FactLoad
    staging: DataFrame
    summary: DataFrame


def load_dimensions(*, dim_product: DataFrame, stg_product: DataFrame, dim_customer: DataFrame,
                    stg_customer: DataFrame, supplier_feed: DataFrame | None, category_rules: DataFrame | None,
                    load_date: _dt.date, region: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Next versions of the product and customer dimensions."""
    dp = scd.load_dim_product(dim_product, stg_product, load_date, ordered=False)       # I1
    dp = with_prices_and_rules(dp, supplier_feed, category_rules, load_date)
    return dp, scd.load_dim_customer(dim_customer, stg_customer, load_date, region, ordered=False)   # I2


def with_prices_and_rules(products: DataFrame, supplier_feed: DataFrame | None, category_rules: DataFrame | None,
                          load_date: _dt.date) -> DataFrame:
    """I6, then I5: both change open versions only."""
    if supplier_feed is not None:
        products = rules.enrich_from_suppliers(products, supplier_feed, load_date)
    if category_rules is not None:
        products = rules.apply_category_rules(products, category_rules, load_date)
    return products


def load_facts(pending: DataFrame, dim_product: DataFrame, dim_customer: DataFrame, dim_store: DataFrame,
               fact_key_start: int | None = None, heavy=None) -> FactLoad:
    """I9 over the pending rows, and the rows the dimension joins drop (I4)."""
    obs = Observation("fact_rows")
    fact = factop.load_fact(pending, dim_product, dim_customer, dim_store, key_start=fact_key_start, heavy=heavy)
    return FactLoad(fact.observe(obs, F.count(F.lit(1)).alias("n")), obs,
                    factop.dropped_by_dims(pending, dim_product, dim_customer, dim_store, heavy))


def slice_outputs(staged: DataFrame, dim_product: DataFrame, run_ts: _dt.datetime, heavy=None) -> SliceOutputs:
    """The graph's outputs of whole slices, whatever batch their rows came with."""
    valid, rejects = clean.split_valid(staged)
    enriched = clean.enrich_sales(valid)
    rollup = rollups.category_rollup(joins.join_product_left(enriched, dim_product, heavy))
    return SliceOutputs(clean.reject_records(rejects, run_ts), joins.unmatched_product(enriched, dim_product, heavy),
                        rollup, rollups.summary_column_mapping(rollup))


def daily_load(*, staged: DataFrame, stg_product: DataFrame, dim_product: DataFrame,
               stg_customer: DataFrame, dim_customer: DataFrame, dim_store: DataFrame,
               supplier_feed: DataFrame | None, category_rules: DataFrame | None,
               load_date: _dt.date, region: str | None = None, batch_id: int | None = None,
               fact_key_start: int | None = None) -> DailyLoad:
    """I10.  ``region=None`` processes every region (defect 6); staged rows of
    every date in ``staged`` are loaded when ``load_date`` only drives the
    dimension loads (a backfill); pass a single-day ``staged`` for a daily run.
    """
    dp, dc = load_dimensions(dim_product=dim_product, stg_product=stg_product, dim_customer=dim_customer,
                             stg_customer=stg_customer, supplier_feed=supplier_feed,
                             category_rules=category_rules, load_date=load_date, region=region)
    facts = load_facts(clean.pending(staged, None, region), dp, dc, dim_store, fact_key_start)
    bid = batch_id if batch_id is not None else int(load_date.strftime("%Y%m%d"))
    staging = scd.mark_loaded(staged, bid, None, region)                         # I4
    return DailyLoad(dp, dc, facts, staging, rollups.regional_summary(facts.fact))   # D1
