"""Store-backed daily run: the job a scheduler starts once per load date
(products first, then customers, then facts; defect 23).  Every run takes a new
batch id; a run that died is completed by a start with its id.  Jobs of
different regions may run at the same time.
Late rows of a day are added by the next run of that day: their facts come beside
the earlier ones, and rollup, rejects, unmatched rows and summary are made again
from every row of the slice.  A rerun of an unchanged day changes nothing.

Layout under ``root``::

    stg_sales/                 slices  (transaction_date, region_code)
    stg_customer/, dim_*/      versions  v=<n>-<id>[/is_current=<flag>] + _versions
    batches/                   started and finished runs
    fact_daily_sales/          slices  (transaction_date, region_code, load_batch_id)
    regional_summary/          slices  (summary_date, region_code), stored by region and month
    category_rollup/           likewise
    category_summary/          likewise, the rollup under the summary's column names
    summary_states/            totals and key sets that regional_summary is merged from, slices  (load_batch_id)
    errors/rejected, errors/unmatched_product   '|' files per slice
    errors/duplicate_sales     slices of staged rows whose transaction id was staged already
    dq_results/, audit/        slices  (load_batch_id)
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import clean, joins, quality, rollups, scd, states
from ..operators.keys import freeze, next_key, stored
from ..sources import ingest, store
from . import pipeline


@dataclass
class Sources:
    sales_txn: DataFrame                     # operational sales
    src_customer: DataFrame                  # operational customer master
    loyalty: DataFrame                       # loyalty profiles
    stg_product: DataFrame                   # product master staged for the load date (A4)
    supplier_feed: DataFrame | None = None   # I6
    category_rules: DataFrame | None = None  # I5
    dq_rules: DataFrame | None = None        # J; None = built-in rules (J7)
    region_tables: str | None = None         # A16: name of a region's own sales table, with ``{region}``

    def sales(self, region: str | None) -> DataFrame:
        """The operational sales of a region: its own table where there is one, else the shared frame."""
        if self.region_tables is None:
            return self.sales_txn
        return ingest.region_table(self.sales_txn.sparkSession, region, self.region_tables, self.sales_txn)


class Warehouse:
    def __init__(self, root: str):
        self.root = root

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return os.path.join(self.root, name)


def bootstrap(spark: SparkSession, wh: Warehouse, *, dim_product: DataFrame, dim_customer: DataFrame,
              dim_store: DataFrame, stg_customer: DataFrame) -> None:
    """Write the first snapshot of each dimension and of customer staging."""
    for df, table in ((dim_product, wh.dim_product), (dim_customer, wh.dim_customer),
                      (dim_store, wh.dim_store), (stg_customer, wh.stg_customer)):
        store.write_snapshot(spark, df, table)


def load_product_master(spark: SparkSession, wh: Warehouse, csv_path: str, load_date: _dt.date,
                        max_rejected: int = S.MAX_REJECTED_ROWS) -> dict:
    """A4 + A5: the day's product master file -> ``stg_product`` slice of the
    load date (rerun-safe), bad lines kept under ``errors/product_master``.
    Fails above ``max_rejected`` bad rows; warns when fewer rows were staged
    than the file holds."""
    res = ingest.ingest_product_csv(spark, csv_path, load_date, max_rejected)
    store.write_slices(res.good, wh.stg_product, ("load_date",))
    if res.bad_rows:
        res.bad.write.mode("overwrite").text(
            os.path.join(wh.errors, "product_master", f"load_date={load_date.isoformat()}"))
    staged = spark.read.parquet(wh.stg_product).where(F.col("load_date") == F.lit(load_date)).count()
    return {**ingest.reconcile_file(spark, csv_path, staged), "bad_rows": res.bad_rows}


def staged_products_of(spark: SparkSession, wh: Warehouse, load_date: _dt.date) -> DataFrame:
    """The product master slice of a load date (partition-pruned read)."""
    return spark.read.parquet(wh.stg_product).where(F.col("load_date") == F.lit(load_date))


def purge_dimension(spark: SparkSession, table: str, as_of: _dt.date,
                    retention_days: int = S.RETENTION_DAYS) -> int:
    """I7 on a stored dimension: the next snapshot without the closed versions
    that ended before ``as_of - retention_days``; folders of versions that all ended
    before it go unread.  Returns the current version."""
    return store.purge_closed(spark, table, (as_of - _dt.timedelta(days=retention_days)).isoformat())


def _product_merge(src: Sources, load_date: _dt.date, bid: int):
    def merge(current: DataFrame, history: DataFrame) -> tuple[DataFrame, DataFrame]:
        staged, how = scd.product_load(current, src.stg_product, load_date)
        opened, closed = scd.scd2_changes(current, history, staged, key_start=_key_start(current, "dim_product_key", bid), **how)
        return pipeline.with_prices_and_rules(opened, src.supplier_feed, src.category_rules, load_date), closed
    return merge


def _customer_merge(stg_customer: DataFrame, load_date: _dt.date, region: str | None, bid: int):
    def merge(current: DataFrame, history: DataFrame) -> tuple[DataFrame, DataFrame]:
        staged, how = scd.customer_load(current, stg_customer, load_date, region)
        return scd.scd2_changes(current, history, staged, key_start=_key_start(current, "dim_customer_key", bid), **how)
    return merge


def _key_start(current: DataFrame, key_col: str, bid: int) -> int:
    """The batch's first free key: an earlier attempt of the batch may have committed some."""
    first = store.first_key(bid)
    return next_key(current.where(F.col(key_col).between(first, store.first_key(bid + 1) - 1)), key_col, first)


def run_daily(spark: SparkSession, wh: Warehouse, src: Sources, load_date: _dt.date,
              region: str | None = None, batch_id: int | None = None,
              run_ts: _dt.datetime | None = None, fail_on_critical: bool = False) -> dict:
    run_ts = run_ts or _dt.datetime.combine(load_date + _dt.timedelta(days=1), _dt.time(2, 0))

    # 0. the day's sales are fetched from the source once; pre-check (D8): no rows for the day -> a successful no-op (batch mode)
    sales = src.sales(region)
    sales = stored(sales.where(clean.business_day(sales, load_date, load_date)))
    if quality.source_availability(sales, load_date).first()["available"] != "Y":
        return {"batch_id": batch_id, "skipped": True, "reason": "no source rows for the load date"}
    bid = batch_id if batch_id is not None else store.open_batch(spark, wh.batches, load_date, region)

    # 1. extract the slice into staging (A12: PENDING replaced, LOADED kept; I11 defaults before the write);
    #    a transaction id staged twice breaks the staging key: one row stays, the others are set aside
    spellings = None if region is None else clean.region_spellings(sales)
    extract = freeze(ingest.apply_defaults(clean.extract_sales(sales, load_date, region, bid, spellings), "stg_sales"))
    unique, doubles = clean.split_duplicates(extract)
    store.reload_staging(spark, unique, wh.stg_sales, load_date, region)
    store.replace_slices(doubles, wh.errors + "/duplicate_sales",
                         store.slice_predicate("transaction_date", load_date, region))

    # 2. shared customer staging: upsert the day's buyers
    buyers = joins.sales_customers(sales, load_date, load_date, region, spellings)
    cust_src = freeze(joins.customer_source(src.src_customer, src.loyalty, buyers, load_date))
    store.update_snapshot(spark, wh.stg_customer, lambda staged: scd.upsert(staged, cust_src, "customer_id"))

    # 3. dimensions: product SCD2 -> supplier prices -> category rules; customer SCD2.  Only open versions are read and
    #    written; a job of another region that commits meanwhile is merged upon, not overwritten
    store.merge_dimension(spark, wh.dim_product, _product_merge(src, load_date, bid))
    store.merge_dimension(spark, wh.dim_customer, _customer_merge(store.read_snapshot(spark, wh.stg_customer), load_date, region, bid))
    dp, dc = store.read_snapshot(spark, wh.dim_product), store.read_snapshot(spark, wh.dim_customer)
    ds = store.read_snapshot(spark, wh.dim_store)

    # 4. fact load of the slice's PENDING rows (I9); keys hold the batch number in their high bits (I8).  Facts that an
    #    unfinished attempt of this batch has written are read by their partition only
    staging = store.read_table(spark, wh.stg_sales)
    day = freeze(staging.where(store.slice_predicate("transaction_date", load_date, region)))
    pend = freeze(day.where(F.col("etl_status") == S.PENDING))
    start = store.first_key(bid)
    existing = store.read_table(spark, wh.fact_daily_sales)
    if existing is not None:
        start = next_key(existing.where((F.col("transaction_date") == F.lit(load_date)) & (F.col("load_batch_id") == bid)),
                         "fact_sales_key", start)
    heavy = joins.heavy_dimension_keys(day)
    loaded = pipeline.load_facts(pend, dp, dc, ds, start, heavy)
    facts = ingest.apply_defaults(loaded.fact, "fact").withColumn("load_batch_id", F.lit(bid).cast("bigint"))
    store.append_fact(facts, wh.fact_daily_sales, frozen=True)
    staged_rows = pend.count()
    fact_rows = _observed(loaded.fact_rows, staged_rows,
                          lambda: spark.read.parquet(wh.fact_daily_sales).where(
                              (F.col("transaction_date") == F.lit(load_date)) & (F.col("load_batch_id") == bid)).count())

    # 5. the graph's outputs of whole slices, from every staged row of them: rejects, unmatched products,
    #    category rollup and its form for the summary table
    out = pipeline.slice_outputs(day, dp, run_ts, heavy)
    rejects = freeze(out.rejects)
    store.write_delimited(rejects, wh.errors + "/rejected", covers=store.slice_predicate("transaction_date", load_date, region))
    store.write_delimited(out.unmatched, wh.errors + "/unmatched_product",
                          covers=store.slice_predicate("transaction_date", load_date, region))
    summary_slices = store.slice_predicate("summary_date", load_date, region)
    rollup = freeze(out.rollup)
    store.replace_packed(rollup, wh.category_rollup, "summary_date", summary_slices)
    store.replace_packed(rollups.summary_column_mapping(rollup), wh.category_summary, "summary_date", summary_slices)

    # 6. status flip of the whole slice, also rows the dimension joins dropped (I4)
    store.write_slices(scd.mark_loaded(day, bid, load_date, region), wh.stg_sales)

    # 7. regional summary of the slices, merged from the states of every batch (D1, A13): facts of earlier batches are not read
    fact_tbl = store.read_table(spark, wh.fact_daily_sales).where(store.slice_predicate("transaction_date", load_date, region))
    of_batch = facts if start == store.first_key(bid) else fact_tbl.where(F.col("load_batch_id") == bid)
    states.write_states(of_batch, wh.summary_states, "load_batch_id")
    store.refresh_summary(states.stored_summary(facts, wh.summary_states, summary_slices), wh.regional_summary, summary_slices)

    # 8. audit of the run: rollup rows (A10), constraint violations of the slice (I12), the ratio to the day before
    audit = quality.audit_counts(rollup).select(
        F.lit("ROLLUP_ROWS").alias("audit"), "region_code", F.lit(None).cast("string").alias("subject"),
        F.col("rollup_rows").alias("value"))
    broken = quality.constraint_audit({"stg_sales": (day, "transaction_id")})
    audit = audit.unionByName(broken.select(
        F.concat(F.lit("VIOLATION_"), "constraint_type").alias("audit"), F.lit(None).cast("string").alias("region_code"),
        F.col("column_name").alias("subject"), F.col("violation_rows").alias("value")))
    two_days = store.read_packed(spark, wh.regional_summary).where(
        F.col("summary_date").between(F.lit(load_date - _dt.timedelta(days=1)), F.lit(load_date)))
    counts = two_days.select("region_code", F.col("summary_date").alias("transaction_date"), F.col("total_transactions").alias("row_count"))
    gate = freeze(quality.ratio_gate(counts).where(F.col("transaction_date") == F.lit(load_date)))
    audit = audit.unionByName(gate.where("gate_passed = 'N'").select(
        F.lit("DAY_GATE_FAILED").alias("audit"), "region_code", F.lit(None).cast("string").alias("subject"),
        F.col("row_count").alias("value")))
    store.write_slices(audit.withColumn("run_date", F.lit(run_ts.date())).withColumn("load_batch_id", F.lit(bid).cast("bigint")),
                       wh.audit, ("load_batch_id",))

    # 9. data quality of the day (J), a slice per batch
    rules_df = src.dq_rules if src.dq_rules is not None else quality.rules_frame(spark, quality.BUILTIN_RULES)
    dq = freeze(quality.run_checks(quality.load_rules(rules_df, "RETAIL"),
                                   {"FACT_DAILY_SALES": fact_tbl, "FACT_REGIONAL_SUMMARY": store.read_packed(spark, wh.regional_summary)},
                                   {"FACT_DAILY_SALES": "transaction_date", "FACT_REGIONAL_SUMMARY": "summary_date"},
                                   load_date=load_date))
    store.write_dq_results(dq, wh.dq_results, run_ts.date(), bid)
    store.close_batch(spark, wh.batches, bid, fact_rows)
    return {"batch_id": bid, "staged_rows": staged_rows, "fact_rows": fact_rows,
            "rejected_rows": rejects.count(), "duplicate_rows": doubles.count(),
            "dropped_rows": staged_rows - fact_rows,
            "below_minimum": staged_rows < S.MIN_ROWS_PER_SLICE,
            "day_gate_failures": gate.where("gate_passed = 'N'").count(),
            "critical_dq_failures": quality.dq_gate(dq, fail_on_critical)}


def run_analytics(spark: SparkSession, wh: Warehouse, load_date: _dt.date,
                  ytd_by_year: bool = False) -> dict:
    """The analytical job (A11, D4-D6, E1-E5, B16, B17): rankings of the load
    month, customer segments with year-to-date spend, and the daily summary
    over the year to date (so running revenue and the previous-day delta have
    history to work on -- defect 10).  Exits without writing when the load
    date has no facts (D8)."""
    year_start = _dt.date(load_date.year, 1, 1)
    fact = spark.read.parquet(wh.fact_daily_sales)
    today = fact.where(F.col("transaction_date") == F.lit(load_date))
    if today.isEmpty():
        return {"skipped": True, "reason": "no fact rows for the load date"}
    ytd_fact = fact.where((F.col("transaction_date") >= F.lit(year_start))
                          & (F.col("transaction_date") <= F.lit(load_date)))
    month = ytd_fact.where(F.month("transaction_date") == load_date.month)
    dc = store.read_snapshot(spark, wh.dim_customer)
    ytd = joins.ytd_spend(ytd_fact, dc, load_date.year)
    segments = rollups.customer_segments(store.read_snapshot(spark, wh.stg_customer), ytd, load_date)
    store.write_analytics(rollups.product_rankings(month), segments,
                          rollups.daily_summary(ytd_fact, ytd_by_year=ytd_by_year), wh.analytics)
    return {"skipped": False}


def _observed(obs: Observation, staged_rows: int, recount) -> int:
    """Row count observed by a write.  A write over an empty slice runs no task
    and reports no metric; then the count is 0 (or recounted if unexpected)."""
    if staged_rows == 0:
        return 0
    try:
        return int(obs.get.get("n", 0) or 0)
    except Exception:  # noqa: BLE001 - metric missing: count the written rows instead
        return int(recount())

