"""The checked queries: one function per check of SURVEY §2, each reading the
driver's tables through the fixtures and running the operators over whole
tables (every day and region of the data is its own slice of one batch).

Output convention shared with the DuckDB oracle: exact decimals are summed
first and leave as DOUBLE; counts, years, months, weeks and ranks are BIGINT;
dates stay DATE.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean, fact as factop, joins, quality, rollups, rules, scd
from ..operators.keys import stored
from ..session import scratch_path
from ..sources import ingest, store
from ..sources.tables import Tables
from . import fixtures as fx, pipeline

LOAD_DATE = fx.LOAD_DATE
RUN_TS = _dt.datetime(1998, 1, 2, 2, 0, 0)   # fixed run timestamp: reruns repeat exactly


def for_check(df: DataFrame) -> DataFrame:
    """Normalise output types: decimal -> double, small ints -> bigint."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- shared frames
def staged(t: Tables) -> DataFrame:
    return clean.extract_sales(fx.sales_txn(t))


def pending(t: Tables) -> DataFrame:
    return clean.pending(staged(t))


def enriched(t: Tables) -> DataFrame:
    valid, _ = clean.split_valid(pending(t))
    return clean.enrich_sales(valid)


def fact(t: Tables) -> DataFrame:
    return factop.load_fact(pending(t), fx.dim_product(t), fx.dim_customer(t), fx.dim_store(t))


def upserted_customers(t: Tables) -> DataFrame:
    buyers = joins.sales_customers(fx.sales_txn(t), None, LOAD_DATE)
    src = joins.customer_source(fx.src_customer(t), fx.loyalty_profile(t), buyers, LOAD_DATE)
    return scd.upsert(fx.stg_customer_prev(t), src, "customer_id")


def dim_product_after(t: Tables) -> DataFrame:
    return scd.load_dim_product(fx.dim_product(t), fx.stg_product(t), LOAD_DATE)


# ---------------------------------------------------------------- checks
def scan_txn_day_region(t: Tables) -> DataFrame:
    return clean.scan_transactions(fx.sales_txn(t))


def dim_product_current(t: Tables) -> DataFrame:
    return joins.product_lookup(fx.dim_product(t))


def extract_sales(t: Tables) -> DataFrame:
    return staged(t)


def valid_sales(t: Tables) -> DataFrame:
    return clean.split_valid(pending(t))[0]


def reject_sales(t: Tables) -> DataFrame:
    return clean.reject_records(clean.split_valid(pending(t))[1], RUN_TS)


def enrich_sales(t: Tables) -> DataFrame:
    return enriched(t)


def join_product_left(t: Tables) -> DataFrame:
    return joins.join_product_left(enriched(t), fx.dim_product(t), joins.heavy_dimension_keys(pending(t)))


def unmatched_product(t: Tables) -> DataFrame:
    return joins.unmatched_product(enriched(t), fx.dim_product(t))


def category_rollup(t: Tables) -> DataFrame:
    return rollups.category_rollup(joins.join_product_left(enriched(t), fx.dim_product(t)))


def summary_column_mapping(t: Tables) -> DataFrame:
    return rollups.summary_column_mapping(category_rollup(t))


def fact_load(t: Tables) -> DataFrame:
    rows = pending(t)
    return factop.load_fact(rows, fx.dim_product(t), fx.dim_customer(t), fx.dim_store(t), heavy=joins.heavy_dimension_keys(rows))


def dropped_by_dims(t: Tables) -> DataFrame:
    return factop.dropped_by_dims(pending(t), fx.dim_product(t), fx.dim_customer(t), fx.dim_store(t))


def surrogate_keys(t: Tables) -> DataFrame:
    return factop.assign_fact_keys(fact(t), 1000)


def regional_summary(t: Tables) -> DataFrame:
    return rollups.regional_summary(fact(t))


def product_rankings(t: Tables) -> DataFrame:
    return rollups.product_rankings(fact(t))


def daily_summary(t: Tables) -> DataFrame:
    return rollups.daily_summary(fact(t))


def customer_upsert(t: Tables) -> DataFrame:
    return upserted_customers(t)


def customer_ytd_spend(t: Tables) -> DataFrame:
    return joins.ytd_spend(fact(t), fx.dim_customer(t), LOAD_DATE.year)


def customer_segments(t: Tables) -> DataFrame:
    ytd = joins.ytd_spend(fact(t), fx.dim_customer(t), LOAD_DATE.year)
    return rollups.customer_segments(upserted_customers(t), ytd, LOAD_DATE)


def fiscal_parts(t: Tables) -> DataFrame:
    return rollups.fiscal_parts(staged(t))


def scd2_change_class(t: Tables) -> DataFrame:
    return scd.change_class(scd.staged_products(fx.stg_product(t), LOAD_DATE), fx.dim_product(t),
                            "product_id", scd.PRODUCT_TRACKED)


def scd2_product(t: Tables) -> DataFrame:
    return dim_product_after(t)


def scd2_customer(t: Tables) -> DataFrame:
    return scd.load_dim_customer(fx.dim_customer(t), fx.stg_customer(t), LOAD_DATE)


def purge_expired(t: Tables) -> DataFrame:
    return scd.purge_expired(fx.dim_product(t), LOAD_DATE)


def distinct_suppliers(t: Tables) -> DataFrame:
    return rollups.distinct_suppliers(dim_product_after(t), LOAD_DATE)


def category_rules(t: Tables) -> DataFrame:
    return rules.apply_category_rules(dim_product_after(t), fx.category_rules(t.spark), LOAD_DATE)


def supplier_enrich(t: Tables) -> DataFrame:
    return rules.enrich_from_suppliers(dim_product_after(t), fx.supplier_feed(t), LOAD_DATE)


def staging_metrics(t: Tables) -> DataFrame:
    return quality.staging_metrics(staged(t))


#: Minimum rows of a slice in the checks: the fixture's slices are small, and every branch of the gates must occur.
GATE_ROWS = 5


def row_count_gate(t: Tables) -> DataFrame:
    return quality.row_count_gate(pending(t), fact(t), GATE_ROWS)


def source_availability(t: Tables) -> DataFrame:
    return quality.source_availability(fx.sales_txn(t))


def day_ratio_gate(t: Tables) -> DataFrame:
    return quality.day_ratio_gate(fact(t), GATE_ROWS)


def audit_counts(t: Tables) -> DataFrame:
    return quality.audit_counts(category_rollup(t))


DQ_DATE_COLUMNS = {"FACT_DAILY_SALES": "transaction_date", "FACT_REGIONAL_SUMMARY": "summary_date"}


def _dq_tables(t: Tables, dq_rules: list[dict]) -> dict[str, DataFrame]:
    """The tables under check; the fact is made once, with the columns that the rules and the summary use."""
    dims = [joins.sent_if_small(dim) for dim in (fx.dim_product(t), fx.dim_customer(t), fx.dim_store(t))]
    f = factop.load_fact(pending(t), *dims)
    f = stored(f.select(*quality.named_columns(f, dq_rules, rollups.SUMMARY_COLUMNS)), "zstd")
    return {"FACT_DAILY_SALES": f, "FACT_REGIONAL_SUMMARY": rollups.regional_summary(f, is_stored=True),
            "DIM_PRODUCT": fx.dim_product(t), "DIM_STORE": fx.dim_store(t)}


def dq_results(t: Tables) -> DataFrame:
    dq_rules = quality.load_rules(quality.rules_frame(t.spark, fx.dq_rule_rows()), "RETAIL")
    return quality.run_checks(dq_rules, _dq_tables(t, dq_rules), DQ_DATE_COLUMNS)


def dq_referential(t: Tables) -> DataFrame:
    dq_rules = quality.load_rules(quality.rules_frame(t.spark, fx.dq_referential_rows()), "RETAIL")
    return quality.run_checks(dq_rules, _dq_tables(t, dq_rules), DQ_DATE_COLUMNS)


def dq_summary(t: Tables) -> DataFrame:
    return quality.dq_summary(dq_results(t))


def audit_pk(t: Tables) -> DataFrame:
    return quality.constraint_audit({
        "stg_sales": (staged(t), "transaction_id"),
        "dim_product": (dim_product_after(t), "dim_product_key"),
        "dim_customer": (scd2_customer(t), "dim_customer_key")})


def audit_fk(t: Tables) -> DataFrame:
    f, s = fact(t), staged(t)
    dp, dc, ds = fx.dim_product(t), fx.dim_customer(t), fx.dim_store(t)
    return quality.foreign_key_audit([
        ("fact_daily_sales", f, "dim_product_key", "dim_product", dp, "dim_product_key"),
        ("fact_daily_sales", f, "dim_customer_key", "dim_customer", dc, "dim_customer_key"),
        ("fact_daily_sales", f, "dim_store_key", "dim_store", ds, "dim_store_key"),
        ("stg_sales", s, "product_id", "dim_product", joins.current(dp), "product_id"),
        ("stg_sales", s, "customer_id", "dim_customer", joins.current(dc), "customer_id")])


def entry(t: Tables) -> DataFrame:
    run = pipeline.daily_load(staged=staged(t), stg_product=fx.stg_product(t), dim_product=fx.dim_product(t),
                     stg_customer=fx.stg_customer(t), dim_customer=fx.dim_customer(t),
                     dim_store=fx.dim_store(t), supplier_feed=fx.supplier_feed(t),
                     category_rules=fx.category_rules(t.spark), load_date=LOAD_DATE)
    return run.summary


# ---------------------------------------------------------------- sink round trips
def _schema_for(df: DataFrame, partition_by: tuple[str, ...]) -> T.StructType:
    data = [f for f in df.schema.fields if f.name not in partition_by]
    parts = [df.schema[c] for c in partition_by]
    return T.StructType(data + parts)


def _roundtrip_delimited(t: Tables, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(t.spark, name)
    store.write_delimited(df, path)
    return store.read_delimited(t.spark, path, _schema_for(df, ("transaction_date", "region_code")))


def reject_sink(t: Tables) -> DataFrame:
    """Rejects as '|' files per slice, read back."""
    return _roundtrip_delimited(t, reject_sales(t), "rejects")


def unmatched_sink(t: Tables) -> DataFrame:
    """Unmatched transactions as '|' files per slice, read back."""
    return _roundtrip_delimited(t, unmatched_product(t), "unmatched")


def fact_append(t: Tables) -> DataFrame:
    """The fact appended by slice (a rerun replaces slices: see tests)."""
    path = scratch_path(t.spark, "fact")
    f = fact(t)
    store.append_fact(f, path)
    return t.spark.read.schema(_schema_for(f, store.FACT_PARTITIONS)).parquet(path)


def analytical_outputs(t: Tables) -> DataFrame:
    """Rankings, segments and daily summary written and all three read back, stacked
    (``subject``: customer, product and month, or date)."""
    spark, base = t.spark, scratch_path(t.spark, "analytics")
    f = fact(t)
    f = stored(f.select(*rollups.DAILY_KEYS, "dim_product_key", "dim_customer_key", "net_amount", "quantity", "discount_amt"))
    segments = rollups.customer_segments(upserted_customers(t), joins.ytd_spend(f, fx.dim_customer(t), LOAD_DATE.year), LOAD_DATE)
    store.write_analytics(rollups.product_rankings(f), segments, rollups.daily_summary(f, is_stored=True), base)
    month = F.concat_ws("-", "dim_product_key", "fiscal_year", "fiscal_month")
    number = lambda c: F.col(c).cast("double").alias("value")
    segments = spark.read.parquet(f"{base}/customer_segments").select(
        F.lit("segments").alias("output"), "region_code", F.col("customer_id").cast("string").alias("subject"),
        F.concat_ws("/", "clv_segment", "churn_risk").alias("label"), F.lit(None).cast("double").alias("value"))
    rankings = spark.read.parquet(f"{base}/product_rankings").select(
        F.lit("rankings").alias("output"), "region_code", month.alias("subject"),
        F.concat_ws("/", "revenue_rank", "revenue_dense_rank").alias("label"), number("total_revenue"))
    daily = store.read_packed(spark, f"{base}/daily_summary").select(
        F.lit("daily").alias("output"), "region_code", F.col("transaction_date").cast("string").alias("subject"),
        F.concat_ws("/", "total_transactions", "unique_customers", "unique_products").alias("label"), number("running_revenue_ytd"))
    return segments.unionByName(rankings).unionByName(daily)


def staging_reload(t: Tables) -> DataFrame:
    """The extract loaded into slice-partitioned staging (reload of a slice
    with LOADED rows: see tests)."""
    path = scratch_path(t.spark, "staging")
    s = staged(t)
    store.reload_staging(t.spark, s, path)
    return t.spark.read.schema(_schema_for(s, ("transaction_date", "region_code"))).parquet(path)


def summary_refresh(t: Tables) -> DataFrame:
    """The regional summary refreshed by slice."""
    path = scratch_path(t.spark, "summary")
    r = regional_summary(t)
    store.refresh_summary(r, path)
    return store.read_packed(t.spark, path).select(*r.columns)


def dq_result_sink(t: Tables) -> DataFrame:
    """DQ results appended to the results table, read back."""
    path = scratch_path(t.spark, "dq_results")
    store.write_dq_results(dq_results(t), path, RUN_TS.date())
    return t.spark.read.parquet(path)


def _product_master_csv(t: Tables) -> tuple[str, ingest.CsvIngest]:
    """The product master written as CSV part files (one header each) under
    the shared scratch folder, then parsed by the A4 reader."""
    path = scratch_path(t.spark, "product_master")
    (fx.product_master_file(t).write.option("header", "true")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
    return path, ingest.parse_product_csv(t.spark, path, LOAD_DATE)


def product_master_csv(t: Tables) -> DataFrame:
    """A4: the good rows of the product master file (bad lines go to their own
    channel; the 50-row limit is reported by ``product_file_reconcile``)."""
    return _product_master_csv(t)[1].good


def product_file_reconcile(t: Tables) -> DataFrame:
    """A5: file lines against rows staged and rejected."""
    path, res = _product_master_csv(t)
    return ingest.reconciliation(t.spark, path, res)


def _incremental(t: Tables, summary: bool) -> DataFrame:
    """K1: staged rows arrive in two drops (before / from the load date) in a
    landing folder; each ``availableNow`` run consumes only new files and
    loads their facts per micro-batch; a third run finds nothing.  Returns the
    summary or the facts read back."""
    from ..streaming import incremental as inc
    spark = t.spark
    base = scratch_path(spark, "incremental")
    landing, ckpt, fact_path = f"{base}/landing", f"{base}/checkpoint", f"{base}/fact"
    s = staged(t)
    dp, dc, ds = fx.dim_product(t), fx.dim_customer(t), fx.dim_store(t)
    process = inc.fact_and_summary(fact_path, f"{base}/summary" if summary else None,
                                   lambda b: pipeline.load_facts(clean.pending(b), dp, dc, ds).fact)
    runs = []
    for drop in (s.where(F.col("transaction_date") < F.lit(LOAD_DATE)),
                 s.where(F.col("transaction_date") >= F.lit(LOAD_DATE))):
        drop.write.mode("append").parquet(landing)
        runs.append(inc.incremental_load(spark, landing, s.schema, ckpt, process))
    runs.append(inc.incremental_load(spark, landing, s.schema, ckpt, process))
    if runs != [1, 1, 0]:
        raise RuntimeError(f"incremental load consumed files more than once: batches per run {runs}")
    return store.read_packed(spark, f"{base}/summary") if summary else spark.read.parquet(fact_path).select(*factop.FACT_COLUMNS)


def incremental_load(t: Tables) -> DataFrame:
    """K1: the facts of the incremental load (they must equal the batch fact load)."""
    return _incremental(t, False)


def incremental_summary(t: Tables) -> DataFrame:
    """K1 + I10: the summary slices kept by the micro-batches."""
    return _incremental(t, True)


# ---------------------------------------------------------------- the store-backed job
def late() -> Column:
    """Whether a sale of the load date arrives after the day's first run (by key rule)."""
    return F.col("txn_id") % 5 == 2


def _daily_runs(t: Tables):
    """``run_daily`` of the load date three times: without its late rows, with
    them, and again unchanged.  The sources are the whole tables."""
    from . import run
    spark, sales = t.spark, fx.sales_txn(t)
    wh = run.Warehouse(scratch_path(spark, "warehouse"))
    run.bootstrap(spark, wh, dim_product=fx.dim_product(t), dim_customer=fx.dim_customer(t),
                  dim_store=fx.dim_store(t), stg_customer=fx.stg_customer_prev(t))
    of_day = F.col("txn_datetime").cast("date") == F.lit(LOAD_DATE)
    first = sales.where(~(of_day & late()))
    reports = []
    for sales_txn in (first, sales, sales):
        src = run.Sources(sales_txn, fx.src_customer(t), fx.loyalty_profile(t), fx.stg_product(t))
        reports.append(run.run_daily(spark, wh, src, LOAD_DATE, run_ts=RUN_TS))
    if any(r.get("skipped") for r in reports):
        return None
    if reports[2]["staged_rows"] or len({r["batch_id"] for r in reports}) != 3:
        raise RuntimeError(f"a rerun of an unchanged day must load nothing under its own id: {reports}")
    return wh


def daily_runs_fact(t: Tables) -> DataFrame:
    """I9 + A8 by the job: the facts of the load date after late rows and a rerun."""
    wh = _daily_runs(t)
    facts = fact(t).limit(0) if wh is None else t.spark.read.parquet(wh.fact_daily_sales)
    return facts.select(
        "transaction_date", "region_code", "quantity", "unit_price", "discount_amt", "gross_amount", "net_amount",
        "tax_amount", "fiscal_year", "fiscal_month", "fiscal_week", "currency_code", "load_date")


def daily_runs_slices(t: Tables) -> DataFrame:
    """D1, D2, A6, A7, A12 and I4 by the job: rows and totals of every output of the load date's slices."""
    spark, wh = t.spark, _daily_runs(t)
    if wh is None:
        return spark.createDataFrame([], "output string, region_code string, n_rows bigint, total double")
    n = F.count(F.lit(1)).cast("bigint").alias("n_rows")
    by = lambda df, name, total: df.groupBy("region_code").agg(n, F.sum(total).cast("double").alias("total")).select(
        F.lit(name).alias("output"), "region_code", "n_rows", "total")
    zero = F.lit(0).cast("double")
    errors = lambda name: spark.read.schema("transaction_id string, transaction_date date, region_code string").option(
        "sep", "|").csv(f"{wh.errors}/{name}")
    staged_rows = spark.read.parquet(wh.stg_sales)
    parts = [by(spark.read.parquet(wh.regional_summary), "summary", F.col("total_revenue")),
             by(spark.read.parquet(wh.category_rollup), "rollup", F.col("total_net_revenue")),
             by(spark.read.parquet(wh.category_summary), "category_summary", F.col("total_transactions")),
             by(staged_rows.where("etl_status = 'LOADED'"), "staging", F.col("quantity")),
             by(errors("rejected"), "rejected", zero), by(errors("unmatched_product"), "unmatched", zero)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def region_routed(t: Tables) -> DataFrame:
    """Each region's extract from its own table where it has one (two regions), else from the shared table."""
    spark, sales = t.spark, fx.sales_txn(t)
    own = {r: f"saleslake_a16_sales_{r.lower()}" for r in PARALLEL}
    for region, name in own.items():
        sales.where(clean.in_region(region)).createOrReplaceTempView(name)
    from .run import Sources
    src = Sources(sales, None, None, None, region_tables="saleslake_a16_sales_{region}")
    out = None
    for region in ("ASIA", "EUROPE", "AFRICA"):
        rows = clean.extract_sales(src.sales(region), None, region).groupBy("region_code", "transaction_date").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity"))
        rows = rows.withColumn("own_table", F.lit("Y" if region in own else "N"))
        out = rows if out is None else out.unionByName(rows)
    return out


def column_defaults(t: Tables) -> DataFrame:
    """Declared defaults on rows whose columns are NULL in the source."""
    raw = fx.sales_txn(t).select(F.col("txn_id").alias("transaction_id"), F.col("disc_amount").alias("discount_amt"),
                                 F.nullif(F.trim("currency"), F.lit("")).alias("currency_code"),
                                 F.lit(None).cast("string").alias("etl_status"))
    return ingest.apply_defaults(raw, "stg_sales")


#: Regions whose jobs run at the same time.
PARALLEL = ("ASIA", "EUROPE")


def parallel_regions(t: Tables) -> DataFrame:
    """I8 + I9 + I10: the jobs of two regions for the load date run at the same time on one warehouse.  Facts and different
    surrogate keys of each region."""
    from concurrent.futures import ThreadPoolExecutor

    from . import run
    spark = t.spark
    wh = run.Warehouse(scratch_path(spark, "parallel"))
    run.bootstrap(spark, wh, dim_product=fx.dim_product(t), dim_customer=fx.dim_customer(t),
                  dim_store=fx.dim_store(t), stg_customer=upserted_customers(t))
    src = run.Sources(fx.sales_txn(t), fx.src_customer(t), fx.loyalty_profile(t), fx.stg_product(t))
    with ThreadPoolExecutor(len(PARALLEL)) as pool:
        list(pool.map(lambda region: run.run_daily(spark, wh, src, LOAD_DATE, region, run_ts=RUN_TS), PARALLEL))
    n = lambda c, name: F.coalesce(c, F.lit(0)).cast("bigint").alias(name)
    facts = store.read_table(spark, wh.fact_daily_sales)
    keys = facts.groupBy("fact_sales_key").agg(F.min("region_code").alias("region_code"), F.count(F.lit(1)).alias("n"))
    return keys.groupBy("region_code").agg(n(F.sum("n"), "n_rows"), n(F.count(F.lit(1)), "n_keys"))


def emptied_slice(t: Tables) -> DataFrame:
    """A12, A13, A6 by the store: the load date's slices are written, then again
    for a source in which one region's sales are void; its old rows are gone."""
    spark, base = t.spark, scratch_path(t.spark, "emptied")
    day = stored(staged(t).where(F.col("transaction_date") == F.lit(LOAD_DATE)))
    for rows in (day, day.where("region_code <> 'ASIA'")):
        store.reload_staging(spark, rows, f"{base}/staging", LOAD_DATE)
        store.refresh_summary(rollups.regional_summary(factop.load_fact(rows, fx.dim_product(t), fx.dim_customer(t), fx.dim_store(t))),
                              f"{base}/summary", store.slice_predicate("summary_date", LOAD_DATE, None))
        store.write_delimited(clean.reject_records(clean.split_valid(rows)[1], RUN_TS), f"{base}/rejected",
                              covers=store.slice_predicate("transaction_date", LOAD_DATE, None))
    n = F.count(F.lit(1)).cast("bigint").alias("n_rows")
    count = lambda df, name: df.groupBy("region_code").agg(n).select(F.lit(name).alias("output"), "region_code", "n_rows")
    slim = "transaction_id string, transaction_date date, region_code string"
    rejected = (spark.read.schema(slim).option("sep", "|").csv(f"{base}/rejected") if store.path_exists(spark, f"{base}/rejected")
                else spark.createDataFrame([], slim))
    left = [store.read_table(spark, f"{base}/{name}") for name in ("staging", "summary")]
    staging, summary = (rejected.limit(0) if df is None else df for df in left)
    return count(staging, "staging").unionByName(count(summary, "summary")).unionByName(count(rejected, "rejected"))


CHECKS = {
    "scan_txn_day_region": scan_txn_day_region,
    "dim_product_current": dim_product_current,
    "extract_sales": extract_sales,
    "valid_sales": valid_sales,
    "reject_sales": reject_sales,
    "enrich_sales": enrich_sales,
    "join_product_left": join_product_left,
    "unmatched_product": unmatched_product,
    "category_rollup": category_rollup,
    "summary_column_mapping": summary_column_mapping,
    "fact_load": fact_load,
    "dropped_by_dims": dropped_by_dims,
    "surrogate_keys": surrogate_keys,
    "regional_summary": regional_summary,
    "product_rankings": product_rankings,
    "daily_summary": daily_summary,
    "customer_upsert": customer_upsert,
    "customer_ytd_spend": customer_ytd_spend,
    "customer_segments": customer_segments,
    "fiscal_parts": fiscal_parts,
    "scd2_change_class": scd2_change_class,
    "scd2_product": scd2_product,
    "scd2_customer": scd2_customer,
    "purge_expired": purge_expired,
    "distinct_suppliers": distinct_suppliers,
    "category_rules": category_rules,
    "supplier_enrich": supplier_enrich,
    "staging_metrics": staging_metrics,
    "row_count_gate": row_count_gate,
    "day_ratio_gate": day_ratio_gate,
    "audit_counts": audit_counts,
    "dq_results": dq_results,
    "dq_referential": dq_referential,
    "dq_summary": dq_summary,
    "audit_pk": audit_pk,
    "audit_fk": audit_fk,
    "entry": entry,
    "product_master_csv": product_master_csv,
    "product_file_reconcile": product_file_reconcile,
    "reject_sink": reject_sink,
    "unmatched_sink": unmatched_sink,
    "fact_append": fact_append,
    "analytical_outputs": analytical_outputs,
    "staging_reload": staging_reload,
    "summary_refresh": summary_refresh,
    "dq_result_sink": dq_result_sink,
    "incremental_load": incremental_load,
    "incremental_summary": incremental_summary,
    "daily_runs_fact": daily_runs_fact,
    "daily_runs_slices": daily_runs_slices,
    "emptied_slice": emptied_slice,
    "parallel_regions": parallel_regions,
    "region_routed": region_routed,
    "column_defaults": column_defaults,
    "source_availability": source_availability,
}


def run_check(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_check(CHECKS[name](Tables(spark, sf_dir)))
