import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleslake.sources import ingest, store
from saleslake.streaming import incremental

D1, D2 = dt.date(1998, 1, 1), dt.date(1998, 1, 2)


def test_slice_writes_are_idempotent(spark, tmp_dir):
    f = spark.createDataFrame([(1, D1, "ASIA", 7), (2, D1, "EUROPE", 7), (3, D2, "ASIA", 7)],
                              "v bigint, transaction_date date, region_code string, load_batch_id bigint")
    path = os.path.join(tmp_dir, "fact")
    store.append_fact(f, path)
    store.append_fact(f.where("v = 1"), path)        # rerun of one slice of batch 7: nothing doubles
    late = spark.createDataFrame([(4, D1, "ASIA", 8)], f.schema)
    store.append_fact(late, path)                    # a later batch adds to the slice
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]


def test_delimited_error_files_replace_a_rerun_slice(spark, tmp_dir):
    """The first write creates the folder (plain append); a rerun of
    one slice replaces only that slice's file, other slices stay."""
    cols = "transaction_id bigint, reason string, transaction_date date, region_code string"
    path = os.path.join(tmp_dir, "rejected")
    first = spark.createDataFrame([(1, "INVALID_PRICE", D1, "ASIA"), (2, "INVALID_QUANTITY", D2, "ASIA")], cols)
    store.write_delimited(first, path)
    assert not store.table_exists(spark, os.path.join(tmp_dir, "nothing_here"))
    store.write_delimited(spark.createDataFrame([(3, "MISSING_PRODUCT", D1, "ASIA")], cols), path)
    back = store.read_delimited(spark, path, spark.createDataFrame([], "transaction_id bigint, reason string").schema)
    assert sorted((r.transaction_id, r.transaction_date) for r in back.collect()) == [(2, D2), (3, D1)]


def test_summary_refresh_replaces_only_touched_slices(spark, tmp_dir):
    """Delete + re-insert of a summary slice; untouched slices stay."""
    cols = "summary_date date, region_code string, total_transactions bigint"
    path = os.path.join(tmp_dir, "summary")
    store.refresh_summary(spark.createDataFrame([(D1, "ASIA", 5), (D1, "EUROPE", 7), (D2, "ASIA", 9)], cols), path)
    store.refresh_summary(spark.createDataFrame([(D1, "ASIA", 6)], cols), path)
    got = sorted((r.summary_date, r.region_code, r.total_transactions) for r in spark.read.parquet(path).collect())
    assert got == [(D1, "ASIA", 6), (D1, "EUROPE", 7), (D2, "ASIA", 9)]


def test_analytics_rerun_is_idempotent(spark, tmp_dir):
    """Rankings and daily summary are slice writes (a rerun replaces its
    slices), segments are overwritten whole with their four columns."""
    rk = "fiscal_year int, fiscal_month int, region_code string, dim_product_key bigint, revenue_rank bigint"
    sg = "customer_id bigint, clv_segment string, churn_risk string, region_code string, lifetime_value double"
    dl = "transaction_date date, region_code string, daily_revenue double"
    base = os.path.join(tmp_dir, "analytics")

    def run(ranks, segs, days):
        store.write_analytics(spark.createDataFrame(ranks, rk), spark.createDataFrame(segs, sg),
                              spark.createDataFrame(days, dl), base)

    run([(1998, 1, "ASIA", 10, 1), (1998, 2, "ASIA", 10, 1)], [(1, "HIGH_VALUE", "LOW", "ASIA", 9.0)],
        [(D1, "ASIA", 5.0), (D2, "ASIA", 6.0)])
    run([(1998, 1, "ASIA", 11, 1)], [(2, "LOW_VALUE", "HIGH", "ASIA", 1.0)], [(D1, "ASIA", 7.0)])
    ranks = sorted((r.fiscal_month, r.dim_product_key) for r in spark.read.parquet(f"{base}/product_rankings").collect())
    assert ranks == [(1, 11), (2, 10)]
    segs = spark.read.parquet(f"{base}/customer_segments")
    assert segs.columns == ["customer_id", "clv_segment", "churn_risk", "region_code"]
    assert [r.customer_id for r in segs.collect()] == [2]
    days = sorted((r.transaction_date, r.daily_revenue) for r in spark.read.parquet(f"{base}/daily_summary").collect())
    assert days == [(D1, 7.0), (D2, 6.0)]


def test_replace_slices_empties_what_it_covers(spark, tmp_dir):
    """A slice without new rows loses its old ones; slices outside stay."""
    cols = "summary_date date, region_code string, total_transactions bigint"
    path = os.path.join(tmp_dir, "summary")
    day = store.slice_predicate("summary_date", D1, None)
    store.refresh_summary(spark.createDataFrame([(D1, "A B%", 5), (D1, None, 7)], cols), path, day)
    store.refresh_summary(spark.createDataFrame([(D2, "ASIA", 9)], cols), path, store.slice_predicate("summary_date", D2, None))
    store.refresh_summary(spark.createDataFrame([(D1, None, 8)], cols), path, day)
    got = sorted(((str(r.summary_date), r.region_code, r.total_transactions) for r in spark.read.parquet(path).collect()), key=str)
    assert got == [("1998-01-01", None, 8), ("1998-01-02", "ASIA", 9)]
    store.refresh_summary(spark.createDataFrame([], cols), path, day)
    assert [r.total_transactions for r in spark.read.parquet(path).collect()] == [9]
    rejects = spark.createDataFrame([(1, "INVALID_PRICE", D1, "ASIA")], "transaction_id bigint, reason string, transaction_date date, region_code string")
    bad = os.path.join(tmp_dir, "rejected")
    covers = store.slice_predicate("transaction_date", D1, None)
    store.write_delimited(rejects, bad, covers=covers)
    assert store.read_delimited(spark, bad, rejects.select("transaction_id", "reason").schema).count() == 1
    store.write_delimited(rejects.limit(0), bad, covers=covers)
    assert store.read_delimited(spark, bad, rejects.schema).count() == 0


def test_unreadable_table_is_not_a_missing_one(spark, tmp_dir):
    assert store.read_table(spark, os.path.join(tmp_dir, "none")) is None
    broken = os.path.join(tmp_dir, "broken")
    os.makedirs(broken)
    with open(os.path.join(broken, "part-0.parquet"), "w") as fh:
        fh.write("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        store.table_exists(spark, broken)


def test_commits(spark, tmp_dir):
    t = os.path.join(tmp_dir, "dim")
    assert store.write_snapshot(spark, spark.range(3), t) == 1
    assert store.write_snapshot(spark, spark.range(3), t) == 1     # unchanged: no new version
    for n in range(2, 6):
        assert store.write_snapshot(spark, spark.range(n + 2), t) == n
    assert len([f for f in os.listdir(t) if f.startswith("v=")]) == store.KEPT_VERSIONS
    assert not store._create_record(spark, os.path.join(t, "_versions"), 5, {})   # another job's commit


def test_staging_reload_keeps_loaded_rows(spark, tmp_dir):
    cols = "transaction_id bigint, transaction_date date, region_code string, etl_status string"
    path = os.path.join(tmp_dir, "stg")
    store.reload_staging(spark, spark.createDataFrame([(1, D1, "ASIA", "LOADED"), (2, D1, "ASIA", "PENDING"),
                                                       (9, D2, "ASIA", "PENDING")], cols), path)
    store.reload_staging(spark, spark.createDataFrame([(1, D1, "ASIA", "PENDING"), (3, D1, "ASIA", "PENDING")],
                                                      cols), path)
    got = sorted((r.transaction_id, r.etl_status) for r in spark.read.parquet(path).collect())
    assert got == [(1, "LOADED"), (3, "PENDING"), (9, "PENDING")]


def test_snapshots(spark, tmp_dir):
    t = os.path.join(tmp_dir, "dim")
    assert store.write_snapshot(spark, spark.range(3), t) == 1
    v1 = store.read_snapshot(spark, t)
    assert store.write_snapshot(spark, v1.union(spark.range(3, 5)), t) == 2
    assert store.read_snapshot(spark, t).count() == 5


def _write_csv(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


HEADER = ("product_id,product_code,product_name,category_code,subcategory_code,supplier_id,cost_price,"
          "list_price,tax_class_code,weight_kg,is_active,effective_date,expiry_date")


def test_product_csv_enforces_the_staging_key(spark, tmp_dir):
    """A4: a repeated or missing product id goes to the bad channel."""
    p = os.path.join(tmp_dir, "product_master_19980101.csv")
    _write_csv(p, [HEADER, "1,P1,Ball,TOYS,T1,3,1.5,2.5,,0.2,Y,1998-01-01,", "1,P1,Ball again,TOYS,T1,3,1.5,2.5,,0.2,Y,1998-01-01,",
                   ",P9,None,TOYS,T1,3,1.5,2.5,,0.2,Y,1998-01-01,", "2,P2,Bat,TOYS,T1,3,1.5,2.5,,0.2,Y,1998-01-01,"])
    res = ingest.ingest_product_csv(spark, p, D1)
    assert (res.good_rows, res.bad_rows) == (2, 2)
    assert sorted((r.product_id, r.product_name) for r in res.good.collect()) == [(1, "Ball"), (2, "Bat")]
    assert any("Ball again" in r.raw_line for r in res.bad.collect())


def test_csv_ingest_bad_rows_and_reconcile(spark, tmp_dir):
    p = os.path.join(tmp_dir, "product_master_19980101.csv")
    _write_csv(p, [HEADER, "1,P1,Ball,TOYS,T1,3,1.5,2.5,,0.2,Y,1998-01-01,",
                   "2,P2,  ,TOYS,T1,3,1.5,2.5,,0.2,,1998-01-01,",
                   "x,P3,Bad id,TOYS,T1,3,1,2,,1,Y,1998-01-01,",
                   "4,P4,Short"])
    res = ingest.ingest_product_csv(spark, p, D1)
    assert (res.good_rows, res.bad_rows) == (2, 2)
    good = {r.product_id: r for r in res.good.collect()}
    assert good[2].product_name is None and good[2].is_active == "Y" and good[1].list_price == Decimal("2.5000")
    assert ingest.reconcile_file(spark, p, res.good_rows) == {"file_rows": 4, "staged_rows": 2, "short": True}
    with pytest.raises(ingest.TooManyRejectedRows):
        ingest.ingest_product_csv(spark, p, D1, max_rejected=1)


def test_reconciliation_over_part_files(spark, tmp_dir):
    """A folder of part files, one header each: only data lines count, and the
    reject limit is reported rather than raised."""
    d = os.path.join(tmp_dir, "product_master")
    os.makedirs(d)
    _write_csv(os.path.join(d, "part-0.csv"), [HEADER, "1,P1,Ball,TOYS,T1,3,1.5,2.5,,0.2,Y,1998-01-01,",
                                               "x,P2,Bad id,TOYS,T1,3,1,2,,1,Y,1998-01-01,"])
    _write_csv(os.path.join(d, "part-1.csv"), [HEADER, "3,P3,  Kite ,TOYS,T1,3,1.5,2.5,,0.2, ,1998-01-01,", ""])
    res = ingest.parse_product_csv(spark, d, D1)
    assert (res.good_rows, res.bad_rows) == (2, 1)
    kite = res.good.where("product_id = 3").first()
    assert (kite.product_name, kite.is_active) == ("Kite", "Y")
    r = ingest.reconciliation(spark, d, res, max_rejected=0).first()
    assert (r.file_rows, r.staged_rows, r.bad_rows, r.short_load, r.accepted) == (3, 2, 1, "Y", "N")
    assert ingest.reconcile_file(spark, d, res.good_rows)["file_rows"] == 3


def test_jdbc_options_region_table_defaults(spark):
    o = ingest.jdbc_options("jdbc:x", "SELECT 1", partition_column="id", lower_bound=1, upper_bound=9,
                            num_partitions=4)
    assert o["dbtable"] == "(SELECT 1) q" and o["fetchsize"] == "10000" and o["numPartitions"] == "4"
    with pytest.raises(ValueError):
        ingest.jdbc_options("jdbc:x", "SELECT 1", partition_column="id")
    spark.range(2).createOrReplaceTempView("stg_customer_sales")
    spark.range(5).createOrReplaceTempView("stg_customer_sales_north")
    assert ingest.region_table(spark, "NORTH", "stg_customer_sales_{region}", "stg_customer_sales").count() == 5
    assert ingest.region_table(spark, "WEST", "stg_customer_sales_{region}", "stg_customer_sales").count() == 2
    df = spark.createDataFrame([(None, None, "X")], "discount_amt decimal(12,4), currency_code string, etl_status string")
    r = ingest.apply_defaults(df, "stg_sales").first()
    assert (r.discount_amt, r.currency_code, r.etl_status) == (Decimal("0.0000"), "GBP", "X")


def test_incremental_load_consumes_each_file_once(spark, tmp_dir):
    landing, ckpt = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ckpt")
    fact_path, summ_path = os.path.join(tmp_dir, "fact"), os.path.join(tmp_dir, "summary")
    schema = "transaction_date date, region_code string, dim_customer_key bigint, dim_product_key bigint, " \
             "quantity decimal(8,2), net_amount decimal(16,4)"
    rows = [(D1, "ASIA", 1, 1, Decimal("1"), Decimal("10")), (D1, "ASIA", 2, 1, Decimal("2"), Decimal("5"))]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    st = spark.createDataFrame([], schema).schema
    process = incremental.fact_and_summary(fact_path, summ_path, lambda b: b)
    assert incremental.incremental_load(spark, landing, st, ckpt, process) == 1
    assert incremental.incremental_load(spark, landing, st, ckpt, process) == 0     # nothing new: no-op
    spark.createDataFrame([(D1, "ASIA", 3, 2, Decimal("1"), Decimal("1"))], schema).coalesce(1) \
        .write.mode("append").parquet(landing)
    assert incremental.incremental_load(spark, landing, st, ckpt, process) == 1
    s = spark.read.parquet(summ_path).first()
    assert (s.total_transactions, float(s.total_revenue), s.distinct_customers) == (3, 16.0, 3)


def test_a_load_reads_only_its_own_facts(spark, tmp_dir):
    """The summary of a date that got two drops is merged from states; facts of the first drop are not read again."""
    import shutil
    facts, summary = os.path.join(tmp_dir, "facts"), os.path.join(tmp_dir, "sums")
    schema = "transaction_date date, region_code string, dim_customer_key bigint, dim_product_key bigint, " \
             "quantity decimal(8,2), net_amount decimal(16,4)"
    process = incremental.fact_and_summary(facts, summary, lambda b: b)
    far = 5 << 40
    process(spark.createDataFrame([(D1, "ASIA", 1, None, Decimal(1), Decimal(2)), (D1, "ASIA", far, 7, Decimal(1), Decimal(2)),
                                   (D1, None, 1, 1, None, None)], schema), 0)
    shutil.rmtree(facts)                                            # what an earlier load wrote is gone
    second = spark.createDataFrame([(D1, "ASIA", far, 8, Decimal(1), Decimal(3)), (D1, "ASIA", 2, 7, Decimal(1), Decimal(3))], schema)
    for _ in range(2):                                              # a replayed epoch replaces its states
        process(second, 1)
    got = {r.region_code: (r.total_transactions, r.total_revenue, r.distinct_customers, r.distinct_products)
           for r in store.read_packed(spark, summary).collect()}
    assert got == {"ASIA": (4, Decimal(10), 3, 2), None: (1, None, 1, 1)}


def test_writer_tasks_follow_rows_and_slices(spark, tmp_dir):
    """The number of files of a slice and of tasks comes from the counts, not from the session's settings."""
    df = spark.range(4000).selectExpr("id", "if(id % 2 = 0, 0, id % 400) AS s")
    few = store.deal_to_writers(df, ("s",), rows_per_task=100_000, slices_per_task=64)
    assert few.rdd.getNumPartitions() == -(-201 // 64)
    parts_of = lambda df: {r.s: r.n for r in df.select("s", F.spark_partition_id().alias("p")).groupBy("s").agg(
        F.countDistinct("p").alias("n")).collect()}
    assert set(parts_of(few).values()) == {1}
    dealt = store.deal_to_writers(df, ("s",), rows_per_task=500, slices_per_task=64)
    assert dealt.rdd.getNumPartitions() == 8
    parts = parts_of(dealt)
    assert parts[0] > 1 and all(n == 1 for s, n in parts.items() if s)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, df.collect()))
    assert store.deal_to_writers(df.limit(0), ("s",)).count() == 0


def test_summary_months(spark, tmp_dir):
    """A table stored by region and month loses emptied slices, keeps the others, and reads like the rows written."""
    path, d2, d3 = os.path.join(tmp_dir, "packed"), dt.date(1998, 1, 2), dt.date(1998, 2, 1)
    rows = lambda *r: spark.createDataFrame(list(r), "summary_date date, region_code string, n int")
    read = lambda: sorted(map(tuple, store.read_packed(spark, path).select("summary_date", "region_code", "n").collect()), key=str)
    store.refresh_summary(rows((D1, "A", 1), (d2, "A", 2), (D1, "B", 3), (d3, "A", 4), (d3, None, 5)), path)
    store.refresh_summary(rows((D1, "A", 10)), path)
    assert read() == sorted([(D1, "A", 10), (d2, "A", 2), (D1, "B", 3), (d3, "A", 4), (d3, None, 5)], key=str)
    store.refresh_summary(rows((d3, None, 6)), path, store.slice_predicate("summary_date", d3, None))
    assert read() == sorted([(D1, "A", 10), (d2, "A", 2), (D1, "B", 3), (d3, None, 6)], key=str)
    store.refresh_summary(rows((D1, "A", 0)).limit(0), path, store.slice_predicate("summary_date", D1, "B"))
    assert read() == sorted([(D1, "A", 10), (d2, "A", 2), (d3, None, 6)], key=str)


def test_a_commit_names_the_version_it_was_computed_from(spark, tmp_dir):
    """Of two jobs that read one version, the second computes again and no rows are lost."""
    t = os.path.join(tmp_dir, "shared")
    store.write_snapshot(spark, spark.range(3), t)
    base = store.version_of(spark, t)
    mine = store.read_snapshot(spark, t, base).union(spark.range(10, 11))
    store.update_snapshot(spark, t, lambda rows: rows.union(spark.range(20, 21)))
    with pytest.raises(store.StaleVersion):
        store.write_snapshot(spark, mine, t, base)
    calls = []

    def add(rows):
        if not calls:                                               # another job commits in between
            store.write_snapshot(spark, store.read_snapshot(spark, t).union(spark.range(30, 31)), t)
        calls.append(1)
        return rows.union(spark.range(10, 11))
    store.update_snapshot(spark, t, add)
    assert len(calls) == 2
    assert sorted(r.id for r in store.read_snapshot(spark, t).collect()) == [0, 1, 2, 10, 20, 30]


DIM_SCHEMA = "k bigint, name string, valid_from date, valid_to date, is_current string"


def test_dimension_versions_share_closed_folders(spark, tmp_dir):
    """A merge reads open versions by a partition filter and writes what changed; a purge drops folders unread."""
    t, high = os.path.join(tmp_dir, "dim"), dt.date(9999, 12, 31)
    day = lambda n: dt.date(1998, 1, n)
    rows = lambda *r: spark.createDataFrame(list(r), DIM_SCHEMA)
    store.write_snapshot(spark, rows((1, "a", day(1), high, "Y"), (2, "b", day(1), high, "Y"), (9, "x", day(1), day(1), "N"),
                                     (8, "y", day(1), day(20), "N")), t)

    def change(current, history):
        plan = current._jdf.queryExecution().toString()
        assert "PartitionFilters: [coalesce((is_current" in plan or "PartitionFilters: [isnotnull(is_current" in plan
        closed = current.where("k = 1").withColumn("is_current", F.lit("N")).withColumn("valid_to", F.lit(day(9)))
        return current.where("k <> 1").union(rows((1, "a2", day(10), high, "Y"))), closed
    assert store.merge_dimension(spark, t, change) == 2
    before, v = store.version_of(spark, t), store.read_snapshot(spark, t)
    assert sorted((r.k, r.name, r.is_current) for r in v.collect()) == [
        (1, "a", "N"), (1, "a2", "Y"), (2, "b", "Y"), (8, "y", "N"), (9, "x", "N")]
    assert store.merge_dimension(spark, t, lambda c, h: (c, c.limit(0))) == 2          # nothing changed: no version
    assert store.purge_closed(spark, t, "1998-01-15") == 3
    after = store.version_of(spark, t)
    assert sorted(r.name for r in store.read_snapshot(spark, t).collect()) == ["a2", "b", "y"]
    untouched = {f["folder"] for f in before.folders if f["folder"].endswith("=Y")}
    assert untouched <= {f["folder"] for f in after.folders}
    assert store.purge_closed(spark, t, "1998-01-15") == 3


def test_a_running_batch_is_not_taken_over(spark, tmp_dir):
    """A second start for a day and region in work is refused; regions are independent."""
    root = os.path.join(tmp_dir, "runs")
    assert store.open_batch(spark, root, D1, "ASIA") == 1
    assert store.open_batch(spark, root, D1, "EUROPE") == 2
    for region in ("ASIA", None):
        with pytest.raises(store.BatchRunning):
            store.open_batch(spark, root, D1, region)
    store.close_batch(spark, root, 1, 5)
    assert store.open_batch(spark, root, D1, "ASIA") == 3
    assert store.first_key(2) - store.first_key(1) == 1 << 40


def test_appends_to_one_table_at_the_same_time(spark, tmp_dir):
    """The first writer to end leaves the uncommitted files of the others alone."""
    from concurrent.futures import ThreadPoolExecutor
    path = os.path.join(tmp_dir, "t")

    def write(k: int) -> None:
        for day in range(3):
            store.write_slices(spark.range(k * 100 + 20).select("id", F.lit(day).alias("d"), F.lit(f"r{k}").alias("r")), path, ("d", "r"))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write, range(6)))
    rows = {(r.d, r.r): r["count"] for r in spark.read.parquet(path).groupBy("d", "r").count().collect()}
    assert rows == {(d, f"r{k}"): k * 100 + 20 for d in range(3) for k in range(6)}
    assert not os.listdir(os.path.join(path, "_temporary"))


def test_jobs_that_begin_the_same_date_at_the_same_time_keep_their_files_apart(spark, tmp_dir):
    """F2 again: the committer moved a date's whole folder to where another job had just made that date's folder, hence into it."""
    from concurrent.futures import ThreadPoolExecutor
    regions = ("ASIA", "EUROPE", "AFRICA", "AMERICA")
    rows = {r: spark.range(1).selectExpr("DATE '1998-01-01' AS transaction_date", "id", f"'{r}' AS region_code") for r in regions}
    with ThreadPoolExecutor(len(regions)) as pool:
        for n in range(40):
            path = f"{tmp_dir}/{n}"
            list(pool.map(lambda r: store._append(rows[r], path, ("transaction_date", "region_code")), regions))
            assert sorted(os.listdir(f"{path}/transaction_date=1998-01-01")) == sorted(f"region_code={r}" for r in regions)
