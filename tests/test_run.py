import datetime as dt

from pyspark.sql import functions as F

from saleslake.plans import fixtures as fx
from saleslake.plans.run import Sources, Warehouse, bootstrap, run_analytics, run_daily
from saleslake.sources import store
from saleslake.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def test_daily_run_is_idempotent(spark, tmp_dir):
    t = Tables(spark, SF)
    sales = fx.sales_txn(t)
    day = (sales.groupBy(F.col("txn_datetime").cast("date").alias("d")).count()
           .orderBy(F.desc("count"), "d").first()["d"])
    wh = Warehouse(tmp_dir)
    bootstrap(spark, wh, dim_product=fx.dim_product(t), dim_customer=fx.dim_customer(t),
              dim_store=fx.dim_store(t), stg_customer=fx.stg_customer_prev(t))
    src = Sources(sales, fx.src_customer(t), fx.loyalty_profile(t), fx.stg_product(t, day),
                  fx.supplier_feed(t), fx.category_rules(spark))
    first = run_daily(spark, wh, src, day)
    assert first["staged_rows"] > 0 and first["fact_rows"] > 0
    fact1 = sorted(map(tuple, spark.read.parquet(wh.fact_daily_sales).drop("fact_sales_key").collect()), key=str)
    summ1 = sorted(map(tuple, spark.read.parquet(wh.regional_summary).collect()), key=str)
    staging = spark.read.parquet(wh.stg_sales).where(F.col("transaction_date") == day)
    assert staging.where("etl_status <> 'LOADED'").count() == 0
    assert staging.count() == first["staged_rows"]
    # rerun of the same day: nothing is pending any more, nothing doubles
    second = run_daily(spark, wh, src, day)
    assert second["staged_rows"] == 0
    fact2 = sorted(map(tuple, spark.read.parquet(wh.fact_daily_sales).drop("fact_sales_key").collect()), key=str)
    summ2 = sorted(map(tuple, spark.read.parquet(wh.regional_summary).collect()), key=str)
    assert fact1 == fact2 and summ1 == summ2
    assert store.current_version(spark, wh.dim_product) == 3
    # fact keys are unique and hold the batch number in their high bits
    keys = spark.read.parquet(wh.fact_daily_sales).select("fact_sales_key")
    assert keys.distinct().count() == keys.count() and keys.agg(F.min("fact_sales_key")).first()[0] == store.first_key(first["batch_id"])
    # summary equals the fact it was built from
    tot = spark.read.parquet(wh.fact_daily_sales).agg(F.count(F.lit(1))).first()[0]
    assert spark.read.parquet(wh.regional_summary).agg(F.sum("total_transactions")).first()[0] == tot
    assert first["fact_rows"] + first["dropped_rows"] == first["staged_rows"]
    assert first["rejected_rows"] >= 0
    # analytics of the day, and the empty-day exit
    assert run_analytics(spark, wh, day) == {"skipped": False}
    seg = spark.read.parquet(wh.analytics + "/customer_segments")
    assert seg.columns == ["customer_id", "clv_segment", "churn_risk", "region_code"] and seg.count() > 0
    ranks = spark.read.parquet(wh.analytics + "/product_rankings")
    assert ranks.where("revenue_rank < 1").count() == 0 and ranks.count() > 0
    assert run_analytics(spark, wh, dt.date(1990, 1, 1))["skipped"] is True
    # pre-check: a day without source rows is a no-op
    assert run_daily(spark, wh, src, dt.date(1990, 1, 1))["skipped"] is True


def test_product_master_load_and_purge(spark, tmp_dir):
    import os
    from saleslake.plans.run import load_product_master, purge_dimension, staged_products_of
    wh = Warehouse(tmp_dir)
    p = os.path.join(tmp_dir, "product_master_19980101.csv")
    with open(p, "w") as fh:
        fh.write("product_id,product_code,product_name,category_code,subcategory_code,supplier_id,cost_price,"
                 "list_price,tax_class_code,weight_kg,is_active,effective_date,expiry_date\n"
                 "1,P1,Ball,TOYS,T1,3,1.5,2.5,,0.2,Y,1998-01-01,\n"
                 "2,P2,Bat,TOYS,T1,3,1.5,2.5,,0.2,Y,1998-01-01,\n"
                 "x,P3,Bad,TOYS,T1,3,1,2,,1,Y,1998-01-01,\n")
    d = dt.date(1998, 1, 1)
    rep = load_product_master(spark, wh, p, d)
    assert rep == {"file_rows": 3, "staged_rows": 2, "short": True, "bad_rows": 1}
    assert load_product_master(spark, wh, p, d)["staged_rows"] == 2          # rerun replaces the slice
    assert staged_products_of(spark, wh, d).count() == 2
    t = Tables(spark, SF)
    store.write_snapshot(spark, fx.dim_product(t), wh.dim_product)
    before = store.read_snapshot(spark, wh.dim_product).count()
    assert purge_dimension(spark, wh.dim_product, d) == 2
    after = store.read_snapshot(spark, wh.dim_product)
    assert after.where("is_current = 'N'").count() == 0 and after.count() < before


def test_late_rows_and_repeated_keys(spark, tmp_dir):
    """Late rows of a day are added, nothing is lost; a repeated staged key ends the dimension load."""
    import pytest
    from saleslake.operators import scd
    t = Tables(spark, SF)
    sales = fx.sales_txn(t)
    day = (sales.groupBy(F.col("txn_datetime").cast("date").alias("d")).count()
           .orderBy(F.desc("count"), "d").first()["d"])
    wh = Warehouse(tmp_dir)
    bootstrap(spark, wh, dim_product=fx.dim_product(t), dim_customer=fx.dim_customer(t),
              dim_store=fx.dim_store(t), stg_customer=fx.stg_customer_prev(t))
    late = (F.col("txn_datetime").cast("date") == F.lit(day)) & (F.col("txn_id") % 3 == 0)
    reports = [run_daily(spark, wh, Sources(s, fx.src_customer(t), fx.loyalty_profile(t), fx.stg_product(t, day)), day)
               for s in (sales.where(~late), sales)]
    assert reports[0]["batch_id"] != reports[1]["batch_id"] and reports[1]["staged_rows"] > 0
    total = sum(r["fact_rows"] for r in reports)
    assert spark.read.parquet(wh.fact_daily_sales).count() == total
    assert spark.read.parquet(wh.regional_summary).agg(F.sum("total_transactions")).first()[0] == total
    staged = spark.read.parquet(wh.stg_sales)
    assert staged.count() == sum(r["staged_rows"] for r in reports)
    rollup = spark.read.parquet(wh.category_rollup).agg(F.sum("total_transactions")).first()[0]
    assert rollup == staged.where("unit_price > 0 and product_id is not null").count()
    with pytest.raises(scd.RepeatedKey):
        twice = fx.stg_product(t, day).unionByName(fx.stg_product(t, day).where("product_id = 1"))
        scd.load_dim_product(fx.dim_product(t), twice, day)
