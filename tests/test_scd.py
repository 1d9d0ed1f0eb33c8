import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from saleslake.operators import scd

D0, D1 = dt.date(1997, 1, 1), dt.date(1998, 1, 1)
HIGH = dt.date(9999, 12, 31)
DIM = ("dim_product_key bigint, product_id bigint, product_code string, product_name string, "
       "category_code string, subcategory_code string, supplier_id bigint, cost_price decimal(12,4), "
       "list_price decimal(12,4), valid_from date, valid_to date, is_current string, version_num int, "
       "tax_class_code string")
STG = ("product_id bigint, product_code string, product_name string, category_code string, "
       "subcategory_code string, supplier_id bigint, cost_price decimal(12,4), list_price decimal(12,4), "
       "tax_class_code string, is_active string, load_date date")


def dim_row(key, pid, name, price, vf=D0, vt=HIGH, cur="Y", ver=1):
    return (key, pid, f"P{pid}", name, "C", "S", 1, Decimal("1"), Decimal(price), vf, vt, cur, ver, None)


def stg_row(pid, name, price, active="Y"):
    return (pid, f"P{pid}", name, "C", "S", 1, Decimal("1"), Decimal(price), None, active, D1)


def test_new_changed_same_absent_and_inactive(spark):
    dim = spark.createDataFrame([dim_row(1000, 1, "a", "10"), dim_row(1001, 2, "b", "20"),
                                 dim_row(1002, 3, None, "30"), dim_row(1003, 4, "d", "40"),
                                 dim_row(999, 2, "old b", "5", vf=dt.date(1995, 1, 1), vt=dt.date(1996, 12, 31), cur="N", ver=1)], DIM)
    dim = dim.withColumn("version_num", F.when(F.col("product_id") == 2, F.when(F.col("is_current") == "Y", 2)
                                              .otherwise(1)).otherwise(F.col("version_num")))
    stg = spark.createDataFrame([stg_row(1, "a", "10"), stg_row(2, "b", "21"), stg_row(3, "X", "30"),
                                 stg_row(5, "e", "50"), stg_row(4, "changed but inactive", "1", "N")], STG)
    cls = {r.product_id: r.change_class for r in
           scd.change_class(scd.staged_products(stg, D1), dim, "product_id", scd.PRODUCT_TRACKED).collect()}
    # NULL name equals the sentinel 'X' (reference parity)
    assert cls == {1: "SAME", 2: "CHANGED", 3: "SAME", 5: "NEW"}
    out = scd.load_dim_product(dim, stg, D1)
    rows = {(r.product_id, r.version_num): r for r in out.collect()}
    assert rows[(2, 2)].is_current == "N" and rows[(2, 2)].valid_to == dt.date(1997, 12, 31)
    assert rows[(2, 3)].is_current == "Y" and rows[(2, 3)].list_price == Decimal("21.0000")
    assert rows[(5, 1)].is_current == "Y" and rows[(5, 1)].valid_from == D1
    assert rows[(4, 1)].is_current == "Y" and rows[(4, 1)].product_name == "d"   # inactive: left open
    new_keys = sorted(r.dim_product_key for r in out.collect() if r.valid_from == D1)
    assert new_keys == [1004, 1005]          # max(key) + 1, dense, in natural-key order
    _invariants(out)
    strict = scd.load_dim_product(dim, stg, D1, null_policy="null_safe")
    assert strict.where("product_id = 3 AND is_current = 'Y'").first().version_num == 2


def _invariants(dim):
    # one current row per key
    assert dim.where("is_current = 'Y'").groupBy("product_id").count().where("count > 1").count() == 0
    # versions 1..n gapless
    v = dim.groupBy("product_id").agg(F.max("version_num").alias("m"), F.count(F.lit(1)).alias("n"))
    assert v.where("m != n").count() == 0
    # intervals do not overlap and never end before they start
    w = Window.partitionBy("product_id").orderBy("version_num")
    nxt = dim.withColumn("next_from", F.lead("valid_from").over(w))
    assert nxt.where("next_from IS NOT NULL AND valid_to >= next_from").count() == 0
    assert dim.where("valid_to < valid_from").count() == 0
    # keys unique
    assert dim.select("dim_product_key").distinct().count() == dim.count()


def test_rerun_changes_nothing(spark):
    dim = spark.createDataFrame([dim_row(1000, 1, "a", "10"), dim_row(1001, 2, "b", "20")], DIM)
    stg = spark.createDataFrame([stg_row(1, "a", "11"), stg_row(3, "c", "3")], STG)
    once = scd.load_dim_product(dim, stg, D1)
    once = spark.createDataFrame(once.collect(), once.schema)
    twice = scd.load_dim_product(once, stg, D1)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_same_day_second_change_replaces_version(spark):
    dim = spark.createDataFrame([dim_row(1000, 1, "a", "10")], DIM)
    first = scd.load_dim_product(dim, spark.createDataFrame([stg_row(1, "a", "11")], STG), D1)
    first = spark.createDataFrame(first.collect(), first.schema)
    second = scd.load_dim_product(first, spark.createDataFrame([stg_row(1, "a", "12")], STG), D1)
    rows = sorted(second.collect(), key=lambda r: r.version_num)
    assert [(r.version_num, r.is_current, str(r.list_price)) for r in rows] == \
        [(1, "N", "10.0000"), (2, "Y", "12.0000")]
    first_key = first.where("is_current = 'Y'").first().dim_product_key
    assert rows[1].dim_product_key == first_key          # replaced in place: same key
    _invariants(second)


def test_customer_scd2_and_upsert(spark):
    dim = spark.createDataFrame(
        [(1000, 1, "C1", "Ann Lee", "a@x", "ASIA", "GOLD", D0, HIGH, "Y", 1)],
        "dim_customer_key bigint, customer_id bigint, customer_code string, full_name string, email string, "
        "region_code string, loyalty_tier string, valid_from date, valid_to date, is_current string, version_num int")
    stg = spark.createDataFrame(
        [(1, "C1", "Ann", "Lee", "a@x", "ASIA", "SILVER", D1), (2, "C2", "Bo", None, "b@x", "ASIA", "STANDARD", D1),
         (3, "C3", "Cy", "Do", "c@x", "EUROPE", "STANDARD", D1)],
        "customer_id bigint, customer_code string, first_name string, last_name string, email string, "
        "region_code string, loyalty_tier string, load_date date")
    out = scd.load_dim_customer(dim, stg, D1, region="ASIA")
    cur = {r.customer_id: r for r in out.where("is_current = 'Y'").collect()}
    assert cur[1].loyalty_tier == "SILVER" and cur[1].version_num == 2
    assert cur[2].full_name == "Bo " and 3 not in cur            # region filter
    tgt = stg.select("customer_id", "customer_code", "loyalty_tier", "load_date").where("customer_id < 3")
    src = spark.createDataFrame([(2, "NEW", "GOLD", D1), (9, "C9", "BRONZE", D1)], tgt.schema)
    up = {r.customer_id: r for r in scd.upsert(tgt, src, "customer_id",
                                               ("loyalty_tier", "load_date")).collect()}
    assert up[2].customer_code == "C2" and up[2].loyalty_tier == "GOLD"   # only update columns change
    assert up[9].customer_code == "C9" and up[1].loyalty_tier == "SILVER"


def test_mark_loaded_and_purge(spark):
    st = spark.createDataFrame([(1, D1, "ASIA", "PENDING", None), (2, D1, "EUROPE", "PENDING", None),
                                (3, D0, "ASIA", "LOADED", 5)],
                               "transaction_id bigint, transaction_date date, region_code string, "
                               "etl_status string, load_batch_id bigint")
    out = {r.transaction_id: r for r in scd.mark_loaded(st, 77, D1, "ASIA").collect()}
    assert (out[1].etl_status, out[1].load_batch_id) == ("LOADED", 77)
    assert out[2].etl_status == "PENDING" and out[3].load_batch_id == 5
    dim = spark.createDataFrame([dim_row(1, 1, "a", "1", vt=dt.date(1995, 12, 31), cur="N"),
                                 dim_row(2, 1, "a", "1", vt=dt.date(1996, 6, 1), cur="N", ver=2),
                                 dim_row(3, 1, "a", "1", ver=3)], DIM)
    kept = sorted(r.dim_product_key for r in scd.purge_expired(dim, D1, 730).collect())
    assert kept == [2, 3]


def test_audit_columns_filled_when_present(spark):
    dim = spark.createDataFrame([dim_row(1000, 1, "a", "10")], DIM).withColumn(
        "created_by", F.lit("INIT")).withColumn("created_date", F.lit(None).cast("timestamp")) \
        .withColumn("updated_by", F.lit(None).cast("string")).withColumn("updated_date", F.lit(None).cast("timestamp"))
    stg = spark.createDataFrame([stg_row(1, "a", "11"), stg_row(2, "b", "1")], STG)
    ts = dt.datetime(1998, 1, 2, 2, 0)
    out = scd.scd2_merge(dim, scd.staged_products(stg, D1), natural_key="product_id", key_col="dim_product_key",
                         tracked=scd.PRODUCT_TRACKED, attrs=scd.PRODUCT_ATTRS, load_date=D1, run_ts=ts)
    rows = {(r.product_id, r.version_num): r for r in out.collect()}
    assert (rows[(1, 1)].updated_by, rows[(1, 1)].updated_date, rows[(1, 1)].created_by) == ("ETL_PROCESS", ts, "INIT")
    assert (rows[(1, 2)].created_by, rows[(1, 2)].created_date, rows[(1, 2)].updated_by) == ("ETL_PROCESS", ts, None)
    assert rows[(2, 1)].created_by == "ETL_PROCESS"


def test_first_load_into_empty_dimension(spark):
    dim = spark.createDataFrame([], DIM)
    stg = spark.createDataFrame([stg_row(2, "b", "1"), stg_row(1, "a", "2")], STG)
    out = sorted(scd.load_dim_product(dim, stg, D1).collect(), key=lambda r: r.product_id)
    assert [(r.dim_product_key, r.product_id, r.version_num, r.is_current) for r in out] == \
        [(1000, 1, 1, "Y"), (1001, 2, 1, "Y")]


def test_null_current_flag_rows_are_kept(spark):
    dim = spark.createDataFrame([dim_row(1000, 1, "a", "10"), dim_row(999, 1, "z", "9", cur=None)], DIM)
    out = scd.load_dim_product(dim, spark.createDataFrame([stg_row(1, "a", "10")], STG), D1)
    assert sorted(r.dim_product_key for r in out.collect()) == [999, 1000]
