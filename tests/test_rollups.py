"""Analytical windows and shares (E3-E5) on small frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from saleslake.operators import rollups

FACT = ("region_code string, transaction_date date, fiscal_year int, fiscal_month int, dim_customer_key bigint, "
        "dim_product_key bigint, quantity decimal(8,2), net_amount decimal(16,4), discount_amt decimal(12,4)")


def _fact(spark, rows):
    return spark.createDataFrame(
        [(r, d, d.year, d.month, c, p, Decimal("1"), Decimal(str(a)), Decimal("0")) for r, d, c, p, a in rows], FACT)


def test_daily_windows_running_total_and_previous_day(spark):
    d1, d2, d4 = dt.date(1997, 12, 31), dt.date(1998, 1, 1), dt.date(1998, 1, 3)
    f = _fact(spark, [("ASIA", d1, 1, 1, 10), ("ASIA", d2, 1, 2, 5), ("ASIA", d2, 2, 2, 1),
                      ("ASIA", d4, 3, 3, 4), ("EUROPE", d2, 1, 1, 7)])
    got = {(r.region_code, r.transaction_date): r for r in rollups.daily_summary(f).collect()}
    asia = [got[("ASIA", d)] for d in (d1, d2, d4)]
    assert [float(r.running_revenue_ytd) for r in asia] == [10.0, 16.0, 20.0]
    # the previous row is the previous day *with sales* (d4 follows d2; no row for the gap day)
    assert [None if r.revenue_vs_prev_day is None else float(r.revenue_vs_prev_day) for r in asia] == \
        [None, -4.0, -2.0]
    assert (got[("ASIA", d2)].unique_customers, got[("ASIA", d2)].total_transactions) == (2, 2)
    assert got[("EUROPE", d2)].revenue_vs_prev_day is None          # windows never cross regions
    by_year = {(r.region_code, r.transaction_date): r
               for r in rollups.daily_summary(f, ytd_by_year=True).collect()}
    assert float(by_year[("ASIA", d2)].running_revenue_ytd) == 6.0   # the running sum restarts each year


def test_rank_shares_sum_to_100_per_region_month(spark):
    d = dt.date(1998, 1, 1)
    rows = [("ASIA", d, 1, p, a) for p, a in [(1, 50), (2, 30), (2, 10), (3, 40), (4, 0)]]
    rows += [("EUROPE", d, 1, 9, 12)]
    r = rollups.product_rankings(_fact(spark, rows))
    shares = r.groupBy("region_code").agg(F.sum("revenue_pct_share").alias("s")).collect()
    assert all(abs(x.s - 100.0) < 1e-9 for x in shares)
    asia = {x.dim_product_key: x for x in r.where("region_code = 'ASIA'").collect()}
    assert (asia[1].revenue_rank, asia[2].revenue_rank, asia[3].revenue_rank, asia[4].revenue_rank) == (1, 2, 2, 4)
    assert (asia[2].revenue_dense_rank, asia[4].revenue_dense_rank) == (2, 3)


def test_category_rollup_exact_distincts_and_average(spark):
    """D2 + D3: exact distinct counts per group (NULLs are not counted), the
    average is net over transactions."""
    cols = ("region_code string, transaction_date date, category_code string, fiscal_year int, fiscal_month int, "
            "customer_id bigint, product_id bigint, store_id bigint, quantity decimal(8,2), "
            "gross_amount decimal(20,6), net_amount decimal(20,6), discount_amt decimal(12,4)")
    d = dt.date(1998, 1, 1)
    rows = [("ASIA", d, "TOYS", 1998, 1, c, p, s, Decimal("1"), Decimal("10"), Decimal("9"), Decimal("1"))
            for c, p, s in [(1, 1, 1), (1, 2, 1), (2, 2, 1), (None, 3, 2)]]
    rows += [("ASIA", d, "FOOD", 1998, 1, 1, 9, 1, Decimal("2"), Decimal("4"), Decimal("4"), Decimal("0"))]
    got = {r.category_code: r for r in rollups.category_rollup(spark.createDataFrame(rows, cols)).collect()}
    toys = got["TOYS"]
    assert (toys.total_transactions, toys.distinct_customers, toys.distinct_products, toys.distinct_stores) == \
        (4, 2, 3, 2)
    assert (float(toys.total_net_revenue), float(toys.total_gross_revenue), toys.avg_basket_value) == (36.0, 40.0, 9.0)
    assert (got["FOOD"].distinct_customers, float(got["FOOD"].total_quantity)) == (1, 2.0)


def test_ytd_spend_sums_every_version_of_a_customer_within_the_year(spark):
    """C8 + D6: facts keyed to an old and the current version of one customer
    add up to that customer; rows outside the year do not count."""
    from saleslake.operators import joins
    fact = spark.createDataFrame(
        [(dt.date(1998, 1, 5), 100, Decimal("10")), (dt.date(1998, 3, 1), 101, Decimal("5")),
         (dt.date(1997, 12, 31), 101, Decimal("99")), (dt.date(1998, 2, 2), 200, Decimal("1"))],
        "transaction_date date, dim_customer_key bigint, net_amount decimal(16,4)")
    dim = spark.createDataFrame([(100, 1, "N"), (101, 1, "Y"), (200, 2, "Y")],
                                "dim_customer_key bigint, customer_id bigint, is_current string")
    got = {r.customer_id: (float(r.total_spend_ytd), r.txn_count_ytd)
           for r in joins.ytd_spend(fact, dim, 1998).collect()}
    assert got == {1: (15.0, 2), 2: (1.0, 1)}


def test_summary_mapping_audit_counts_and_cursor_suppliers(spark):
    """Summary columns (revenue is net, gross beside it); A10: rollup rows
    per region and day; D11: suppliers of current versions opened on the load
    date, each once, NULL suppliers left out."""
    from saleslake.operators import quality
    cols = ("region_code string, transaction_date date, category_code string, fiscal_year int, fiscal_month int, "
            "customer_id bigint, product_id bigint, store_id bigint, quantity decimal(8,2), "
            "gross_amount decimal(20,6), net_amount decimal(20,6), discount_amt decimal(12,4)")
    d = dt.date(1998, 1, 1)
    rows = [("ASIA", d, cat, 1998, 1, 1, 1, 1, Decimal("1"), Decimal("10"), Decimal("8"), Decimal("2"))
            for cat in ("TOYS", "FOOD")]
    roll = rollups.category_rollup(spark.createDataFrame(rows, cols))
    m = rollups.summary_column_mapping(roll)
    assert "total_discount_amount" not in m.columns and "distinct_stores" not in m.columns
    r = m.where("category_code = 'TOYS'").first()
    assert (float(r.total_revenue), float(r.gross_revenue), r.avg_basket_size) == (8.0, 10.0, 8.0)
    a = quality.audit_counts(roll).first()
    assert (a.region_code, a.summary_date, a.rollup_rows) == ("ASIA", d, 2)
    dim = spark.createDataFrame(
        [(1, 7, "Y", d), (2, 7, "Y", d), (3, 8, "N", d), (4, 9, "Y", dt.date(1997, 1, 1)), (5, None, "Y", d)],
        "product_id bigint, supplier_id bigint, is_current string, valid_from date")
    assert [x.supplier_id for x in rollups.distinct_suppliers(dim, d).collect()] == [7]


def test_customer_segments_and_dq_result_append(spark, tmp_dir):
    """Only customers staged within the staleness window, YTD spend beside
    them (NULL when none); B15: NVL; A14: DQ results are appended per run."""
    import os
    from saleslake import schemas as S
    from saleslake.functions import columns as C
    from saleslake.sources import store
    d = dt.date(1998, 1, 1)
    old = d - dt.timedelta(days=S.STALENESS_DAYS + 1)
    stg = spark.createDataFrame(
        [(1, "C1", "ASIA", "GOLD", Decimal("900"), d, d), (2, "C2", "ASIA", "STANDARD", Decimal("5"), d, d),
         (3, "C3", "ASIA", "GOLD", Decimal("900"), old, old)],
        "customer_id bigint, customer_code string, region_code string, loyalty_tier string, "
        "lifetime_value decimal(14,2), last_purchase_date date, load_date date")
    ytd = spark.createDataFrame([(1, Decimal("12.5"), 2)], "customer_id bigint, total_spend_ytd decimal(20,4), "
                                                         "txn_count_ytd bigint")
    seg = {r.customer_id: r for r in rollups.customer_segments(stg, ytd, d).collect()}
    assert sorted(seg) == [1, 2]
    assert (float(seg[1].total_spend_ytd), seg[2].total_spend_ytd) == (12.5, None)
    want = {r.customer_id: (r.s, r.c) for r in stg.select(
        "customer_id", C.value_segment("lifetime_value").alias("s"),
        C.churn_risk("last_purchase_date", d).alias("c")).collect()}
    assert all((seg[k].clv_segment, seg[k].churn_risk) == want[k] for k in seg)
    nv = spark.createDataFrame([(None,), (Decimal("3"),)], "x decimal(12,4)").select(
        C.nvl("x", F.lit(0).cast("decimal(12,4)")).alias("x")).collect()
    assert sorted(r.x for r in nv) == [Decimal("0"), Decimal("3")]
    path = os.path.join(tmp_dir, "dq")
    res = spark.createDataFrame([(1, "R")], "rule_id bigint, rule_name string")
    store.write_dq_results(res, path)
    store.write_dq_results(res, path)
    assert spark.read.parquet(path).count() == 2


def test_distinct_counts_copy_no_rows(spark):
    """No Expand in the plans; NULL keys are not counted, NULL groups are."""
    from saleslake.operators.states import grouped_with_distincts
    rows = [("A", 1, 1), ("A", 1, None), ("A", 2, None), (None, 5, 5), (None, 5, 6), ("B", None, None)]
    df = spark.createDataFrame(rows, "g string, x int, y int")
    got = grouped_with_distincts(df, ["g"], [F.count(F.lit(1)).alias("n"), F.sum("x").alias("s")], {"dx": "x", "dy": "y"})
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("A", 3, 4, 2, 1), (None, 2, 10, 1, 2), ("B", 1, None, 0, 0)], key=str)
    assert grouped_with_distincts(df.limit(0), ["g"], [F.count(F.lit(1)).alias("n")], {"dx": "x"}).count() == 0


def test_grouped_distincts_evaluate_their_input_once(spark):
    from saleslake.operators.states import grouped_with_distincts
    seen = spark.sparkContext.accumulator(0)

    def see(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    df = spark.range(100).selectExpr("id % 3 AS g", "id % 7 AS x").mapInPandas(see, "g bigint, x bigint")
    got = grouped_with_distincts(df, ["g"], [F.count(F.lit(1)).alias("n")], {"dx": "x", "dy": "x"}).collect()
    assert {(r.g, r.n, r.dx, r.dy) for r in got} == {(0, 34, 7, 7), (1, 33, 7, 7), (2, 33, 7, 7)}
    assert seen.value == 100


def test_named_columns_of_rules(spark):
    from saleslake.operators.quality import named_columns
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, ab int, d int")
    rule = lambda sql: {"sql_fragment": sql, "parent_key": None}
    assert named_columns(df, [rule("COUNT(*)"), rule("A > 0")], ("d",)) == ["a", "d"]
    assert named_columns(df, [rule("a * b > 0")]) == df.columns
