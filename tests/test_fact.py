"""Fact load (I9, C1-C3, B7-B9) and the rows it drops (I4) on small frames."""

import datetime as dt
from decimal import Decimal

from saleslake.operators import fact as factop

D1 = dt.date(1998, 1, 1)
STAGED = ("transaction_id bigint, customer_id bigint, product_id bigint, store_id bigint, transaction_date date, "
          "quantity decimal(8,2), unit_price decimal(12,4), discount_amt decimal(12,4), region_code string, "
          "currency_code string, load_date date, load_batch_id bigint")


def _dim(spark, key, nat, rows):
    return spark.createDataFrame(rows, f"{key} bigint, {nat} bigint, is_current string")


def test_fact_inner_joins_product_and_customer_left_joins_store(spark):
    staged = spark.createDataFrame([
        (1, 10, 20, 30, D1, Decimal("2"), Decimal("5.0000"), Decimal("1.0000"), "ASIA", None, D1, 19980101),
        (2, 11, 20, 30, D1, Decimal("1"), Decimal("5.0000"), Decimal("0"), "ASIA", "GBP", D1, 19980101),  # no customer
        (3, 10, 21, 30, D1, Decimal("1"), Decimal("5.0000"), Decimal("0"), "ASIA", "GBP", D1, 19980101),  # closed product
        (4, 10, 20, 39, D1, Decimal("3"), Decimal("2.0000"), Decimal("0"), "ASIA", "GBP", D1, 19980101),  # no store
    ], STAGED)
    dp = _dim(spark, "dim_product_key", "product_id", [(200, 20, "Y"), (210, 21, "N")])
    dc = _dim(spark, "dim_customer_key", "customer_id", [(100, 10, "Y")])
    ds = _dim(spark, "dim_store_key", "store_id", [(300, 30, "Y")])
    facts = {r.fact_sales_key: r for r in factop.load_fact(staged, dp, dc, ds, key_start=5000).collect()}
    assert sorted(facts) == [5000, 5001]                                  # dense keys from the start value
    by_store = {r.dim_store_key: r for r in facts.values()}
    assert set(by_store) == {300, None}                                   # a missing store keeps the row
    r = by_store[300]
    assert (r.dim_product_key, r.dim_customer_key, r.gross_amount, r.net_amount, r.currency_code) == \
        (200, 100, Decimal("10.0000"), Decimal("9.0000"), "GBP")
    dropped = {r.transaction_id: r.drop_reason for r in factop.dropped_by_dims(staged, dp, dc, ds).collect()}
    assert dropped == {2: "NO_CURRENT_CUSTOMER", 3: "NO_CURRENT_PRODUCT"}


def test_sales_customers_and_customer_source(spark):
    """C6 + E6: buyers in the window with their latest purchase (region matched
    after trim and upper case); C7 + B19: trimmed, lower-cased e-mail, default
    loyalty tier when the profile is missing, only buyers are staged."""
    from saleslake.operators import joins
    from saleslake import schemas as S
    t0 = dt.datetime(1998, 1, 1, 9, 0)
    sales = spark.createDataFrame(
        [(1, t0, " asia "), (1, t0.replace(hour=18), "ASIA"), (2, t0, "EUROPE"), (3, t0 - dt.timedelta(days=1), "ASIA")],
        "cust_id bigint, txn_datetime timestamp_ntz, store_region_cd string")
    buyers = joins.sales_customers(sales, D1, D1, "ASIA")
    got = {r.cust_id: r.last_purchase_date for r in buyers.collect()}
    assert got == {1: t0.replace(hour=18)}
    assert {r.cust_id for r in joins.sales_customers(sales, None, D1).collect()} == {1, 2, 3}
    src = spark.createDataFrame(
        [(1, " C1 ", "Ann", "  ", " Ann@X.COM ", "07", "ASIA", D1), (2, "C2", "Bo", "Do", "b@x", "07", "EUROPE", D1)],
        "cust_id bigint, cust_ref_cd string, first_nm string, last_nm string, email_addr string, mobile_phone string, "
        "home_region_cd string, reg_date date")
    loyalty = spark.createDataFrame([], "cust_id bigint, tier_cd string, lifetime_spend decimal(14,2)")
    rows = joins.customer_source(src, loyalty, buyers, D1).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.customer_id, r.customer_code, r.last_name, r.email, r.loyalty_tier) == \
        (1, "C1", None, "ann@x.com", S.DEFAULT_LOYALTY_TIER)


def test_small_dimension_keys_are_sent_and_large_ones_joined(spark, monkeypatch):
    """A dimension that is counted small is sent, whatever its size is estimated at, so that the sales aren't shuffled; the
    rows are the same either way, with repeated and null keys."""
    from saleslake.operators import joins
    staged = spark.createDataFrame([(n, c, p, 30, D1, Decimal("2"), Decimal("5.0000"), Decimal("0"), "ASIA", None, D1, 19980101)
                                    for n, (c, p) in enumerate([(10, 20), (None, 20), (11, 20), (11, None), (12, 21)])], STAGED)
    dims = [_dim(spark, "dim_product_key", "product_id", [(200, 20, "Y"), (201, 20, "N"), (210, 21, "N"), (5, None, "Y")]),
            _dim(spark, "dim_customer_key", "customer_id", [(100, 10, "Y"), (110, 11, "Y"), (111, 11, "Y"), (6, None, "Y")]),
            _dim(spark, "dim_store_key", "store_id", [(300, 30, "Y")])]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan, rows = {}, {}
        for most in (joins.KEYS_SENT, 1):
            monkeypatch.setattr(joins, "KEYS_SENT", most)
            fact = factop.load_fact(staged, *[joins.sent_if_small(d) for d in dims])
            plan[most] = fact._jdf.queryExecution().executedPlan().toString()
            rows[most] = sorted(map(str, fact.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    small, large = plan.values()
    assert small.count("BroadcastHashJoin") == 3 and "hashpartitioning" not in small
    assert large.count("SortMergeJoin") == 2 and large.count("BroadcastHashJoin") == 1      # the store has one current version
    assert len(rows[1]) == 3 and len(set(map(tuple, rows.values()))) == 1


def test_keys_of_some_million_versions_are_sent(spark):
    """Customers of 360 x sf0.1 (4.9 million) were joined by a shuffle of all sales."""
    from saleslake.operators import joins
    for n, sent in ((5_000_000, True), (9_000_000, False)):
        dim = spark.range(n).selectExpr("id AS customer_id", "id AS dim_customer_key", "'Y' AS is_current")
        assert ("strategy=broadcast" in joins.sent_if_small(dim)._jdf.queryExecution().analyzed().toString()) is sent


def test_supplier_regions_are_sent_to_the_line_items(spark, tmp_dir, monkeypatch):
    """The lookup of the suppliers' regions doesn't shuffle the line items, whatever its size is estimated at; the rows
    are the same either way, with repeated and null keys."""
    from saleslake.operators import joins
    from saleslake.plans import fixtures as fx
    from saleslake.sources.tables import Tables
    day = dt.datetime(1998, 1, 1)
    rows = {"lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double",
                         [(1, 1, 1, 1, 2.0, 0.1), (1, 1, 2, 2, 3.0, 0.0), (2, 1, None, 1, 1.0, 0.0), (2, 2, 1, 7, 4.0, 0.05),
                          (2, 2, 9, 3, 5.0, 0.0), (None, 1, 1, 4, 1.0, 0.0)]),
            "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
                       [(1, 5, day, "HIGH"), (2, None, day, None)]),
            "part": ("p_partkey long, p_retailprice double", [(1, 10.0), (2, 20.0), (None, 1.0)]),
            "supplier": ("s_suppkey long, s_nationkey int", [(1, 1), (1, 1), (2, 2), (3, None), (None, 1)]),
            "nation": ("n_nationkey int, n_regionkey int", [(1, 1), (2, 2), (None, 1)]),
            "region": ("r_regionkey int, r_name string", [(1, "ASIA"), (2, "EUROPE"), (None, "NONE")])}
    for name, (schema, some) in rows.items():
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan, found = {}, {}
        for most in (joins.KEYS_SENT, 1):
            monkeypatch.setattr(joins, "KEYS_SENT", most)
            sales = fx.sales_txn(Tables(spark, tmp_dir))
            plan[most] = sales._jdf.queryExecution().executedPlan().toString()
            found[most] = sorted(map(str, sales.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sent, joined = plan.values()
    assert "hashpartitioning(l_suppkey" not in sent and "hashpartitioning(l_suppkey" in joined
    assert len(found[1]) == 5 and len(set(map(tuple, found.values()))) == 1
