"""Invariants on random frames (SURVEY §5 (3))."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslake.operators import clean, joins, rollups, scd

D1 = dt.date(1998, 1, 1)
HIGH = dt.date(9999, 12, 31)
DIM = ("dim_product_key bigint, product_id bigint, product_code string, product_name string, "
       "category_code string, subcategory_code string, supplier_id bigint, cost_price decimal(12,4), "
       "list_price decimal(12,4), valid_from date, valid_to date, is_current string, version_num int, "
       "tax_class_code string")
STG = ("product_id bigint, product_code string, product_name string, category_code string, "
       "subcategory_code string, supplier_id bigint, cost_price decimal(12,4), list_price decimal(12,4), "
       "tax_class_code string, is_active string, load_date date")
SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

names = st.sampled_from([None, "a", "b"])
prices = st.sampled_from([None, Decimal("1"), Decimal("2")])


@st.composite
def dims_and_stage(draw):
    keys = draw(st.lists(st.integers(1, 12), unique=True, max_size=10))
    dim, key = [], 1000
    for k in keys:
        n_closed = draw(st.integers(0, 2))
        start = dt.date(1990, 1, 1)
        for v in range(1, n_closed + 1):
            end = start + dt.timedelta(days=100)
            dim.append((key, k, f"P{k}", draw(names), "C", "S", 1, Decimal("1"), draw(prices), start, end, "N", v,
                        None))
            key, start = key + 1, end + dt.timedelta(days=1)
        if draw(st.booleans()):
            dim.append((key, k, f"P{k}", draw(names), "C", "S", 1, Decimal("1"), draw(prices), start, HIGH, "Y",
                        n_closed + 1, None))
            key += 1
    staged_keys = draw(st.lists(st.integers(1, 15), unique=True, max_size=10))
    stg = [(k, f"P{k}", draw(names), "C", "S", 1, Decimal("1"), draw(prices), None,
            draw(st.sampled_from(["Y", "Y", "N"])), D1) for k in staged_keys]
    return dim, stg


def check_dim(dim):
    rows = dim.collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.product_id, []).append(r)
    assert len({r.dim_product_key for r in rows}) == len(rows)
    for versions in by_key.values():
        assert sum(1 for r in versions if r.is_current == "Y") <= 1
        vs = sorted(r.version_num for r in versions)
        assert vs == list(range(1, len(vs) + 1))
        ordered = sorted(versions, key=lambda r: r.version_num)
        for a, b in zip(ordered, ordered[1:]):
            assert a.valid_to < b.valid_from
        assert all(r.valid_from <= r.valid_to for r in versions)
        if any(r.is_current == "Y" for r in versions):
            assert ordered[-1].is_current == "Y"


@SLOW
@given(dims_and_stage())
def test_scd2_invariants_and_rerun(spark, case):
    dim_rows, stg_rows = case
    dim = spark.createDataFrame(dim_rows, DIM)
    stg = spark.createDataFrame(stg_rows, STG)
    out = scd.load_dim_product(dim, stg, D1)
    out = spark.createDataFrame(out.collect(), out.schema)
    check_dim(out)
    active = {r[0] for r in stg_rows if r[9] == "Y"}
    cur = {r.product_id for r in out.where("is_current = 'Y'").collect()}
    assert active <= cur                                   # every active staged key is open afterwards
    assert out.count() >= dim.count()                      # history is never lost
    again = scd.load_dim_product(out, stg, D1)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, out.collect()), key=str)


rowvals = st.tuples(st.sampled_from([None, Decimal("-1"), Decimal("0"), Decimal("2")]),
                    st.sampled_from([None, Decimal("0"), Decimal("5")]),
                    st.sampled_from([None, 1, 2]),
                    st.sampled_from(["ASIA", "EUROPE"]),
                    st.sampled_from([D1, D1 + dt.timedelta(days=1)]))


@SLOW
@given(st.lists(rowvals, max_size=30))
def test_split_and_summary_totals(spark, rows):
    staged = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "transaction_id bigint, quantity decimal(8,2), unit_price decimal(12,4), product_id bigint, "
        "region_code string, transaction_date date")
    valid, reject = clean.split_valid(staged)
    ids_v = {r.transaction_id for r in valid.collect()}
    ids_r = {r.transaction_id for r in reject.collect()}
    assert ids_v | ids_r == set(range(len(rows))) and not (ids_v & ids_r)
    fact = (valid.withColumn("net_amount", F.col("quantity") * F.col("unit_price"))
            .withColumn("dim_customer_key", F.col("transaction_id")).withColumn("dim_product_key", F.col("product_id")))
    summ = rollups.regional_summary(fact)
    tot = summ.agg(F.sum("total_transactions").alias("n"), F.sum("total_revenue").alias("r")).first()
    ftot = fact.agg(F.count(F.lit(1)).alias("n"), F.sum("net_amount").alias("r")).first()
    assert (tot.n or 0) == ftot.n and tot.r == ftot.r
    assert summ.where(F.col("total_transactions") <= 0).count() == 0


ENRICHED = ("transaction_id bigint, customer_id bigint, product_id bigint, store_id bigint, transaction_date date, "
            "quantity decimal(8,2), unit_price decimal(12,4), discount_amt decimal(12,4), gross_amount decimal(20,6), "
            "net_amount decimal(20,6), region_code string, currency_code string, basket_tier string, "
            "fiscal_year int, fiscal_month int")


@SLOW
@given(st.lists(st.sampled_from([None, 1, 2, 3, 4]), max_size=25), dims_and_stage())
def test_product_join_matched_plus_unmatched_is_input(spark, pids, dim_stage):
    """The left join neither drops nor repeats a row (one current
    version per product), and its unmatched port is exactly the rows without a
    current product."""
    dim_rows, _ = dim_stage
    dim = spark.createDataFrame(dim_rows, DIM)
    enriched = spark.createDataFrame(
        [(i, 1, p, 1, D1, Decimal("1"), Decimal("1"), Decimal("0"), Decimal("1"), Decimal("1"), "ASIA", "GBP",
          "BASIC", 1998, 1) for i, p in enumerate(pids)], ENRICHED)
    current_ids = {r[1] for r in dim_rows if r[11] == "Y"}
    joined = joins.join_product_left(enriched, dim).collect()
    assert sorted(r.transaction_id for r in joined) == list(range(len(pids)))
    unmatched = {r.transaction_id for r in joins.unmatched_product(enriched, dim).collect()}
    assert unmatched == {i for i, p in enumerate(pids) if p not in current_ids}
    defaulted = {r.transaction_id for r in joined if r.product_code == "UNKNOWN"}
    assert defaulted == unmatched
