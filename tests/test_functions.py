import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from saleslake.functions import columns as C


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


def test_discount_pct_per_unit_and_zero_price(spark):
    s = "d decimal(12,4), p decimal(12,4)"
    assert one(spark, C.discount_pct("d", "p"), s, (Decimal("45.6170"), Decimal("912.3400"))) == Decimal("5.00")
    assert one(spark, C.discount_pct("d", "p"), s, (Decimal("1"), Decimal("0"))) == Decimal("0.00")
    assert one(spark, C.discount_pct("d", "p"), s, (None, Decimal("10"))) == Decimal("0.00")
    # half rounds away from zero: 1/8 = 12.5%
    assert one(spark, C.discount_pct("d", "p"), s, (Decimal("0.0125"), Decimal("0.1000"))) == Decimal("12.50")


def test_full_name_keeps_stray_space(spark):
    s = "f string, l string"
    assert one(spark, C.full_name("f", "l"), s, ("Ann", None)) == "Ann "
    assert one(spark, C.full_name("f", "l"), s, (None, None)) == " "


def test_currency_label_and_basket_tier(spark):
    df = spark.createDataFrame([("USD", Decimal("501")), ("EUR", Decimal("100")), (None, Decimal("100.01")),
                                ("GBP", Decimal("0"))], "c string, g decimal(20,6)")
    got = df.select(C.relabel_currency("c").alias("c"), C.basket_tier(F.col("g")).alias("t")).collect()
    assert [(r.c, r.t) for r in got] == [("GBP", "PREMIUM"), ("GBP", "BASIC"), (None, "STANDARD"),
                                         ("GBP", "BASIC")]


def test_segments_and_churn(spark):
    df = spark.createDataFrame([(Decimal("5000.01"), dt.datetime(1997, 6, 1)), (None, None),
                                (Decimal("100"), dt.datetime(1997, 10, 1)),
                                (Decimal("1000.5"), dt.datetime(1997, 12, 31))],
                               "v decimal(14,2), lp timestamp_ntz")
    got = df.select(C.value_segment("v").alias("s"), C.churn_risk("lp", dt.date(1998, 1, 1)).alias("c")).collect()
    assert [(r.s, r.c) for r in got] == [("HIGH_VALUE", "HIGH"), ("PROSPECT", "UNKNOWN"),
                                         ("PROSPECT", "MEDIUM"), ("MID_VALUE", "LOW")]


def test_iso_week_at_year_end_and_quarter(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2021, 1, 3),), (dt.date(1998, 10, 1),)], "d date")
    got = df.select(C.fiscal_year("d").alias("y"), C.fiscal_week("d").alias("w"),
                    C.fiscal_quarter("d").alias("q")).collect()
    assert [(r.y, r.w, r.q) for r in got] == [(2024, 1, "Q4"), (2021, 53, "Q1"), (1998, 40, "Q4")]


def test_sentinel_vs_null_safe(spark):
    df = spark.createDataFrame([(None, "X"), (None, None), ("a", None)], "a string, b string")
    got = df.select(C.sentinel_differs(F.col("a"), F.col("b")).alias("s"),
                    C.null_safe_differs(F.col("a"), F.col("b")).alias("n")).collect()
    assert [(r.s, r.n) for r in got] == [(False, True), (False, False), (True, True)]


def test_tax_rounds_unrounded_net(spark):
    df = spark.createDataFrame([(Decimal("10.123456"),)], "n decimal(22,6)")
    assert df.select(C.tax_amount(F.col("n")).alias("t")).first().t == Decimal("2.0247")
