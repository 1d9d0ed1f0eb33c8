"""Heavy-hitter join: same rows as the plain join, NULL keys around it, heavy keys dealt over many tasks."""

import pytest
from pyspark.sql import functions as F

from saleslake.operators.skew import heavy_hitter_join, heavy_hitters


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def sides(spark):
    left = spark.range(6000).select(
        "id", F.expr("case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 400 end").alias("k"))
    right = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return left, right.unionByName(spark.createDataFrame([(None, 1), (7, 2)], "k long, v long"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_the_plain_join(sides, how):
    left, right = sides
    assert heavy_hitters(left, ["k"])
    assert _rows(heavy_hitter_join(left, right, ["k"], how)) == _rows(left.join(right, ["k"], how).select(
        *[c for c in ("id", "k", "v") if c != "v" or how in ("inner", "left")]))


def test_two_key_columns_and_no_heavy_key(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "b", 3)], "x int, y string, z int")
    right = spark.createDataFrame([(1, "a", 9), (2, None, 8)], "x int, y string, w int")
    assert _rows(heavy_hitter_join(left, right, ["x", "y"], "left")) == _rows(
        spark.createDataFrame([(1, "a", 1, 9), (1, None, 2, None), (2, "b", 3, None)], "x int, y string, z int, w int"))
    empty = left.where("x > 9")
    assert heavy_hitter_join(empty, right, ["x", "y"], "left").count() == 0


def test_a_key_with_a_third_of_all_rows_is_dealt_out(spark):
    """Without AQE no task holds over twice the median of the joined rows."""
    left = spark.range(120_000).select("id", F.expr("if(id % 3 = 0, 7, id % 5000)").alias("k"))
    right = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plain = left.join(right, "k")
        dealt = heavy_hitter_join(left, right, ["k"])
        most = {}
        for name, df in (("plain", plain), ("dealt", dealt)):
            n = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
            most[name] = n[-1] / n[len(n) // 2]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert most["dealt"] < 2 < most["plain"]
