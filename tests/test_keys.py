import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from saleslake.operators.keys import assign_dense_keys, distributed_rank


def test_dense_keys_follow_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(13)
    out = assign_dense_keys(df, "k", [F.col("v")], 1000)
    rows = out.collect()
    assert sorted(r.k for r in rows) == list(range(1000, 6000))
    assert all(r.k == 1000 + r.v for r in rows)


def test_distributed_rank_matches_window_with_ties_and_hot_group(spark):
    rnd = random.Random(7)
    data = [("hot", rnd.choice([None, 0, 0, 1, 2, 3, 5, 8])) for _ in range(3000)]
    data += [(f"g{i % 17}", rnd.randint(0, 40)) for i in range(2000)]
    data += [(None, rnd.randint(0, 5)) for _ in range(50)]          # a NULL group
    df = spark.createDataFrame(data, "g string, v int").repartition(9)
    got = distributed_rank(df, ["g"], "v", rank_col="r", dense_rank_col="dr")
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    want = df.select("g", "v", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("dr"))
    assert sorted(map(tuple, got.select("g", "v", "r", "dr").collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)


def test_dense_keys_in_place_are_unique_and_dense(spark):
    df = spark.range(0, 3000).repartition(7)
    rows = assign_dense_keys(df, "k", None, 50).collect()
    assert sorted(r.k for r in rows) == list(range(50, 3050))


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "g string, v int")
    assert distributed_rank(empty, ["g"], "v").count() == 0
    assert assign_dense_keys(empty, "k", [F.col("v")], 1).count() == 0
