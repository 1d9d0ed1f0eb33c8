"""Exact distinct counts without copying rows, and summary states that merge.

``grouped_with_distincts`` makes the totals and each distinct count as aggregates of their own over the pruned columns and stacks
them, so no row is copied once per distinct column, and the pairs (group, key) are combined map-side.  The rows are stored first, so
that the joins they come from run once and not once per aggregate.

A state holds what a summary of one group and one load can be merged from: totals, and per counted key the set of its
values, a row each.  Sets merge by union, so the summary of a slice after several loads comes
from their states alone; no fact is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import store
from .keys import stored


def grouped_with_distincts(df: DataFrame, keys: list[Column | str], totals: list[Column], distinct: dict[str, str],
                           is_stored: bool = False) -> DataFrame:
    """``df.groupBy(keys).agg(totals..., countDistinct(column) AS name ...)``; ``distinct``: name -> column.

    ``keys`` must be named columns (aliases allowed); NULL keys are a group, NULL values are not counted.
    ``df`` should hold the columns needed and no more, as it is stored unless it ``is_stored`` already.
    """
    df = df if is_stored else stored(df)
    out = df.groupBy(*keys).agg(*totals)
    names = out.columns[:len(keys)]
    measures = out.columns[len(keys):]
    for name, column in distinct.items():
        pairs = df.select(*keys, F.col(column).alias("_key")).where(F.col("_key").isNotNull()).distinct()
        out = out.unionByName(pairs.groupBy(*names).agg(F.count(F.lit(1)).alias(name)), allowMissingColumns=True)
    # of each measure a group has one value, in the row it comes from
    return out.groupBy(*names).agg(*[F.max(m).alias(m) for m in measures],
                                   *[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in distinct])


#: Counted keys of the regional summary.
COUNTED = {"distinct_customers": "dim_customer_key", "distinct_products": "dim_product_key"}
SLICE = ("region_code", "summary_date")
TOTALS, KEYS = "totals", "keys"


def total_state(fact: DataFrame, load: str) -> DataFrame:
    """Per slice and load: rows, quantity, revenue."""
    return fact.groupBy("region_code", F.col("transaction_date").alias("summary_date"), load).agg(
        F.count(F.lit(1)).alias("total_transactions"), F.sum("quantity").alias("total_quantity"), F.sum("net_amount").alias("total_revenue"))


def key_state(fact: DataFrame, load: str, counted: dict[str, str] = COUNTED) -> DataFrame:
    """Per slice, load and counted key: the values that occur."""
    pairs = None
    for name, column in counted.items():
        one = fact.where(F.col(column).isNotNull()).select(
            "region_code", F.col("transaction_date").alias("summary_date"), load, F.lit(name).alias("counted"),
            F.col(column).cast("bigint").alias("value")).distinct()
        pairs = one if pairs is None else pairs.unionByName(one)
    return pairs


def summary_of(totals: DataFrame, keys: DataFrame, counted: dict[str, str] = COUNTED) -> DataFrame:
    """D1 from the states of all loads of some slices."""
    merged = totals.groupBy(*SLICE).agg(*[F.sum(m).alias(m) for m in ("total_transactions", "total_quantity", "total_revenue")])
    sets = (keys.select(*SLICE, "counted", "value").distinct()
            .groupBy(*SLICE).agg(*[F.count_if(F.col("counted") == name).alias(name) for name in counted]))
    stacked = merged.unionByName(sets, allowMissingColumns=True)
    measures = merged.columns[len(SLICE):]
    out = stacked.groupBy(*SLICE).agg(*[F.max(m).alias(m) for m in measures],
                                      *[F.coalesce(F.max(n), F.lit(0)).cast("bigint").alias(n) for n in counted])
    return out.where(F.col("total_transactions").isNotNull()).withColumn(
        "avg_basket_size", F.try_divide(F.col("total_revenue").cast("double"), F.col("total_transactions").cast("double")))


def write_states(fact: DataFrame, path: str, load: str) -> None:
    """The states of the loads in ``fact``, in a folder per load: a load that is repeated replaces its states."""
    store.write_slices(total_state(fact, load), f"{path}/{TOTALS}", (load,))
    store.write_slices(key_state(fact, load), f"{path}/{KEYS}", (load,))


def stored_summary(fact: DataFrame, path: str, covers: Column) -> DataFrame:
    """The summary of the slices that ``covers`` selects, from the states of all loads; ``fact`` (any rows) gives the types
    where nothing is stored."""
    spark = fact.sparkSession
    totals, keys = (store.read_table(spark, f"{path}/{name}") for name in (TOTALS, KEYS))
    load = "load_batch_id"
    totals = total_state(fact.limit(0), load) if totals is None else totals
    keys = key_state(fact.limit(0), load) if keys is None else keys
    return summary_of(totals.where(covers), keys.where(covers))


def merged_summary(fact: DataFrame, path: str) -> DataFrame:
    """The summary of the slices that ``fact`` touches, from the states of all loads.

    The states of other dates are skipped by their statistics, those of other slices by a semi join.
    """
    spark = fact.sparkSession
    touched = fact.select(F.col("region_code").alias("_r"), F.col("transaction_date").alias("_d")).distinct()
    first, last = fact.agg(F.min("transaction_date"), F.max("transaction_date")).first()
    of = lambda name: spark.read.parquet(f"{path}/{name}").where(F.col("summary_date").between(F.lit(first), F.lit(last)))
    here = [df.join(touched, df["region_code"].eqNullSafe(F.col("_r")) & (df["summary_date"] == F.col("_d")), "left_semi")
            for df in (of(TOTALS), of(KEYS))]
    return summary_of(*here)
