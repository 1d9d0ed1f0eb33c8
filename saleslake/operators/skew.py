"""Equi-join that deals heavy keys over many tasks, whatever the planner does.

A shuffle join sends every row of a key to one task, so a customer, product or text that holds a third of the rows
makes one task do a third of the work.  ``heavy_hitter_join`` finds the heavy keys of the left side with one mergeable
sketch (``approx_top_k``: a few thousand counters a task, no shuffle of the keys), gives each left row of a heavy
key one of several salts, and repeats the right rows of that key once for each salt.  Rows whose key is
NULL can't match anything: they are dealt evenly too.

The sketch decides only how rows are dealt; the result is that of the plain join at any size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys whose salts are sent to the tasks at most; a key outside holds under 1/750 of the rows.
HEAVY_KEYS = 1000
#: Counters of the sketch.
TRACKED = 10_000
#: Each salt of a heavy key gets this part of a partition's fair share.
SHARE = 4

_HEAVY = T.StructType([T.StructField("_key", T.LongType()), T.StructField("_salts", T.IntegerType())])


#: (xxhash64 of a heavy key, None for NULL; the number of its salts)
Heavy = list[tuple[int | None, int]]


def heavy_keys(df: DataFrame, *keys: list[str], partitions: int | None = None) -> list[Heavy]:
    """For each key (a list of columns) the values, NULL included, that hold more than ``2 / SHARE`` of a partition's fair share;
    at most HEAVY_KEYS.  One pass over the key columns for all keys."""
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tops = [F.expr(f"approx_top_k({_key_sql(on)}, {HEAVY_KEYS}, {TRACKED})") for on in keys]
    rows, *found = df.agg(F.count("*"), *tops, *[F.count_if(_any_null(on)) for on in keys]).first()
    share = max(1.0, rows / (SHARE * partitions))
    counts = [[(t["item"], t["count"]) for t in top or () if t["item"] is not None] + [(None, nulls)]
              for top, nulls in zip(found, found[len(keys):])]
    return [[(key, -int(-n // share)) for key, n in of if n >= 2 * share] for of in counts]


def heavy_hitters(df: DataFrame, on: list[str], partitions: int | None = None) -> Heavy:
    """The heavy values of one key."""
    return heavy_keys(df, on, partitions=partitions)[0]


def _key_sql(on: list[str]) -> str:
    nulls = " or ".join(f"`{c}` is null" for c in on)
    return f"if({nulls}, null, xxhash64({', '.join(f'`{c}`' for c in on)}))"


def _any_null(on: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(f"`{c}`").isNull() for c in on))


def heavy_hitter_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", spread: list[str] | None = None,
                      heavy: Heavy | None = None) -> DataFrame:
    """``left.join(right, on, how)`` for ``how`` in inner, left, left_semi, left_anti, with heavy left keys salted.

    ``spread``: columns that tell the left rows of one key apart (default: all of ``left``); a row's salt is a hash of
    them, hence the same when a lost task runs again.  ``heavy``: result of ``heavy_hitters`` where the caller has it;
    else one pass over the left keys finds it.  The key columns need the same types on both sides.
    Columns: those of ``left``, then for inner and left those of ``right`` that are not keys.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    heavy = heavy_hitters(left, on) if heavy is None else heavy
    if not heavy:
        return left.join(right, on, how).select(*[F.col(f"`{c}`") for c in _columns(left, right, on, how)])
    nulls = dict(heavy).get(None, 1)
    salts = F.broadcast(left.sparkSession.createDataFrame([h for h in heavy if h[0] is not None], _HEAVY))    # at most HEAVY_KEYS rows
    of = F.expr(_key_sql(on))
    deal = F.xxhash64(*[F.col(f"`{c}`") for c in (spread or left.columns)])
    left_ = left.join(salts, of == F.col("_key"), "left").withColumn(
        "_salt", F.pmod(deal, F.when(_any_null(on), F.lit(nulls)).otherwise(F.coalesce("_salts", F.lit(1)))).cast("int")).drop("_key", "_salts")
    salted = right.where(~_any_null(on)).join(salts, of == F.col("_key"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))).drop("_key", "_salts")
    return left_.join(salted, [*on, "_salt"], how).select(*[F.col(f"`{c}`") for c in _columns(left, right, on, how)])


def _columns(left: DataFrame, right: DataFrame, on: list[str], how: str) -> list[str]:
    return left.columns + ([] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on])
