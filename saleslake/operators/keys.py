"""Surrogate keys (I8) and distributed ordinals (rank / dense_rank) that never
funnel a large group through one task.

Both use the same two-pass idea:

1. range-partition the rows by the sort order (Spark samples the keys, so the
   partitions are balanced even when one group is huge), sort inside each
   partition, and freeze the placement with a *reliable* ``checkpoint()`` in the
   cluster's checkpoint folder -- recomputation after a lost executor then sees
   the same rows in the same partitions;
2. derive per-partition offsets from a tiny summary (one row per partition, or
   per partition and group), join them back and add each row's position inside
   its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

_POS_BITS = 33  # monotonically_increasing_id = (partition index << 33) + position


def freeze(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint (the cluster's shared
    checkpoint folder): the lineage is cut and a lost executor never forces a
    recomputation that could place rows differently."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_freeze = freeze


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Evaluate ``df`` once, as a Parquet table in the shared scratch folder that is read as often as wanted.

    Smaller than ``freeze`` (columns are compressed, and a reader takes the ones it needs), but rows lose their placement.
    ``compression``: the Parquet codec (default: the session's)."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def next_key(df: DataFrame | None, key_col: str, start: int) -> int:
    """Sequence continuation: max(existing key) + 1, or ``start`` on an empty table."""
    if df is None:
        return start
    m = df.agg(F.max(key_col).alias("m")).first()["m"]
    return start if m is None else max(int(m) + 1, start)


def assign_dense_keys(df: DataFrame, key_col: str, order_by: list[Column | str] | None,
                      start: int) -> DataFrame:
    """Give every row a key ``start, start+1, ...``.

    Keys are unique and dense.  With ``order_by`` they follow that order (a
    range-partitioned sort); with a total order (ties only between rows equal in
    every column) the keyed result is deterministic.  Without ``order_by`` rows
    are numbered where they are -- no shuffle, no sort -- which is all a
    sequence needs.  The offsets table has one row per non-empty partition: its
    size is bounded by the partition count, not by the data, so it is broadcast.
    """
    ordered = _freeze(df.orderBy(*order_by) if order_by else df)
    tagged = (ordered.withColumn("_rid", F.monotonically_increasing_id())
              .withColumn("_pid", F.shiftrightunsigned("_rid", _POS_BITS)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = F.col("_rid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    key = F.lit(start).cast("bigint") + F.col("_off") + pos
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(key_col, key.cast("bigint"))
            .drop("_rid", "_pid", "_off"))


def distributed_rank(df: DataFrame, partition_by: list[str], order_col: str,
                     descending: bool = True, rank_col: str = "rank",
                     dense_rank_col: str = "dense_rank", total_col: str | None = None) -> DataFrame:
    """``rank()`` and ``dense_rank()`` over ``partition_by`` ordered by one
    column, without holding any group in one task.

    * distinct values per group are counted first (a partial aggregate, so a
      value shared by a third of the rows collapses to one row);
    * those are range-partitioned on (group, value) and frozen by checkpoint;
    * each (group, partition) chunk -- bounded by the partition size -- is
      ranked locally, and the counts of earlier partitions of the same group
      (at most one row per partition) are added;
    * the ranks join back to the rows on (group, value).

    ``total_col``: also the sum of ``order_col`` over the group, carried along with the chunks' counts.
    """
    v = F.col(order_col)
    ordv = v.desc_nulls_last() if descending else v.asc_nulls_first()
    vals = df.groupBy(*partition_by, order_col).agg(F.count(F.lit(1)).alias("_n"), F.sum(order_col).alias("_sum"))
    ordered = _freeze(vals.repartitionByRange(*[F.col(c) for c in partition_by], ordv)
                      .sortWithinPartitions(*partition_by, ordv)
                      .withColumn("_pid", F.spark_partition_id()))
    w_local = Window.partitionBy(*partition_by, "_pid").orderBy(ordv)
    local = ordered.select(
        *partition_by, order_col, "_pid",
        F.coalesce(F.sum("_n").over(w_local.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_rows_before"),
        (F.row_number().over(w_local) - 1).alias("_vals_before"))
    stats = ordered.groupBy(*partition_by, "_pid").agg(
        F.sum("_n").alias("_rows_in"), F.count(F.lit(1)).alias("_vals_in"), F.sum("_sum").alias("_sum_in"))
    w_parts = Window.partitionBy(*partition_by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        *partition_by, "_pid",
        F.coalesce(F.sum("_rows_in").over(w_parts), F.lit(0)).alias("_rows_off"),
        F.coalesce(F.sum("_vals_in").over(w_parts), F.lit(0)).alias("_vals_off"),
        F.sum("_sum_in").over(Window.partitionBy(*partition_by)).alias("_total"))
    offs = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in [*partition_by, "_pid"]],
                          "_rows_off", "_vals_off", "_total")
    on = [local[c].eqNullSafe(offs[f"_o_{c}"]) for c in [*partition_by, "_pid"]]   # NULL groups rank too
    ranks = (local.join(offs, on)
             .select(*partition_by, order_col,
                     (F.col("_rows_off") + F.col("_rows_before") + 1).cast("bigint").alias(rank_col),
                     (F.col("_vals_off") + F.col("_vals_before") + 1).cast("bigint").alias(dense_rank_col), "_total"))
    keys = [*partition_by, order_col]
    r = ranks.select(*[F.col(c).alias(f"_r_{c}") for c in keys], rank_col, dense_rank_col,
                     *([F.col("_total").alias(total_col)] if total_col else []))
    cond = [df[c].eqNullSafe(r[f"_r_{c}"]) for c in keys]   # NULL values rank too
    return df.join(r, cond).drop(*[f"_r_{c}" for c in keys])
