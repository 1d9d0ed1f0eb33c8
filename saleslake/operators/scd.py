"""Change-data operators: SCD2 (I1, I2, C9-C12), staging upsert (I3), status
transition (I4), retention purge (I7).

Parquet has no MERGE.  A stored dimension is split by ``is_current``: ``scd2_changes``
reads the open versions, and the store writes the next open versions and appends the
newly closed ones (``store.merge_dimension``); earlier closed versions stay as they are.
``scd2_merge`` returns the whole next snapshot instead.  Every operator is one join of the
open versions with the staged rows plus small aggregates -- no per-key loop, no cursor.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from .keys import assign_dense_keys, freeze, next_key

SCD_COLUMNS = ("valid_from", "valid_to", "is_current", "version_num")

PRODUCT_TRACKED = {"product_name": False, "category_code": False, "list_price": True,
                   "cost_price": True, "supplier_id": True}
PRODUCT_ATTRS = ("product_code", "product_name", "category_code", "subcategory_code",
                 "supplier_id", "cost_price", "list_price", "tax_class_code")
CUSTOMER_TRACKED = {"full_name": False, "email": False, "loyalty_tier": False}
CUSTOMER_ATTRS = ("customer_code", "full_name", "email", "region_code", "loyalty_tier")


class RepeatedKey(ValueError):
    """A staged natural key occurs more than once."""


def _differs(tracked: dict[str, bool], null_policy: str) -> Column:
    test = C.sentinel_differs if null_policy == "sentinel" else C.null_safe_differs
    parts = [test(F.col(f"_c_{c}"), F.col(f"_s_{c}"), numeric) for c, numeric in tracked.items()]
    return reduce(lambda a, b: a | b, parts)


def change_class(staged: DataFrame, dim: DataFrame, natural_key: str,
                 tracked: dict[str, bool], null_policy: str = "sentinel") -> DataFrame:
    """One join of staged rows with current versions -> NEW / CHANGED / SAME."""
    cur = dim.where(F.col("is_current") == "Y").select(
        F.col(natural_key), *[F.col(c).alias(f"_c_{c}") for c in tracked], F.lit(True).alias("_has_cur"))
    s = staged.select(natural_key, *[F.col(c).alias(f"_s_{c}") for c in tracked])
    j = s.join(cur, natural_key, "left")
    cls = (F.when(F.col("_has_cur").isNull(), "NEW")
           .when(_differs(tracked, null_policy), "CHANGED").otherwise("SAME"))
    return j.select(natural_key, cls.alias("change_class"))


def _audit(df: DataFrame, cols: list[str], target_types, values: dict) -> DataFrame:
    """Fill the audit columns a dimension has (created/updated by and date)."""
    for c, v in values.items():
        if c in cols:
            df = df.withColumn(c, F.lit(v).cast(target_types[c]))
    return df


def scd2_changes(current: DataFrame, history: DataFrame, staged: DataFrame, *, natural_key: str, key_col: str,
                 tracked: dict[str, bool], attrs: tuple[str, ...], load_date: _dt.date, key_start: int,
                 null_policy: str = "sentinel", run_ts: _dt.datetime | None = None, ordered: bool = False) -> tuple[DataFrame, DataFrame]:
    """Generic SCD type 2 merge of the open versions: (the next open versions, the versions this run closes).

    * staged key without an open version -> version 1 (or max+1 after history);
    * tracked attribute changed -> open row closed (``valid_to = load_date-1``,
      ``'N'``) and a new version ``max(version)+1`` opened at ``load_date``;
      when the open version itself began on ``load_date`` (same-day rerun) it
      is replaced instead, so no interval ends before it starts;
    * unchanged, missing or untracked -> untouched.

    ``history`` (closed versions) is read for the versions of staged keys only, and only two columns of it;
    rows closed earlier are neither read as a whole nor returned.  ``key_start``: the first free surrogate key;
    ``ordered``: new keys follow the natural key, else rows are numbered where they are.
    ``staged`` must hold one row per natural key (the staging primary key); a
    repeated key ends the merge, as it would open two versions.
    Audit columns present (``created_by/created_date`` on inserted
    rows, ``updated_by/updated_date`` on closed rows) take ``run_ts`` -- a
    parameter, so reruns repeat exactly (default: midnight of ``load_date``).
    """
    repeated = staged.groupBy(natural_key).count().where("count > 1").first()
    if repeated is not None:
        raise RepeatedKey(f"{natural_key} {repeated[natural_key]!r} is staged {repeated['count']} times")
    cols = current.columns
    types = {f.name: f.dataType for f in current.schema.fields}
    ts = run_ts or _dt.datetime.combine(load_date, _dt.time())
    s = staged.select(natural_key, *[F.col(a).alias(f"_s_{a}") for a in attrs], F.lit(True).alias("_staged"))
    # C11: the highest closed version of each staged key; an open version is higher than the closed ones
    maxv = (history.select(natural_key, "version_num").join(s.select(natural_key), natural_key, "left_semi")
            .groupBy(natural_key).agg(F.max("version_num").alias("_maxv")))
    # one full outer join: open versions x staged rows
    tagged = current.select(*cols, *[F.col(c).alias(f"_c_{c}") for c in tracked], F.lit(True).alias("_has_cur"))
    j = tagged.join(s.join(maxv, natural_key, "left"), natural_key, "full")
    changed = F.coalesce(F.col("_has_cur") & F.col("_staged") & _differs(tracked, null_policy), F.lit(False))
    same_day = F.coalesce(F.col("valid_from") == F.lit(load_date), F.lit(False))
    j = freeze(j.withColumn("_changed", changed).withColumn("_new", F.col("_has_cur").isNull()).withColumn("_same_day", same_day))

    untouched = j.where(F.col("_has_cur") & ~F.col("_changed")).select(*cols)
    closed = (j.where(F.col("_changed") & ~F.col("_same_day"))
              .withColumn("valid_to", F.date_sub(F.lit(load_date), 1))
              .withColumn("is_current", F.lit("N")))
    closed = _audit(closed, cols, types, {"updated_by": S.ETL_USER, "updated_date": ts}).select(*cols)
    before = F.greatest(F.coalesce("version_num", F.lit(0)), F.coalesce("_maxv", F.lit(0)))
    ins = (j.where(F.col("_new") | F.col("_changed"))
           .select(natural_key, *[F.col(f"_s_{a}").alias(a) for a in attrs if a != natural_key],
                   F.col("_same_day"), F.col(key_col).alias("_cur_key"),
                   F.when(F.col("_same_day"), F.col("version_num")).otherwise(before + 1).cast(types["version_num"]).alias("version_num"))
           .withColumn("valid_from", F.lit(load_date))
           .withColumn("valid_to", F.lit(S.HIGH_DATE))
           .withColumn("is_current", F.lit("Y")))
    # a same-day replacement keeps its key (facts of the day may already use it);
    # every other inserted version draws the next keys of the sequence
    fresh = assign_dense_keys(ins.where(~F.col("_same_day")), key_col,
                              [F.col(natural_key).asc_nulls_first()] if ordered else None, key_start)
    replaced = ins.where(F.col("_same_day")).withColumn(key_col, F.col("_cur_key"))
    ins = fresh.unionByName(replaced)
    ins = _audit(ins, cols, types, {"created_by": S.ETL_USER, "created_date": ts, "updated_by": None,
                                    "updated_date": None})
    ins = ins.select(*[(F.col(c) if c in ins.columns else F.lit(None)).cast(types[c]).alias(c) for c in cols])
    return untouched.unionByName(ins), closed


def split_open(dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(open versions, every other row, NULL flags included)."""
    is_open = F.coalesce(F.col("is_current") == "Y", F.lit(False))
    return dim.where(is_open), dim.where(~is_open)


def scd2_merge(dim: DataFrame, staged: DataFrame, *, key_col: str, key_start: int = S.KEY_START, ordered: bool = True,
               **how) -> DataFrame:
    """The whole next snapshot of ``dim`` (``scd2_changes`` for a table that isn't stored by ``is_current``);
    surrogate keys go on after the largest in use."""
    current, history = split_open(dim)
    opened, closed = scd2_changes(current, history, staged, key_col=key_col, key_start=next_key(dim, key_col, key_start),
                                  ordered=ordered, **how)
    return history.select(*dim.columns).unionByName(closed).unionByName(opened)


def staged_products(stg_product: DataFrame, load_date: _dt.date) -> DataFrame:
    """Products of the load date that are active (the reference's cursor)."""
    return stg_product.where((F.col("load_date") == F.lit(load_date)) & (F.col("is_active") == "Y"))


def product_load(dim: DataFrame, stg_product: DataFrame, load_date: _dt.date) -> tuple[DataFrame, dict]:
    """The staged rows and the merge parameters of I1 for a dimension with the columns of ``dim``."""
    return staged_products(stg_product, load_date), dict(
        natural_key="product_id", key_col="dim_product_key", tracked=PRODUCT_TRACKED,
        attrs=tuple(a for a in PRODUCT_ATTRS if a in dim.columns), load_date=load_date)


def load_dim_product(dim_product: DataFrame, stg_product: DataFrame, load_date: _dt.date,
                     null_policy: str = "sentinel", ordered: bool = True) -> DataFrame:
    """SCD2 product load."""
    staged, how = product_load(dim_product, stg_product, load_date)
    return scd2_merge(dim_product, staged, null_policy=null_policy, ordered=ordered, **how)


def staged_customers(stg_customer: DataFrame, load_date: _dt.date, region: str | None = None) -> DataFrame:
    """Customers staged on the load date (optionally one region), full name built."""
    cond = (F.col("load_date") == F.lit(load_date)) & F.col("customer_id").isNotNull()
    if region is not None:
        cond = cond & (F.col("region_code") == F.lit(region))
    return stg_customer.where(cond).withColumn("full_name", C.full_name("first_name", "last_name"))


def customer_load(dim: DataFrame, stg_customer: DataFrame, load_date: _dt.date, region: str | None = None) -> tuple[DataFrame, dict]:
    """The staged rows and the merge parameters of I2 for a dimension with the columns of ``dim``."""
    return staged_customers(stg_customer, load_date, region), dict(
        natural_key="customer_id", key_col="dim_customer_key", tracked=CUSTOMER_TRACKED,
        attrs=tuple(a for a in CUSTOMER_ATTRS if a in dim.columns), load_date=load_date)


def load_dim_customer(dim_customer: DataFrame, stg_customer: DataFrame, load_date: _dt.date,
                      region: str | None = None, null_policy: str = "sentinel", ordered: bool = True) -> DataFrame:
    """I2 + C9 + C10: SCD2 customer load; inserts are staged keys that have no
    current version once changed ones are closed (new + just closed)."""
    staged, how = customer_load(dim_customer, stg_customer, load_date, region)
    return scd2_merge(dim_customer, staged, null_policy=null_policy, ordered=ordered, **how)


UPSERT_UPDATE_COLUMNS = ("loyalty_tier", "lifetime_value", "last_purchase_date", "load_date")


def upsert(target: DataFrame, source: DataFrame, key: str,
           update_columns: tuple[str, ...] = UPSERT_UPDATE_COLUMNS) -> DataFrame:
    """MERGE as one full outer join.  Matched rows take ``update_columns``
    from the source and keep the rest; unmatched source rows are inserted whole;
    target rows without a source row are kept."""
    cols = target.columns
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_in_s"))
    j = t.join(s, F.col(f"_t_{key}") == F.col(f"_s_{key}"), "full")
    out = []
    for c in cols:
        if c in update_columns:
            e = F.when(F.col("_in_s").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}"))
        else:
            e = F.when(F.col("_in_t").isNotNull(), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}"))
        out.append(e.cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def mark_loaded(staged: DataFrame, batch_id: int | Column, load_date=None, region=None) -> DataFrame:
    """I4: PENDING -> LOADED (+ batch id) for every row of the slice, also the
    rows the dimension joins dropped (reported apart by ``dropped_by_dims``)."""
    cond = F.col("etl_status") == S.PENDING
    if load_date is not None:
        cond = cond & (F.col("transaction_date") == F.lit(load_date))
    if region is not None:
        cond = cond & (F.col("region_code") == F.lit(region))
    bid = batch_id if isinstance(batch_id, Column) else F.lit(batch_id).cast("bigint")
    return (staged.withColumn("_hit", cond)
            .withColumn("etl_status", F.when(F.col("_hit"), F.lit(S.LOADED)).otherwise(F.col("etl_status")))
            .withColumn("load_batch_id", F.when(F.col("_hit"), bid).otherwise(F.col("load_batch_id")))
            .drop("_hit"))


def purge_expired(dim: DataFrame, as_of: _dt.date, retention_days: int = S.RETENTION_DAYS) -> DataFrame:
    """Drop closed versions whose ``valid_to`` is before ``as_of - retention``.
    Returned as the remaining rows (the snapshot to write)."""
    cutoff = F.date_sub(F.lit(as_of), retention_days)
    expired = (F.col("is_current") == "N") & (F.col("valid_to") < cutoff)
    return dim.where(~F.coalesce(expired, F.lit(False)))
