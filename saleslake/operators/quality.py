"""Data quality: rule-driven checks (J1-J8), staging metrics (D7, G1), row
count gates (D8, D9), audit counts (A10) and constraint audits (I12).

Every check of a table is one aggregate over one scan of it (``count_if`` and
friends), turned into rows with ``inline`` -- never one query per rule or per
metric.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from .clean import business_day
from .keys import freeze
from .states import grouped_with_distincts

# --------------------------------------------------------------------------- J
DQ_RULE_SCHEMA = T.StructType([
    T.StructField("rule_id", T.IntegerType()),
    T.StructField("rule_name", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("rule_type", T.StringType()),
    T.StructField("sql_fragment", T.StringType()),
    T.StructField("threshold_pct", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("is_active", T.StringType()),
    T.StructField("execution_order", T.IntegerType()),
    T.StructField("parent_table", T.StringType()),
    T.StructField("parent_key", T.StringType()),
])

# The reference's built-in fallback rules
BUILTIN_RULES = [
    (1, "NULL_PRODUCT_KEY", "FACT_DAILY_SALES", "NULL_CHECK",
     "COUNT(CASE WHEN dim_product_key IS NULL THEN 1 END)", 0.0, "CRITICAL"),
    (2, "NEGATIVE_NET_AMOUNT", "FACT_DAILY_SALES", "RANGE_CHECK", "net_amount >= 0", 0.1, "WARNING"),
    (3, "REGIONAL_SUMMARY_PRESENT", "FACT_REGIONAL_SUMMARY", "THRESHOLD_COUNT", "COUNT(*)", 0.0, "CRITICAL"),
]

RESULT_SCHEMA = T.StructType([
    T.StructField("rule_id", T.LongType()),
    T.StructField("rule_name", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("rule_type", T.StringType()),
    T.StructField("check_date", T.DateType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("failed_rows", T.LongType()),
    T.StructField("fail_pct", T.DoubleType()),
    T.StructField("threshold_pct", T.DoubleType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("severity", T.StringType()),
])


def rules_frame(spark: SparkSession, rows: list[tuple], domain: str = "RETAIL") -> DataFrame:
    """Rule rows -> rules DataFrame (``(id, name, table, type, fragment,
    threshold, severity[, parent_table, parent_key])``), active, in order."""
    full = []
    for i, r in enumerate(rows):
        parent = tuple(r[7:9]) if len(r) > 7 else (None, None)
        full.append((r[0], r[1], r[2], r[3], r[4], r[5], r[6], domain, "Y", i + 1, *parent))
    return spark.createDataFrame(full, DQ_RULE_SCHEMA)


def load_rules(rules: DataFrame, domain: str) -> list[dict]:
    """A15 + F1 + J7: active rules of a domain in execution order; the built-in
    ones where there are none, so that no run checks nothing.  Rule rows are few
    and are collected to build one plan per table."""
    def active(frame: DataFrame) -> list[dict]:
        rows = (frame.where((F.col("domain") == domain) & (F.col("is_active") == "Y"))
                .orderBy("execution_order", "rule_id").collect())
        return [r.asDict() for r in rows]
    return active(rules) or active(rules_frame(rules.sparkSession, BUILTIN_RULES, domain))


def named_columns(df: DataFrame, rules: list[dict], also: tuple[str, ...] = ()) -> list[str]:
    """The columns of ``df`` that the fragments and parent keys of the rules can refer to, and ``also``; all of them where
    a fragment has a star beside COUNT(*)."""
    text = " ".join(str(r.get(k) or "") for r in rules for k in ("sql_fragment", "parent_key"))
    if "*" in re.sub(r"count\s*\(\s*\*\s*\)", "", text, flags=re.I):
        return df.columns
    return [c for c in df.columns if c in also or re.search(rf"\b{re.escape(c)}\b", text, re.I)]


@dataclass
class _TablePlan:
    frame: DataFrame
    date_col: str | None
    rules: list[dict] = field(default_factory=list)


def _pct(failed: Column, total: Column) -> Column:
    """ROUND(failed / NULLIF(total,0) * 100, 4), exact; an empty slice gives 0."""
    return F.coalesce(
        F.round(failed.cast("decimal(20,0)") / F.nullif(total, F.lit(0)).cast("decimal(20,0)") * 100, 4),
        F.lit(0)).cast("double")


def _rule_columns(rule: dict, ref_col: str | None) -> tuple[Column, Column, Column]:
    """(total, failed, pct) aggregate expressions of one rule."""
    rt, frag = rule["rule_type"], rule["sql_fragment"]
    total = F.count(F.lit(1))
    if rt == "NULL_CHECK":                      # J1: fragment counts failures
        failed = F.expr(frag).cast("bigint")
    elif rt == "RANGE_CHECK":                   # J2: rows where the predicate is FALSE
        failed = F.count_if(~F.expr(frag))
    elif rt == "REFERENTIAL_CHECK":             # J3: rows where the expression is NULL
        probe = F.col(ref_col) if ref_col else F.expr(frag)
        failed = F.count_if(probe.isNull())
    elif rt == "THRESHOLD_COUNT":               # J4: a metric; never fails
        return F.expr(frag).cast("bigint"), F.lit(0).cast("bigint"), F.lit(0.0)
    else:                                       # J5: fragment returns the failed count
        failed = F.expr(frag).cast("bigint")
    return total.cast("bigint"), failed, _pct(failed, total)


#: A fragment with a query of its own.
SUBQUERY = re.compile(r"\bselect\b", re.I)


def _metrics(plan: _TablePlan, rules: list[dict], load_date: _dt.date | None) -> DataFrame:
    """check_date and the measures of the rules, from one aggregate over the table."""
    f = plan.frame
    if load_date is not None and plan.date_col:
        f = f.where(F.col(plan.date_col) == F.lit(load_date))
    structs = []
    for rule in rules:
        ref_col = f"_ref_{rule['rule_id']}" if (rule["rule_type"] == "REFERENTIAL_CHECK"
                                                and rule.get("parent_table")) else None
        total, failed, pct = _rule_columns(rule, ref_col)
        structs.append(F.struct(F.lit(rule["rule_id"]).cast("bigint").alias("rule_id"),
                                total.alias("total_rows"), failed.alias("failed_rows"),
                                pct.alias("fail_pct")))
    if load_date is None and plan.date_col:
        agg = f.groupBy(F.col(plan.date_col).alias("check_date")).agg(F.array(*structs).alias("_m"))
    else:
        agg = f.agg(F.array(*structs).alias("_m")).withColumn("check_date", F.lit(load_date).cast("date"))
    return agg.select("check_date", F.inline("_m"))


def _subquery_metrics(spark: SparkSession, rule: dict, tables: dict[str, DataFrame], date_col: str | None,
                      load_date: _dt.date | None) -> DataFrame:
    """The measures of one rule whose fragment queries other tables: it is
    evaluated for each row first (J2: true passes, J3: NULL fails), or as a
    whole for the rule types that count.  The tables are the frames given, under view names of their own."""
    private = {name.lower(): f"dq_{uuid.uuid4().hex}_{i}" for i, name in enumerate(tables)}
    for name, df in tables.items():
        df.createOrReplaceTempView(private[name.lower()])
    # table names outside quoted text become those of the views, whatever else the catalog has
    names = re.compile("'(?:[^']|'')*'|" + "|".join(rf"\b{re.escape(n)}\b" for n in sorted(private, key=len, reverse=True)), re.I)
    renamed = lambda sql: names.sub(lambda m: private.get(m[0].lower(), m[0]), sql)
    try:
        kind, frag, table = rule["rule_type"], renamed(rule["sql_fragment"]), private[rule["target_table"].lower()]
        if kind in ("RANGE_CHECK", "REFERENTIAL_CHECK"):
            rows = spark.sql(f"SELECT *, ({frag}) AS _probe FROM {table}")
            fails = F.col("_probe").isNull() if kind == "REFERENTIAL_CHECK" else ~F.col("_probe")
            plan = _TablePlan(rows.withColumn("_fails", fails), date_col)
            return _metrics(plan, [rule | {"rule_type": "GENERIC", "sql_fragment": "count_if(_fails)", "parent_table": None}],
                            load_date)
        of_day = f"WHERE {date_col} = DATE '{load_date}'" if date_col and load_date else ""
        counted = spark.sql(f"SELECT COUNT(1) AS n, CAST(({frag}) AS BIGINT) AS m FROM {table} {of_day}")
        metric = kind == "THRESHOLD_COUNT"
        return counted.select(F.lit(load_date).cast("date").alias("check_date"), F.lit(rule["rule_id"]).cast("bigint").alias("rule_id"),
                              F.col("m" if metric else "n").alias("total_rows"),
                              (F.lit(0).cast("bigint") if metric else F.col("m")).alias("failed_rows"),
                              (F.lit(0.0) if metric else _pct(F.col("m"), F.col("n"))).alias("fail_pct"))
    finally:
        for view in private.values():
            spark.catalog.dropTempView(view)


def run_checks(rules: list[dict], tables: dict[str, DataFrame], date_columns: dict[str, str],
               load_date: _dt.date | None = None, strict_threshold: bool = False) -> DataFrame:
    """Evaluate every rule; one aggregate per target table.

    ``load_date=None`` checks every date of each table (grouped by its date
    column, defect 11: each table names its own date column).  A rule that does
    not analyse, or that fails while it runs, becomes an ERROR row (not passed)
    and the others continue: the rules of a table run together, and one by one
    only if that fails.  A fragment that holds a subquery runs apart, with the
    tables under their names (J3).
    ``passed = fail_pct <= threshold``, where a threshold of 0 or NULL means
    0.01 unless ``strict_threshold``.
    """
    spark = next(iter(tables.values())).sparkSession
    plans: dict[str, _TablePlan] = {}
    errors: list[tuple] = []
    parts: list[DataFrame] = []

    def attempt(rule: dict, make: Callable[[], DataFrame]) -> None:
        try:
            parts.append(freeze(make()))
        except PySparkException as e:
            errors.append(_error_row(rule, str(e).splitlines()[0][:200], load_date))

    for rule in rules:
        tname = rule["target_table"]
        base = tables.get(tname)
        if base is None:
            errors.append(_error_row(rule, "unknown table", load_date))
            continue
        if SUBQUERY.search(rule["sql_fragment"]):
            attempt(rule, lambda r=rule: _subquery_metrics(spark, r, tables, date_columns.get(r["target_table"]), load_date))
            continue
        plan = plans.setdefault(tname, _TablePlan(base, date_columns.get(tname)))
        ref_col = None
        if rule["rule_type"] == "REFERENTIAL_CHECK" and rule.get("parent_table"):
            parent = tables.get(rule["parent_table"])
            if parent is None:
                errors.append(_error_row(rule, "unknown parent table", load_date))
                continue
            ref_col = f"_ref_{rule['rule_id']}"
            child_key, parent_key = rule["sql_fragment"], rule["parent_key"]
            keys = parent.select(F.col(parent_key).alias(f"_pk_{rule['rule_id']}")).distinct() \
                .withColumn(ref_col, F.lit(True))
            trial = plan.frame.join(keys, F.expr(child_key) == F.col(f"_pk_{rule['rule_id']}"), "left")
        else:
            trial = plan.frame
        try:
            cols = _rule_columns(rule, ref_col)
            trial.agg(*[c.alias(f"_{i}") for i, c in enumerate(cols)]).schema   # analyse alone
        except PySparkException as e:
            errors.append(_error_row(rule, str(e).splitlines()[0][:200], load_date))
            continue
        plan.frame = trial.drop(f"_pk_{rule['rule_id']}") if ref_col else trial
        plan.rules.append(rule)

    for plan in plans.values():
        if not plan.rules:
            continue
        try:
            parts.append(freeze(_metrics(plan, plan.rules, load_date)))
        except PySparkException:
            for rule in plan.rules:
                attempt(rule, lambda r=rule, p=plan: _metrics(p, [r], load_date))
    meta = spark.createDataFrame(
        [(int(r["rule_id"]), r["rule_name"], r["target_table"], r["rule_type"],
          None if r["threshold_pct"] is None else float(r["threshold_pct"]), r["severity"] or "WARNING")
         for r in rules],
        "rule_id bigint, rule_name string, target_table string, rule_type string, "
        "threshold_pct double, severity string")
    if parts:
        metrics = parts[0]
        for p in parts[1:]:
            metrics = metrics.unionByName(p)
        # rules are few: the metadata join is broadcast by size (a handful of rows)
        res = metrics.join(F.broadcast(meta), "rule_id")
        thr = F.col("threshold_pct")
        eff = thr if strict_threshold else F.coalesce(F.nullif(thr, F.lit(0.0)), F.lit(S.DQ_DEFAULT_THRESHOLD))
        passed = F.coalesce(F.col("fail_pct"), F.lit(0.0)) <= F.coalesce(eff, F.lit(0.0))
        res = res.select("rule_id", "rule_name", "target_table", "rule_type", "check_date",
                         "total_rows", "failed_rows", "fail_pct", "threshold_pct",
                         passed.alias("passed"),
                         F.when(passed, "PASS").otherwise("FAIL").alias("status"), "severity")
    else:
        res = spark.createDataFrame([], RESULT_SCHEMA)
    if errors:
        res = res.unionByName(spark.createDataFrame(errors, RESULT_SCHEMA))
    return res


def _error_row(rule: dict, _msg: str, load_date: _dt.date | None = None) -> tuple:
    """A rule that failed: severity ERROR, not passed (dated when one date is checked)."""
    return (int(rule["rule_id"]), rule["rule_name"], rule["target_table"], rule["rule_type"], load_date,
            None, None, None, None if rule["threshold_pct"] is None else float(rule["threshold_pct"]),
            False, "FAIL", "ERROR")


def dq_summary(results: DataFrame) -> DataFrame:
    """Per checked date, total / passed / critical failures / other failures."""
    return (results.groupBy("check_date")
            .agg(F.count(F.lit(1)).alias("total_rules"),
                 F.count_if(F.col("passed")).alias("passed_rules"),
                 F.count_if(~F.col("passed") & (F.col("severity") == "CRITICAL")).alias("critical_failures"),
                 F.count_if(~F.col("passed") & (F.col("severity") != "CRITICAL")).alias("other_failures")))


class CriticalDQFailure(RuntimeError):
    pass


def dq_gate(results: DataFrame, fail_on_critical: bool) -> int:
    """J8 gate: number of critical failures; raise only when asked."""
    n = results.where(~F.col("passed") & (F.col("severity") == "CRITICAL")).count()
    if n and fail_on_critical:
        raise CriticalDQFailure(f"{n} critical data quality failure(s)")
    return n


# --------------------------------------------------------------------------- D7
STAGING_METRICS = ("TOTAL_ROWS", "NULL_PRODUCT_ID", "NULL_CUSTOMER_ID", "ZERO_AMOUNT_ROWS",
                   "DISTINCT_STORES", "DISTINCT_PRODUCTS")


def staging_metrics(staged: DataFrame) -> DataFrame:
    """D7 + G1: the six staging metrics per (date, region) slice from the
    stacked aggregates of ``grouped_with_distincts``, as (metric, value) rows."""
    columns = ("transaction_date", "region_code", "product_id", "customer_id", "unit_price", "store_id")
    agg = grouped_with_distincts(staged.select(*columns), ["transaction_date", "region_code"], [
        F.count(F.lit(1)).alias("TOTAL_ROWS"),
        F.count_if(F.col("product_id").isNull()).alias("NULL_PRODUCT_ID"),
        F.count_if(F.col("customer_id").isNull()).alias("NULL_CUSTOMER_ID"),
        F.count_if(F.col("unit_price") == 0).alias("ZERO_AMOUNT_ROWS")],
        {"DISTINCT_STORES": "store_id", "DISTINCT_PRODUCTS": "product_id"})
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("bigint").alias("value"))
                     for m in STAGING_METRICS])
    return agg.select("transaction_date", "region_code", F.inline(rows))


# --------------------------------------------------------------------------- D8, D9, A10
def row_count_gate(pending: DataFrame, fact: DataFrame, min_rows: int = S.MIN_ROWS_PER_SLICE) -> DataFrame:
    """Per slice, staged rows vs the minimum (a warning, as in the driver
    script), empty batch = no-op, and whether the fact got rows."""
    st = pending.groupBy("transaction_date", "region_code").agg(F.count(F.lit(1)).alias("staged_rows"))
    fc = fact.groupBy("transaction_date", "region_code").agg(F.count(F.lit(1)).alias("fact_rows"))
    j = st.unionByName(fc, allowMissingColumns=True).groupBy("transaction_date", "region_code").agg(
        F.sum("staged_rows").alias("staged_rows"), F.sum("fact_rows").alias("fact_rows"))   # NULL regions meet too
    staged_rows = F.coalesce(F.col("staged_rows"), F.lit(0)).cast("bigint")
    fact_rows = F.coalesce(F.col("fact_rows"), F.lit(0)).cast("bigint")
    return j.select(
        "transaction_date", "region_code", staged_rows.alias("staged_rows"), fact_rows.alias("fact_rows"),
        F.when(staged_rows == 0, "EMPTY_NOOP").when(staged_rows < min_rows, "BELOW_MINIMUM")
         .otherwise("OK").alias("staging_gate"),
        F.when(fact_rows == 0, "FACT_EMPTY").otherwise("FACT_LOADED").alias("fact_gate"))


def day_ratio_gate(fact: DataFrame, min_rows: int = S.MIN_ROWS_PER_SLICE,
                   min_ratio: Decimal = S.MIN_DAY_RATIO) -> DataFrame:
    """Each region-day's fact count against the previous day's.  Passes
    with at least ``min_rows`` rows and at least ``min_ratio`` of the previous
    day (no previous day: ratio not applied).  The window runs over the daily
    counts: one row per region and calendar day."""
    return ratio_gate(fact.groupBy("region_code", "transaction_date").agg(F.count(F.lit(1)).alias("row_count")), min_rows, min_ratio)


def ratio_gate(counts: DataFrame, min_rows: int = S.MIN_ROWS_PER_SLICE, min_ratio: Decimal = S.MIN_DAY_RATIO) -> DataFrame:
    """D9 from the row counts (region_code, transaction_date, row_count) of the slices."""
    days = Window.partitionBy("region_code").orderBy("transaction_date")
    follows = F.lag("transaction_date").over(days) == F.date_sub("transaction_date", 1)
    j = counts.withColumn("prev_row_count", F.when(follows, F.lag("row_count").over(days)))
    ratio_ok = F.col("prev_row_count").isNull() | (F.col("row_count") >= F.col("prev_row_count") * F.lit(min_ratio))
    ok = (F.col("row_count") >= min_rows) & ratio_ok
    return j.select("region_code", "transaction_date", F.col("row_count").cast("bigint"),
                    F.col("prev_row_count").cast("bigint"),
                    F.try_divide(F.col("row_count").cast("double"),
                                 F.col("prev_row_count").cast("double")).alias("day_ratio"),
                    F.when(ok, "Y").otherwise("N").alias("gate_passed"))


def source_availability(src_sales: DataFrame, load_date: _dt.date | None = None) -> DataFrame:
    """D8 pre-check: source rows per business day (one day when ``load_date``
    is given).  A day with no row is reported with 0 rows and not available."""
    d = F.col("txn_datetime").cast("date")
    src = src_sales if load_date is None else src_sales.where(business_day(src_sales, load_date, load_date))
    counts = src.groupBy(d.alias("business_date")).agg(F.count(F.lit(1)).cast("bigint").alias("source_rows"))
    if load_date is not None:   # the requested day appears even when the source has nothing for it
        day = src_sales.sparkSession.createDataFrame([(load_date,)], "business_date date")
        counts = day.join(counts, "business_date", "left").select(
            "business_date", F.coalesce("source_rows", F.lit(0)).cast("bigint").alias("source_rows"))
    return counts.withColumn("available", F.when(F.col("source_rows") > 0, "Y").otherwise("N"))


def audit_counts(rollup: DataFrame) -> DataFrame:
    """A10: rollup rows written per region and day (the audit log's count)."""
    return (rollup.groupBy("region_code", "summary_date")
            .agg(F.count(F.lit(1)).cast("bigint").alias("rollup_rows")))


# --------------------------------------------------------------------------- I12
def constraint_audit(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """I12 (keys, NOT NULL, widths): one row per (table, constraint, column)
    with the number of violating rows.  Each table is read once: an aggregate by
    the primary key carries the NOT NULL and width counts on to the total."""
    parts = []
    for name, (df, pk) in tables.items():
        checks = []
        for c in S.NOT_NULL.get(name, ()):
            if c in df.columns:
                checks.append(("NOT_NULL", c, F.count_if(F.col(c).isNull())))
        for c, w in S.DECLARED_WIDTHS.get(name, {}).items():
            if c in df.columns:
                checks.append(("WIDTH", c, F.count_if(F.length(F.col(c)) > w)))
        by_key = df.groupBy(pk).agg(F.count(F.lit(1)).alias("_n"), *[e.alias(f"_v{i}") for i, (_, _, e) in enumerate(checks)])
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
        sums = [("PK_UNIQUE", pk, total(F.when(F.col("_n") > 1, F.col("_n")))),
                *[(k, c, total(F.col(f"_v{i}"))) for i, (k, c, _) in enumerate(checks)]]
        arr = F.array(*[F.struct(F.lit(k).alias("constraint_type"), F.lit(c).alias("column_name"), e.alias("violation_rows"))
                        for k, c, e in sums])
        parts.append(by_key.agg(arr.alias("_a")).select(F.lit(name).alias("table_name"), F.inline("_a")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def foreign_key_audit(checks: list[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """I12 (foreign keys): ``(child_name, child, fk, parent_name, parent, pk)``
    -> rows whose non-NULL key has no parent row (a left-anti join on the
    distinct parent keys; NULL keys are allowed, as in SQL)."""
    parts = []
    for child_name, child, fk, parent_name, parent, pk in checks:
        keys = parent.select(F.col(pk).alias("_pk")).distinct()
        orphans = child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).cast("bigint").alias("orphan_rows"))
                     .select(F.lit(child_name).alias("table_name"), F.lit(fk).alias("column_name"),
                             F.lit(parent_name).alias("parent_table"), "orphan_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
