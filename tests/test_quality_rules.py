import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleslake.operators import quality, rules

D1 = dt.date(1998, 1, 1)


def fact(spark, rows):
    return spark.createDataFrame(rows, "transaction_date date, dim_product_key bigint, net_amount decimal(16,4)")


def test_dq_rules_one_scan_bad_rule_isolated_thresholds(spark):
    f = fact(spark, [(D1, 1, Decimal("5")), (D1, None, Decimal("-1")), (D1, 3, None),
                     (dt.date(1998, 1, 2), 4, Decimal("1"))])
    summ = spark.createDataFrame([(D1, 3)], "summary_date date, n int")
    rows = quality.BUILTIN_RULES + [(9, "BROKEN", "FACT_DAILY_SALES", "RANGE_CHECK", "nope > 0", 0.0, "WARNING")]
    rdf = quality.rules_frame(spark, rows)
    tables = {"FACT_DAILY_SALES": f, "FACT_REGIONAL_SUMMARY": summ}
    dates = {"FACT_DAILY_SALES": "transaction_date", "FACT_REGIONAL_SUMMARY": "summary_date"}
    res = {(r.rule_name, r.check_date): r for r in
           quality.run_checks(quality.load_rules(rdf, "RETAIL"), tables, dates).collect()}
    nulls = res[("NULL_PRODUCT_KEY", D1)]
    assert (nulls.total_rows, nulls.failed_rows, nulls.fail_pct, nulls.passed) == (3, 1, 33.3333, False)
    neg = res[("NEGATIVE_NET_AMOUNT", D1)]          # NULL predicate does not fail
    assert (neg.failed_rows, neg.status) == (1, "FAIL")
    assert res[("REGIONAL_SUMMARY_PRESENT", D1)].total_rows == 1
    assert res[("BROKEN", None)].severity == "ERROR" and res[("BROKEN", None)].passed is False
    assert res[("NULL_PRODUCT_KEY", dt.date(1998, 1, 2))].passed is True   # 0 <= 0.01 (threshold 0)
    # a single load date on an empty slice reports 0 rows, pct 0 (no crash)
    empty = quality.run_checks(quality.load_rules(rdf, "RETAIL")[:1], tables, dates,
                               load_date=dt.date(2000, 1, 1)).first()
    assert (empty.total_rows, empty.fail_pct, empty.passed) == (0, 0.0, True)
    summary = quality.dq_summary(quality.run_checks(quality.load_rules(rdf, "RETAIL"), tables, dates,
                                                    load_date=D1))
    s = summary.where(F.col("check_date") == D1).first()
    assert (s.critical_failures, s.total_rules) == (1, 4)
    res_d1 = quality.run_checks(quality.load_rules(rdf, "RETAIL"), tables, dates, load_date=D1)
    with pytest.raises(quality.CriticalDQFailure):
        quality.dq_gate(res_d1, fail_on_critical=True)
    assert quality.dq_gate(res_d1, fail_on_critical=False) == 1


def test_referential_and_generic_rules(spark):
    """Without a parent table a NULL key fails; with one, a key missing from
    the parent fails too (a NULL child key never matches).  A duplicated parent
    key does not multiply fact rows.  J5: the fragment returns the failed count."""
    f = fact(spark, [(D1, 1, Decimal("5")), (D1, 2, Decimal("0")), (D1, 7, Decimal("1")), (D1, None, Decimal("2"))])
    dim = spark.createDataFrame([(1,), (2,), (2,)], "dim_product_key bigint")
    rdf = quality.rules_frame(spark, [
        (11, "KEY_SET", "FACT_DAILY_SALES", "REFERENTIAL_CHECK", "dim_product_key", 50.0, "WARNING"),
        (12, "PRODUCT_FK", "FACT_DAILY_SALES", "REFERENTIAL_CHECK", "dim_product_key", 0.0, "CRITICAL",
         "DIM_PRODUCT", "dim_product_key"),
        (14, "ZERO_NET", "FACT_DAILY_SALES", "GENERIC", "count_if(net_amount = 0)", 30.0, "WARNING")])
    res = {r.rule_id: r for r in quality.run_checks(
        quality.load_rules(rdf, "RETAIL"), {"FACT_DAILY_SALES": f, "DIM_PRODUCT": dim},
        {"FACT_DAILY_SALES": "transaction_date"}).collect()}
    assert (res[11].total_rows, res[11].failed_rows, res[11].passed) == (4, 1, True)
    assert (res[12].total_rows, res[12].failed_rows, res[12].fail_pct, res[12].status) == (4, 2, 50.0, "FAIL")
    assert (res[14].failed_rows, res[14].fail_pct, res[14].passed) == (1, 25.0, True)


def test_strict_threshold(spark):
    f = fact(spark, [(D1, 1, Decimal("5"))] * 9999 + [(D1, None, Decimal("5"))])
    rdf = quality.rules_frame(spark, quality.BUILTIN_RULES[:1])
    lax = quality.run_checks(quality.load_rules(rdf, "RETAIL"), {"FACT_DAILY_SALES": f},
                             {"FACT_DAILY_SALES": "transaction_date"}).first()
    strict = quality.run_checks(quality.load_rules(rdf, "RETAIL"), {"FACT_DAILY_SALES": f},
                                {"FACT_DAILY_SALES": "transaction_date"}, strict_threshold=True).first()
    assert lax.fail_pct == 0.01 and lax.passed is True and strict.passed is False


def test_category_rules_ordered_isolated_and_cross_category(spark):
    dim = spark.createDataFrame(
        [(1, "A", Decimal("10"), D1, "Y", "x"), (2, "B", Decimal("10"), D1, "Y", "y"),
         (3, "A", Decimal("10"), dt.date(1997, 1, 1), "Y", "z"), (4, "A", Decimal("10"), D1, "N", "w")],
        "dim_product_key bigint, category_code string, list_price decimal(12,4), valid_from date, "
        "is_current string, product_name string")
    rl = spark.createDataFrame(
        [("A", "double", "list_price", "list_price * 2", "Y", 1),
         ("A", "plus_one", "list_price", "list_price + 1", "Y", 2),     # sees rule 1's result
         ("A", "broken", "list_price", "missing_col", "Y", 3),
         ("A", "move_to_b", "category_code", "'B'", "Y", 4),
         ("B", "rename", "product_name", "upper(product_name)", "Y", 1),  # also hits the moved row
         ("B", "bad_target", "dim_product_key", "0", "Y", 2),
         ("A", "inactive", "list_price", "0", "N", 5)],
        "category_code string, rule_name string, col_target string, rule_expr string, is_active string, "
        "execution_order int")
    notes = []
    out = {r.dim_product_key: r for r in rules.apply_category_rules(dim, rl, D1, notes).collect()}
    assert out[1].list_price == Decimal("21.0000") and out[1].category_code == "B" and out[1].product_name == "X"
    assert out[2].product_name == "Y" and out[2].dim_product_key == 2
    assert out[3].list_price == Decimal("10.0000") and out[4].list_price == Decimal("10.0000")
    skipped = {n.rule_name for n in notes if not n.applied}
    assert skipped == {"broken", "bad_target"}


def test_supplier_enrichment_latest_effective(spark):
    dim = spark.createDataFrame(
        [(1, 10, Decimal("1"), Decimal("1"), D1, "Y"), (2, 10, Decimal("1"), Decimal("1"), dt.date(1990, 1, 1), "Y"),
         (3, 20, Decimal("1"), Decimal("1"), dt.date(1990, 1, 1), "Y"),
         (1, 10, Decimal("1"), Decimal("1"), dt.date(1990, 1, 1), "N")],
        "product_id bigint, supplier_id bigint, list_price decimal(12,4), cost_price decimal(12,4), "
        "valid_from date, is_current string")
    feed = spark.createDataFrame(
        [(10, 1, Decimal("5"), Decimal("4"), dt.date(1997, 1, 1)), (10, 1, Decimal("6"), Decimal("4"), dt.date(1997, 6, 1)),
         (10, 1, Decimal("9"), Decimal("9"), dt.date(1999, 1, 1)), (10, 2, Decimal("7"), Decimal("7"), dt.date(1997, 1, 1)),
         (20, 3, Decimal("8"), Decimal("8"), dt.date(1997, 1, 1))],
        "supplier_id bigint, product_id bigint, list_price decimal(12,4), cost_price decimal(12,4), effective_date date")
    out = sorted(((r.product_id, r.is_current, str(r.list_price)) for r in
                  rules.enrich_from_suppliers(dim, feed, D1).collect()))
    # supplier 20 opened no version today -> product 3 untouched; closed rows untouched
    assert out == [(1, "N", "1.0000"), (1, "Y", "6.0000"), (2, "Y", "7.0000"), (3, "Y", "1.0000")]


def test_staging_metrics_and_gates(spark):
    st = spark.createDataFrame(
        [(D1, "ASIA", 1, 1, 1, Decimal("0")), (D1, "ASIA", None, 1, 2, Decimal("3")),
         (D1, "ASIA", 2, None, 1, Decimal("3"))],
        "transaction_date date, region_code string, product_id bigint, customer_id bigint, store_id bigint, "
        "unit_price decimal(12,4)")
    m = {r.metric: r.value for r in quality.staging_metrics(st).collect()}
    assert m == {"TOTAL_ROWS": 3, "NULL_PRODUCT_ID": 1, "NULL_CUSTOMER_ID": 1, "ZERO_AMOUNT_ROWS": 1,
                 "DISTINCT_STORES": 2, "DISTINCT_PRODUCTS": 2}
    f = spark.createDataFrame([(D1, "ASIA")] * 120 + [(D1 + dt.timedelta(days=1), "ASIA")] * 95
                              + [(D1 + dt.timedelta(days=2), "ASIA")] * 130,
                              "transaction_date date, region_code string")
    g = {r.transaction_date: r.gate_passed for r in quality.day_ratio_gate(f).collect()}
    assert list(g.values()) and g[D1] == "Y" and g[D1 + dt.timedelta(days=1)] == "N" \
        and g[D1 + dt.timedelta(days=2)] == "Y"
    rc = quality.row_count_gate(st.where("1 = 0"), f.where("1 = 0"))
    assert rc.count() == 0


def test_constraint_and_foreign_key_audits(spark):
    """Duplicated keys count every row of the duplicate group; NOT NULL and
    declared widths count violating rows; a NULL foreign key is not an orphan."""
    dim = spark.createDataFrame([(1, 10, "P1", D1), (1, 11, "P1", D1), (2, None, "X" * 21, D1), (3, 13, "P3", None)],
                                "dim_product_key bigint, product_id bigint, product_code string, valid_from date")
    got = {(r.constraint_type, r.column_name): r.violation_rows
           for r in quality.constraint_audit({"dim_product": (dim, "dim_product_key")}).collect()}
    assert got[("PK_UNIQUE", "dim_product_key")] == 2
    assert (got[("NOT_NULL", "product_id")], got[("NOT_NULL", "valid_from")]) == (1, 1)
    assert got[("WIDTH", "product_code")] == 1
    child = spark.createDataFrame([(1,), (2,), (5,), (None,), (5,)], "dim_product_key bigint")
    fk = quality.foreign_key_audit([("fact_daily_sales", child, "dim_product_key", "dim_product", dim,
                                     "dim_product_key")]).first()
    assert (fk.table_name, fk.parent_table, fk.orphan_rows) == ("fact_daily_sales", "dim_product", 2)


def test_run_time_failures_subqueries_and_fallback(spark):
    """A rule that fails while it runs is an ERROR row, the others go on; J3: a fragment may hold a
    subquery; J7: without active rules the built-in ones run."""
    f = fact(spark, [(D1, 1, Decimal("5")), (D1, 2, Decimal("0")), (D1, 7, Decimal("1"))])
    dim = spark.createDataFrame([(1,), (2,)], "dim_product_key bigint")
    rdf = quality.rules_frame(spark, [
        (1, "DIVIDES", "FACT_DAILY_SALES", "RANGE_CHECK", "1 / net_amount > 0", 0.0, "WARNING"),
        (2, "POSITIVE", "FACT_DAILY_SALES", "RANGE_CHECK", "net_amount >= 0", 0.0, "WARNING"),
        (3, "IN_DIM", "FACT_DAILY_SALES", "REFERENTIAL_CHECK",
         "SELECT max(d.dim_product_key) FROM DIM_PRODUCT d WHERE d.dim_product_key = FACT_DAILY_SALES.dim_product_key", 0.0, "CRITICAL"),
        (4, "BAD_QUERY", "FACT_DAILY_SALES", "REFERENTIAL_CHECK", "SELECT x FROM NOWHERE", 0.0, "CRITICAL")])
    tables = {"FACT_DAILY_SALES": f, "DIM_PRODUCT": dim}
    res = {r.rule_id: r for r in quality.run_checks(quality.load_rules(rdf, "RETAIL"), tables,
                                                    {"FACT_DAILY_SALES": "transaction_date"}, load_date=D1).collect()}
    assert (res[1].severity, res[1].passed, res[4].severity) == ("ERROR", False, "ERROR")
    assert (res[2].total_rows, res[2].status) == (3, "PASS")
    assert (res[3].total_rows, res[3].failed_rows, res[3].status) == (3, 1, "FAIL")
    assert [r["rule_name"] for r in quality.load_rules(rdf, "NO_SUCH_DOMAIN")] == [r[1] for r in quality.BUILTIN_RULES]


def test_category_rule_that_fails_while_it_runs_is_skipped(spark):
    dim = spark.createDataFrame([(1, "A", Decimal("0"), D1, "Y")],
                                "dim_product_key bigint, category_code string, list_price decimal(12,4), valid_from date, is_current string")
    rl = spark.createDataFrame([("A", "inverse", "list_price", "1 / list_price", "Y", 1), ("A", "plus", "list_price", "list_price + 1", "Y", 2)],
                               "category_code string, rule_name string, col_target string, rule_expr string, is_active string, execution_order int")
    notes = []
    assert rules.apply_category_rules(dim, rl, D1, notes).first().list_price == Decimal("1.0000")
    assert [(n.rule_name, n.applied) for n in notes] == [("inverse", False), ("plus", True)]


def test_null_regions_are_kept(spark):
    """Groups without a region rank and count like any other."""
    from saleslake.operators import rollups
    cols = ("region_code string, dim_product_key bigint, fiscal_year int, fiscal_month int, net_amount decimal(16,4), "
            "quantity decimal(8,2), transaction_date date")
    f = spark.createDataFrame([(r, k, 1998, 1, Decimal(k), Decimal(1), D1) for r, k in
                               ((None, 1), (None, 2), (None, 3), ("ASIA", 4), ("ASIA", 5))], cols)
    ranks = rollups.product_rankings(f).collect()
    assert sorted((r.region_code or "", r.revenue_rank) for r in ranks) == [("", 1), ("", 2), ("", 3), ("ASIA", 1), ("ASIA", 2)]
    gate = quality.row_count_gate(f, f, min_rows=3).collect()
    assert sorted((r.region_code or "", r.staged_rows, r.fact_rows, r.staging_gate) for r in gate) == [
        ("", 3, 3, "OK"), ("ASIA", 2, 2, "BELOW_MINIMUM")]
    empty = quality.row_count_gate(f.where("region_code = 'ASIA'"), f, min_rows=3).where("region_code is null").first()
    assert (empty.staging_gate, empty.fact_gate) == ("EMPTY_NOOP", "FACT_LOADED")


def test_subquery_rules_query_the_frames_given(spark):
    """A view of the rule's table name in the session is neither used nor replaced, and quoted text stays."""
    spark.createDataFrame([(None,)] * 5, "product_id bigint").createOrReplaceTempView("DIM_PRODUCT")
    rule = (1, "r", "FACT_DAILY_SALES", "RANGE_CHECK",
            "product_id IN (SELECT d.product_id FROM DIM_PRODUCT d) AND note <> 'DIM_PRODUCT'", 0.0, "CRITICAL")
    tables = {"FACT_DAILY_SALES": spark.createDataFrame([(1, "a"), (2, "b")], "product_id bigint, note string"),
              "DIM_PRODUCT": spark.createDataFrame([(1,), (2,)], "product_id bigint")}
    rules_df = quality.rules_frame(spark, [rule])
    r = quality.run_checks(quality.load_rules(rules_df, "RETAIL"), tables, {}).first()
    assert (r.total_rows, r.failed_rows, r.status) == (2, 0, "PASS")
    assert spark.table("DIM_PRODUCT").count() == 5
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("dq_")] == []
    spark.catalog.dropTempView("DIM_PRODUCT")


def test_rules_run_together_and_failing_ones_are_found(spark):
    """The number of jobs doesn't follow the number of rules; a rule that fails while it runs is left out alone."""
    day = dt.date(1998, 1, 1)
    dim = spark.createDataFrame([(1, "TOYS", "a", day, "Y"), (2, "FOOD", "b", day, "Y"), (3, "TOYS", "c", day, "N")],
                                "product_id int, category_code string, product_name string, valid_from date, is_current string")

    def run(exprs):
        rules_df = spark.createDataFrame([("TOYS", f"r{i:02}", "product_name", e, "Y", i) for i, e in enumerate(exprs)],
                                         "category_code string, rule_name string, col_target string, rule_expr string, is_active string, "
                                         "execution_order int")
        outcomes = []
        spark.sparkContext.setJobGroup(f"rules{len(exprs)}", "rules")
        out = rules.apply_category_rules(dim, rules_df, day, outcomes)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rules{len(exprs)}"))
        return {r.product_id: r.product_name for r in out.collect()}, [o.rule_name for o in outcomes if not o.applied], jobs

    few, _, jobs_of_few = run(["concat(product_name, '0')"] * 2)
    many, bad, jobs_of_many = run(["concat(product_name, '0')"] * 12)
    assert few == {1: "a00", 2: "b", 3: "c"} and many[1] == "a" + "0" * 12 and not bad
    assert jobs_of_many <= jobs_of_few + 2                    # sorting the rules themselves may take a job more
    broken = ["concat(product_name, '0')"] * 9
    broken[2] = broken[6] = "cast(raise_error('x') AS string)"
    broken[4] = "no_such_column"
    got, bad, _ = run(broken)
    assert got[1] == "a" + "0" * 6 and sorted(bad) == ["r02", "r04", "r06"]
