import datetime as dt
from decimal import Decimal

from saleslake.operators import clean

SRC = ("txn_id bigint, cust_id bigint, prod_id bigint, store_id bigint, txn_datetime timestamp_ntz, "
       "sold_qty decimal(8,2), unit_sell_price decimal(12,4), disc_amount decimal(12,4), "
       "store_region_cd string, currency string, payment_type_cd string, terminal_ref string, txn_status_cd string")


def src(spark, rows):
    return spark.createDataFrame(rows, SRC)


def row(i, status="COMPLETED", qty="1", price="10", disc="1", region=" asia ", prod=1):
    return (i, 7, prod, 3, dt.datetime(1998, 1, 1, 13, 5), Decimal(qty) if qty is not None else None,
            Decimal(price) if price is not None else None, Decimal(disc) if disc is not None else None,
            region, None, "CARD", "T3", status)


def test_extract_filters_and_defaults(spark):
    rows = [row(1), row(2, status="VOID"), row(3, status=None), row(4, qty="0"), row(5, price="-1"),
            row(6, price="0", disc=None), row(7, status="TEST"), row(8, status="  "), row(9, status=" VOID ")]
    out = {r.transaction_id: r for r in clean.extract_sales(src(spark, rows)).collect()}
    assert sorted(out) == [1, 6]
    r = out[1]
    assert r.region_code == "ASIA" and r.currency_code == "GBP" and r.etl_status == "PENDING"
    assert r.transaction_date == dt.date(1998, 1, 1) and r.load_batch_id == 19980101
    assert r.source_file_name == "ASIA_txn_1998-01-01" and r.discount_pct == Decimal("10.00")
    assert out[6].discount_amt == Decimal("0") and out[6].discount_pct == Decimal("0.00")


def test_extract_slice_parameters(spark):
    rows = [row(1), row(2, region="EUROPE")]
    out = clean.extract_sales(src(spark, rows), load_date=dt.date(1998, 1, 1), region="ASIA",
                              batch_id=42).collect()
    assert [(r.transaction_id, r.load_batch_id) for r in out] == [(1, 42)]


def test_split_is_total(spark):
    staged = spark.createDataFrame(
        [(1, Decimal("1"), Decimal("2"), 5), (2, None, Decimal("2"), 5), (3, Decimal("1"), Decimal("0"), 5),
         (4, Decimal("1"), Decimal("2"), None), (5, Decimal("-1"), None, None)],
        "transaction_id bigint, quantity decimal(8,2), unit_price decimal(12,4), product_id bigint")
    valid, reject = clean.split_valid(staged)
    assert sorted(r.transaction_id for r in valid.collect()) == [1]
    assert sorted(r.transaction_id for r in reject.collect()) == [2, 3, 4, 5]
    assert valid.count() + reject.count() == staged.count()
    reasons = {r.transaction_id: r.rejection_reason for r in
               clean.reject_records(reject.withColumn("region_code", staged.transaction_id.cast("string"))
                                    .withColumn("transaction_date", staged.transaction_id.cast("string")),
                                    dt.datetime(1998, 1, 2)).collect()}
    assert reasons[2] == "INVALID_QUANTITY" and reasons[3] == "INVALID_PRICE"
    assert reasons[5] == "INVALID_QUANTITY; INVALID_PRICE; MISSING_PRODUCT"


def test_scan_transactions_slice_status_and_lookup_pruning(spark):
    """A2 + B4: the graph's scan keeps COMPLETED rows with quantity > 0 of one
    slice (region matched after trim/upper case; the raw region is carried);
    A3: the product lookup keeps current versions and only its lookup columns."""
    from saleslake.operators import joins
    rows = [row(1), row(2, status="VOID"), row(3, qty="0"), row(4, region="EUROPE"), row(5, status=" COMPLETED ")]
    got = {r.transaction_id: r for r in clean.scan_transactions(src(spark, rows), dt.date(1998, 1, 1), "ASIA",
                                                                batch_id=7).collect()}
    assert sorted(got) == [1, 5]
    assert (got[1].region_code, got[1].load_batch_id, got[1].discount_pct) == (" asia ", 7, Decimal("10.00"))
    assert clean.scan_transactions(src(spark, rows), dt.date(1998, 1, 2), "ASIA").count() == 0
    dim = spark.createDataFrame(
        [(1, "P1", "a", "C", "S", Decimal("1"), "Y", dt.date(1998, 1, 1), dt.date(9999, 12, 31), 99),
         (1, "P1", "old", "C", "S", Decimal("1"), "N", dt.date(1990, 1, 1), dt.date(1997, 12, 31), 98)],
        "product_id bigint, product_code string, product_name string, category_code string, subcategory_code string, "
        "list_price decimal(12,4), is_current string, valid_from date, valid_to date, cost_price int")
    lk = joins.product_lookup(dim)
    assert lk.columns == list(joins.LOOKUP_COLUMNS) and [r.product_name for r in lk.collect()] == ["a"]


def test_region_and_day_reach_the_scan(spark, tmp_dir):
    """A2, B2: the spellings of a region and the range of a day are pushed filters; the rows are those of the exact test."""
    rows = [(1, " asia", "1998-01-01 10:00:00"), (2, "ASIA", "1998-01-01 23:59:59.9"), (3, "EUROPE", "1998-01-01 00:00:00"),
            (4, "Asia ", "1998-01-02 00:00:00"), (5, None, "1998-01-01 12:00:00")]
    src = spark.createDataFrame(rows, "txn_id long, store_region_cd string, at string").selectExpr(
        "txn_id", "store_region_cd", "cast(at AS timestamp_ntz) AS txn_datetime", "txn_id AS cust_id", "txn_id AS prod_id", "txn_id AS store_id",
        "cast(1 AS decimal(8,2)) AS sold_qty", "cast(2 AS decimal(12,4)) AS unit_sell_price", "cast(0 AS decimal(12,4)) AS disc_amount",
        "'COMPLETED' AS txn_status_cd", "'GBP' AS currency", "'C' AS payment_type_cd", "'T' AS terminal_ref")
    src.write.parquet(tmp_dir + "/src")
    src = spark.read.parquet(tmp_dir + "/src")
    day = dt.date(1998, 1, 1)
    spellings = clean.region_spellings(src)
    assert {k: sorted(v) for k, v in spellings.items()} == {"ASIA": [" asia", "ASIA", "Asia "], "EUROPE": ["EUROPE"]}
    for scan in (clean.extract_sales, clean.scan_transactions):
        got = scan(src, day, "ASIA", spellings=spellings)
        plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
        pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
        assert "In(store_region_cd" in pushed and "GreaterThanOrEqual(txn_datetime" in pushed and "LessThan(txn_datetime" in pushed
        ids = sorted(r.transaction_id for r in got.collect())
        assert ids == sorted(r.transaction_id for r in scan(src, day, "ASIA").collect()) == [1, 2]
    assert clean.extract_sales(src, day, "AFRICA", spellings=spellings).count() == 0
