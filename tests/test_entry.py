import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"region_code", "summary_date", "total_revenue"} <= set(df.columns)


def test_queries_and_oracle_keys(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 80
    for k in q:
        assert k.split("_", 1)[0][0] in "abcdefgijk" or k.startswith("op") or k == "pipeline"
