"""The pipeline's stages on a small table, each judged on its own input."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from saleslake.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("key", F.lit("k"))
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        counts.append(out.count())
        assert out.join(docs, "doc_id", "left_anti").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[0]
    assert counts[2] < counts[0]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]


def test_near_duplicates_and_leaks_go_clean_documents_stay(spark):
    base = " ".join(f"word{i}" for i in range(300))
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(1, base, "en", "s", 1), (2, base + " word300", "en", "s", 1), (3, base, "en", "s", 1), (4, "other " + base[::-1], "en", "s", 1),
            (5, "before " + leak.upper() + " after", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(corpus_pipeline.exact_dedup_stage(spark, docs, SF)) == [1, 2, 4, 5]
    assert ids(corpus_pipeline.simhash_stage(spark, docs, SF)) == [1, 4, 5]
    assert ids(corpus_pipeline.decontamination_stage(spark, docs, SF)) == [1, 2, 3, 4]


def test_run_and_queries(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_odd_rows_through_all_stages(spark):
    """Null and empty texts, null and repeated ids, repeated rows, a very long text, clashing columns; and no documents at all."""
    rows = [(1, None, None, None, None, "a"), (2, "", "en", "s", 0, "b"), (None, "a text without an id of some length", "en", "s", 1, "c"),
            (3, "one text twice", "en", "s", 1, "d"), (3, "one text twice", "en", "s", 1, "d"), (3, "another with that id", "en", "s", 1, "e"),
            (4, "long word " * 30_000, "en", "s", 1, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, Digest string")
    for given in (docs, docs.limit(0)):
        left = given
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, left, SF)
            assert left.columns == docs.columns, name
        packed = corpus_pipeline.STAGES[-1][1](spark, left, SF)
        assert packed.select("doc_id").distinct().count() == left.select("doc_id").distinct().count()
    texts = [r.text for r in corpus_pipeline.exact_dedup_stage(spark, docs, SF).collect()]
    assert len(texts) == 5 and texts.count("one text twice") == 1                 # null and empty are equal texts


@pytest.mark.skipif(not os.path.exists(f"{SF}/pages.parquet"), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    import duckdb
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, cur.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*names).collect())
