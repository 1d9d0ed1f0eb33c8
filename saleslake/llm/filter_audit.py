"""Operator 12: how filters interact - what each removes, repeats or costs in every order they may be applied.

Each filter has a stored table of the ids (row numbers) of the documents that fail it.  The documents' rows go through the
tables one after the other: a left-semi join finds those that fail the filter, a left-anti join those that pass, and both
go on, with the filter's bit set or not.  Documents of a part that fail the same filters are then one relation,
counted once.  For each of the prefixes (the sets of filters that come before a filter in some order, 80 for five
filters) a left-anti join of these relations with those that the prefix removes gives the survivors, a left-semi
join of the survivors with those that fail the filter its removals, a left-semi join of the others the redundant ones.  All orders
are read off the prefixes.  Only ids, parts and label flags are joined, never texts.

Defined results: null text counts as empty, a null part as the empty string; every row is a document, repeated ids
too; a null id has no labels and never fails the duplicate filter, nor makes others fail it; a label repeated for an id counts
if any of its rows has it; an empty table gives no rows; very long texts are read whole; further columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import ASCII_SPACE, scratch_path, text_of, union_all, written
from saleslake.operators.skew import heavy_hitter_join

SPACES = " \t\n\x0b\f\r"


def text_filters() -> dict[str, Column]:
    """Filters A to D as failure conditions over the columns of ``text_features``."""
    return {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * F.col("n_upper") > 2 * F.col("n_chars"),
        "D": F.col("has_markup"),
    }


def text_features(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """row, doc_id, part, digest of the text, and the numbers that filters look at."""
    whole = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text_of(text_col).alias("text"))
    words = whole.withColumn("words", F.split(F.btrim("text", F.lit(SPACES)), ASCII_SPACE))
    some = F.length(F.btrim("text", F.lit(SPACES))) > 0
    return words.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.when(some, F.size("words")).otherwise(0).cast("long").alias("n_words"),
        F.when(some, F.size(F.array_distinct("words"))).otherwise(0).cast("long").alias("n_distinct"),
        F.length("text").cast("long").alias("n_chars"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"), F.col("text").rlike(r"[#$%&*|]").alias("has_markup"))


def _duplicates(features: DataFrame) -> DataFrame:
    """Rows whose text a smaller id has."""
    first = (features.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("digest", "first"))
    rows = features.select("row", "doc_id", "digest")
    return heavy_hitter_join(rows, first, ["digest"], spread=["row"]).where("doc_id > first").select("row")


def failing_ids(docs: DataFrame, filters: dict[str, Column] | None = None, duplicate: str | None = "E", id_col: str = "doc_id",
                text_col: str = "text", part_col: str = "source") -> tuple[DataFrame, dict[str, DataFrame]]:
    """The stored rows (row, doc_id, part) and per filter the stored table (row) of those that fail it.

    ``filters``: name -> failure condition over ``text_features``; ``duplicate``: name of the filter that fails texts
    which a smaller id has, None for none.  Filters are in the order of their names.
    """
    spark = docs.sparkSession
    filters = text_filters() if filters is None else filters
    features = text_features(docs, id_col, text_col, part_col)
    fails = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in filters.items()]))
    rows = written(features.select("row", "doc_id", "part", "digest", fails.alias("fails")), "audit-rows")
    path = scratch_path(spark, "audit-failing")
    rows.select("row", F.explode("fails").alias("filter")).write.partitionBy("filter").parquet(path)
    every = spark.read.schema("row long, filter string").parquet(path)
    tables = {n: every.where(F.col("filter") == n).select("row") for n in filters}
    if duplicate:
        tables[duplicate] = written(_duplicates(rows), "audit-duplicates")
    return rows.select("row", "doc_id", "part"), dict(sorted(tables.items()))


def survivors(rows: DataFrame, tables: dict[str, DataFrame], prefix: str | list[str]) -> DataFrame:
    """The rows that are left after the filters of ``prefix``: one left-anti join with each one's id table."""
    for name in prefix:
        rows = rows.join(tables[name], "row", "left_anti")
    return rows


def failing_sets(rows: DataFrame, tables: dict[str, DataFrame], labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """part, failed (bits of the filters that the documents fail), docs, good, toxic."""
    of = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    level = heavy_hitter_join(rows, of, ["doc_id"], "left", spread=["row"]).select(
        "row", "part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), F.lit(0).alias("failed"))
    level = written(level, "audit-level")
    for bit, table in enumerate(tables.values()):
        caught = level.join(table, "row", "left_semi").withColumn("failed", F.col("failed").bitwiseOR(F.lit(1 << bit)))
        level = written(caught.unionByName(level.join(table, "row", "left_anti")), "audit-level")
    return level.groupBy("part", "failed").agg(
        F.count("*").alias("docs"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, duplicate: str | None = "E",
          id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row per part, order of all filters and step (from 1); the numbers of orders and prefixes grow with the
    factorial and the power of the number of filters, so it is meant for a handful of them.
    """
    spark = docs.sparkSession
    rows, tables = failing_ids(docs, filters, duplicate, id_col, text_col, part_col)
    names, every = list(tables), (1 << len(tables)) - 1
    sets = written(failing_sets(rows, tables, labels, id_col), "audit-sets")

    # fixed relations over the bits: the sets that a prefix removes, the sets that fail a filter
    bits = [1 << b for b in range(len(names))]
    prefixes = [(p, f) for f in bits for p in range(every + 1) if not p & f]
    removes = spark.createDataFrame([(p, s) for p in range(every + 1) for s in range(every + 1) if p & s], "prefix int, failed int")
    fails = spark.createDataFrame([(f, s) for f in bits for s in range(every + 1) if f & s], "filter int, failed int")

    pairs = F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(f).alias("filter")) for p, f in prefixes])
    cells = sets.withColumn("at", F.explode(pairs)).select("part", "failed", "docs", "good", "toxic", "at.prefix", "at.filter")
    alive = cells.join(removes, ["prefix", "failed"], "left_anti")
    gone = cells.join(removes, ["prefix", "failed"], "left_semi")
    removed = alive.join(fails, ["filter", "failed"], "left_semi")
    passed = alive.join(fails, ["filter", "failed"], "left_anti")
    redundant = gone.join(fails, ["filter", "failed"], "left_semi")
    measured = union_all([
        cells.select("part", "prefix", "filter", *_measures()),
        passed.select("part", "prefix", "filter", *_measures(kept="docs")),
        removed.select("part", "prefix", "filter", *_measures(removed="docs", good_lost="good", toxic_lost="toxic")),
        redundant.select("part", "prefix", "filter", *_measures(redundant="docs"))])
    table = written(measured.groupBy("part", "prefix", "filter").agg(*[F.sum(m).alias(m) for m in MEASURES]), "audit-prefixes")

    # what depends on the filter alone: removals after all others, and removals summed over all orders
    before = F.bit_count("prefix")
    weight = F.element_at(F.array(*[F.lit(factorial(b) * factorial(len(names) - 1 - b)).cast("long") for b in range(len(names))]), before + 1)
    whole = table.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("prefix") == every - F.col("filter"), F.col("removed")).otherwise(0)).alias("unique_fails"),
        F.sum(F.col("removed") * weight).alias("shapley"))
    steps = [("".join(order), k + 1, sum(1 << names.index(n) for n in order[:k]), 1 << names.index(order[k]))
             for order in permutations(names) for k in range(len(names))]
    orders = spark.createDataFrame(steps, "filter_order string, step int, prefix int, filter int")
    return table.join(whole, ["part", "filter"]).join(orders, ["prefix", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


MEASURES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")


def _measures(**of: str) -> list[Column]:
    return [(F.col(of[m]) if m in of else F.lit(0)).cast("long").alias(m) for m in MEASURES]
