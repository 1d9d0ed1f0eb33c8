"""Operator 1: exact deduplication as a stateful stream with disk-backed state.

Every row becomes a small record: digest of the normalised text, stable identifier, content locator.
Structured Streaming groups the records by digest; the state store is RocksDB, there is no watermark
and so no expiry.  The state of a digest is the smallest (identifier, row, locator) seen and the number of rows.
The grouping combines on the map side, so a text that holds a third of all rows reaches its state
partition as one record per task.

A digest seen twice is a hit.  The texts of hits are read again and grouped by (digest, full bytes):
equality of bytes, not of digests, decides.  Should one digest cover different texts, its rows are
classed by their bytes.

Defined results: null text counts as empty; a null id sorts after all others; of repeated rows
(same id, same text) one is kept; an empty table gives no rows; further columns, whatever their names, are ignored
by ``exact_dedup`` and returned unchanged by ``drop_exact_copies``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslake.llm.common import ASCII_SPACE, text_of, written
from saleslake.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Parts into which the rows of one digest are dealt when hits are read again.
SALTS = 8


def normalised(text_col: str = "text") -> Column:
    """Each run of ASCII white space replaced by one space."""
    return F.regexp_replace(text_of(text_col), ASCII_SPACE, " ")


def sha256_of(text: Column) -> Column:
    return F.sha2(text, 256)


def _stream_state(spark: SparkSession, path: str, schema, files_per_trigger: int | None) -> DataFrame:
    """Run the records at ``path`` through the keyed state; the last state of every digest."""
    out, epochs = scratch_path(spark, "dedup-state"), []

    def keep_epoch(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/{epoch}")
        epochs.append(f"{out}/{epoch}")

    store = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
             # many small stores: no disk space ahead of need, and only changes are uploaded
             "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
             "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
             "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
             "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256"}
    before = {k: spark.conf.get(k, None) for k in store}
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    states = (reader.parquet(path).groupBy("digest")
              .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "place")).alias("keep"),
                   F.count("*").alias("n")))
    try:
        for k, v in store.items():
            spark.conf.set(k, v)
        (states.writeStream.outputMode("update").foreachBatch(keep_epoch).trigger(availableNow=True)
         .option("checkpointLocation", scratch_path(spark, "dedup-checkpoint")).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if not epochs:
        return spark.createDataFrame([], states.schema)
    # a digest is written again by each epoch that met it: its state only ever falls (keep) or rises (n)
    seen = spark.read.schema(states.schema).parquet(*epochs)
    return seen.groupBy("digest").agg(F.min("keep").alias("keep"), F.max("n").alias("n")) if len(epochs) > 1 else seen


def _texts(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """id, text, digest, and the row itself as a struct, so that no column of ``docs`` can clash."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
                       F.col(f"`{id_col}`").alias("id"), normalised(text_col).alias("text"))
    return rows.withColumn("digest", digest(F.col("text")))


def _classes(texts: DataFrame, files_per_trigger: int | None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Records; the state of each digest; the byte-checked classes of digests that cover different texts, or None."""
    spark = texts.sparkSession
    path = scratch_path(spark, "dedup-records")
    records = texts.select("digest", "id", F.monotonically_increasing_id().alias("row"),
                           F.input_file_name().alias("place"), F.sha2("text", 256).alias("sha"))
    records.write.parquet(path)
    state = _stream_state(spark, path, records.schema, files_per_trigger)
    hits = state.where("n > 1").select("digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = texts.select("id", "text", "digest", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    checked = (salted.join(hits, ["digest", "salt"], "left_semi").groupBy("digest", "text")
               .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("keep"), F.count("*").alias("n")))
    checked = written(checked.select("digest", "text", F.col("keep.id").alias("keep_id"), "n")
                      .withColumn("texts", F.count("*").over(Window.partitionBy("digest"))).where("texts > 1"),
                      "dedup-classes")
    return spark.read.schema(records.schema).parquet(path), state, None if checked.isEmpty() else checked


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256_of,
                files_per_trigger: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    texts = _texts(docs, id_col, text_col, digest)
    records, state, classes = _classes(texts, files_per_trigger)
    plain = records.join(state, "digest").select(
        F.col("id").alias("doc_id"), F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"),
        (records["row"] == F.col("keep.row")).alias("kept"), F.col("sha").alias("text_sha256"), "digest")
    if classes is None:
        return plain.drop("digest")
    order = Window.partitionBy("digest", "text").orderBy(F.col("id").asc_nulls_last())
    clashed = texts.drop("whole").join(classes, ["digest", "text"]).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"), F.sha2("text", 256).alias("text_sha256"))
    return plain.join(classes.select("digest"), "digest", "left_anti").drop("digest").unionByName(clashed)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      digest: Callable[[Column], Column] = sha256_of) -> DataFrame:
    """``docs`` without exact copies, all columns unchanged; of equal texts the row with the smallest id stays.

    Rows meet their keeper's record on (digest, id): the rows of one large group have different ids
    and so are dealt over all tasks.
    """
    texts = _texts(docs, id_col, text_col, digest)
    _, state, classes = _classes(texts, None)
    name = lambda c: F.coalesce(c.cast("string"), F.lit("null"))  # noqa: E731 - a join key that is never null
    texts = texts.select("whole", "digest", name(F.col("id")).alias("key"), "text")
    keepers = state.select("digest", name(F.col("keep.id")).alias("key"))
    if classes is None:
        once = Window.partitionBy("digest", "key").orderBy("digest")
        kept = texts.drop("text").join(keepers, ["digest", "key"])
        return kept.withColumn("nth", F.row_number().over(once)).where("nth = 1").select("whole.*")
    clash = classes.select("digest").distinct()
    once = Window.partitionBy("digest", "key", "text").orderBy("digest")
    by_digest = texts.join(keepers.join(clash, "digest", "left_anti"), ["digest", "key"])
    by_text = texts.join(classes.select("digest", "text", name(F.col("keep_id")).alias("key")), ["digest", "text", "key"])
    kept = by_digest.unionByName(by_text)
    return kept.withColumn("nth", F.row_number().over(once)).where("nth = 1").select("whole.*")
