"""K1: incremental load.  The reference's PENDING -> LOADED status protocol is
'consume every staged row exactly once'; here the file source's checkpoint
records which files were consumed, and each micro-batch runs the load.

``foreachBatch`` is at-least-once (a batch can be replayed after a failure),
so the batch function must be idempotent -- the slice writes of
``saleslake.sources.store`` (dynamic partition overwrite) are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import states
from ..operators.keys import stored
from ..sources import store


def incremental_load(spark: SparkSession, landing_dir: str, schema: T.StructType,
                     checkpoint_dir: str, process: Callable[[DataFrame, int], None],
                     fmt: str = "parquet", max_files_per_trigger: int | None = None) -> int:
    """Consume every file that arrived in ``landing_dir`` since the last run,
    then stop (``availableNow``).  Returns the number of micro-batches run."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    batches = []

    def run(df: DataFrame, epoch: int) -> None:
        batches.append(epoch)
        process(df, epoch)

    q = (reader.load(landing_dir).writeStream.foreachBatch(run)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


LOAD = "batch_epoch"


def fact_and_summary(fact_path: str, summary_path: str | None, fact_of: Callable[[DataFrame], DataFrame]):
    """A batch function: staged rows -> fact rows -> touched summary slices.

    * the batch's facts go to ``fact_path/batch_epoch=<epoch>`` (dynamic overwrite): a
      replayed epoch rewrites its own folder, nothing doubles.  Files are range-partitioned
      by date and region, so that each holds few dates;
    * the batch's summary states (totals and key sets, ``operators.states``) go to
      ``<summary_path>_states/*/batch_epoch=<epoch>``, likewise, and the regional summary of every
      (date, region) the batch touched is merged from the states of all epochs.  Of the facts only this
      batch's are read, however many epochs a slice has.  Skipped when ``summary_path`` is None.
    """
    def process(batch: DataFrame, epoch: int) -> None:
        facts = stored(fact_of(batch).withColumn(LOAD, F.lit(epoch).cast("bigint")))
        (facts.repartitionByRange("transaction_date", "region_code").sortWithinPartitions("transaction_date", "region_code")
         .write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(LOAD).parquet(fact_path))
        if summary_path is None or facts.isEmpty():
            return
        states.write_states(facts, f"{summary_path}_states", LOAD)
        store.refresh_summary(states.merged_summary(facts, f"{summary_path}_states"), summary_path)
    return process
