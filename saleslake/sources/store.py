"""Sinks and table layout (A6-A8, A11-A14) on plain Parquet / CSV.

* slice tables (staging, fact, error files) are partitioned by
  ``(transaction_date, region_code)``: rerunning a slice replaces exactly that
  slice, which makes every append idempotent (A8, A12); a write that names
  its slices also empties those that got no rows;
* summaries, a few rows per date and region, are partitioned by region and month;
  replacing a slice writes its month again (A13);
* dimensions are split by ``is_current``; a version is one record ``<table>/_versions/<n>``,
  created once, that names its folders: the open versions, and the closed ones
  that this and earlier versions have added.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators.keys import freeze


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything exists at ``path`` (a file-system metadata call on the driver)."""
    jpath, fs = _fs(spark, path)
    return fs.exists(jpath)


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


#: What one writer task takes at most: rows of a slice, and slices (a file each).
ROWS_PER_TASK = 1_000_000
SLICES_PER_TASK = 64


def deal_to_writers(df: DataFrame, partition_by, rows_per_task: int = ROWS_PER_TASK, slices_per_task: int = SLICES_PER_TASK) -> DataFrame:
    """``df`` placed for a write partitioned by slice: all rows of a slice in one task (one file), several slices in a
    task, and a slice of over twice ``rows_per_task`` rows dealt over several tasks.

    The number of tasks comes from the counted rows and slices, so it doesn't depend on the session's
    shuffle settings.  ``df`` is evaluated twice (count and write): callers freeze what is costly.  The table of
    large slices has at most 25,000 rows, as each holds 1 / 50,000 of all rows or more.
    """
    slices = df.groupBy(F.xxhash64(*partition_by).alias("_slice")).count()
    rows, n = slices.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    each = max(rows_per_task, -(-rows // 50_000))
    tasks = max(1, -(-rows // each), -(-n // slices_per_task))
    large = [(r["_slice"], -(-r["count"] // each)) for r in slices.where(F.col("count") > 2 * each).collect()] if rows > 2 * each else []
    if not large:
        return df.repartition(tasks, *partition_by)
    parts = df.sparkSession.createDataFrame(large, "_slice bigint, _parts bigint")
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.coalesce(F.col("_parts"), F.lit(1)))
    return (df.join(F.broadcast(parts), F.xxhash64(*partition_by) == F.col("_slice"), "left")
            .withColumn("_part", deal).repartition(tasks, *partition_by, "_part").drop("_slice", "_parts", "_part"))


def write_slices(df: DataFrame, path: str, partition_by=("transaction_date", "region_code"), fmt: str = "parquet",
                 frozen: bool = False, covers: Column | None = None,
                 read: Callable[[SparkSession, str], DataFrame | None] | None = None, **options) -> None:
    """Replace slices: afterwards those that ``df`` has rows of hold exactly these rows, other slices stay.

    The files that the slices have are noted, the rows are appended, and the noted files are deleted: a reader never
    finds fewer rows than before and after, no slice is renamed, and a run that dies in between is mended by its rerun.
    ``covers`` (a predicate on the slice columns): the slices to replace, also those that ``df`` has no row of; ``df``
    must lie within.  ``frozen``: ``df`` is stored already; else it is frozen first, so that it is evaluated once.
    ``read``: how the table is read, for other formats than Parquet.  File names of the replaced slices are all that
    comes to the driver."""
    spark = df.sparkSession
    df = df if frozen else freeze(df)
    table = (read or read_table)(spark, path)
    old: list = []
    if table is not None:
        gone = table.where(covers) if covers is not None else _semi(table, df, partition_by, "left_semi")
        old = gone.select(F.col("_metadata.file_path").alias("file")).distinct().collect()
    _append(deal_to_writers(df, partition_by), path, partition_by, fmt, **options)
    _delete_files(spark, old)


def _append(df: DataFrame, path: str, partition_by, fmt: str = "parquet", **options) -> None:
    """Add files to a table that other jobs may add to at the same time.

    Hadoop's committer keeps uncommitted files in ``_temporary/<attempt>`` and the first job to end removes ``_temporary`` with the
    files of all others; so each write has an attempt number of its own and removes that folder alone.  Its first algorithm renames
    whole folders that the table doesn't have yet, into the folder of that name if another job has made it meanwhile; the second one
    makes folders and moves files.  With it a write that fails may leave files of tasks that ended, as one that dies while it commits
    does with the first: its rerun replaces them."""
    attempt = uuid.uuid4().int >> 97
    options |= {"mapreduce.job.application.attempt.id": attempt, "mapreduce.fileoutputcommitter.cleanup.skipped": "true",
                "mapreduce.fileoutputcommitter.algorithm.version": "2"}
    try:
        df.write.mode("append").partitionBy(*partition_by).options(**options).format(fmt).save(path)
    finally:
        jpath, fs = _fs(df.sparkSession, os.path.join(path, "_temporary", str(attempt)))
        fs.delete(jpath, True)


def _delete_files(spark: SparkSession, rows: list) -> None:
    for row in rows:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["file"]))
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, False)


def replace_slices(df: DataFrame, path: str, covers: Column, partition_by=("transaction_date", "region_code")) -> None:
    """Delete-then-insert of the slices that ``covers`` selects, also where ``df`` has none."""
    write_slices(df, path, partition_by, covers=covers)


def write_delimited(df: DataFrame, path: str, partition_by=("transaction_date", "region_code"),
                    covers: Column | None = None) -> None:
    """A6 / A7: '|'-delimited error files, one folder per slice.  With ``covers``
    the slices it selects are replaced, emptied ones included."""
    options = {"sep": "|", "header": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss", "dateFormat": "yyyy-MM-dd"}
    slices = T.StructType([df.schema[c] for c in partition_by])
    first = T.StructField("_first", T.StringType())
    read = lambda spark, at: (spark.read.schema(T.StructType([first, *slices.fields])).option("sep", "|").csv(at)
                              if path_exists(spark, at) else None)
    write_slices(df, path, partition_by, "csv", covers=covers, read=read, **options)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("sep", "|").option("header", "false")
            .option("dateFormat", "yyyy-MM-dd").csv(path))


FACT_PARTITIONS = ("transaction_date", "region_code", "load_batch_id")


def append_fact(fact: DataFrame, path: str, frozen: bool = False) -> None:
    """Fact append, idempotent per (date, region, batch): a rerun of a batch
    replaces that batch's rows, while facts of the same slice loaded by an
    earlier batch (late arrivals) stay."""
    write_slices(fact, path, FACT_PARTITIONS, frozen=frozen)


def slice_predicate(date_col: str, load_date, region: str | None) -> Column:
    """The slices of a day (of one region, or of all)."""
    covers = F.col(date_col) == F.lit(load_date)
    return covers if region is None else covers & (F.col("region_code") == F.lit(region))


#: Partition columns of summary tables: the region and the month of the date.
PACKED = "slice_month"


def replace_packed(df: DataFrame, path: str, date_col: str, covers: Column | None = None, region_col: str = "region_code") -> None:
    """Delete-then-insert of small slices: a table with few rows per (date, region) is stored by region and month.

    Afterwards the slices that ``covers`` selects (without it: those that ``df`` has) hold exactly the rows of ``df``.
    The months they lie in are read and written again, other months are not touched.  A month's folder
    belongs to one region, so jobs of different regions write different folders.
    """
    spark = df.sparkSession
    df = freeze(df.withColumn(PACKED, F.trunc(date_col, "month")))
    table = read_table(spark, path)
    out, pack, old = df, (region_col, PACKED), []
    if table is not None:
        touched = df.select(*pack)
        if covers is None:
            stays = _semi(_semi(table, df, pack, "left_semi"), df, (region_col, date_col), "left_anti")
        else:
            touched = touched.unionByName(table.where(covers).select(*pack))
            stays = _semi(table, touched, pack, "left_semi").where(~F.coalesce(covers, F.lit(False)))
        out = freeze(df.unionByName(stays.select(*df.columns)))
        old = _semi(table, touched, pack, "left_semi").select(F.col("_metadata.file_path").alias("file")).distinct().collect()
    _append(deal_to_writers(out, pack), path, pack)
    _delete_files(spark, old)


def _semi(left: DataFrame, right: DataFrame, on, how: str) -> DataFrame:
    """A semi or anti join in which NULL keys match each other."""
    keys = right.select(*[F.col(c).alias(f"_k_{c}") for c in on]).distinct()
    return left.join(keys, [left[c].eqNullSafe(keys[f"_k_{c}"]) for c in on], how)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """A table that ``replace_packed`` wrote, without the month."""
    return spark.read.parquet(path).drop(PACKED)


def refresh_summary(summary: DataFrame, path: str, covers: Column | None = None) -> None:
    """Delete + re-insert of the summary slices.  With ``covers`` a slice
    that no longer has rows loses its old summary."""
    replace_packed(summary, path, "summary_date", covers)


def reload_staging(spark: SparkSession, new_rows: DataFrame, path: str, load_date=None,
                   region: str | None = None) -> None:
    """Replace the PENDING rows of each slice and keep its LOADED rows; a
    transaction already LOADED is not staged again (defect 18).

    The slices are those of ``load_date`` and ``region`` (a slice whose extract
    came out empty loses its PENDING rows too) or, without a date, those present
    in ``new_rows``.  Both inputs are frozen before slice folders are replaced,
    so the extract is evaluated once and the rewrite never reads files it is
    deleting.
    """
    new_rows = freeze(new_rows)
    existing = read_table(spark, path)
    out = new_rows
    if existing is not None:
        loaded = existing.where(F.col("etl_status") == S.LOADED)
        if load_date is not None:
            loaded = loaded.where(slice_predicate("transaction_date", load_date, region))
        else:
            slices = new_rows.select("transaction_date", "region_code").distinct()
            loaded = loaded.join(slices, ["transaction_date", "region_code"], "left_semi")
        loaded = freeze(loaded.select(*new_rows.columns))
        fresh = new_rows.join(loaded.select("transaction_id", "transaction_date", "region_code"),
                              ["transaction_id", "transaction_date", "region_code"], "left_anti")
        out = freeze(loaded.unionByName(fresh))
    if load_date is None:
        write_slices(out, path, frozen=True)
    else:
        replace_slices(out, path, slice_predicate("transaction_date", load_date, region))


def write_dq_results(results: DataFrame, path: str, run_date=None, batch_id: int | None = None) -> None:
    """One row per rule and run, with the date of the run.  Results of a
    batch are a slice of their own: a retry of the batch replaces them."""
    results = results.withColumn("run_date", F.lit(run_date).cast("date"))
    if batch_id is None:
        results.write.mode("append").parquet(path)
    else:
        write_slices(results.withColumn("load_batch_id", F.lit(batch_id).cast("bigint")), path, ("load_batch_id",))


def write_analytics(rankings: DataFrame, segments: DataFrame, daily: DataFrame, base: str) -> None:
    """Rankings appended, segments overwritten (4 columns), daily summary
    appended; rerun slices are replaced, so reruns stay idempotent."""
    write_slices(rankings, os.path.join(base, "product_rankings"),
                 ("fiscal_year", "fiscal_month", "region_code"))
    (segments.select("customer_id", "clv_segment", "churn_risk", "region_code")
     .write.mode("overwrite").parquet(os.path.join(base, "customer_segments")))
    replace_packed(daily, os.path.join(base, "daily_summary"), "transaction_date")


NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is none yet (no folder,
    or a folder without data files).  Any other failure is raised: a table that
    can't be read is not a missing one.  A file that another job replaces between
    the listing and the reading of its schema makes the table be listed again."""
    for last in (False, False, True):
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() in NO_TABLE:
                return None
            raise
        except PySparkException as e:
            if last or "FILE_NOT_EXIST" not in (e.getCondition() or "") and "FileNotFound" not in str(e):
                raise


def table_exists(spark: SparkSession, path: str) -> bool:
    """A Parquet table with data files at ``path``."""
    return read_table(spark, path) is not None


# ---------------------------------------------------------------- records
# A record is one small file ``<folder>/<number>`` that is created or not created
# as a whole: the file system refuses a second creation, so two jobs can't both
# take a number, and a reader finds either the earlier or the new one.

def _records(spark: SparkSession, folder: str) -> list[int]:
    jpath, fs = _fs(spark, folder)
    if not fs.exists(jpath):
        return []
    return sorted(int(n) for n in (f.getPath().getName() for f in fs.listStatus(jpath)) if n.isdigit())


def _create_record(spark: SparkSession, folder: str, number: int, value: dict) -> bool:
    """Create record ``number``; False if another job has it."""
    jpath, fs = _fs(spark, os.path.join(folder, str(number)))
    try:
        out = fs.create(jpath, False)
    except Py4JJavaError as e:
        if "exist" in str(e.java_exception).lower():
            return False
        raise
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    return True


def _read_record(spark: SparkSession, folder: str, number: int) -> dict:
    jpath, fs = _fs(spark, os.path.join(folder, str(number)))
    stream = fs.open(jpath)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


# ---------------------------------------------------------------- batches
#: Surrogate keys of a batch: its number in the high bits, the position below.  Batches that run at the same time can't
#: draw the same key, and no counter is shared.
KEY_BITS = 40


class BatchRunning(RuntimeError):
    """A run of the same day and region has started and not finished."""


def open_batch(spark: SparkSession, root: str, load_date, region: str | None) -> int:
    """A new id for a run of a day and region (None: all regions).

    A run that has not finished may still be at work, so its id is never taken: the start is refused, and whoever
    knows that the run has died passes its id to ``run_daily`` to complete it.  Of two starts at once the first stays.
    """
    started, done = os.path.join(root, "started"), os.path.join(root, "done")

    def others(below: float) -> list[int]:
        open_ids = sorted(set(_records(spark, started)) - set(_records(spark, done)))
        runs = [(n, _read_record(spark, started, n)) for n in open_ids if n < below]
        return [n for n, r in runs if r["load_date"] == str(load_date) and (r["region"] == region or None in (r["region"], region))]

    def refuse(ids: list[int]) -> None:
        if ids:
            raise BatchRunning(f"batch {ids[0]} of {load_date} ({region or 'all regions'}) has not finished; pass its id to complete it")

    refuse(others(float("inf")))
    while True:
        n = max(_records(spark, started), default=0) + 1
        if _create_record(spark, started, n, {"load_date": str(load_date), "region": region}):
            break
    if earlier := others(n):
        close_batch(spark, root, n, 0)
        refuse(earlier)
    return n


def close_batch(spark: SparkSession, root: str, batch_id: int, rows: int) -> None:
    """Record a finished run."""
    _create_record(spark, os.path.join(root, "done"), batch_id, {"rows": rows})


def first_key(batch_id: int) -> int:
    """The first surrogate key of a batch."""
    return batch_id << KEY_BITS


# ---------------------------------------------------------------- snapshots
KEPT_VERSIONS = 3
OPEN = "is_current"


class StaleVersion(RuntimeError):
    """Another job has committed since the version that a change was computed from."""


class Version(NamedTuple):
    """A committed version of a table: its number (0: none yet), columns and folders.

    The rows of a dimension are split by ``is_current``; folders of closed versions (``first``, ``last``: the range of ``valid_to``) are
    shared by the versions after them.
    """
    number: int
    columns: list[str]
    folders: list[dict]


def current_version(spark: SparkSession, table: str) -> int | None:
    return max(_records(spark, os.path.join(table, "_versions")), default=None)


def version_of(spark: SparkSession, table: str) -> Version:
    n = current_version(spark, table)
    if n is None:
        return Version(0, [], [])
    record = _read_record(spark, os.path.join(table, "_versions"), n)
    return Version(n, record["columns"], record["folders"])


def _read_folders(spark: SparkSession, table: str, v: Version, folders: list[dict]) -> DataFrame:
    """Rows of some folders; ``is_current`` is a partition column, so a predicate on it prunes folders."""
    paths = [os.path.join(table, f["folder"]) for f in folders]
    return spark.read.option("basePath", table).parquet(*paths).select(*v.columns)


def read_snapshot(spark: SparkSession, table: str, version: Version | None = None) -> DataFrame:
    v = version or version_of(spark, table)
    if not v.number:
        raise FileNotFoundError(f"no snapshot in {table}")
    return _read_folders(spark, table, v, v.folders)


def _content(df: DataFrame) -> tuple:
    """Rows and an order-free hash of them."""
    cols = sorted(df.columns)
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*cols).cast("decimal(20,0)"))).first())


def _write_folder(df: DataFrame, table: str, number: int) -> list[dict]:
    """Write rows into a new folder; of a dimension, open and other versions apart."""
    spark, folder = df.sparkSession, f"v={number}-{uuid.uuid4().hex[:8]}"
    path = os.path.join(table, folder)
    if not {OPEN, "valid_to"} <= set(df.columns):
        df.write.parquet(path)
        return [{"folder": folder}]
    df.hint("rebalance", OPEN).write.partitionBy(OPEN).parquet(path)
    jpath, fs = _fs(spark, path)
    names = sorted(n for n in (f.getPath().getName() for f in fs.listStatus(jpath)) if n.startswith(OPEN))
    out = []
    for name in names:
        ends = spark.read.parquet(os.path.join(path, name)).agg(F.min("valid_to").cast("string"), F.max("valid_to").cast("string")).first()
        out.append({"folder": f"{folder}/{name}", "first": ends[0], "last": ends[1]})
    return out


def _delete_folders(spark: SparkSession, table: str, base: Version, folders: list[dict]) -> None:
    """Remove what was written for a version that is not committed."""
    for top in {f["folder"].split("/")[0] for f in folders if f not in base.folders}:
        jpath, fs = _fs(spark, os.path.join(table, top))
        fs.delete(jpath, True)


def _is_open(folder: dict) -> bool:
    return folder["folder"].endswith(f"{OPEN}=Y")


def _commit(spark: SparkSession, table: str, base: Version, columns: list[str], folders: list[dict]) -> int:
    """Make the next version after ``base``; StaleVersion if another job has made it.  Folders that none of the
    ``KEPT_VERSIONS`` last versions names are deleted."""
    versions = os.path.join(table, "_versions")
    if not _create_record(spark, versions, base.number + 1, {"columns": columns, "folders": folders}):
        _delete_folders(spark, table, base, folders)
        raise StaleVersion(f"another job has committed version {base.number + 1} of {table}")
    numbers = _records(spark, versions)
    named = {f["folder"] for n in numbers[-KEPT_VERSIONS:] for f in _read_record(spark, versions, n)["folders"]}
    for old in numbers[:-KEPT_VERSIONS]:
        for f in _read_record(spark, versions, old)["folders"]:
            if f["folder"] not in named:
                jpath, fs = _fs(spark, os.path.join(table, f["folder"]))
                fs.delete(jpath, True)
        jpath, fs = _fs(spark, os.path.join(versions, str(old)))
        fs.delete(jpath, False)
    return base.number + 1


def write_snapshot(spark: SparkSession, df: DataFrame, table: str, base: Version | None = None) -> int:
    """Write the next version of a whole table and commit it; returns the current version.

    ``base``: the version that ``df`` was computed from (default: the current one, for a table that is
    replaced whatever it held).  If another job has committed after ``base``, StaleVersion is raised and that job's version
    stays.  A version equal to its base is not committed (a rerun of an unchanged day changes nothing).
    """
    base = base or version_of(spark, table)
    folders = _write_folder(df, table, base.number + 1)
    new = Version(base.number + 1, df.columns, folders)
    if base.number and folders and _content(read_snapshot(spark, table, base)) == _content(read_snapshot(spark, table, new)):
        _delete_folders(spark, table, base, folders)
        return base.number
    return _commit(spark, table, base, df.columns, folders)


def update_snapshot(spark: SparkSession, table: str, change: Callable[[DataFrame], DataFrame], attempts: int = 5) -> int:
    """Commit ``change(current rows)``; computed again from the newer version if another job commits meanwhile."""
    def once() -> int:
        base = version_of(spark, table)
        return write_snapshot(spark, change(read_snapshot(spark, table, base)), table, base)
    return _until_committed(once, attempts)


def merge_dimension(spark: SparkSession, table: str, merge: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]],
                    attempts: int = 5) -> int:
    """Commit ``merge(open versions, closed versions)`` = (next open versions, newly closed versions).

    The open versions are read and written again, newly closed ones are added in a folder of their own, and folders closed earlier
    stay as they are.  Computed again from the newer version if another job commits meanwhile.
    """
    def once() -> int:
        base = version_of(spark, table)
        rows = read_snapshot(spark, table, base)
        is_open = F.coalesce(F.col(OPEN) == "Y", F.lit(False))
        current, history = rows.where(is_open), rows.where(~is_open)
        opened, closed = merge(current, history)
        opened, closed = freeze(opened.select(*base.columns)), freeze(closed.select(*base.columns))
        added = closed.count()
        if not added and _content(opened) == _content(current):
            return base.number
        folders = _write_folder(opened, table, base.number + 1) + (_write_folder(closed, table, base.number + 1) if added else [])
        kept = [f for f in base.folders if not _is_open(f)]
        return _commit(spark, table, base, base.columns, kept + folders)
    return _until_committed(once, attempts)


def purge_closed(spark: SparkSession, table: str, cutoff: str, attempts: int = 5) -> int:
    """I7 on a stored dimension: the next version without closed rows whose ``valid_to`` is before ``cutoff`` (ISO date).

    A folder whose rows all ended before it is left out without being read, a folder whose rows end on both sides is
    written again, and all others stay.
    """
    def once() -> int:
        base = version_of(spark, table)
        gone = [f for f in base.folders if not _is_open(f) and f["last"] and f["last"] < cutoff]
        mixed = [f for f in base.folders if not _is_open(f) and f not in gone and f["first"] and f["first"] < cutoff]
        if not gone and not mixed:
            return base.number
        left = []
        for f in mixed:
            rows = _read_folders(spark, table, base, [f])
            expired = (F.col(OPEN) == "N") & (F.col("valid_to") < F.lit(cutoff).cast("date"))
            left += _write_folder(rows.where(~F.coalesce(expired, F.lit(False))), table, base.number + 1)
        kept = [f for f in base.folders if f not in gone and f not in mixed]
        return _commit(spark, table, base, base.columns, kept + left)
    return _until_committed(once, attempts)


def _until_committed(once: Callable[[], int], attempts: int) -> int:
    for _ in range(attempts - 1):
        try:
            return once()
        except StaleVersion:
            continue
    return once()
