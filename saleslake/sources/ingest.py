"""Ingest edges: JDBC query source (A1), product CSV with a bad-record channel
(A4) and its reconciliation (A5), region-routed tables (A16), column defaults
(I11)."""

from __future__ import annotations

import datetime as _dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.columns import trim_to_null
from ..session import ensure_checkpoint_dir

log = logging.getLogger(__name__)


# ------------------------------------------------------------------ A1
def jdbc_options(url: str, query: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None) -> dict[str, str]:
    """A1: options of a pushed-down query read.  The subquery runs in the
    database; with a partition column the read is split into ``num_partitions``
    parallel range queries instead of the reference's single connection."""
    opts = {"url": url, "dbtable": f"({query}) q", "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_query(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


# ------------------------------------------------------------------ A4, A5
PRODUCT_CSV_SCHEMA = T.StructType([f for f in S.STG_PRODUCT.fields if f.name != "load_date"])


class TooManyRejectedRows(RuntimeError):
    pass


@dataclass
class CsvIngest:
    good: DataFrame
    bad: DataFrame
    bad_rows: int
    good_rows: int


def parse_product_csv(spark: SparkSession, path: str, load_date: _dt.date) -> CsvIngest:
    """A4: ``product_master_<yyyymmdd>.csv`` (a file or a folder of part files)
    -> (good rows, bad lines) and their counts; no limit is applied here.

    Malformed rows (bad values, too few or too many fields) land in ``_bad``, and
    so do rows that break the staging key: without a product id, or with one that
    an earlier line has.
    The parsed frame is frozen with a reliable checkpoint first: Spark refuses
    a query on the corrupt-record column alone, and both outputs must come from
    the same parse.
    """
    ensure_checkpoint_dir(spark)
    schema = T.StructType(PRODUCT_CSV_SCHEMA.fields + [T.StructField("_bad", T.StringType())])
    parsed = (spark.read.schema(schema).option("header", "true").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_bad").option("dateFormat", "yyyy-MM-dd")
              .csv(path).withColumn("_line", F.monotonically_increasing_id())).checkpoint(eager=True)
    names = [f.name for f in PRODUCT_CSV_SCHEMA.fields]
    nth = F.row_number().over(Window.partitionBy("_bad", "product_id").orderBy("_line"))   # one product's lines
    text = F.to_csv(F.struct(*[F.col(n).cast("string").alias(n) for n in names]))
    broken = F.col("_bad").isNull() & (F.col("product_id").isNull() | (F.col("_nth") > 1))
    keyed = parsed.where("_bad is null").withColumn("_nth", nth).withColumn("_bad", F.when(broken, text)).drop("_nth")
    parsed = keyed.unionByName(parsed.where("_bad is not null")).drop("_line").checkpoint(eager=True)
    bad = parsed.where(F.col("_bad").isNotNull()).select(F.col("_bad").alias("raw_line"))
    good = (parsed.where(F.col("_bad").isNull()).drop("_bad")
            .select(*[trim_to_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType)
                      else F.col(f.name) for f in PRODUCT_CSV_SCHEMA.fields])
            .withColumn("is_active", F.coalesce("is_active", F.lit("Y")))
            .withColumn("load_date", F.lit(load_date)))
    counts = parsed.agg(F.count_if(F.col("_bad").isNotNull()).alias("b"),
                        F.count_if(F.col("_bad").isNull()).alias("g")).first()
    return CsvIngest(good, bad, int(counts["b"]), int(counts["g"]))


def ingest_product_csv(spark: SparkSession, path: str, load_date: _dt.date,
                       max_rejected: int = S.MAX_REJECTED_ROWS) -> CsvIngest:
    """A4 with its limit: more than ``max_rejected`` bad rows fails the load;
    below that the partial load is accepted."""
    res = parse_product_csv(spark, path, load_date)
    if res.bad_rows > max_rejected:
        raise TooManyRejectedRows(f"{res.bad_rows} rejected rows > {max_rejected}")
    if res.bad_rows:
        log.warning("%d product rows rejected", res.bad_rows)
    return res


def _file_rows(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank data lines of a CSV file or folder: one header line per file
    is not a data line."""
    return (spark.read.text(path).where(F.length(F.trim("value")) > 0)
            .agg((F.count(F.lit(1)) - F.count_distinct(F.col("_metadata.file_path"))).alias("file_rows")))


def reconcile_file(spark: SparkSession, path: str, staged_rows: int) -> dict:
    """A5: data lines of the file (headers excluded) against rows staged."""
    lines = _file_rows(spark, path).first()["file_rows"]
    return {"file_rows": lines, "staged_rows": staged_rows, "short": staged_rows < lines}


def reconciliation(spark: SparkSession, path: str, res: CsvIngest,
                   max_rejected: int = S.MAX_REJECTED_ROWS) -> DataFrame:
    """A5 as one row: file lines, staged and rejected rows, whether the load is
    short of the file and whether its rejects are within the limit."""
    return (_file_rows(spark, path)
            .withColumn("staged_rows", F.lit(res.good_rows).cast("bigint"))
            .withColumn("bad_rows", F.lit(res.bad_rows).cast("bigint"))
            .withColumn("short_load", F.when(F.col("staged_rows") < F.col("file_rows"), "Y").otherwise("N"))
            .withColumn("accepted", F.lit("Y" if res.bad_rows <= max_rejected else "N")))


# ------------------------------------------------------------------ A16
def region_table(spark: SparkSession, region: str | None, template: str, default: str | DataFrame) -> DataFrame:
    """A region may have its own table (``template`` with ``{region}``);
    otherwise the shared default (a table's name, or its rows) is read."""
    if region:
        name = template.format(region=region.lower())
        if spark.catalog.tableExists(name):
            return spark.table(name)
    return spark.table(default) if isinstance(default, str) else default


# ------------------------------------------------------------------ I11
def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Declared column defaults, applied before a write (Spark has none)."""
    out = df
    for col, value in S.DEFAULTS.get(table, {}).items():
        if col in out.columns:
            out = out.withColumn(col, F.coalesce(F.col(col), F.lit(value)).cast(out.schema[col].dataType))
    return out
