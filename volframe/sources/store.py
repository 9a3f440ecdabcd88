"""Stores as partitioned Parquet: chains and surfaces by ticker and date, tables as a whole, records as JSON lines.

Writes replace whole partitions and nothing else, so a write that runs twice leaves the same files. Reads filter on the
partition columns, so only the folders asked for are listed and read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volframe.operators.timeseries import keep_last

#: Version of the way surfaces are built; surfaces of another version count as missing.
BUILDER = "svi/1"
CONTRACT = ("ticker", "date", "expiration", "strike", "option_type")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table of Parquet files."""
    try:
        return bool(spark.read.parquet(path).schema)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def replace(rows: DataFrame, path: str) -> None:
    """Write rows, replacing the partitions (ticker, date) that they have; others stay. rows may not read path itself."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ticker", "date").parquet(path)


def save_chain(chain: DataFrame, path: str, arrival: Sequence[str] = ()) -> None:
    """Merge a chain into the store; of rows of one contract and day the new one stays, the last by `arrival` if given.

    Partitions without new rows are not read. The columns `date` and `ticker` name the partition; date comes from as_of if
    it is missing. Rows without ticker or date raise.
    """
    spark = chain.sparkSession
    new = chain if "date" in chain.columns else chain.withColumn("date", F.to_date("as_of"))
    bad = F.col("ticker").isNull() | F.col("date").isNull()
    new = new.withColumn("ticker", F.when(bad, F.raise_error(F.lit("a row without ticker or date"))).otherwise(F.col("ticker"))).withColumn("_new", F.lit(1))
    if exists(spark, path):
        touched = new.select("ticker", "date").distinct()
        old = spark.read.parquet(path).join(F.broadcast(touched) if touched.count() <= 100_000 else touched, ["ticker", "date"], "left_semi").withColumn("_new", F.lit(0))
        new = old.unionByName(new, allowMissingColumns=True)
    out = keep_last(new, [c for c in CONTRACT if c in new.columns], ["_new", *arrival]).drop("_new")
    replace(staged(out, path), path)


def staged(rows: DataFrame, path: str) -> DataFrame:
    """Rows as a table of their own: what is read must not be what is replaced.

    It is a checkpoint if spark.checkpoint.dir is set, which Spark cleans up; else a folder beside path that no other
    writer uses.
    """
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir():
        return rows.checkpoint()
    beside = f"{path.rstrip('/')}.next-{uuid.uuid4().hex}"
    rows.write.parquet(beside)
    return spark.read.schema(rows.schema).parquet(beside)


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir; with a local master a temporary one will do."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{base.rstrip('/')}/volframe-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def kept(rows: DataFrame) -> DataFrame:
    """Rows for several uses: a checkpoint if spark.checkpoint.dir is set, which goes with the last reference; else cached."""
    return rows.checkpoint() if rows.sparkSession.sparkContext.getCheckpointDir() else rows.persist()


def load(spark: SparkSession, path: str, tickers: Sequence[str] | None = None, start=None, end=None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of a store of the given tickers and dates (both ends included); the filters prune partitions."""
    out = spark.read.parquet(path)
    if tickers is not None:
        out = out.where(F.col("ticker").isin(list(tickers)))
    if start is not None:
        out = out.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.where(F.col("date") <= F.lit(end).cast("date"))
    return out.select(*columns) if columns else out


def available(spark: SparkSession, path: str) -> DataFrame:
    """ticker and date of every partition: Spark reads no column of the files for it."""
    return spark.read.parquet(path).select("ticker", "date").distinct()


def save_surfaces(slices: DataFrame, path: str, builder: str = BUILDER) -> None:
    """Write fitted slices, replacing the surfaces of their days; needs ticker and date (or as_of)."""
    s = slices if "date" in slices.columns else slices.withColumn("date", F.to_date("as_of"))
    replace(s.withColumn("builder", F.lit(builder)), path)


def load_surfaces(spark: SparkSession, path: str, builder: str | None = BUILDER, **where) -> DataFrame:
    """Slices of surfaces built by the given version (None: any). Partitions that hold a rejection alone have none."""
    s = load(spark, path, **where)
    return s.where(F.col("builder").isNotNull() if builder is None else F.col("builder") == builder)


def to_build(spark: SparkSession, chains: str, surfaces: str, builder: str = BUILDER) -> DataFrame:
    """ticker and date of chains without a surface of the current version: what an incremental build has to do."""
    have = available(spark, chains)
    if not exists(spark, surfaces):
        return have
    return have.join(load_surfaces(spark, surfaces, builder).select("ticker", "date").distinct(), ["ticker", "date"], "left_anti")


def append_record(record: DataFrame, path: str) -> None:
    """Append rows as JSON lines, a file a call; earlier files are never touched."""
    record.coalesce(1).write.mode("append").json(path)


def latest_record(spark: SparkSession, path: str, schema: str, at: str = "checked_at") -> DataFrame:
    """The record with the greatest `at`; no row without any."""
    return spark.read.schema(schema).json(path).orderBy(F.col(at).desc_nulls_last()).limit(1)


def integrity(spark: SparkSession, path: str, keys: Sequence[str] = ("expiration", "strike", "option_type")) -> DataFrame:
    """Per ticker: days, rows, rows that repeat a contract of their day, first and last day."""
    one = spark.read.parquet(path).groupBy("ticker", "date", *keys).agg(F.count("*").alias("n"))
    day = one.groupBy("ticker", "date").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("repeated"))
    return day.groupBy("ticker").agg(F.count("*").alias("days"), F.sum("n").alias("rows"), F.sum("repeated").alias("repeated"), F.min("date").alias("first"), F.max("date").alias("last"))
