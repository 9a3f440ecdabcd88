"""Snapshot files that carry their version in their name: `<prefix>_<version>.parquet`, one for each collection.

Consecutive snapshots overlap, and a later one often settles what an earlier one left open. All files are read in one scan,
whatever their columns; the version comes from the name. Versions are ordered as text, so that dates are in order and
BACKFILL, which fills in history, comes before all of them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volframe.operators.timeseries import replace_by_key, upsert
from volframe.sources import store

BACKFILL = "0000_backfill"


def file_of(folder: str, prefix: str, version: str) -> str:
    return f"{folder.rstrip('/')}/{prefix}_{version}.parquet"


def read_all(spark: SparkSession, folder: str, prefix: str) -> DataFrame | None:
    """Rows of all snapshots with `version`; columns that a file lacks are null. None without any file.

    A snapshot may be one file or a folder of parts. A file that cannot be read raises, unless
    spark.sql.files.ignoreCorruptFiles is set.
    """
    try:
        rows = spark.read.option("mergeSchema", True).parquet(file_of(folder, prefix, "*"))
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    version = F.regexp_extract(F.col("_metadata.file_path"), f"/{re.escape(prefix)}_([^/]*)\\.parquet(/[^/]*)?$", 1)
    return rows.select("*", version.alias("version"))


def newest_cells(rows: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """One row per key: of each other column the value of the highest version that has one.

    Aggregated before the shuffle, all columns in one pass. A cell that no version has stays null; rows of one key and
    version are expected to agree, the larger value counts where they don't; keys may be null.
    """
    values = [c for c in rows.columns if c not in (*keys, version)]
    newest = [F.max(F.when(F.col(c).isNotNull(), F.struct(version, c)))[c].alias(c) for c in values]
    return rows.groupBy(*keys).agg(*newest) if newest else rows.select(*keys).distinct()


def index_history(spark: SparkSession, folder: str, prefix: str = "vix", needed: str | None = None) -> DataFrame | None:
    """One row per date out of all snapshots; with `needed`, only dates where that column is known. None without files."""
    rows = read_all(spark, folder, prefix)
    if rows is None:
        return None
    out = newest_cells(rows, ["date"])
    return out.where(F.col(needed).isNotNull()) if needed and needed in out.columns else out


def save_index_snapshot(rows: DataFrame, folder: str, version: str, prefix: str = "vix") -> None:
    """Write one collection; the same version again replaces it."""
    rows.coalesce(1).write.mode("overwrite").parquet(file_of(folder, prefix, version))


def save_backfill(rows: DataFrame, folder: str, prefix: str = "vix") -> None:
    """Merge rows into the backfill: new values that aren't null win, dates outside of them stay."""
    spark, path = rows.sparkSession, file_of(folder, prefix, BACKFILL)
    if store.exists(spark, path):
        rows = store.staged(upsert(spark.read.parquet(path), rows, ["date"]), f"{folder.rstrip('/')}/backfill")
    save_index_snapshot(rows, folder, BACKFILL, prefix)


def save_index_history(spark: SparkSession, folder: str, path: str, prefix: str = "vix") -> None:
    """Write the consolidated history to a table of its own; nothing without snapshots."""
    out = index_history(spark, folder, prefix)
    if out is not None:
        out.coalesce(1).write.mode("overwrite").parquet(path)


def latest(history: DataFrame, date: str = "date") -> DataFrame:
    """series and value of the newest date, without those that are null there."""
    last = history.orderBy(F.col(date).desc_nulls_last()).limit(1)
    names = [c for c in history.columns if c != date]
    return last.select(F.explode(F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("value")) for c in names])).alias("x")).select("x.*").where("value is not null")


def save_schedule(releases: DataFrame, folder: str, as_of: str, announced: Column | None = None, prefix: str = "earnings") -> None:
    """Record the releases (ticker, announced, ...) due on as_of or later, as known that day.

    A second schedule of the day replaces the tickers it has and leaves the others.
    """
    spark, path = releases.sparkSession, file_of(folder, prefix, as_of)
    due = releases.where((F.col("announced") if announced is None else announced) >= F.lit(as_of).cast("date"))
    if store.exists(spark, path):
        due = store.staged(replace_by_key(spark.read.parquet(path), due, "ticker"), f"{folder.rstrip('/')}/schedule")
    due.coalesce(1).write.mode("overwrite").parquet(path)


def schedules(spark: SparkSession, folder: str, prefix: str = "earnings") -> DataFrame | None:
    """All recorded schedules with `snapshot`, the day each was known on. None without any; see features.scheduled_next."""
    rows = read_all(spark, folder, prefix)
    return None if rows is None else rows.withColumn("snapshot", F.col("version").try_cast("date")).drop("version").where("snapshot is not null")
