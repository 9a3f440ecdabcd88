"""Rows computed from a partitioned store, recomputed only where its files have changed.

A partition's stamp is a digest of the names, sizes and modification times of its files, which Spark has at hand without
reading a column. The cache is appended to and never rewritten: a row counts if its stamp and version are the current ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volframe.sources import store

KEYS = ("ticker", "date")


def stamps(spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """keys and stamp of every partition of a store."""
    m = F.col("_metadata")
    files = spark.read.parquet(path).select(*keys, m["file_path"].alias("p"), m["file_size"].alias("s"), F.unix_micros(m["file_modification_time"]).alias("t")).distinct()
    one = F.concat_ws(":", "p", F.col("s").cast("string"), F.col("t").cast("string"))
    return files.groupBy(*keys).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(one)), "\n"), 256).alias("stamp"))


def refresh(spark: SparkSession, source: str, cache: str, version: str, compute: Callable[[DataFrame], DataFrame], keys: Sequence[str] = KEYS, select: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """compute(rows of source) for all of source, but called only on partitions without a current row in the cache.

    compute gives rows with the keys; a partition may give none or several. Of a partition that gave none the cache keeps a
    mark, so that it isn't computed again. select narrows the source's rows (to a builder, to tickers), and narrows the
    result as well. A row of another version, of a file that has changed or is gone, counts no longer. Two runs at a time
    may compute a partition twice; its rows then count once.
    """
    rows = spark.read.parquet(source)
    rows = rows if select is None else select(rows)
    now = stamps(spark, source, keys)
    if select is not None:
        now = now.join(rows.select(*keys).distinct(), list(keys), "left_semi")
    have = None
    if store.exists(spark, cache):
        have = spark.read.parquet(cache).where(F.col("_version") == version).join(now.withColumnRenamed("stamp", "_stamp"), [*keys, "_stamp"], "left_semi")
    todo = now if have is None else now.join(have.select(*keys).distinct(), list(keys), "left_anti")
    todo = store.kept(todo)
    if not todo.isEmpty():
        fresh = compute(rows.join(todo, list(keys), "left_semi"))
        marked = todo.join(fresh.withColumn("_empty", F.lit(False)), list(keys), "left").withColumn("_empty", F.coalesce("_empty", F.lit(True)))
        marked.withColumnRenamed("stamp", "_stamp").withColumn("_version", F.lit(version)).write.mode("append").parquet(cache)
    todo.unpersist()
    if not store.exists(spark, cache):
        return spark.createDataFrame([], now.drop("stamp").schema)
    all_ = spark.read.option("mergeSchema", True).parquet(cache).where(F.col("_version") == version)
    current = all_.join(now.withColumnRenamed("stamp", "_stamp"), [*keys, "_stamp"], "left_semi").where(~F.col("_empty"))
    return current.drop("_stamp", "_version", "_empty").distinct()
