"""Incremental loads with Structured Streaming: files as they come, late rows settled by key, publication time as event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from volframe.sources import store

LEDGER = "version long, query string, batch long, buckets int, at array<long>, before array<long>"


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _ledger(spark: SparkSession, target: str):
    """The newest entry of a table's ledger, or None: version, query, batch, buckets, at (version that holds each bucket)."""
    path = f"{target}/ledger"
    return spark.read.schema(LEDGER).parquet(path).orderBy(F.desc("version")).first() if store.exists(spark, path) else None


def _of(at: Sequence[int | None], target: str) -> list[str]:
    return [f"{target}/v{v}/_bucket={b}" for b, v in enumerate(at) if v is not None]


def upsert_stream(stream: DataFrame, target: str, keys: Sequence[str], version: str, checkpoint: str, buckets: int = 64):
    """The newest non-null value per key and column, whatever the order in which batches bring them, as a table at target.

    Column c has its version beside it as _version_c, so that a late row with an older version never replaces a newer
    value; at equal versions the later batch wins, and a null version is the oldest. Null keys are a key like any other.
    Keys are dealt into buckets by a hash, and a batch reads and writes the buckets of its own keys alone: version n of the
    table is target/v<n> for these, and what the ledger names for the others. The ledger is written last, into one of two
    folders in turn, so a batch that fails half-way leaves the version before it as it was. A batch that runs twice gives
    the same version again; one of another checkpoint, also a fresh one, goes on from what is there. The number of buckets
    is fixed by the first batch: choose it so that one fits a task. A table has one writing stream at a time. Returns the
    query; it ends when all files present are read. upserted() reads the table.
    """
    target = target.rstrip("/")
    values = [c for c in stream.columns if c not in (*keys, version)]
    # a struct is never null itself: only nulls of the value are left out
    age = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(f"_version_{c}"), F.col("_new"))) for c in values}
    newest = [F.max_by(x, age[c]).alias(x) for c in values for x in (c, f"_version_{c}")]

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")  # kept in the checkpoint
        last = _ledger(spark, target)
        if last and last.buckets != buckets:
            raise ValueError(f"{target} has {last.buckets} buckets")
        again = bool(last) and (last.query, last.batch) == (query, number)
        n = 0 if last is None else last.version + (not again)
        at = [None] * buckets if last is None else list(last.before if again else last.at)
        before = list(at)
        rows = batch.select(*keys, *values, *[F.col(version).alias(f"_version_{c}") for c in values], F.lit(True).alias("_new"))
        rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())  # at most `buckets`
        held = _of([v if b in set(touched) else None for b, v in enumerate(at)], target)
        # the batch is reduced before it meets the table, whose rows are shuffled once
        rows = rows.groupBy(*keys, "_bucket", "_new").agg(*newest)
        if held:
            old = spark.read.schema(rows.drop("_bucket", "_new").schema).parquet(*held)
            rows = rows.unionByName(old.withColumns({"_new": F.lit(False), "_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")}))
        rows.repartition("_bucket").groupBy("_bucket", *keys).agg(*newest).write.mode("overwrite").partitionBy("_bucket").parquet(f"{target}/v{n}")
        for b in touched:
            at[b] = n
        entry = spark.createDataFrame([(n, query, number, buckets, at, before)], LEDGER).withColumn("slot", F.lit(n % 2))
        entry.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(f"{target}/ledger")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upserted(spark: SparkSession, target: str) -> DataFrame | None:
    """The table that upsert_stream keeps, with its _version_ columns; None before the first batch with rows.

    What is returned is one version: batches that come later write folders of their own.
    """
    target = target.rstrip("/")
    last = _ledger(spark, target)
    paths = _of(last.at, target) if last else []
    return spark.read.parquet(*paths) if paths else None


def superseded(spark: SparkSession, target: str) -> list[str]:
    """Folders that the newest version doesn't read and a repeat of its batch wouldn't either: they may be deleted."""
    target = target.rstrip("/")
    last = _ledger(spark, target)
    if last is None:
        return []
    used = set(_of(last.at, target)) | set(_of(last.before, target))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target)  # a row for each file, without its content
    folders = files.select(F.regexp_extract("path", r"/(v\d+/_bucket=\d+)/[^/]*$", 1).alias("f")).where("f <> ''").distinct()
    return sorted(f for f in (f"{target}/{r.f}" for r in folders.collect()) if f not in used)


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str, late: str = "1 day") -> DataFrame:
    """First row of each key; keys are forgotten once the watermark has passed."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def bars_from_ticks(stream: DataFrame, key: str, time: str, price: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Open, high, low, close and count per key and window of event time."""
    w = F.window(time, width)
    return stream.withWatermark(time, late).groupBy(key, w).agg(F.min_by(price, time).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, time).alias("close"), F.count("*").alias("n")).select(key, F.col("window.start").alias("start"), "open", "high", "low", "close", "n")
