"""A vendor's drop folder: one payload a file, `<ticker>_<yyyy-mm-dd>.json`, as a table and as a stream.

The name is known before a file is opened, and Spark drops files by it while it lists them, so a day's quotes cost that
day's files. What cannot be read is a row with an error, not a failed job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volframe.sources.store import CONTRACT, save_chain
from volframe.sources.vendors import PAYLOAD, delayed_quotes

NAME = r"^(.+)_(\d{4}-\d{2}-\d{2})\.json$"
SCHEMA = "value string"


def _named(files: DataFrame) -> DataFrame:
    name = F.col("_metadata.file_name")
    return files.select(F.nullif(F.regexp_extract(name, NAME, 1), F.lit("")).alias("ticker"), F.nullif(F.regexp_extract(name, NAME, 2), F.lit("")).try_cast("date").alias("as_of"), F.col("value").alias("payload"), name.alias("file"))


def _checked(rows: DataFrame) -> DataFrame:
    """Adds error: what is wrong with a file, null if nothing is."""
    data = F.from_json("payload", PAYLOAD)["data"]
    error = F.when(F.col("ticker").isNull() | F.col("as_of").isNull(), "no ticker and date in the name").when(data.isNull(), "no payload").when(F.coalesce(F.size(data["options"]), F.lit(0)) <= 0, "no options")
    return rows.withColumn("error", error)


def _wanted(name: Column, tickers: Sequence[str] | None, start: str | None, end: str | None) -> Column | None:
    """A condition on the file's name alone: names are as long as ticker and date are, and dates are in order as text."""
    day = F.substring(name, -15, 10)
    tests = [day >= str(start)] if start else []
    tests += [day <= str(end)] if end else []
    tests += [F.expr("substring(_metadata.file_name, 1, length(_metadata.file_name) - 16)").isin(list(tickers))] if tickers is not None else []
    out = None
    for t in tests:
        out = t if out is None else out & t
    return out


def read(spark: SparkSession, folder: str, tickers: Sequence[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """ticker, as_of, payload, file and error of the files in a folder; with bounds only of those whose name is inside.

    A file is one row, however long. Names without ticker and date are rows with an error, unless bounds leave them out.
    """
    files = spark.read.schema(SCHEMA).option("wholetext", True).option("pathGlobFilter", "*.json").text(folder)
    inside = _wanted(F.col("_metadata.file_name"), tickers, start, end)
    return _checked(_named(files if inside is None else files.where(inside)))


def quotes(drops: DataFrame) -> DataFrame:
    """The chain of all files without an error."""
    return delayed_quotes(drops.where("error is null").select("ticker", "as_of", "payload"))


def stream(spark: SparkSession, folder: str, files_per_trigger: int = 256) -> DataFrame:
    """As read(), for files as they come."""
    files = spark.readStream.schema(SCHEMA).option("wholetext", True).option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return _checked(_named(files))


def collect_stream(drops: DataFrame, chains: str, errors: str, checkpoint: str):
    """Merge the files of a stream into a store of chains, and write down those with an error; ends when all are read.

    The checkpoint knows the files that were read; a batch that is run again after a failure merges the same rows again,
    which changes nothing. Errors are kept by batch, so that they aren't written twice either.
    """

    def merge(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        batch.where("error is not null").select("file", "ticker", "as_of", "error").write.mode("overwrite").parquet(f"{errors.rstrip('/')}/batch={number}")
        rows = quotes(batch)
        if not rows.isEmpty():
            save_chain(rows.dropDuplicates(list(c for c in CONTRACT if c != "date") + ["as_of"]), chains)
        batch.unpersist()

    return drops.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
