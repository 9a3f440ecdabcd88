"""The plain tables of the domain as stores below one folder: rates, macro, prices, indices, earnings, features, forecasts.

A write touches the partitions that its rows belong to and no others: they are read, merged and replaced together, so that a
write that runs twice leaves the same table. Reads filter on partition columns, and column selections reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volframe.functions.pricing import interpolate
from volframe.operators.timeseries import keep_last, upsert
from volframe.sources import store


@dataclass(frozen=True)
class Spec:
    """keys name a row; part is the partition, a column or `year` of the date.

    how: cells (of a row that is there twice, a new value that isn't null wins), owner (new rows replace all rows of their
    first key), rows (a new row replaces the old one), whole (new rows replace the table).
    """

    keys: tuple[str, ...]
    part: str
    how: str = "cells"


SPECS = {
    "rates": Spec(("date", "tenor_years"), "year"), "macro": Spec(("date",), "year"), "indices": Spec(("date",), "year"), "prices": Spec(("ticker", "date"), "ticker"),
    "earnings": Spec(("ticker", "announced"), "ticker", "owner"), "features": Spec(("ticker", "date"), "ticker", "whole"), "forecasts": Spec(("ticker", "date", "horizon"), "ticker", "rows"),
}


class Tables:
    """Readers and writers of the tables of SPECS (or of specs given) below a folder."""

    def __init__(self, spark: SparkSession, folder: str, specs: dict[str, Spec] = SPECS):
        self.spark, self.folder, self.specs = spark, folder.rstrip("/"), specs

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, name: str, rows: DataFrame) -> None:
        """Merge rows into a table; see Spec. Of new rows with equal keys the largest one counts, rows with a null key raise.

        Columns that only one side has stay, null on the other.
        """
        spec, path = self.specs[name], self.path(name)
        bad = F.lit(False)
        for k in spec.keys:
            bad = bad | F.col(k).isNull()
        first, *rest = spec.keys
        new = rows.withColumn(first, F.when(bad, F.raise_error(F.lit(f"{name}: a row without {' or '.join(spec.keys)}")).cast(rows.schema[first].dataType)).otherwise(F.col(first)))
        new = keep_last(new, spec.keys, [])
        if spec.part == "year":
            new = new.withColumn("year", F.year("date"))
        if spec.how == "whole":
            store.staged(new, path).write.mode("overwrite").partitionBy(spec.part).parquet(path)
            return
        if store.exists(self.spark, path):
            new = store.kept(new)
            old = self.spark.read.parquet(path).join(new.select(spec.part).distinct(), spec.part, "left_semi")
            if spec.how == "owner":
                merged = old.join(new.select(first).distinct(), first, "left_anti").unionByName(new, allowMissingColumns=True)
            elif spec.how == "rows":
                merged = old.join(new.select(*spec.keys), list(spec.keys), "left_anti").unionByName(new, allowMissingColumns=True)
            else:
                merged = upsert(old, new, spec.keys)
            new = store.staged(merged, path)
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(spec.part).parquet(path)

    def load(self, name: str, tickers: Sequence[str] | None = None, start=None, end=None, columns: Sequence[str] | None = None) -> DataFrame | None:
        """Rows of a table, both ends of the dates included; None if the table was never written."""
        spec, path = self.specs[name], self.path(name)
        if not store.exists(self.spark, path):
            return None
        out = self.spark.read.option("mergeSchema", True).parquet(path)
        if tickers is not None:
            out = out.where(F.col("ticker").isin(list(tickers)))
        day = F.col("date" if "date" in spec.keys else spec.keys[-1]).cast("date")
        for bound, ok in ((start, lambda a, b: a >= b), (end, lambda a, b: a <= b)):
            if bound is not None:
                to = F.lit(bound).cast("date")
                out = out.where(ok(day, to) & ok(F.col("year"), F.year(to)) if spec.part == "year" else ok(day, to))
        out = out.drop("year") if spec.part == "year" else out
        return out.select(*columns) if columns else out

    def rate(self, days: DataFrame, tenor: float, fallback: float | None = None) -> DataFrame:
        """days(date) with `rate` at a tenor, from each tenor's last rate known on the day; fallback where there is none."""
        from volframe.operators.corpus import curves

        rates = self.load("rates")
        tenors = [] if rates is None else [r.tenor_years for r in rates.select("tenor_years").distinct().orderBy("tenor_years").collect()]  # a dozen
        out = days.join(curves(days, rates, tenors), "date", "left")
        return out.withColumn("rate", F.coalesce(interpolate(F.lit(tenor), F.col("curve")), F.lit(fallback).cast("double"))).drop("curve")

    def latest(self, name: str, by: Sequence[str] = ("ticker",)) -> DataFrame | None:
        """The last row of each key by date."""
        rows = self.load(name)
        return None if rows is None else rows.groupBy(*by).agg(F.max(F.struct("date", *[c for c in rows.columns if c != "date"])).alias("r")).select("r.*")
