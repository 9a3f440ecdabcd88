"""Realised volatility, returns, forward labels and the HAR regressors, as window expressions over (ticker, date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volframe.operators.timeseries import forward_sum, trailing

def by_date():
    return Window.partitionBy("ticker").orderBy("date")


def full(x: Column, w, n: int, f=F.avg) -> Column:
    return F.when(F.count(x).over(w) == n, f(x).over(w))


def repaired(prices: DataFrame) -> DataFrame:
    """adj_close filled by the last known ratio to close (1 before the first)."""
    ratio = F.last(F.col("adj_close") / F.col("close"), True).over(by_date().rowsBetween(Window.unboundedPreceding, 0))
    return prices.withColumn("adj_close", F.coalesce("adj_close", F.col("close") * F.coalesce(ratio, F.lit(1.0))))


def log_return(days: int, column: str = "adj_close") -> Column:
    return F.log(F.col(column) / F.lag(column, days).over(by_date()))


def close_to_close(r: Column, n: int) -> Column:
    return F.sqrt(252 * full(r * r, trailing("ticker", "date", n), n))


def yang_zhang(prices: DataFrame, n: int, name: str) -> DataFrame:
    """Overnight and open-to-close sample variances and the Rogers-Satchell mean, on rows with a previous close."""
    f = prices.withColumn("_o", F.log(F.col("open") / F.lag("close").over(by_date()))).withColumn("_c", F.log(F.col("close") / F.col("open")))
    rs = F.log(F.col("high") / F.col("close")) * F.log(F.col("high") / F.col("open")) + F.log(F.col("low") / F.col("close")) * F.log(F.col("low") / F.col("open"))
    f = f.withColumn("_rs", rs)
    k = 0.34 / (1.34 + (n + 1) / (n - 1))
    w = trailing("ticker", "date", n)
    v = full(F.col("_o"), w, n, F.var_samp) + k * full(F.col("_c"), w, n, F.var_samp) + (1 - k) * full(F.col("_rs"), w, n)
    return f.withColumn("_v", v).withColumn(name, F.when(F.col("_v") < 0, 0.0).otherwise(F.sqrt(252 * F.col("_v")))).drop("_o", "_c", "_rs", "_v")


def realized_features(prices: DataFrame) -> DataFrame:
    f = repaired(prices)
    f = f.select("*", *[log_return(d).alias(f"ret_{d}d") for d in (1, 5, 21)])
    f = f.select("*", *[close_to_close(F.col("ret_1d"), n).alias(f"rv_cc_{n}d") for n in (10, 21, 63)])
    return yang_zhang(f, 21, "rv_yz_21d")


def labels(prices: DataFrame, horizons=(5, 21)) -> DataFrame:
    """label_rv_h and label_ret_h over the next h rows."""
    f = repaired(prices).withColumn("_r", log_return(1))
    for h in horizons:
        f = f.withColumn(f"label_rv_{h}", F.sqrt(252.0 / h * forward_sum(F.col("_r") * F.col("_r"), "ticker", "date", h)))
        f = f.withColumn(f"label_ret_{h}", F.log(F.lead("adj_close", h).over(by_date()) / F.col("adj_close")))
    return f.drop("_r")


def daily_variance(prices: DataFrame) -> DataFrame:
    """252 times the squared overnight return plus Garman-Klass (not below 0), on prices scaled to adj_close."""
    f = repaired(prices)
    hl, co = F.log(F.col("high") / F.col("low")), F.log(F.col("close") / F.col("open"))
    gk = F.greatest(0.5 * hl * hl - (2 * F.log(F.lit(2.0)) - 1) * co * co, F.lit(0.0))
    night = F.log(F.col("open") * F.col("adj_close") / F.col("close") / F.lag("adj_close").over(by_date()))
    return f.withColumn("rv_d", 252 * (night * night + gk))


def har_dataset(prices: DataFrame, horizons=(5, 21)) -> DataFrame:
    """rv_d, rv_w (5 rows), rv_m (22 rows) and forward variances y_h per ticker and date."""
    f = daily_variance(prices).withColumn("ret", log_return(1))
    f = f.withColumn("rv_w", full(F.col("rv_d"), trailing("ticker", "date", 5), 5)).withColumn("rv_m", full(F.col("rv_d"), trailing("ticker", "date", 22), 22))
    for h in horizons:
        f = f.withColumn(f"y_{h}", 252.0 / h * forward_sum(F.col("ret") * F.col("ret"), "ticker", "date", h))
    return f.where(F.col("ret").isNotNull())
