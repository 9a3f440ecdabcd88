"""Queries behind screens and reports: latest features, smiles, term structures, forecasts and how they turned out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volframe.operators import expiry as E
from volframe.operators.features import TENORS_DAYS
from volframe.operators.surface import implied_vol, otm_quotes
from volframe.operators.timeseries import day_numbers

# fixed values: deltas of the tenor and delta table, 0 being at the money
DELTA_COLUMNS = {"10P": -0.10, "25P": -0.25, "ATM": 0.0, "25C": 0.25, "10C": 0.10}


def overview(features: DataFrame, as_of: Column, columns: Sequence[str], trend: str, stale_days: int = 5, points: int = 63) -> DataFrame:
    """Per ticker its last row on or before as_of, and the last values of `trend`, oldest first, nulls left out.

    Tickers whose last row is more than stale_days old are left out. as_of is a constant; one row per ticker and date.
    """
    w = Window.partitionBy("ticker").orderBy(F.col("date").desc())
    rows = features.where(F.col("date") <= as_of).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= points)
    last = F.max(F.when(F.col("_n") == 1, F.struct("date", *columns))).alias("last")
    values = F.array_sort(F.collect_list(F.when(F.col(trend).isNotNull(), F.struct("date", F.col(trend).alias("v"))))).alias("trend")
    out = rows.groupBy("ticker").agg(last, values).where(F.datediff(as_of, F.col("last.date")) <= stale_days)
    return out.select("ticker", "last.*", F.transform("trend", lambda x: x["v"]).alias("trend"))


def on_or_before(rows: DataFrame, target: Column, date: str = "date") -> DataFrame:
    """Per ticker the latest date that is not after target."""
    return rows.where(F.col(date) <= target).groupBy("ticker").agg(F.max(date).alias(date))


def history(rows: DataFrame, ticker: str, start=None, end=None) -> DataFrame:
    """A ticker's rows from start to end, both included; filters reach the scan."""
    out = rows.where(F.col("ticker") == ticker)
    out = out if start is None else out.where(F.col("date") >= F.lit(start).cast("date"))
    return out if end is None else out.where(F.col("date") <= F.lit(end).cast("date"))


def expiry_table(slices: DataFrame) -> DataFrame:
    """Fitted expiries with days, forward, its source and the fit error in points."""
    return slices.select("ticker", "as_of", "expiration", F.round(F.col("T") * 365).cast("int").alias("days"), "T", "forward", "source", (100 * F.col("rmse")).alias("fit_rmse_pts"))


def default_expiries(slices: DataFrame, targets: Sequence[int] = (30, 91)) -> DataFrame:
    """The expiry nearest to each target of days, each once, in the order of the targets; of two as near the earlier."""
    table = expiry_table(slices)
    near = [F.min(F.struct(F.abs(F.col("days") - t).alias("gap"), "T", "expiration")).alias(f"n{i}") for i, t in enumerate(targets)]
    out = table.groupBy("ticker", "as_of").agg(*near)
    return out.select("ticker", "as_of", F.posexplode(F.array_distinct(F.array(*[F.col(f"n{i}.expiration") for i in range(len(targets))]))).alias("place", "expiration"))


def smile_curves(slices: DataFrame, points: int = 121, pad: float = 0.02) -> DataFrame:
    """Fitted smiles over the quoted strikes and a little beyond: k, moneyness in percent, iv."""
    s = slices.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    k = F.col("k_min") - pad + F.col("_i") * (F.col("k_max") - F.col("k_min") + 2 * pad) / (points - 1)
    s = s.withColumn("k", k)
    iv = F.sqrt(F.greatest(E.wing_variance(F.struct(*E.SHAPE), F.col("k")), F.lit(0.0)) / F.col("T"))
    return s.select("ticker", "as_of", "expiration", F.round(F.col("T") * 365).cast("int").alias("days"), F.col("_i").alias("point"), "k", (100 * F.exp("k")).alias("moneyness"), iv.alias("iv"))


def smile_quotes(chain: DataFrame, slices: DataFrame, rate: float = 0.05, least_off: float = 0.01) -> DataFrame:
    """Out-of-the-money quotes beside the fit they went into: k, moneyness in percent, iv, bid_iv, ask_iv, half_spread, fit
    (the smile's volatility at k), residual in points and used, all in volatility.

    chain as for surface.otm_quotes, without discount: each quote is discounted as its expiry was, looked up in a map of the
    surface's expiries by rounded tenor, so that parity gives the fit's own forward; a tenor that isn't there takes `rate`.
    slices have T, expiration, discount and the shape. used tells quotes within the fit's own bounds from those off it; it
    and the fit are null where no smile was fitted. Snapshots without a surface are there with nulls. One slice per tenor.
    """
    key = lambda t: F.round(t, 8)
    entry = F.struct(key(F.col("T")).alias("key"), F.struct((-F.log("discount") / F.col("T")).alias("rate"), "expiration", *E.SHAPE).alias("value"))
    by = slices.where(F.col("T") > 0).groupBy("ticker", "as_of").agg(F.map_from_entries(F.collect_list(entry)).alias("_expiries"))
    at = F.try_element_at(F.col("_expiries"), key(F.col("T")))
    rows = chain.drop("discount", "expiration").join(by, ["ticker", "as_of"], "left").withColumn("_s", at).drop("_expiries")
    q = otm_quotes(rows.withColumn("discount", F.exp(-F.coalesce("_s.rate", F.lit(rate)) * F.col("T"))))
    side = lambda c: implied_vol(c, "forward", "strike", "T", "discount", "is_call")
    q = q.withColumns({"bid_iv": side("bid"), "ask_iv": side("ask")})
    fit = F.sqrt(F.greatest(E.wing_variance(F.col("_s"), F.col("k")), F.lit(0.0)) / F.col("T"))
    q = q.withColumn("fit", F.when(F.col("_s").isNotNull(), fit)).withColumn("_off", F.abs(F.col("sigma") - F.col("fit")))
    w = Window.partitionBy("ticker", "as_of", "T")  # as many rows as an expiry has strikes
    q = q.withColumn("_mid", F.median("_off").over(w)).withColumn("_mad", F.median(F.abs(F.col("_off") - F.col("_mid"))).over(w))
    bound = F.greatest(4 * 1.4826 * F.col("_mad"), F.coalesce("spread_iv", F.lit(0.01)), F.lit(least_off))
    return q.select(
        "ticker", "as_of", "T", F.col("_s.expiration").alias("expiration"), "strike", "is_call", "forward", "k", (100 * F.exp("k")).alias("moneyness"), F.col("sigma").alias("iv"), "bid_iv", "ask_iv", (0.5 * F.col("spread_iv")).alias("half_spread"),
        "fit", (100 * (F.col("sigma") - F.col("fit"))).alias("residual"), (F.col("_off") <= bound).alias("used"),
    )


def delta_markers(slices: DataFrame, deltas: Sequence[float] = (-0.25, 0.25)) -> DataFrame:
    """Moneyness in percent of the deltas at each expiry of a surface."""
    s = E.surfaces(slices).withColumn("_s", F.explode("slices")).withColumn("_b", E.bracket(F.col("slices"), F.col("_s.T")))
    return s.select("ticker", "as_of", F.col("_s.expiration").alias("expiration"), *[(100 * F.exp(E.delta_strike(F.col("_b"), d))).alias(f"{'put' if d < 0 else 'call'}_{round(abs(d) * 100)}") for d in deltas])


def term_structure(slices: DataFrame, points: int = 120) -> DataFrame:
    """At-the-money volatility at `points` tenors between the first and last expiry, evenly spaced in logs, and at the expiries."""
    s = E.surfaces(slices)
    first, last = F.get("slices", F.lit(0))["T"], F.get(F.col("slices"), F.size("slices") - 1)["T"]
    curve = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: first * F.pow(last / first, i / (points - 1)))
    tenor = F.explode(F.concat(F.transform(curve, lambda t: F.struct(t.alias("t"), F.lit(False).alias("listed"))), F.transform("slices", lambda x: F.struct(x["T"].alias("t"), F.lit(True).alias("listed")))))
    s = s.select("*", tenor.alias("_t")).withColumn("_b", E.bracket(F.col("slices"), F.col("_t.t")))
    return s.select("ticker", "as_of", F.col("_t.listed").alias("listed"), (F.col("_t.t") * 365).alias("days"), E.iv(F.col("_b"), F.lit(0.0)).alias("iv"))


def delta_tenor_table(slices: DataFrame, extrapolate: bool = False) -> DataFrame:
    """Volatility by tenor and delta; null beyond the expiries or quoted strikes, unless extrapolate is set."""
    s = E.surfaces(slices).withColumn("_t", F.explode(F.array(*[F.struct(F.lit(n).alias("tenor"), F.lit(d / 365).alias("t")) for n, d in TENORS_DAYS.items()])))
    s = s.withColumn("_b", E.bracket(F.col("slices"), F.col("_t.t")))
    s = s.withColumns({f"_k{c}": F.lit(0.0) if d == 0 else E.delta_strike(F.col("_b"), d) for c, d in DELTA_COLUMNS.items()})
    b = F.col("_b")
    cell = lambda k: F.when(F.lit(True) if extrapolate else b["inside"] & E.is_observed(b, k), E.iv(b, k))
    return s.select("ticker", "as_of", F.col("_t.tenor").alias("tenor"), *[cell(F.col(f"_k{c}")).alias(c) for c in DELTA_COLUMNS])


def latest_forecasts(forecasts: DataFrame, as_of: Column) -> DataFrame:
    """Per ticker and horizon the newest forecast on or before as_of."""
    w = Window.partitionBy("ticker", "horizon").orderBy(F.col("date").desc())
    return forecasts.where(F.col("date") <= as_of).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def window_end(rows: DataFrame, sessions: DataFrame, horizon: Column, date: str = "date") -> DataFrame:
    """rows with window_end, the session that is `horizon` sessions after the date; beyond the calendar weekdays count."""
    days = day_numbers(sessions)
    first = days.groupBy("pos").agg(F.min("day").alias("window_end"))
    out = rows.join(days.select(F.col("day").alias(date), F.col("pos").alias("_p")), date, "left").withColumn("_e", F.col("_p") + horizon)
    return out.join(first.withColumnRenamed("pos", "_e"), "_e", "left").drop("_p", "_e")


def record(forecasts: DataFrame, by: Sequence[str] = ("ticker", "horizon")) -> DataFrame:
    """n, rmse and bias in points of forecast and implied volatility, and the share inside the range, of closed windows."""
    k = forecasts.dropna(subset=["realised_vol", "forecast_vol", "implied_vol"])
    gap = lambda c: F.col(c) - F.col("realised_vol")
    rmse = lambda c: 100 * F.sqrt(F.avg(gap(c) * gap(c)))
    inside = F.col("realised_vol").between(F.col("lo80_vol"), F.col("hi80_vol")).cast("double")
    return k.groupBy(*by).agg(
        F.count("*").alias("n"), rmse("forecast_vol").alias("rmse_forecast"), rmse("implied_vol").alias("rmse_implied"), (100 * F.avg(gap("forecast_vol"))).alias("bias_forecast"), (100 * F.avg(gap("implied_vol"))).alias("bias_implied"),
        F.avg(inside).alias("coverage80"),
    )
