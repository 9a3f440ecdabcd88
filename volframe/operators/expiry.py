"""The continuous surface over fitted expiries: one row per surface with its slices as a short array, sorted by T.

Total variance is linear in T between the two expiries around a tenor, volatility is flat beyond the first and the last
one, and beyond the quoted strikes of a slice its total variance goes on along the tangent, which may not fall outwards.
Queries are Column expressions on such a row, and one Arrow function that searches strikes; nothing is shuffled after
surfaces() has put the slices together.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from volframe.functions.pricing import ncdf, normal_cdf, svi_extrapolated

SHAPE = ("a", "b", "rho", "m", "sigma", "k_min", "k_max")
#: Halvings of the bracket in which delta_strike looks: 7 / 2^40 is below 1e-11.
HALVINGS = 40


def _let(x: Column, f) -> Column:
    """f(x) with x evaluated once: bodies of lambdas share no common expressions."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def surfaces(slices: DataFrame, keys=("ticker", "as_of")) -> DataFrame:
    """slices(keys, T, a, b, rho, m, sigma, k_min, k_max, ...) as keys and `slices`, an array of all other columns by T.

    Slices with a null among T and the shape are left out; of slices with equal T all stay, in the order of their columns.
    A surface has as many slices as expiries are listed, some dozens. The number of tasks is fixed: the rows are few, the
    work on them is not, and adaptive execution would put them into one task.
    """
    spark = slices.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rest = [c for c in slices.columns if c not in (*keys, "T")]
    whole = slices.dropna(subset=["T", *SHAPE]).where(F.col("T") > 0)
    return whole.repartition(parts, *keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("T", *rest))).alias("slices"))


def wing_variance(s: Column, k: Column) -> Column:
    """Total variance of one slice at k, with its tangents beyond the quoted strikes."""
    return svi_extrapolated(k, *[s[c] for c in SHAPE])


def bracket(slices: Column, t: Column) -> Column:
    """struct(lo, hi, x, t, inside): the slices around tenor t, the weight of the later one, whether t is between them.

    Beyond the first or the last slice both are that slice. Null for an empty array.
    """
    first, last = F.get(slices, F.lit(0)), F.get(slices, F.size(slices) - 1)
    below, above = F.filter(slices, lambda s: s["T"] < t), F.filter(slices, lambda s: s["T"] >= t)
    edge = F.when(t <= first["T"], first).when(t >= last["T"], last)
    lo = F.coalesce(edge, F.get(below, F.size(below) - 1))
    hi = F.coalesce(edge, F.get(above, F.lit(0)))
    x = F.when(lo["T"] < hi["T"], (t - lo["T"]) / (hi["T"] - lo["T"])).otherwise(F.lit(0.0))
    inside = (t >= first["T"] - 1e-12) & (t <= last["T"] + 1e-12)
    return F.when(F.size(slices) > 0, F.struct(lo.alias("lo"), hi.alias("hi"), x.alias("x"), t.alias("t"), inside.alias("inside")))


def total_variance(b: Column, k: Column) -> Column:
    """b: a bracket (best staged as a column of its own)."""
    lo, hi = wing_variance(b["lo"], k), wing_variance(b["hi"], k)
    w = F.when(b["lo"]["T"] == b["hi"]["T"], lo * b["t"] / b["lo"]["T"]).otherwise((1 - b["x"]) * lo + b["x"] * hi)
    return F.when(b.isNotNull() & k.isNotNull(), F.greatest(w, F.lit(1e-10)))


def iv(b: Column, k: Column) -> Column:
    return F.sqrt(total_variance(b, k) / b["t"])


def quoted_range(b: Column) -> tuple[Column, Column]:
    """Strikes (as k) that both slices around the tenor quote."""
    return F.greatest(b["lo"]["k_min"], b["hi"]["k_min"]), F.least(b["lo"]["k_max"], b["hi"]["k_max"])


def is_observed(b: Column, k: Column) -> Column:
    """Whether k is quoted by both slices; beyond the expiries only a tenor that is the edge expiry's own counts."""
    low, high = quoted_range(b)
    near = F.abs(b["t"] - b["lo"]["T"]) <= 1e-8 + 1e-5 * F.abs(b["lo"]["T"])
    return ((b["lo"]["T"] != b["hi"]["T"]) | near) & (k >= low) & (k <= high)


def _wings(k: np.ndarray, a, b, rho, m, sigma, lo, hi) -> np.ndarray:
    """wing_variance on arrays."""
    at = np.clip(k, lo, hi)
    root = np.sqrt((at - m) ** 2 + sigma * sigma)
    slope = b * (rho + (at - m) / root)
    slope = np.where(k < lo, np.minimum(slope, 0), np.where(k > hi, np.maximum(slope, 0), 0))
    return a + b * (rho * (at - m) + root) + slope * (k - at)


@F.pandas_udf(DoubleType())
def _delta_k(t: pd.Series, x: pd.Series, delta: pd.Series, t0: pd.Series, a0: pd.Series, b0: pd.Series, rho0: pd.Series, m0: pd.Series, sigma0: pd.Series, lo0: pd.Series, hi0: pd.Series, t1: pd.Series, a1: pd.Series, b1: pd.Series, rho1: pd.Series, m1: pd.Series, sigma1: pd.Series, lo1: pd.Series, hi1: pd.Series) -> pd.Series:
    t, x, delta, t0, t1, *rest = (np.asarray(v, float) for v in (t, x, delta, t0, t1, a0, b0, rho0, m0, sigma0, lo0, hi0, a1, b1, rho1, m1, sigma1, lo1, hi1))
    target, one = np.where(delta > 0, delta, 1 + delta), t0 == t1

    def gap(k: np.ndarray) -> np.ndarray:
        first = _wings(k, *rest[:7])
        w = np.where(one, first * t / t0, (1 - x) * first + x * _wings(k, *rest[7:]))
        root = np.sqrt(np.maximum(w, 1e-10))
        return normal_cdf(-k / root + root / 2) - target

    with np.errstate(all="ignore"):
        lo, hi = np.full(len(t), -4.0), np.full(len(t), 3.0)
        ok = (gap(lo) >= 0) & (gap(hi) <= 0)
        for _ in range(HALVINGS):
            mid = (lo + hi) / 2
            above = gap(mid) > 0
            lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    return pd.Series(np.where(ok, (lo + hi) / 2, np.nan)).astype(object).where(ok, None)


def delta_strike(b: Column, delta: float | Column) -> Column:
    """k at which the forward delta is `delta` (below 0: a put's) with the smile's own volatility there; null if not in -4..3.

    The call delta falls with k on a smile free of arbitrage, so halving finds it: an Arrow function over all rows of a
    batch at once (as nested lambdas the same search took over ten times as long). b is best staged as a column.
    """
    delta = delta if isinstance(delta, Column) else F.lit(float(delta))
    side = lambda s: [s["T"], *[s[c] for c in SHAPE]]
    return _delta_k(b["t"], b["x"], delta.cast("double"), *side(b["lo"]), *side(b["hi"]))


def variance_swaps(slices: DataFrame, name: str = "vs_w", keys=("ticker", "as_of", "T"), steps: int = 4000, low: float = -2.5, high: float = 1.5) -> DataFrame:
    """slices with the fair total variance of a variance swap: twice the integral of out-of-the-money prices over e^k.

    The trapezoid's points are rows, which are summed before any shuffle. There is one slice per key; a null among its
    shape gives null.
    """
    h = (high - low) / steps
    p = slices.select(*keys, F.struct(*SHAPE).alias("s"), F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("i"))
    p = p.withColumn("k", low + F.col("i") * h).withColumn("root", F.sqrt(F.greatest(wing_variance(F.col("s"), F.col("k")), F.lit(1e-12))))
    p = p.withColumn("d", -F.col("k") / F.col("root") + F.col("root") / 2)
    sign = F.when(F.col("k") >= 0, F.lit(1.0)).otherwise(-1.0)
    price = sign * (ncdf(sign * F.col("d")) - F.exp("k") * ncdf(sign * (F.col("d") - F.col("root"))))
    edge = F.when(F.col("i").isin(0, steps), 0.5).otherwise(1.0)
    whole = p.groupBy(*keys).agg(F.sum(2 * h * edge * price * F.exp(-F.col("k"))).alias(name))
    return slices.join(whole, list(keys), "left")


def variance_swap_vol(b: Column, n: Column, field: str = "vs_w") -> Column:
    """Volatility at the bracket's tenor, linear in total variance; null beyond the expiries or with fewer than two slices."""
    w = (1 - b["x"]) * b["lo"][field] + b["x"] * b["hi"][field]
    return F.when(b["inside"] & (n >= 2), F.sqrt(w / b["t"]))


def grid(surfaces: DataFrame, strikes: list[float], tenors: list[float]) -> DataFrame:
    """Long form of each surface on a grid: k, tenor, w, iv, observed. The grid is an argument of the query, not a table."""
    out = surfaces.withColumn("tenor", F.explode(F.array(*map(F.lit, tenors)))).withColumn("_b", bracket(F.col("slices"), F.col("tenor")))
    out = out.withColumn("k", F.explode(F.array(*map(F.lit, strikes))))
    w = total_variance(F.col("_b"), F.col("k"))
    return out.withColumn("w", w).withColumn("iv", F.sqrt(F.col("w") / F.col("tenor"))).withColumn("observed", is_observed(F.col("_b"), F.col("k"))).drop("_b", "slices")


def bilinear(points: Column, k: Column, t: Column) -> Column:
    """Volatility of a stored grid at (k, t): points is an array of struct(tenor, smile: array of struct(k, iv)), all sorted.

    Linear in k and in t within the cell, and with the cell's own slopes beyond the grid.
    """

    def cell(xs: Column, at: Column, name: str) -> tuple[Column, Column]:
        n = F.size(F.filter(xs, lambda p: p[name] <= at))
        i = F.greatest(F.lit(0), F.least(n - 1, F.size(xs) - 2))
        return F.get(xs, i), F.get(xs, i + 1)

    def across(smile: Column) -> Column:
        a, b = cell(smile, k, "k")
        return a["iv"] + (b["iv"] - a["iv"]) * (k - a["k"]) / (b["k"] - a["k"])

    p, q = cell(points, t, "tenor")
    lo, hi = across(p["smile"]), across(q["smile"])
    return lo + (hi - lo) * (t - p["tenor"]) / (q["tenor"] - p["tenor"])


def from_long(frame: DataFrame, keys=("ticker", "as_of")) -> DataFrame:
    """Long grid (keys, k, tenor, iv) as one row per surface with `points` for bilinear(); repeated points are averaged."""
    one = frame.groupBy(*keys, "tenor", "k").agg(F.avg("iv").alias("iv"))
    smile = one.groupBy(*keys, "tenor").agg(F.array_sort(F.collect_list(F.struct("k", "iv"))).alias("smile"))
    return smile.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("tenor", "smile"))).alias("points"))


def smile_at(points: Column, t: Column) -> Column:
    """The smile of a stored grid at tenor t: array of struct(k, iv) at the strikes of the tenors around it."""
    i = F.greatest(F.lit(0), F.least(F.size(F.filter(points, lambda p: p["tenor"] <= t)) - 1, F.size(points) - 2))
    two = lambda p, q: F.zip_with(p["smile"], q["smile"], lambda a, b: F.struct(a["k"].alias("k"), (a["iv"] + (b["iv"] - a["iv"]) * (t - p["tenor"]) / (q["tenor"] - p["tenor"])).alias("iv")))
    return _let(F.struct(F.get(points, i).alias("p"), F.get(points, i + 1).alias("q")), lambda x: two(x["p"], x["q"]))


def smile_iv(smile: Column, k: Column) -> Column:
    """Linear in k, with the slopes of the first and last pair beyond the ends."""
    i = F.greatest(F.lit(0), F.least(F.size(F.filter(smile, lambda p: p["k"] <= k)) - 1, F.size(smile) - 2))
    line = lambda a, b: a["iv"] + (b["iv"] - a["iv"]) * (k - a["k"]) / (b["k"] - a["k"])
    return _let(i, lambda j: line(F.get(smile, j), F.get(smile, j + 1)))


def smile_delta_strike(smile: Column, delta: float, t: Column, rounds: int = 8) -> Column:
    """k of a forward delta on a smile (see smile_at), by repeating k = -N^-1(delta) sigma root(t) + sigma^2 t / 2."""
    z = NormalDist().inv_cdf(delta if delta > 0 else 1 + delta)
    k = lambda v: -F.lit(z) * v * F.sqrt(t) + v * v * t / 2
    vol = F.aggregate(F.sequence(F.lit(2), F.lit(rounds)), smile_iv(smile, F.lit(0.0)), lambda v, _: _let(k(v), lambda at: smile_iv(smile, at)))
    return _let(vol, k)
