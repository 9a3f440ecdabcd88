"""Which columns predict what: univariate regressions of a whole panel in one pass, and their summary by group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volframe.operators.evaluate import two_sided


def panel(rows: DataFrame, features: Sequence[str], targets: Mapping[str, Column | str], by: Sequence[str] = ("ticker",), order: str = "date") -> DataFrame:
    """Long form (by, order, target, feature, x, y) of all pairs of a feature and a target that are finite in a row."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    wide = rows.select(*by, order, *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)], *[(F.col(t) if isinstance(t, str) else t).cast("double").alias(f"_t{i}") for i, t in enumerate(targets.values())])
    xs = F.filter(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_f{i}").alias("x")) for i, f in enumerate(features)]), lambda s: finite(s["x"]))
    ys = F.filter(F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"_t{i}").alias("y")) for i, t in enumerate(targets)]), lambda s: finite(s["y"]))
    long = wide.select(*by, order, F.explode(ys).alias("_y"), xs.alias("_xs")).select(*by, order, "_y", F.explode("_xs").alias("_x"))
    return long.select(*by, order, "_y.target", "_x.feature", "_x.x", "_y.y")


def regressions(long: DataFrame, lag: int, least: int = 100, by: Sequence[str] = ("ticker",), order: str = "date") -> DataFrame:
    """Per (by, target, feature): n, slope for one standard deviation of x, t, p, r2; see panel().

    t is Newey-West's with Bartlett weights up to `lag`. With those weights the long-run sum is that of the squares of all
    sums over lag + 1 rows in a row, those at both ends that are cut short included, divided by lag + 1; so two window sums
    do for it, whatever the lag. Groups of fewer than `least` rows, or whose x doesn't vary, have no row. There is one row
    for each value of order in a group.
    """
    keys = [*by, "target", "feature"]
    all_, w = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(order)
    sd, n = F.stddev_pop("x").over(all_), F.count("*").over(all_)
    d = long.withColumns({"_n": n, "_sd": sd, "_mean": F.avg("x").over(all_), "_my": F.avg("y").over(all_)}).where((F.col("_n") >= least) & (F.col("_sd") > 1e-12))
    d = d.withColumn("_z", (F.col("x") - F.col("_mean")) / F.col("_sd")).withColumn("_dy", F.col("y") - F.col("_my"))
    d = d.withColumn("_b", F.avg(F.col("_z") * F.col("_dy")).over(all_))  # the slope, as z has mean 0 and deviation 1
    d = d.withColumn("_e", F.col("_dy") - F.col("_b") * F.col("_z")).withColumn("_s", F.col("_z") * F.col("_e"))
    ahead = w.rowsBetween(0, lag)
    d = d.withColumn("_back", F.sum("_s").over(w.rowsBetween(-lag, 0))).withColumn("_ahead", F.when(F.count("*").over(ahead) <= lag, F.sum("_s").over(ahead)))
    total = (F.sum(F.col("_back") ** 2) + F.coalesce(F.sum(F.col("_ahead") ** 2), F.lit(0.0))) / (lag + 1)
    out = d.groupBy(*keys).agg(F.count("*").alias("n"), F.max("_b").alias("slope"), total.alias("_total"), (1 - F.try_divide(F.sum(F.col("_e") ** 2), F.sum(F.col("_dy") ** 2))).alias("r2"))
    t = F.when(F.col("_total") > 0, F.col("slope") * F.col("n") / F.sqrt("_total"))
    return out.withColumn("t", t).withColumn("p", two_sided(F.col("t"))).select(*keys, "n", "slope", "t", "p", "r2")


def summarise(fits: DataFrame, group: Column, order: Sequence[str] = (), by: str = "ticker") -> DataFrame:
    """Per target, group and feature: tickers, median slope, how many have |t| > 2 and the median's sign, median r2, place.

    place orders the features of a target: groups in the order given, others after them, then by |t| > 2 falling, then by
    name. A null t is not above 2.
    """
    f = fits.withColumn("group", group)
    keys = ["target", "group", "feature"]
    whole = f.withColumn("_m", F.median("slope").over(Window.partitionBy(*keys)))  # a row for each ticker, few in a group
    out = whole.groupBy(*keys).agg(F.count_distinct(by).alias("tickers"), F.max("_m").alias("median_slope"), F.count_if(F.abs("t") > 2).alias("significant"), F.count_if(F.signum("slope") == F.signum("_m")).alias("same_sign"), F.median("r2").alias("median_r2"))
    at = F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col("group")), F.lit(0)) if order else F.lit(0)
    at = F.when(at == 0, F.lit(len(order) + 1)).otherwise(at)
    return out.withColumn("place", F.row_number().over(Window.partitionBy("target").orderBy(at, F.col("significant").desc(), "group", "feature")))


def usable(fits: DataFrame, by: str = "ticker") -> DataFrame:
    """Per ticker the largest number of rows that a regression of it had."""
    return fits.groupBy(by).agg(F.max("n").alias("rows"))
