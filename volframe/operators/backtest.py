"""Strategy returns and their figures, drawdowns, signals, and comparison of models by information criteria."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drawdown(rows: DataFrame, value: str, by: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    top = F.max(value).over(w)
    return rows.withColumn("drawdown", F.when(top > 0, (top - F.col(value)) / top).otherwise(0.0))


def metrics(rows: DataFrame, ret: str, value: str, by: list[str], order: str) -> DataFrame:
    """Sharpe, Sortino, win rate, largest drawdown and Calmar per group; without spread a ratio is 0."""
    r = F.col(ret)
    d = drawdown(rows, value, by, order).groupBy(*by).agg(
        F.count(ret).alias("n"), F.avg(ret).alias("mean"), F.stddev_samp(ret).alias("sd"), F.count_if(r < 0).alias("falls"), F.sqrt(F.avg(F.when(r < 0, r * r))).alias("down"),
        F.avg((r > 0).cast("double")).alias("win_rate"), F.max("drawdown").alias("max_drawdown"), F.sum(ret).alias("total"),
    )
    year = F.sqrt(F.lit(252.0))
    return d.select(*by, "n", "total", F.when(F.col("sd") > 1e-12, F.col("mean") / F.col("sd") * year).otherwise(0.0).alias("sharpe"), F.when((F.col("falls") >= 2) & (F.col("down") > 1e-12), F.col("mean") / F.col("down") * year).otherwise(0.0).alias("sortino"), "win_rate", "max_drawdown", F.when(F.col("max_drawdown") > 1e-12, F.col("mean") * 252 / F.col("max_drawdown")).otherwise(0.0).alias("calmar"))


def z_signal(x: Column, w, limit: float = 1.5) -> Column:
    """rich, cheap or neutral by the z-score against the frame; neutral with fewer than two values or without spread."""
    sd = F.stddev_samp(x).over(w)
    z = F.when((F.count(x).over(w) >= 2) & (sd >= 1e-10), (x - F.avg(x).over(w)) / sd)
    return F.when(z > limit, "rich").when(z < -limit, "cheap").otherwise("neutral")


def term_shape(short: Column, mid: Column, long: Column, flat: float = 0.005) -> Column:
    """Of three points of a term structure: FLAT, HUMPED, INVERTED or NORMAL."""
    return F.when(F.abs(long - short) < flat, "FLAT").when((mid > short) & (mid > long), "HUMPED").when(long < short, "INVERTED").when(long.isNotNull() & short.isNotNull(), "NORMAL")


def term_fit(points: DataFrame, by: list[str], t: str = "T", iv: str = "iv", flat: float = 0.005, hump: float = 0.005) -> DataFrame:
    """One row per term structure: n, slope (least squares), curvature (of a parabola), spread (last less first) and shape.

    Rows with a null are left out. One point has slope 0, two have curvature 0; equal tenors count as they are. The shape is
    FLAT within `flat` of slope, HUMPED if an inner point is above both ends by `hump`, else INVERTED or NORMAL.
    """
    x, y = F.col(t), F.col(iv)
    p = points.where(x.isNotNull() & y.isNotNull()).withColumn("_s", x * x)
    f = p.groupBy(*by).agg(
        F.count("*").alias("n"), F.var_pop(x).alias("xx"), F.var_pop("_s").alias("ss"), F.covar_pop(x, F.col("_s")).alias("xs"), F.covar_pop(x, y).alias("xy"), F.covar_pop(F.col("_s"), y).alias("sy"),
        F.min_by(iv, t).alias("first"), F.max_by(iv, t).alias("last"), F.max(F.struct(iv, (-x).alias("t"))).alias("peak"), F.min(t).alias("lo"), F.max(t).alias("hi"),
    )
    det = F.col("xx") * F.col("ss") - F.col("xs") * F.col("xs")
    slope = F.when((F.col("n") >= 2) & (F.col("xx") > 0), F.col("xy") / F.col("xx")).otherwise(0.0)
    curvature = F.when((F.col("n") >= 3) & (det > 0), (F.col("xx") * F.col("sy") - F.col("xs") * F.col("xy")) / det).otherwise(0.0)
    top, at = F.col(f"peak.{iv}"), -F.col("peak.t")
    humped = (F.col("n") >= 3) & (at > F.col("lo")) & (at < F.col("hi")) & (top > F.col("first") + hump) & (top > F.col("last") + hump)
    shape = F.when(F.abs(slope) < flat, "FLAT").when(humped, "HUMPED").when(slope < -flat, "INVERTED").otherwise("NORMAL")
    return f.select(*by, "n", slope.alias("slope"), curvature.alias("curvature"), (F.col("last") - F.col("first")).alias("spread"), shape.alias("shape"))


def inversions(points: DataFrame, by: list[str], t: str = "T", iv: str = "iv", threshold: float = 0.01) -> DataFrame:
    """by, near, far: the tenors of which the nearer has the higher volatility, by more than threshold.

    A term structure is a short array (one entry per expiry), compared within its row. Rows with a null are left out.
    """
    rows = points.where(F.col(t).isNotNull() & F.col(iv).isNotNull()).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(t).alias("t"), F.col(iv).alias("v")))).alias("_p"))
    near = rows.select(*by, "_p", F.explode("_p").alias("_n"))
    far = near.withColumn("_f", F.explode(F.filter("_p", lambda p: (p["t"] > F.col("_n.t")) & (F.col("_n.v") > p["v"] + threshold))))
    return far.select(*by, F.col("_n.t").alias("near"), F.col("_f.t").alias("far"))


def information_criteria(fits: DataFrame, by: list[str]) -> DataFrame:
    """fits(model, n_params, n_obs, sse): Gaussian AIC and BIC, difference to the best, Akaike weight."""
    n = F.col("n_obs")
    loglik = -n / 2 * (F.log(2 * F.lit(3.141592653589793) * F.col("sse") / n) + 1)
    f = fits.withColumn("aic", 2 * F.col("n_params") - 2 * loglik).withColumn("bic", F.log(n) * F.col("n_params") - 2 * loglik)
    w = Window.partitionBy(*by)
    f = f.withColumn("delta_aic", F.col("aic") - F.min("aic").over(w))
    return f.withColumn("weight", F.exp(-F.col("delta_aic") / 2) / F.sum(F.exp(-F.col("delta_aic") / 2)).over(w))


def cumulative(rows: DataFrame, pnl: str, by: list[str], order: str) -> DataFrame:
    """rows with the running sum of the P&L; nulls add nothing, days of a group don't repeat."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("cum_pnl", F.coalesce(F.sum(pnl).over(w), F.lit(0.0)))


def rolling_sharpe(rows: DataFrame, value: str, by: list[str], order: str, days: int = 63) -> DataFrame:
    """rows with the annualised Sharpe ratio of the last `days` changes of value; null before, 0 without spread."""
    w = Window.partitionBy(*by).orderBy(order)
    ret = F.when(F.lag(value).over(w) > 0, F.col(value) / F.lag(value).over(w) - 1)
    f = rows.withColumn("_ret", ret)
    last = w.rowsBetween(-(days - 1), 0)
    sd = F.stddev_samp("_ret").over(last)
    sharpe = F.when(sd > 1e-12, F.avg("_ret").over(last) / sd * F.sqrt(F.lit(252.0))).otherwise(0.0)
    return f.withColumn("rolling_sharpe", F.when(F.count("_ret").over(last) == days, sharpe)).drop("_ret")


def pnl_attribution(rows: DataFrame, pnl: str = "net_pnl", strategy: str = "strategy") -> DataFrame:
    """strategy and its total; one row "total" where there is no strategy column."""
    by = F.col(strategy) if strategy in rows.columns else F.lit("total")
    return rows.groupBy(by.alias("strategy")).agg(F.sum(pnl).alias("pnl"))


def by_strategy_and_regime(rows: DataFrame, regimes: list[str], pnl: str = "net_pnl") -> DataFrame:
    """Per strategy: sum, mean and share of gains, and the mean in each regime; null where a regime has no day."""
    return rows.groupBy("strategy").agg(F.sum(pnl).alias("total"), F.avg(pnl).alias("mean"), F.avg((F.col(pnl) > 0).cast("double")).alias("hit_rate"), *[F.avg(F.when(F.col("regime") == g, F.col(pnl))).alias(f"mean_{g}") for g in regimes])


def priced_legs(legs: DataFrame, surfaces: DataFrame, rate: float) -> DataFrame:
    """legs(ticker, as_of, option_type, strike, T, spot, quantity, last_iv) with iv, price and Greeks per share.

    Each leg is looked up at its own moneyness and remaining time on its day's surface (surfaces(ticker, as_of, slices));
    without one, or with an expired leg, the last known volatility counts, or 0.
    """
    from volframe.functions.pricing import with_greeks
    from volframe.operators import expiry as E

    f = legs.join(surfaces.select("ticker", "as_of", "slices"), ["ticker", "as_of"], "left").withColumn("_b", E.bracket(F.col("slices"), F.col("T")))
    f = f.withColumn("_k", F.log(F.col("strike") / (F.col("spot") * F.exp(F.lit(rate) * F.col("T")))))
    found = F.when(F.col("T") > 0, E.iv(F.col("_b"), F.col("_k")))
    f = f.withColumn("iv", F.coalesce(F.when(found > 0, found), F.col("last_iv"), F.lit(0.0))).withColumn("_r", F.lit(rate))
    return with_greeks(f, "spot", "strike", "T", "_r", "iv", F.col("option_type") == "call").drop("slices", "_b", "_k", "_r")


def portfolio_greeks(legs: DataFrame, by: list[str], multiplier: float = 100.0) -> DataFrame:
    """Cash Greeks and value of priced legs, by group; a null quantity counts as 0."""
    q = F.coalesce("quantity", F.lit(0)) * multiplier
    return legs.groupBy(*by).agg(*[F.sum(F.col(c) * q).alias(c) for c in ("price", "delta", "gamma", "vega", "theta")])


def butterfly_mispricing(smiles: DataFrame, by: list[str], market: str = "market_iv", model: str = "model_iv", least_bps: float = 50.0) -> DataFrame:
    """Inner strikes whose butterfly differs from the model's by at least least_bps: the three strikes, both, the gap.

    A butterfly is the mean of its neighbours' volatilities less its own; rows with a null volatility are left out first.
    """
    w = Window.partitionBy(*by).orderBy("strike")
    s = smiles.where(F.col(market).isNotNull() & F.col(model).isNotNull())
    fly = lambda c: (F.lag(c).over(w) + F.lead(c).over(w)) / 2 - F.col(c)
    s = s.select(*by, F.lag("strike").over(w).alias("strike_lo"), F.col("strike").alias("strike_mid"), F.lead("strike").over(w).alias("strike_hi"), fly(market).alias("market_fly"), fly(model).alias("model_fly"))
    s = s.withColumn("mispricing_bps", (F.col("market_fly") - F.col("model_fly")) * 10_000)
    return s.where(F.abs("mispricing_bps") >= least_bps)


def calendar_value(iv_near: Column, iv_far: Column, t_near: Column, t_far: Column) -> Column:
    """Far less near total variance; below 0 it can be an arbitrage."""
    return iv_far * iv_far * t_far - iv_near * iv_near * t_near


def composite_signal(skew_signal: Column, shape: Column, regime: Column, atm_z: Column, limit: float = 1.5) -> tuple[Column, Column]:
    """(recommendation, confidence) from skew (rich, cheap), term structure, volatility regime and the level's z-score.

    Each points to an action with a score; the highest wins, of equal ones the first in the order below, with its share of
    all scores as confidence. Without any, neutral.
    """
    z = F.coalesce(atm_z, F.lit(0.0))
    one = lambda c, x: F.when(c, F.lit(x) if isinstance(x, float) else x).otherwise(0.0)
    scores = {
        "buy_vol": one(z < -limit, F.abs(z)) + one(regime == "Crisis", 2.0), "sell_vol": one(z > limit, F.abs(z)) + one(regime == "Low", 1.0),
        "buy_skew": one(skew_signal == "rich", 1.0), "sell_skew": one(skew_signal == "cheap", 1.0), "flatten": one(shape == "INVERTED", 1.0), "steepen": one(shape == "NORMAL", 0.5),
    }
    ranked = F.array(*[F.struct(s.alias("score"), F.lit(-i).alias("place"), F.lit(n).alias("name")) for i, (n, s) in enumerate(scores.items())])
    best, total = F.array_max(ranked), F.aggregate(ranked, F.lit(0.0), lambda a, x: a + x["score"])
    some = best["score"] >= 0.1
    return F.when(some, best["name"]).otherwise("neutral"), F.when(some, best["score"] / total).otherwise(0.0)


def rmse(rows: DataFrame, model: str, market: str, by: list[str], weight: str | None = None) -> DataFrame:
    """n and root mean squared error of model against market, weighted if asked; rows with a null on either side don't count."""
    ok = rows.where(F.col(model).isNotNull() & F.col(market).isNotNull())
    w = F.coalesce(F.col(weight), F.lit(0.0)) if weight else F.lit(1.0)
    gap = F.col(model) - F.col(market)
    return ok.groupBy(*by).agg(F.count("*").alias("n"), F.sqrt(F.try_divide(F.sum(w * gap * gap), F.sum(w))).alias("rmse"))
