"""Volatility forecasts: the HAR family with implied volatility and releases, walk-forward, and their comparison."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volframe.functions.pricing import qlike
from volframe.operators import evaluate as E
from volframe.operators.features import calendar_columns, historical_event_variance
from volframe.operators.realized import by_date, har_dataset
from volframe.operators.timeseries import forward_sum, trailing
from volframe.sources.store import kept

# fixed values: implied input of each horizon with its fallback, the days it covers, and the columns of the wide model
IMPLIED_INPUT = {5: ("atm_7d", "atm_14d"), 21: ("vs_30d", "atm_30d")}
TENOR_DAYS = {"atm_7d": 7, "atm_14d": 14, "vs_30d": 30, "atm_30d": 30}
HAR_TERMS = ("rv_d", "rv_w", "rv_m")
SURFACE_RAW = ("ts_30_91", "rr25_30d", "bf25_30d", "atm_skew_30d", "mkt_skew", "vrp_30d")


def har() -> dict[str, Column]:
    """Terms of the HAR model: logs of the daily, weekly and monthly variance."""
    return {f"log_{c}": E.log_of(c) for c in HAR_TERMS}


def implied_column(h: int) -> str:
    """The implied column that goes with a horizon of h sessions: an index in points, or the 30-day variance swap."""
    return "mkt_vix9d" if h <= 7 else "vs_30d"


def implied_variance(h: int) -> Column:
    """The market's own forecast, unadjusted; indices are in points. Null where it isn't positive."""
    c = implied_column(h)
    v = F.col(c) / 100 if c.startswith("mkt_") else F.col(c)
    return F.when(v > 0, v * v)


def implied_regression(h: int) -> dict[str, Column]:
    return {"log_iv": F.log(implied_variance(h))}


def har_iv(h: int) -> dict[str, Column]:
    return har() | implied_regression(h)


def har_x(h: int) -> dict[str, Column]:
    """HAR and implied terms with the surface's columns; to be fitted with a ridge of 5."""
    more = {"log_vs_91d": 2 * E.log_of("vs_91d"), "log_vix_ts": E.log_of("mkt_vix3m") - E.log_of("mkt_vix"), "log_vvix": E.log_of("mkt_vvix")}
    return har_iv(h) | more | {c: F.col(c) for c in SURFACE_RAW}


def event_terms(use_implied: bool = True) -> dict[str, Column]:
    """Terms without release days, for targets without them."""
    terms = {f"log_{c}_ex": E.log_of(f"{c}_ex") for c in HAR_TERMS}
    return terms | ({"log_iv_ex": 2 * E.log_of("iv_ex")} if use_implied else {})


def with_implied(rows: DataFrame, h: int) -> DataFrame:
    """rows with iv_in and iv_src: the implied input of the horizon, its fallback where it is null."""
    first, second = IMPLIED_INPUT[h]
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("double")
    source = F.when(have(first).isNotNull(), first).when(have(second).isNotNull(), second)
    return rows.withColumn("iv_in", F.coalesce(have(first), have(second))).withColumn("iv_src", source)


def event_dataset(prices: DataFrame, events: DataFrame, days: DataFrame, horizons=(5, 21)) -> DataFrame:
    """har_dataset with release days taken out: rv_*_ex, y_h_ex, ev_day, ev_next, ev_in_h and ev_hist_var.

    On a release day rv_d_ex is that of the day before, if that has none; weekly and monthly means need 4 of 5 and 18 of 22
    other days. A target without its release days is the mean squared return of the others. Tickers without events have the
    plain values. prices have one row per ticker and date; events(ticker, event).
    """
    ds = har_dataset(prices, horizons)
    marks = events.where(F.col("event").isNotNull()).select("ticker", F.col("event").alias("date"), F.lit(True).alias("ev_day")).distinct()
    f = ds.join(marks, ["ticker", "date"], "left").withColumn("ev_day", F.coalesce("ev_day", F.lit(False)))
    f = f.withColumn("_ex", F.when(~F.col("ev_day"), F.col("rv_d")))
    mean = lambda n, least: F.when(F.count("_ex").over(trailing("ticker", "date", n)) >= least, F.avg("_ex").over(trailing("ticker", "date", n)))
    f = f.withColumns({"rv_d_ex": F.coalesce(F.col("_ex"), F.lag("_ex").over(by_date())), "rv_w_ex": mean(5, 4), "rv_m_ex": mean(22, 18)})
    plain = F.when(~F.col("ev_day"), F.col("ret") ** 2).otherwise(0.0)
    for h in horizons:
        n = forward_sum((~F.col("ev_day")).cast("double"), "ticker", "date", h)
        f = f.withColumn(f"y_{h}_ex", F.when(F.col(f"y_{h}").isNotNull(), F.try_divide(252 * forward_sum(plain, "ticker", "date", h), n)))
    f = calendar_columns(f, events, days)
    f = f.withColumnsRenamed({"earn_next_date": "ev_next"}).withColumns({f"ev_in_{h}": F.coalesce(F.col("earn_days_to") <= h, F.lit(False)) for h in horizons})
    closes = prices.select("ticker", "date", F.coalesce("adj_close", "close").alias("close"))
    hist = historical_event_variance(closes, events).select("ticker", "date", F.col("hist_var").alias("ev_hist_var"))
    return f.join(hist, ["ticker", "date"], "left").drop("_ex", "earn_days_to", "earn_days_since")


def event_variance(rows: DataFrame) -> Column:
    """Jump variance of a release: the implied move squared, else the historical excess."""
    have = [F.col(c) ** 2 if c == "earn_implied_move" else F.col(c) for c in ("earn_implied_move", "ev_hist_var") if c in rows.columns]
    return F.coalesce(*have, F.lit(None).cast("double"))


def with_events(rows: DataFrame, h: int) -> DataFrame:
    """rows with iv_ex (implied input without a release it covers), ev_add (what a release within h adds), ev_move, y_true.

    y_h becomes the target without release days. Stripping leaves at least half of the implied volatility.
    """
    e2 = F.coalesce(event_variance(rows), F.lit(0.0))
    tenor = F.element_at(F.create_map(*[F.lit(x) for c, n in TENOR_DAYS.items() for x in (c, float(n))]), F.col("iv_src"))
    inside = F.coalesce(F.datediff("ev_next", "date") <= tenor, F.lit(False))
    iv2 = F.col("iv_in") ** 2
    out = rows.withColumn("_e2", e2)
    strip = F.when(inside, F.col("_e2") * 365 / tenor).otherwise(0.0)
    return out.withColumns({
        "iv_ex": F.sqrt(F.greatest(iv2 - strip, 0.25 * iv2)), "ev_add": F.when(F.col(f"ev_in_{h}"), 252.0 / h * F.col("_e2")).otherwise(0.0),
        "ev_move": F.when(F.col(f"ev_in_{h}"), F.sqrt("_e2")), "y_true": F.col(f"y_{h}"), f"y_{h}": F.col(f"y_{h}_ex"),
    }).drop("_e2")


def build_forecasts(rows: DataFrame, horizons=(5, 21), use_implied: bool = True, events: bool = True) -> DataFrame:
    """Forecasts of all horizons in one table, walk-forward and pooled: volatilities with an 80 % range, inputs and outcome.

    rows: event_dataset (or har_dataset, without events) joined with the implied columns. Rows without inputs have none.
    """
    out = None
    for h in horizons:
        d = with_implied(rows, h)
        if events:
            d = with_events(d, h)
            terms = event_terms(use_implied)
        else:
            d = d.withColumns({"ev_add": F.lit(0.0), "ev_move": F.lit(None).cast("double"), "y_true": F.col(f"y_{h}")})
            terms = har() | ({"log_iv": 2 * E.log_of("iv_in")} if use_implied else {})
        f = E.walk_forward(d, f"y_{h}", h, terms, keep=("rv_m", "iv_in", "iv_src", "ev_add", "ev_move", "y_true"))
        f = f.select(
            "ticker", "date", "horizon", *[F.sqrt(F.col(a) + F.col("ev_add")).alias(b) for a, b in (("forecast", "forecast_vol"), ("lo", "lo80_vol"), ("hi", "hi80_vol"))],
            F.col("iv_in").alias("implied_vol"), F.col("iv_src").alias("implied_input"), F.sqrt("rv_m").alias("trailing_vol"), F.sqrt("y_true").alias("realised_vol"),
            F.col("month").alias("refit_date"), "n_train", (F.col("ev_add") > 0).alias("event_in_window"), "ev_move",
        )
        out = f if out is None else out.unionByName(f)
    return out


def compare(forecasts: Mapping[str, DataFrame], actual: DataFrame, h: int, baseline: str) -> DataFrame:
    """Scores of models on the rows that all of them forecast, and the Diebold-Mariano test against the baseline.

    forecasts: by model, with ticker, date and forecast; actual(ticker, date, y), variances. Losses are averaged by date
    before the test, so that tickers of one day count as one observation.
    """
    rows = actual.where("y > 0").select("ticker", "date", "y")
    for i, f in enumerate(forecasts.values()):
        rows = rows.join(f.where("forecast > 0").select("ticker", "date", F.col("forecast").alias(f"f{i}")), ["ticker", "date"])
    names = list(forecasts)
    stack = rows.select("ticker", "date", "y", F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"f{i}").alias("f")) for i, n in enumerate(names)])).alias("m"), F.col(f"f{names.index(baseline)}").alias("base"))
    stack = stack.select("ticker", "date", "y", "m.model", "m.f", "base")
    v = lambda c: F.sqrt(c)
    gap, logs = v("f") - v("y"), F.log("y") - F.log("f")
    scores = stack.groupBy("model").agg(
        F.count("*").alias("n"), F.avg(qlike(F.col("y"), F.col("f"))).alias("qlike"), (100 * F.sqrt(F.avg(gap * gap))).alias("rmse_vol"), (100 * F.avg(F.abs(gap))).alias("mae_vol"),
        (100 * F.avg(gap)).alias("bias_vol"), (1 - F.try_divide(F.sum(logs * logs), F.var_pop(F.log("y")) * F.count("*"))).alias("r2_log"),
    )
    daily = stack.where(F.col("model") != baseline).groupBy("model", "date").agg(F.avg(qlike(F.col("y"), F.col("base"))).alias("lb"), F.avg(qlike(F.col("y"), F.col("f"))).alias("lm"))
    test = E.diebold_mariano(daily, "lb", "lm", "date", ["model"], h).select("model", F.col("dm").alias("dm_stat"), F.col("p").alias("dm_p"))
    return scores.join(test, "model", "left")


def compare_windows(base: DataFrame, model: DataFrame, horizons=(5, 21)) -> DataFrame:
    """Two tables of forecasts (see build_forecasts) on the windows that both forecast: by horizon, over all windows, those
    with a release inside, and those without one.

    n, mean QLIKE of base, model and the raw implied volatility (where it is known), and the Diebold-Mariano test of base
    against model (above 0: model is better) on losses averaged by date, with the horizon as lag. Which windows hold a
    release is model's to say. Windows that aren't closed, or whose forecast or outcome isn't positive, don't count.
    """
    keys = ["ticker", "date", "horizon"]
    rows = model.select(*keys, (F.col("forecast_vol") ** 2).alias("_m"), (F.col("realised_vol") ** 2).alias("_y"), (F.col("implied_vol") ** 2).alias("_i"), "event_in_window").join(base.select(*keys, (F.col("forecast_vol") ** 2).alias("_b")), keys)
    rows = rows.where("_y > 0 and _m > 0 and _b > 0")
    inside = F.coalesce("event_in_window", F.lit(False))
    rows = rows.select("date", "horizon", F.explode(F.array(F.lit("all"), F.when(inside, "release").otherwise("no release"))).alias("windows"), *[qlike(F.col("_y"), F.col(c)).alias(n) for c, n in (("_b", "base"), ("_m", "model"), ("_i", "implied"))])
    by, names = ["horizon", "windows"], ("base", "model", "implied")
    # a row for each day from here on: scores and tests share one pass over the forecasts
    daily = kept(rows.groupBy(*by, "date").agg(F.count("*").alias("n"), *[F.sum(c).alias(f"_{c}") for c in names], F.count("implied").alias("_n"), F.avg("base").alias("base"), F.avg("model").alias("model")))
    scores = daily.groupBy(*by).agg(F.sum("n").alias("n"), *[F.try_divide(F.sum(f"_{c}"), F.sum("_n" if c == "implied" else "n")).alias(c) for c in names])
    tests = None
    for h in horizons:
        t = E.diebold_mariano(daily.where(F.col("horizon") == h), "base", "model", "date", by, h).select(*by, F.col("dm").alias("dm_stat"), F.col("p").alias("dm_p"))
        tests = t if tests is None else tests.unionByName(t)
    return scores.join(tests, by, "left")


def releases_seen(forecasts: DataFrame) -> DataFrame:
    """Per ticker the different releases, by the size of their move, that closed windows held."""
    return forecasts.where("realised_vol is not null and event_in_window").groupBy("ticker").agg(F.count_distinct("ev_move").alias("releases"))


def by_regime(forecast: DataFrame, actual: DataFrame, regimes: DataFrame) -> DataFrame:
    """n and mean QLIKE of a forecast in each regime. regimes(date, regime); days without one are left out."""
    rows = forecast.join(actual.select("ticker", "date", "y"), ["ticker", "date"]).where("y > 0 and forecast > 0").join(regimes.where("regime is not null"), "date")
    return rows.groupBy("regime").agg(F.count("*").alias("n"), F.avg(qlike(F.col("y"), F.col("forecast"))).alias("qlike"))


def outcomes(forecasts: DataFrame) -> DataFrame:
    """Per ticker and horizon: closed forecasts, mean QLIKE, rmse and bias of volatility in points, share inside the range."""
    c = forecasts.where("realised_vol > 0")
    gap = F.col("forecast_vol") - F.col("realised_vol")
    return c.groupBy("ticker", "horizon").agg(
        F.count("*").alias("n"), F.avg(qlike(F.col("realised_vol") ** 2, F.col("forecast_vol") ** 2)).alias("qlike"), (100 * F.sqrt(F.avg(gap * gap))).alias("rmse"), (100 * F.avg(gap)).alias("bias"),
        F.avg(F.col("realised_vol").between(F.col("lo80_vol"), F.col("hi80_vol")).cast("double")).alias("covered"),
    )


def latest(forecasts: DataFrame) -> DataFrame:
    """The last forecast of each ticker and horizon; of repeated rows of a date any one."""
    w = Window.partitionBy("ticker", "horizon").orderBy(F.col("date").desc())
    return forecasts.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

