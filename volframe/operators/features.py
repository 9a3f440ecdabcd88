"""Features of surfaces and prices per (ticker, day), and their assembly into one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volframe.operators import expiry as E
from volframe.operators.realized import realized_features
from volframe.operators.timeseries import align, asof_join, rolling_rank, rolling_z, shifted, trailing

# fixed values: tenors in days, those with a whole smile, deltas, and the columns that get dynamics
TENORS_DAYS = {"7d": 7, "14d": 14, "30d": 30, "60d": 60, "91d": 91, "182d": 182, "365d": 365}
SMILE_TENORS = ("30d", "91d")
DELTAS = {"p10": -0.10, "p25": -0.25, "c25": 0.25, "c10": 0.10}
DYNAMIC_COLUMNS = ["atm_30d", "atm_91d", "vs_30d", "rr25_30d", "bf25_30d", "ts_7_30", "ts_30_91", "vrp_30d"]
# ... indices by their name in lower case, macro series with the days from observation to publication, version of the table
MARKET_COLUMNS = {c: f"mkt_{c}" for c in ("vix", "vix3m", "vix9d", "vix1d", "vvix", "skew", "vxn", "vxd", "ovx", "gvz", "move")}
MACRO_LAGS = {"HY_OAS": 1, "IG_OAS": 1, "USD_BROAD": 1, "BREAKEVEN_10Y": 1, "REAL_YIELD_10Y": 1, "STLFSI": 6, "NFCI": 5}
FEATURE_VERSION = "features/2"
STEP = 0.01


def surface_features(slices: DataFrame, keys=("ticker", "as_of"), spot: str | None = None, extrapolate: bool = False) -> DataFrame:
    """One row per surface with at least two slices: volatilities at tenors and deltas, smile shape, term structure, carry.

    slices needs the columns of expiry.SHAPE, T, forward, source, rmse and, if named, spot. A point outside of the expiries
    or of the quoted strikes is null, unless extrapolate is set. Nulls in a slice's shape leave the slice out; repeated
    slices count twice in n_expiries; an empty table gives an empty result.
    """
    surf = E.surfaces(E.variance_swaps(slices, keys=(*keys, "T")), keys).where(F.size("slices") >= 2)
    surf = surf.withColumns({f"_b_{n}": E.bracket(F.col("slices"), F.lit(d / 365)) for n, d in TENORS_DAYS.items()})
    surf = surf.withColumns({f"_k_{d}_{n}": E.delta_strike(F.col(f"_b_{n}"), DELTAS[d]) for n in SMILE_TENORS for d in DELTAS})

    def value(p: Column) -> Column:
        return F.when(F.lit(True) if extrapolate else p["b"]["inside"] & E.is_observed(p["b"], p["k"]), E.iv(p["b"], p["k"]))

    # all points in one array, so that the long expression of a volatility is there once
    points = {f"atm_{n}": (n, F.lit(0.0)) for n in TENORS_DAYS} | {f"iv_{d}_{n}": (n, F.col(f"_k_{d}_{n}")) for n in SMILE_TENORS for d in DELTAS}
    points |= {f"_{s}_{n}": (n, F.lit(x)) for n in SMILE_TENORS for s, x in (("up", STEP), ("dn", -STEP))}
    surf = surf.withColumn("_v", F.transform(F.array(*[F.struct(F.col(f"_b_{n}").alias("b"), k.alias("k")) for n, k in points.values()]), value))
    surf = surf.withColumns({name: F.get("_v", F.lit(i)) for i, name in enumerate(points)})
    c, out = F.col, {}
    for n in SMILE_TENORS:
        atm, up, dn = c(f"atm_{n}"), c(f"_up_{n}"), c(f"_dn_{n}")
        for d in ("25", "10"):
            call, put = c(f"iv_c{d}_{n}"), c(f"iv_p{d}_{n}")
            out |= {f"rr{d}_{n}": call - put, f"bf{d}_{n}": 0.5 * (call + put) - atm}
        out |= {f"atm_skew_{n}": (up - dn) / (2 * STEP), f"atm_curv_{n}": (up - 2 * atm + dn) / STEP**2, f"vs_{n}": E.variance_swap_vol(c(f"_b_{n}"), F.size("slices"))}
    out |= {"ts_7_30": c("atm_30d") - c("atm_7d"), "ts_30_91": c("atm_91d") - c("atm_30d"), "ts_30_365": c("atm_365d") - c("atm_30d")}
    size = F.size("slices").cast("double")
    near = F.array_min(F.transform(F.filter("slices", lambda s: (s["source"] == "parity") & s["T"].between(0.5, 1.5)), lambda s: F.struct(F.abs(s["T"] - 1.0).alias("gap"), s["T"].alias("T"), s["forward"].alias("forward"))))
    if spot:
        own = F.get(F.col("slices"), F.lit(0))[spot]
        out |= {"fwd_carry_1y": F.when(own > 0, F.log(near["forward"] / own) / near["T"]), "spot": own}
    sorted_rmse = F.array_sort(F.transform("slices", lambda s: s["rmse"]))
    middle = lambda i: F.get(sorted_rmse, i.cast("int"))
    out |= {
        "n_expiries": size, "nearest_expiry_days": F.get(c("slices"), F.lit(0))["T"] * 365, "fit_rmse": (middle((F.size("slices") - 1) / 2) + middle(F.size("slices") / 2)) / 2,
        "parity_fraction": F.size(F.filter("slices", lambda s: s["source"] == "parity")) / size,
    }
    surf = surf.withColumns(out)
    return surf.select(*[x for x in surf.columns if not x.startswith("_") and x != "slices"])


def fill_closes(prices: DataFrame, spots: DataFrame) -> DataFrame:
    """Days without a close take the snapshot's spot, days without a bar come in with it alone. spots(ticker, date, spot).

    Null spots fill nothing; of repeated spots of a day the largest counts; bars that repeat stay.
    """
    s = spots.where(F.col("spot").isNotNull()).groupBy("ticker", "date").agg(F.max("spot").alias("_spot"))
    return prices.join(s, ["ticker", "date"], "full_outer").withColumn("close", F.coalesce("close", "_spot")).drop("_spot")


def add_dynamics(table: DataFrame, sessions: DataFrame, columns: Sequence[str], z_window: int = 63, pct_window: int = 252, least: int = 20) -> DataFrame:
    """_d1 and _d5 over sessions, _z63 and _pct252 over the trailing sessions of the calendar, per column and ticker.

    Windows count sessions, not rows: a session without a row is a gap, as are nulls. There is one row per ticker and date;
    dates that are no session have no dynamics.
    """
    f = align(table, sessions, "ticker", "date")
    for c in columns:
        for n in (1, 5):
            f = shifted(f, "ticker", c, n, f"_{c}{n}")
    w = lambda n: Window.partitionBy("ticker").orderBy("seq").rangeBetween(-(n - 1), 0)
    on = F.col("seq").isNotNull()
    out = {}
    for c in columns:
        x = F.col(c)
        out |= {f"{c}_d{n}": x - F.col(f"_{c}{n}") for n in (1, 5)}
        out |= {f"{c}_z{z_window}": F.when(on, rolling_z(x, w(z_window), least)), f"{c}_pct{pct_window}": F.when(on, rolling_rank(x, w(pct_window), least))}
    return f.withColumns(out).drop("seq", *[f"_{c}{n}" for c in columns for n in (1, 5)])


def published(history: DataFrame, lags: Mapping[str, int] = MACRO_LAGS) -> DataFrame:
    """history(date, a column for each series) by day of publication: published and macro_<series>, null where none is due.

    Each series comes out its own number of days after the date it is for. Series that history lacks are left out; nulls
    are no observation; of repeated dates the largest value counts.
    """
    have = [n for n in lags if n in history.columns]
    due = F.array(*[F.struct(F.date_add("date", lags[n]).alias("published"), F.lit(n).alias("series"), F.col(n).cast("double").alias("value")) for n in have])
    rows = history.where(F.col("date").isNotNull()).select(F.explode(due).alias("x")).select("x.*").where("value is not null")
    return rows.groupBy("published").agg(*[F.max(F.when(F.col("series") == n, F.col("value"))).alias(f"macro_{n.lower()}") for n in have])


def available_asof(days: DataFrame, history: DataFrame, lags: Mapping[str, int] = MACRO_LAGS, on: str = "date") -> DataFrame:
    """days with macro_<series>: of each series the last value that was public on the day; all series in one search."""
    p = published(history, lags)
    return asof_join(days, p, on, "published", values=[c for c in p.columns if c != "published"])


def feature_table(surface: DataFrame, prices: DataFrame, market: DataFrame, macro: DataFrame, earnings: DataFrame | None, sessions: DataFrame, dynamics: Sequence[str] = DYNAMIC_COLUMNS, version: str = FEATURE_VERSION) -> DataFrame:
    """Surface features (ticker, date, spot, ...) with realised volatility, premia, indices, macro as published, earnings.

    Closes missing from prices come from the snapshots' spots. market(date, vix, ...) joins by date, those of MARKET_COLUMNS
    that it has; macro(published, a column for each series; see published()) as last published; earnings(ticker, date, ...)
    by key. Every join is by (ticker, date) or by date. feature_version names the version, builder stays if surface has it.
    """
    real = realized_features(fill_closes(prices, surface.select("ticker", "date", "spot")))
    real = real.select("ticker", "date", "ret_1d", "ret_5d", "ret_21d", "rv_cc_10d", "rv_cc_21d", "rv_cc_63d", "rv_yz_21d")
    f = asof_join(surface, macro, "date", "published", values=[c for c in macro.columns if c != "published"])  # before the joins, as it reads its left side twice
    f = f.join(real, ["ticker", "date"], "left")
    f = f.withColumn("vrp_30d", F.col("atm_30d") - F.col("rv_cc_21d")).withColumn("vrp_var_30d", F.col("vs_30d") ** 2 - F.col("rv_cc_21d") ** 2)
    f = f.join(market.select("date", *[F.col(a).alias(b) for a, b in MARKET_COLUMNS.items() if a in market.columns]), "date", "left")
    if earnings is not None:
        f = f.join(earnings, ["ticker", "date"], "left")
    return add_dynamics(f, sessions, dynamics).withColumn("feature_version", F.lit(version))


def training_frame(table: DataFrame, labels: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """ticker, date, features and label, on rows where all of them are there."""
    return table.join(labels.select("ticker", "date", label), ["ticker", "date"]).select("ticker", "date", *features, label).dropna(subset=[*features, label])


def label_atm(table: DataFrame, sessions: DataFrame, column: str = "atm_30d", horizons=(5, 21)) -> DataFrame:
    """Change of a column over the next h sessions; null where that session has no row."""
    f = align(table, sessions, "ticker", "date")
    for h in horizons:
        f = shifted(f, "ticker", column, -h, f"_{h}").withColumn(f"label_atm_{h}", F.col(f"_{h}") - F.col(column)).drop(f"_{h}")
    return f.drop("seq")


# ---- earnings


def atm_term(slices: DataFrame, keys=("ticker", "as_of")) -> DataFrame:
    """keys and term: array of struct(T, expiration, w) of at-the-money total variance, by T; w above 0 alone counts."""
    w = F.col("a") + F.col("b") * (-F.col("rho") * F.col("m") + F.sqrt(F.col("m") ** 2 + F.col("sigma") ** 2))
    rows = slices.withColumn("w", w).where((F.col("w") > 0) & F.col("expiration").isNotNull())
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("T", "expiration", "w"))).alias("term"))


def implied_event_variance(rows: DataFrame, days: DataFrame, most_t: float = 0.30) -> DataFrame:
    """rows(ticker, as_of, event, term) with e2, the jump variance of the release that moves session `event`; null if none.

    Between the last expiry before the event and the first one after it, what the daily variance of the first does not
    explain; without one before, what that of the next two expiries after it does not. days: see day_numbers. A first
    expiry beyond most_t, or a variance that isn't above 0, gives null. One row per ticker and as_of.
    """
    t = rows.select("ticker", "as_of", "event", F.explode_outer("term").alias("s"))
    t = t.join(days.select(F.col("day").alias("as_of"), F.col("pos").alias("_from")), "as_of", "left")
    t = t.withColumn("_x", F.col("s.expiration")).join(days.select(F.col("day").alias("_x"), F.col("pos").alias("_to")), "_x", "left")
    point = F.struct(F.col("s.T").alias("T"), (F.col("_to") - F.col("_from")).alias("n"), F.col("s.w").alias("w"))
    after = F.col("_x") >= F.col("event")
    f = t.groupBy("ticker", "as_of", "event").agg(F.max(F.when(~after & (F.col("_to") - F.col("_from") >= 1), point)).alias("pre"), F.array_sort(F.collect_list(F.when(after, point))).alias("post"))
    p1, p2 = F.get("post", F.lit(0)), F.get("post", F.lit(1))
    e2 = F.when(F.col("pre").isNotNull(), p1["w"] - F.col("pre.w") / F.col("pre.n") * p1["n"]).when(p2["n"] > p1["n"], p1["w"] - (p2["w"] - p1["w"]) / (p2["n"] - p1["n"]) * p1["n"])
    found = f.select("ticker", "as_of", F.when((p1["T"] <= most_t) & (e2 > 0), e2).alias("e2"))
    return rows.join(found, ["ticker", "as_of"], "left")


def calendar_columns(rows: DataFrame, events: DataFrame, days: DataFrame, date: str = "date") -> DataFrame:
    """rows with earn_next_date (after the date), earn_days_to and earn_days_since in sessions. events(ticker, event)."""
    e = events.where(F.col("event").isNotNull()).distinct()
    f = asof_join(rows, e.withColumn("earn_next_date", F.col("event")), date, "event", ["ticker"], ["earn_next_date"], strict=True, forward=True)
    f = asof_join(f, e.withColumn("_last", F.col("event")), date, "event", ["ticker"], ["_last"])
    for c, n in ((date, "_p"), ("earn_next_date", "_pn"), ("_last", "_pl")):
        f = f.join(days.select(F.col("day").alias(c), F.col("pos").alias(n)), c, "left")
    f = f.withColumn("earn_days_to", F.col("_pn") - F.col("_p")).withColumn("earn_days_since", F.col("_p") - F.col("_pl"))
    return f.drop("_last", "_p", "_pn", "_pl")


def historical_event_variance(closes: DataFrame, events: DataFrame, normal_days: int = 63, least_days: int = 40, last: int = 8, least: int = 4) -> DataFrame:
    """closes(ticker, date, close) with hist_var: mean of the last 8 events' squared returns beyond a normal day's.

    A normal day is the mean squared return of the trailing days without event, up to the day before the event. Rows
    without a close are left out; null before four events; never below 0.
    """
    by = Window.partitionBy("ticker").orderBy("date")
    f = closes.where(F.col("close").isNotNull()).join(events.select("ticker", F.col("event").alias("date"), F.lit(True).alias("is_ev")).distinct(), ["ticker", "date"], "left").withColumn("is_ev", F.coalesce("is_ev", F.lit(False)))
    f = f.withColumn("_r2", F.log(F.col("close") / F.lag("close").over(by)) ** 2)
    w, plain = by.rowsBetween(-(normal_days - 1), 0), F.when(~F.col("is_ev"), F.col("_r2"))
    f = f.withColumn("_normal", F.when(F.count(plain).over(w) >= least_days, F.avg(plain).over(w)))
    f = f.withColumn("_excess", F.col("_r2") - F.lag("_normal").over(by)).withColumn("_real", F.col("is_ev") & F.col("_r2").isNotNull())
    own = Window.partitionBy("ticker", "_real").orderBy("date").rowsBetween(-(last - 1), 0)
    f = f.withColumn("_mean", F.when(F.col("_real") & (F.count("_excess").over(own) >= least), F.avg("_excess").over(own)))
    known = F.last("_mean", True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return f.withColumn("hist_var", F.when(known.isNotNull(), F.greatest(known, F.lit(0.0)))).drop("_r2", "_normal", "_excess", "_real", "_mean")


def scheduled_next(rows: DataFrame, schedule: DataFrame, date: str = "date") -> DataFrame:
    """rows with `scheduled`: the next event as the latest schedule on or before the date has it; null if it has none.

    schedule(ticker, snapshot, event): all events that a snapshot of a day lists. rows have one row per ticker and date.
    """
    days = schedule.select("ticker", "snapshot").distinct().withColumn("_snap", F.col("snapshot"))
    f = asof_join(rows, days, date, "snapshot", ["ticker"], ["_snap"])
    keys = f.select("ticker", date, "_snap").where(F.col("_snap").isNotNull()).distinct()
    listed = schedule.select("ticker", F.col("snapshot").alias("_snap"), "event")
    found = keys.join(listed, ["ticker", "_snap"]).where(F.col("event") > F.col(date)).groupBy("ticker", date).agg(F.min("event").alias("scheduled"))
    return f.drop("_snap").join(found, ["ticker", date], "left")


def earnings_features(rows: DataFrame, events: DataFrame, days: DataFrame, schedule: DataFrame | None = None, closes: DataFrame | None = None) -> DataFrame:
    """rows(ticker, date, term) with earn_next_date, earn_days_to, earn_days_since, earn_implied_move, earn_hist_move.

    Where a schedule covers the date, its next event counts. Tickers without events have nulls.
    """
    f = calendar_columns(rows, events, days)
    if schedule is not None:
        f = scheduled_next(f, schedule).withColumn("earn_next_date", F.coalesce("scheduled", "earn_next_date")).drop("scheduled", "earn_days_to")
        for c, n in (("date", "_p"), ("earn_next_date", "_pn")):
            f = f.join(days.select(F.col("day").alias(c), F.col("pos").alias(n)), c, "left")
        f = f.withColumn("earn_days_to", F.col("_pn") - F.col("_p")).drop("_p", "_pn")
    e2 = implied_event_variance(f.select("ticker", F.col("date").alias("as_of"), F.col("earn_next_date").alias("event"), "term"), days)
    f = f.join(e2.select("ticker", F.col("as_of").alias("date"), F.sqrt("e2").alias("earn_implied_move")), ["ticker", "date"], "left")
    if closes is not None:
        hist = historical_event_variance(closes, events).select("ticker", "date", F.sqrt("hist_var").alias("earn_hist_move"))
        f = f.join(hist, ["ticker", "date"], "left")
    return f.drop("term")
