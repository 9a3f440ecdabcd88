"""Snapshot documents: for each ticker its features, forecasts with their record, and peers, as one nested row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volframe.operators import serving
from volframe.sources.store import kept

#: Fixed values, the document's format: section -> name -> (feature, factor, digits). Volatilities become percent.
SECTIONS = {
    "implied_vol_pct": {"atm_7d": ("atm_7d", 100, 2), "atm_30d": ("atm_30d", 100, 2), "atm_91d": ("atm_91d", 100, 2), "atm_365d": ("atm_365d", 100, 2), "variance_swap_30d": ("vs_30d", 100, 2)},
    "implied_vol_changes_pts": {"atm_30d_1d": ("atm_30d_d1", 100, 2), "atm_30d_5d": ("atm_30d_d5", 100, 2), "variance_swap_30d_1d": ("vs_30d_d1", 100, 2)},
    "smile_30d": {
        "iv_10d_put_pct": ("iv_p10_30d", 100, 2), "iv_25d_put_pct": ("iv_p25_30d", 100, 2), "iv_25d_call_pct": ("iv_c25_30d", 100, 2), "iv_10d_call_pct": ("iv_c10_30d", 100, 2),
        "risk_reversal_25d_pts": ("rr25_30d", 100, 2), "butterfly_25d_pts": ("bf25_30d", 100, 2), "risk_reversal_25d_5d_change_pts": ("rr25_30d_d5", 100, 2),
    },
    "smile_91d": {"risk_reversal_25d_pts": ("rr25_91d", 100, 2), "butterfly_25d_pts": ("bf25_91d", 100, 2)},
    "term_structure_pts": {"atm_30d_minus_7d": ("ts_7_30", 100, 2), "atm_91d_minus_30d": ("ts_30_91", 100, 2), "atm_365d_minus_30d": ("ts_30_365", 100, 2)},
    "percentiles_0_to_100": {
        "atm_30d": ("atm_30d_pct252", 100, 0), "variance_swap_30d": ("vs_30d_pct252", 100, 0), "risk_reversal_25d_30d": ("rr25_30d_pct252", 100, 0), "butterfly_25d_30d": ("bf25_30d_pct252", 100, 0),
        "term_91d_minus_30d": ("ts_30_91_pct252", 100, 0), "variance_risk_premium_30d": ("vrp_30d_pct252", 100, 0),
    },
    "realised": {
        "vol_21d_close_to_close_pct": ("rv_cc_21d", 100, 2), "vol_21d_yang_zhang_pct": ("rv_yz_21d", 100, 2), "vol_63d_pct": ("rv_cc_63d", 100, 2), "return_5d_pct": ("ret_5d", 100, 2), "return_21d_pct": ("ret_21d", 100, 2),
    },
    "market": {
        "vix": ("mkt_vix", 1, 2), "vix3m_over_vix": ("_vix_ratio", 1, 3), "vvix": ("mkt_vvix", 1, 2), "cboe_skew": ("mkt_skew", 1, 2), "move_treasury_vol": ("mkt_move", 1, 2),
        "high_yield_spread_pct": ("macro_hy_oas", 1, 2), "chicago_fed_nfci": ("macro_nfci", 1, 2),
    },
    "data_quality": {"expiries_fitted": ("n_expiries", 1, 0), "nearest_expiry_days": ("nearest_expiry_days", 1, 0), "median_fit_error_pts": ("fit_rmse", 100, 2)},
}
EARNINGS = {"trading_days_until": ("earn_days_to", 1, 0), "implied_move_pct": ("earn_implied_move", 100, 2), "historical_average_move_pct": ("earn_hist_move", 100, 2)}
PEER = {"atm_30d_pct": ("atm_30d", 100, 2), "atm_30d_percentile": ("atm_30d_pct252", 100, 0), "risk_reversal_25d_30d_pts": ("rr25_30d", 100, 2), "variance_risk_premium_30d_pts": ("vrp_30d", 100, 2)}
NOTE = "A percentile compares the day with the 252 sessions up to it; there are %d days of history, and fewer than 252 are all compared."


def number(x: Column, factor: float = 1, digits: int = 2) -> Column:
    """A scaled, rounded double; null for null, NaN and infinities, and no negative zero."""
    v = F.round(x.cast("double") * factor, digits)
    return F.when(F.abs(v) < float("inf"), F.when(v == 0, 0.0).otherwise(v))


def _sorted_struct(fields: dict[str, Column]) -> Column:
    return F.struct(*[fields[c].alias(c) for c in sorted(fields)])


def with_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows with asset_group by ticker, Other if groups(ticker, asset_group) lacks it; one group per ticker."""
    return rows.join(groups.select("ticker", "asset_group"), "ticker", "left").fillna({"asset_group": "Other"})


def display_order(tickers: DataFrame, groups: DataFrame) -> DataFrame:
    """tickers with place, from groups(ticker, place): known ones by place, others after them by name. Ties by name."""
    return tickers.join(groups.select("ticker", "place"), "ticker", "left").orderBy(F.col("place").asc_nulls_last(), "ticker")


def catalog(columns: DataFrame, entries: Sequence[tuple[str, str, str]]) -> DataFrame:
    """columns(column) with unit and meaning of the first of entries (pattern, unit, meaning) that matches the whole name.

    Names that none matches have UNDOCUMENTED as meaning and no unit; a null name has neither.
    """
    hits = [F.when(F.col("column").rlike(f"^(?:{p})$"), F.struct(F.lit(u).alias("unit"), F.lit(m).alias("meaning"))) for p, u, m in entries]
    found = F.coalesce(*hits, F.when(F.col("column").isNotNull(), F.struct(F.lit(None).cast("string").alias("unit"), F.lit("UNDOCUMENTED").alias("meaning"))))
    return columns.withColumn("_e", found).select(*columns.columns, "_e.unit", "_e.meaning")


def _forecasts(forecasts: DataFrame, as_of: Column, days: int, horizons: Sequence[int]) -> DataFrame:
    """ticker, volatility_forecast: newest forecast and record of the last days for each horizon, null without any."""
    newest = serving.latest_forecasts(forecasts, as_of).where(F.col("horizon").isin(list(horizons)))
    past = serving.record(forecasts.where(F.col("date").between(F.date_sub(as_of, days), as_of)))
    both = newest.select("ticker", "horizon", "date", "forecast_vol", "lo80_vol", "hi80_vol", "implied_vol", "implied_input").join(past, ["ticker", "horizon"], "left")
    scored = {"n_scored": F.coalesce("n", F.lit(0)), "rmse_forecast_pts": number(F.col("rmse_forecast")), "rmse_implied_pts": number(F.col("rmse_implied")), "share_inside_80pct_range": number(F.col("coverage80"))}
    one = _sorted_struct(
        {
            "forecast_vol_pct": number(F.col("forecast_vol"), 100), "range_80pct": F.array(number(F.col("lo80_vol"), 100), number(F.col("hi80_vol"), 100)), "implied_vol_used_pct": number(F.col("implied_vol"), 100),
            "implied_input": F.col("implied_input").cast("string"), "forecast_date": F.col("date").cast("date").cast("string"), "track_record_last_6m": _sorted_struct(scored),
        }
    )
    by_horizon = {f"{h}_trading_days": F.max(F.when(F.col("horizon") == h, one)) for h in horizons}
    return both.groupBy("ticker").agg(*[by_horizon[c].alias(c) for c in sorted(by_horizon)]).select("ticker", F.struct(*sorted(by_horizon)).alias("volatility_forecast"))


def snapshots(features: DataFrame, groups: DataFrame, as_of: Column, forecasts: DataFrame | None = None, market: str = "SPY", record_days: int = 182, horizons: Sequence[int] = (5, 21), stale_days: int = 5) -> DataFrame:
    """ticker, as_of, document: the snapshot of each ticker with features on or before as_of, a constant date.

    features has one row per ticker and date; columns that it lacks are null in the document, as are nulls, NaN and
    infinities. Peers are the tickers of the same group and the market, without the ticker itself and without those whose
    features are more than stale_days old. The parts for earnings and forecasts are null if there is nothing to say. Keys
    are in alphabetical order on every level, as digest() needs them.
    """
    f = features.where(F.col("date") <= as_of)
    has = set(f.columns)
    if {"mkt_vix", "mkt_vix3m"} <= has:
        f = f.withColumn("_vix_ratio", F.try_divide("mkt_vix3m", "mkt_vix"))
        has.add("_vix_ratio")
    cell = lambda c, factor, digits, row="_r": number(F.col(f"{row}.{c}") if c in has else F.lit(None), factor, digits)
    part = lambda spec, row="_r": {name: cell(*x, row) for name, x in spec.items()}
    used = {x[0] for spec in [*SECTIONS.values(), EARNINGS, PEER] for x in spec.values()} | {"date", "spot", "vrp_30d", "earn_next_date"}
    rows = f.groupBy("ticker").agg(F.max_by(F.struct(*[c for c in f.columns if c in used]), "date").alias("_r"), F.count("*").alias("_days"))
    rows = kept(with_group(rows, groups))  # a row per ticker; peers and the market come from it as well

    fresh = rows.where(F.datediff(as_of, F.col("_r.date")) <= stale_days).select("ticker", "asset_group", _sorted_struct({"ticker": F.col("ticker"), **part(PEER)}).alias("_p"))
    peers = fresh.groupBy("asset_group").agg(F.collect_list("_p").alias("_peers"))
    index = fresh.agg(F.max(F.when(F.col("ticker") == market, F.col("_p"))).alias("_m"))  # no keys: always one row
    rows = rows.join(peers, "asset_group", "left").crossJoin(F.broadcast(index))
    every = F.array_union(F.coalesce("_peers", F.array().cast(peers.schema["_peers"].dataType)), F.when(F.col("_m").isNotNull(), F.array("_m")).otherwise(F.array().cast(peers.schema["_peers"].dataType)))
    others = F.array_sort(F.filter(every, lambda p: p["ticker"] != F.col("ticker")), lambda a, b: F.when(a["ticker"] < b["ticker"], -1).when(a["ticker"] > b["ticker"], 1).otherwise(0))
    if forecasts is not None:
        rows = rows.join(_forecasts(forecasts, as_of, record_days, horizons), "ticker", "left")
    else:
        rows = rows.withColumn("volatility_forecast", F.lit(None).cast("string"))
    release = F.col("_r.earn_next_date").cast("date").cast("string") if "earn_next_date" in has else F.lit(None).cast("string")
    fields = {name: _sorted_struct(part(spec)) for name, spec in SECTIONS.items()} | {
        "ticker": F.col("ticker"), "as_of": F.col("_r.date").cast("date").cast("string"), "history_available_days": F.col("_days"), "history_note": F.format_string(NOTE, "_days"), "spot": cell("spot", 1, 2),
        "variance_risk_premium_30d_pts": cell("vrp_30d", 100, 2), "earnings": F.when(release.isNotNull(), _sorted_struct({"next_release_session": release, **part(EARNINGS)})),
        "asset_group": F.col("asset_group"), "peers": others, "volatility_forecast": F.col("volatility_forecast"),
    }
    return rows.select("ticker", F.col("_r.date").cast("date").alias("as_of"), _sorted_struct(fields).alias("document"))


def as_json(document: Column) -> Column:
    """The document as JSON with all keys, nulls included."""
    return F.to_json(document, {"ignoreNullFields": "false"})


def digest(document: Column, *extra: str) -> Column:
    """First 16 hex digits of SHA-256 over the JSON and the extra parts (of a prompt, a model), joined by bars."""
    return F.substring(F.sha2(F.concat_ws("|", as_json(document), *map(F.lit, extra or ("",))), 256), 1, 16)

