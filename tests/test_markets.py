"""Exchange days, term structures, SABR fits, spot volatilities and snapshot documents on small frames."""

import datetime as dt
import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from volframe.operators import backtest as B
from volframe.operators import market_days as M
from volframe.operators import sabr as A
from volframe.operators import snapshot as N
from volframe.operators import surface as S
from volframe.operators import timeseries as T


def test_holidays_and_half_days(spark):
    off = ["2024-01-01", "2024-01-15", "2024-02-19", "2024-03-29", "2024-05-27", "2024-06-19", "2024-07-04", "2024-09-02", "2024-11-28", "2024-12-25", "2021-12-24", "2023-01-02", "2020-07-03", "2000-04-21", "2019-04-19"]
    on = ["2021-12-31", "2021-06-18", "1997-01-20", "2024-11-29", "2024-07-03", "2024-12-24", "2022-12-23"]
    days = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in [*off, *on, "2024-06-22"]] + [(None,)], "d date")
    got = {str(r.d): (r.s, r.c) for r in days.select("d", M.is_session(F.col("d")).alias("s"), M.close_minute(F.col("d")).alias("c")).collect()}
    assert all(got[d] == (False, None) for d in off) and all(got[d][0] for d in on)
    assert {d for d, v in got.items() if v[1] == 780} == {"2024-11-29", "2024-07-03", "2024-12-24"}
    assert got["2024-06-22"] == (False, None) and got["None"] == (None, None)
    closed = [dt.date(2021, 12, 31)]
    assert not days.where("d = '2021-12-31'").select(M.is_session(F.col("d"), closed)).first()[0]


def test_easter(spark):
    known = {1961: "1961-04-02", 1981: "1981-04-19", 2000: "2000-04-23", 2019: "2019-04-21", 2038: "2038-04-25", 2049: "2049-04-18", 2076: "2076-04-19", 1954: "1954-04-18"}
    got = spark.createDataFrame([(y,) for y in known], "y int").select("y", M.easter(F.col("y")).cast("string").alias("e")).collect()
    assert {r.y: r.e for r in got} == known


def test_guards(spark):
    day = dt.date(2024, 3, 28)
    at = lambda h, m, d=28: dt.datetime(2024, 3, d, h, m)
    rows = [(day, at(16, 14)), (day, at(16, 15)), (day, at(17, 0, 27)), (dt.date(2024, 3, 29), at(17, 0, 29)), (day, at(15, 29)), (day, at(15, 30)), (day, at(16, 0)), (day, None)]
    df = spark.createDataFrame(rows, "a date, now timestamp")
    got = df.select(M.collection_status(F.col("a"), F.col("now")), M.preclose_allowed(F.col("a"), F.col("now"))).collect()
    assert [r[0] for r in got] == ["intraday", "ok", "other day", "no session", "intraday", "intraday", "intraday", None]
    assert [r[1] for r in got] == [False, False, False, False, False, True, False, None]


def test_term_fit_is_a_polynomial_fit(spark):
    t, v = [0.1, 0.25, 0.5, 1.0, 2.0], [0.2, 0.26, 0.24, 0.22, 0.21]
    rows = [("a", x, y) for x, y in zip(t, v)] + [("b", 1.0, 0.2), ("c", 0.5, 0.3), ("c", 1.0, 0.2), ("a", None, 0.9), ("a", 0.7, None)]
    got = {r.k: r for r in B.term_fit(spark.createDataFrame(rows, "k string, T double, iv double"), ["k"]).collect()}
    assert got["a"].slope == pytest.approx(np.polyfit(t, v, 1)[0]) and got["a"].curvature == pytest.approx(np.polyfit(t, v, 2)[0]) and got["a"].spread == pytest.approx(0.01)
    assert (got["b"].slope, got["b"].curvature, got["b"].shape) == (0.0, 0.0, "FLAT") and (got["c"].curvature, got["c"].shape) == (0.0, "INVERTED")
    pairs = B.inversions(spark.createDataFrame(rows, "k string, T double, iv double"), ["k"]).where("k = 'a'").collect()
    assert {(r.near, r.far) for r in pairs} == {(a, b) for a, x in zip(t, v) for b, y in zip(t, v) if a < b and x > y + 0.01}


def test_sabr_fit(spark):
    k = np.exp(np.linspace(-0.4, 0.4, 15))
    rows = [(i, 1.0, float(x), 0.5, float(y)) for i, p in enumerate([(0.3, -0.5, 0.6), (0.2, 0.4, 1.1)]) for x, y in zip(k, A.model(np.array(p), 1.0, k, 0.5, 0.5))]
    rows += [(7, 1.0, 1.0, 0.5, 0.2), (0, 1.0, None, 0.5, 0.2), (0, 1.0, 1.1, 0.5, float("nan"))]
    df = spark.createDataFrame(rows, "i int, forward double, strike double, T double, iv double")
    got = {r.i: r for r in A.calibrate(df, ["i"]).collect()}
    assert (got[0].alpha, got[0].rho, got[0].nu) == pytest.approx((0.3, -0.5, 0.6), abs=1e-5) and (got[1].alpha, got[1].rho, got[1].nu) == pytest.approx((0.2, 0.4, 1.1), abs=1e-5)
    assert got[7].alpha is None and got[7].n == 1 and got[0].n == 15
    assert A.calibrate(df.where("false"), ["i"]).count() == 0


def test_spot_volatility(spark):
    rows = [(10.450583572185565, 100.0, 100.0, 1.0, 0.05, True), (5.573526022256971, 100.0, 100.0, 1.0, 0.05, False), (1.0, 100.0, 50.0, 1.0, 0.05, True), (10.0, 100.0, 100.0, 0.0, 0.05, True), (None, 100.0, 100.0, 1.0, 0.05, True)]
    got = [r[0] for r in spark.createDataFrame(rows, "p double, s double, k double, t double, r double, c boolean").select(S.spot_implied_vol("p", "s", "k", "t", "r", "c")).collect()]
    assert got[:2] == pytest.approx([0.2, 0.2], abs=1e-9) and got[2:] == [None] * 3


def test_shifts(spark):
    rows = [("a", 1, 1.0), ("a", 2, 2.0), ("a", 4, 4.0), ("b", 2, 9.0), ("a", None, 7.0), (None, 3, 8.0), (None, 2, 8.5)]
    f = T.shifted(T.shifted(spark.createDataFrame(rows, "k string, seq int, v double"), "k", "v", 1, "back"), "k", "v", -2, "ahead")
    got = {(r.k, r.seq): (r.back, r.ahead) for r in f.collect()}
    assert got == {("a", 1): (None, None), ("a", 2): (1.0, 4.0), ("a", 4): (None, None), ("b", 2): (None, None), ("a", None): (None, None), (None, 3): (None, None), (None, 2): (None, None)}


def test_snapshot_document(spark):
    d = dt.date(2024, 5, 2)
    feats = [("A", d, 0.2, 0.913, float("nan"), 12.345678, d), ("A", dt.date(2024, 5, 1), 0.1, 0.5, 0.0, 1.0, None), ("B", d, 0.3, None, 0.01, None, None), ("C", dt.date(2024, 4, 20), 0.4, 0.1, 0.0, 1.0, None), ("M", d, 0.15, 0.2, -0.00001, 1.0, None), ("X", d, 0.15, 0.2, 0.0, 1.0, None), ("A", dt.date(2024, 5, 9), 9.0, 9.0, 9.0, 9.0, None)]
    f = spark.createDataFrame(feats, "ticker string, date date, atm_30d double, atm_30d_pct252 double, vrp_30d double, spot double, earn_next_date date").withColumn("document", F.lit("clash"))
    g = spark.createDataFrame([("A", "g"), ("B", "g"), ("C", "g"), ("M", "m")], "ticker string, asset_group string")
    cols = "ticker string, horizon int, date date, forecast_vol double, lo80_vol double, hi80_vol double, implied_vol double, implied_input string, realised_vol double"
    fc = spark.createDataFrame([("A", 5, d, 0.2, 0.1, 0.3, 0.25, "vs", None), ("A", 5, dt.date(2024, 4, 1), 0.2, 0.1, 0.3, 0.25, "vs", 0.22), ("A", 5, dt.date(2023, 1, 2), 0.2, 0.1, 0.3, 0.25, "vs", 0.9)], cols)
    s = N.snapshots(f, g, F.lit("2024-05-03").cast("date"), fc, market="M").select("ticker", N.as_json(F.col("document")).alias("j"), N.digest(F.col("document"), "p", "m").alias("h"), N.digest(F.col("document")).alias("h0"))
    got = {r.ticker: r for r in s.collect()}
    a = json.loads(got["A"].j)
    assert set(got) == {"A", "B", "C", "M", "X"} and a["as_of"] == "2024-05-02" and a["history_available_days"] == 2
    assert a["implied_vol_pct"] == {"atm_7d": None, "atm_30d": 20.0, "atm_91d": None, "atm_365d": None, "variance_swap_30d": None}
    assert a["spot"] == 12.35 and a["variance_risk_premium_30d_pts"] is None and a["percentiles_0_to_100"]["atm_30d"] == 91.0
    assert [p["ticker"] for p in a["peers"]] == ["B", "M"] and a["earnings"]["next_release_session"] == "2024-05-02"
    track = a["volatility_forecast"]["5_trading_days"]["track_record_last_6m"]
    assert track == {"n_scored": 1, "rmse_forecast_pts": 2.0, "rmse_implied_pts": 3.0, "share_inside_80pct_range": 1.0} and a["volatility_forecast"]["21_trading_days"] is None
    m, x = json.loads(got["M"].j), json.loads(got["X"].j)
    assert m["peers"] == [] and m["variance_risk_premium_30d_pts"] == 0.0 and "-0.0" not in got["M"].j and m["volatility_forecast"] is None and m["earnings"] is None
    assert x["asset_group"] == "Other" and [p["ticker"] for p in x["peers"]] == ["M"]
    for row in got.values():
        plain = json.dumps(json.loads(row.j), sort_keys=True, separators=(",", ":"))
        assert plain == row.j
        assert row.h == hashlib.sha256((plain + "|p|m").encode()).hexdigest()[:16] and row.h0 == hashlib.sha256((plain + "|").encode()).hexdigest()[:16]
    assert N.snapshots(f.where("false"), g, F.lit("2024-05-03").cast("date")).count() == 0


def test_catalog_and_order(spark):
    c = spark.createDataFrame([("atm_30d",), ("atm_30d_z63",), ("other",), (None,)], "column string")
    got = {r.column: (r.unit, r.meaning) for r in N.catalog(c, [(r"atm_\d+d", "vol", "at the money"), (r"atm_.*", "sd", "z-score")]).collect()}
    assert got == {"atm_30d": ("vol", "at the money"), "atm_30d_z63": ("sd", "z-score"), "other": (None, "UNDOCUMENTED"), None: (None, None)}
    t = spark.createDataFrame([("Z",), ("B",), ("SPY",), ("C",)], "ticker string")
    assert [r.ticker for r in N.display_order(t, spark.createDataFrame([("SPY", 0), ("C", 1)], "ticker string, place int")).collect()] == ["SPY", "C", "B", "Z"]
