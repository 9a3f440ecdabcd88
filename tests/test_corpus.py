"""Batch builds, rows recomputed by file, snapshots by name, tensors, density verdicts, panels and exchange time."""

import datetime
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

DAY = datetime.date(2026, 1, 6)
CHAIN = "ticker string, date date, expiration date, T double, strike double, option_type string, bid double, ask double, underlying_price double"
TENORS = (1 / 12, 0.25, 0.5, 1.0, 2.0)


def quotes(ticker, day, tenors=TENORS, level=0.20, spot=100.0, known=True):
    from statistics import NormalDist

    n, out = NormalDist().cdf, []
    for t in tenors:
        f, d = spot * math.exp(0.02 * t), math.exp(-0.04 * t)
        for i in range(22):
            k = -0.35 + 0.53 * i / 21
            v = level + 0.01 * t - 0.025 * k / math.sqrt(max(t, 1 / 52)) + 0.06 * k * k
            strike, root = f * math.exp(k), v * math.sqrt(t)
            for kind, s in (("call", 1), ("put", -1)):
                mid = d * s * (f * n(s * (-k / root + root / 2)) - strike * n(s * (-k / root - root / 2)))
                out.append((ticker, day, day + datetime.timedelta(days=round(t * 365)), t, strike, kind, mid * 0.98, mid * 1.02, spot if known else None))
    return out


def outcome(frame):
    return {(r.ticker, r.date): (r.status, r.message) for r in frame.collect()}


def test_corpus_is_built_again_where_it_must_be(spark, tmp_path):
    from volframe.operators import corpus as C
    from volframe.plans.registry import K_GRID, T_GRID
    from volframe.sources import store

    chains, surfaces = str(tmp_path / "chains"), str(tmp_path / "surfaces")
    day = lambda n: DAY + datetime.timedelta(days=n)
    store.replace(spark.createDataFrame(quotes("A", day(0)) + quotes("A", day(1)) + quotes("A", day(2), (0.12, 0.55, 1.0)) + quotes("B", day(0), known=False), CHAIN), chains)
    go = lambda **k: outcome(C.build_corpus(spark, chains, surfaces, K_GRID, T_GRID, **k))
    assert C.build_corpus(spark, str(tmp_path / "none"), surfaces, K_GRID, T_GRID).count() == 0
    first = go()
    assert first == {("A", day(0)): ("built", None), ("A", day(1)): ("built", None), ("A", day(2)): ("rejected", "only 3 expiries fitted (need 4)"), ("B", day(0)): ("failed", "no underlying price")}
    have = lambda **k: sorted({(r.ticker, r.date) for r in store.load_surfaces(spark, surfaces, **k).collect()})
    assert have() == [("A", day(0)), ("A", day(1))]
    again = go()
    assert again[("A", day(0))] == ("skipped", "already there") and again[("A", day(2))][0] == "rejected"
    assert go(start=str(day(1)), end=str(day(1)), overwrite=True) == {("A", day(1)): ("built", None)}
    assert go(tickers=["A"], dates=[day(0), day(5)]) == {("A", day(0)): ("skipped", "already there"), ("A", day(5)): ("failed", "no chain rows")}
    # surfaces of an older builder: one can be built again, the other is rejected and must not stay
    old = store.load_surfaces(spark, surfaces).where("ticker = 'A'").drop("builder", "rejected").where(F.col("date") == F.lit(day(0)))
    store.save_surfaces(store.staged(old.unionByName(old.withColumn("date", F.lit(day(2)))), surfaces), surfaces, "old/0")
    assert have(builder=None) == [("A", day(0)), ("A", day(1)), ("A", day(2))] and have() == [("A", day(1))]
    later = go()
    assert later[("A", day(0))][0] == "built" and later[("A", day(2))][0] == "rejected"
    assert have(builder=None) == [("A", day(0)), ("A", day(1))] == have()


def test_outcomes_have_figures_and_a_summary(spark):
    from volframe.operators import corpus as C
    from volframe.plans.registry import K_GRID, T_GRID

    chain = spark.createDataFrame(quotes("A", DAY) + quotes("A", DAY)[:10], CHAIN)
    rates = spark.createDataFrame([(DAY - datetime.timedelta(days=3), 0.25, 0.0777), (DAY + datetime.timedelta(days=1), 0.25, 0.5)], "date date, tenor_years double, rate double")
    slices, out = C.build(chain, chain.select("ticker", "date"), K_GRID, T_GRID, rates, [0.25])
    row = out.first()
    assert row.status == "built" and row.r == pytest.approx(0.0777) and row.spot == 100 and row.n_slices == 5 and row.parity_fraction == 1 and row.fit_rmse < 0.005 and 0 < row.observed_fraction <= 1
    assert abs(row.atm_3m - 0.2025) < 0.01 and 0 < row.skew_3m < 0.1 and slices.count() == 5
    s = C.summary(out).first()
    assert (s.attempted, s.counts, s.atm_3m_median) == (1, {"built": 1}, row.atm_3m)
    assert C.summary(out.limit(0)).first().attempted == 0
    assert C.build(chain.limit(0), chain.limit(0), K_GRID, T_GRID)[1].count() == 0
    assert C.build(chain, chain, K_GRID, T_GRID)[1].first().r == 0.05  # no curve


def test_a_smile_that_raises_is_a_message(spark, monkeypatch):
    from volframe.operators import surface as S

    real = S._fit_group

    def broken(t, ks, *rest):
        if (np.asarray(t) == 0.5).any():
            raise ValueError("out of luck")
        return real(t, ks, *rest)

    monkeypatch.setattr(S, "_fit_group", broken)
    import pandas as pd

    quote = [{"k": x, "sigma": 0.2, "spread_iv": None} for x in np.linspace(-0.2, 0.2, 9)]
    pdf = pd.DataFrame({"ticker": "A", "as_of": DAY, "T": [0.25, 0.5], "forward": 100.0, "source": "parity", "quotes": [quote, quote]})
    out = next(S._fit_rows(iter([pdf]))).set_index("T")
    assert out.message[0.25] is None and out.rmse[0.25] < 1e-6 and out.message[0.5] == "ValueError: out of luck" and math.isnan(out.a[0.5])


def test_many_smiles_are_fitted_as_one_by_one():
    from volframe.operators.surface import _fit_group

    rng, ks, ivs = np.random.default_rng(0), [], []
    for n in (6, 9, 30, 14):
        k = np.sort(rng.uniform(-0.4, 0.3, n))
        ks.append(k)
        ivs.append(0.2 - 0.1 * k + 0.3 * k * k + rng.normal(0, 0.002, n) + (np.arange(n) == 3) * 0.3 * (n > 8))
    t, spread = np.array([0.1, 0.5, 1.0, 2.0]), [np.full(len(k), 0.01) for k in ks]
    p, off = _fit_group(t, ks, ivs, spread)
    for i in range(4):
        q, own = _fit_group(t[[i]], [ks[i]], [ivs[i]], [spread[i]])
        assert len(own[0]) == len(off[i]) <= len(ks[i]) - (len(ks[i]) > 8)
        assert np.allclose(np.sort(own[0]), np.sort(off[i]), atol=1e-6)


def test_only_changed_partitions_are_computed_again(spark, tmp_path):
    from volframe.sources import increment, store

    source, cache = str(tmp_path / "s"), str(tmp_path / "c")
    put = lambda rows: store.replace(spark.createDataFrame([(t, DAY + datetime.timedelta(days=d), x) for t, d, x in rows], "ticker string, date date, x double"), source)
    put([("A", 0, 1.0), ("A", 0, 2.0), ("A", 1, 3.0), ("B", 0, 4.0), ("C", 0, -1.0)])
    asked = []

    def compute(rows):
        asked.append(sorted((r.ticker, (r.date - DAY).days) for r in rows.select("ticker", "date").distinct().collect()))
        return rows.where("x > 0").groupBy("ticker", "date").agg(F.sum("x").alias("total"))

    go = lambda version="1", **k: sorted((r.ticker, (r.date - DAY).days, r.total) for r in increment.refresh(spark, source, cache, version, compute, **k).collect())
    first = go()
    assert first == [("A", 0, 3.0), ("A", 1, 3.0), ("B", 0, 4.0)] and asked == [[("A", 0), ("A", 1), ("B", 0), ("C", 0)]]
    assert go() == first and len(asked) == 1
    for name in os.listdir(f"{source}/ticker=A/date={DAY}"):  # touching a file is enough
        if name.endswith(".parquet"):
            os.utime(f"{source}/ticker=A/date={DAY}/{name}", (1, 1))
    assert go() == first and asked[1:] == [[("A", 0)]]
    put([("B", 0, 9.0), ("D", 1, 5.0)])
    assert go() == [("A", 0, 3.0), ("A", 1, 3.0), ("B", 0, 9.0), ("D", 1, 5.0)] and asked[2:] == [[("B", 0), ("D", 1)]]
    assert go("2") == go() and len(asked[3]) == 5 and len(asked) == 4
    assert go(select=lambda rows: rows.where("ticker = 'B'")) == [("B", 0, 9.0)] and len(asked) == 4


def test_snapshots_are_one_history(spark, tmp_path):
    from volframe.sources import snapshots as N

    folder = str(tmp_path / "vix")
    d = lambda n: DAY + datetime.timedelta(days=n)
    put = lambda version, rows, kind: N.save_index_snapshot(spark.createDataFrame(rows, "date date, " + kind), folder, version)
    assert N.index_history(spark, folder) is None
    put("2026-01-06", [(d(-1), 20.0, None, 140.0), (d(0), 21.0, 22.0, None)], "VIX double, VIX3M double, SKEW double")
    put("2026-01-07", [(d(0), 21.5, 22.5, 141.0), (d(1), None, 23.0, None)], "VIX double, VIX3M double, SKEW double")
    N.save_backfill(spark.createDataFrame([(d(-2), 10.0, 1.0), (d(0), 11.0, 2.0)], "date date, VIX double, VVIX double"), folder)
    N.save_backfill(spark.createDataFrame([(d(-3), 9.0), (d(-2), None)], "date date, VIX double"), folder)  # a shorter one erases nothing
    got = {(r.date - DAY).days: (r.VIX, r.VIX3M, r.SKEW, r.VVIX) for r in N.index_history(spark, folder).collect()}
    assert got == {-3: (9.0, None, None, None), -2: (10.0, None, None, 1.0), -1: (20.0, None, 140.0, None), 0: (21.5, 22.5, 141.0, 2.0), 1: (None, 23.0, None, None)}
    assert N.index_history(spark, folder, needed="VIX").count() == 4
    assert {(r.series, r.value) for r in N.latest(N.index_history(spark, folder)).collect()} == {("VIX3M", 23.0)}
    N.save_index_history(spark, folder, str(tmp_path / "history"))
    assert spark.read.parquet(str(tmp_path / "history")).count() == 5


def test_schedules_are_known_by_their_day(spark, tmp_path):
    from volframe.operators.features import scheduled_next
    from volframe.sources import snapshots as N

    folder = str(tmp_path / "events")
    put = lambda as_of, rows: N.save_schedule(spark.createDataFrame([(t, datetime.date.fromisoformat(x)) for t, x in rows], "ticker string, announced date"), folder, as_of)
    assert N.schedules(spark, folder) is None
    put("2026-04-20", [("A", "2026-04-30"), ("A", "2026-01-02"), ("B", "2026-05-01")])
    put("2026-04-20", [("B", "2026-05-02")])
    put("2026-05-04", [("A", "2026-05-07")])
    s = N.schedules(spark, folder)
    assert sorted((r.ticker, str(r.announced), str(r.snapshot)) for r in s.collect()) == [("A", "2026-04-30", "2026-04-20"), ("A", "2026-05-07", "2026-05-04"), ("B", "2026-05-02", "2026-04-20")]
    rows = spark.createDataFrame([("A", datetime.date(2026, 4, x)) for x in (17, 22)] + [("A", datetime.date(2026, 5, 5))], "ticker string, date date")
    got = scheduled_next(rows, s.withColumnRenamed("announced", "event"))
    assert {str(r.date): str(r.scheduled) for r in got.collect()} == {"2026-04-17": "None", "2026-04-22": "2026-04-30", "2026-05-05": "2026-05-07"}


def test_histories_are_rectangular(spark):
    from volframe.operators import corpus as C

    rows = [("A", DAY + datetime.timedelta(days=d), k, t, 0.2 + d / 100 + k / 10 + t, k > 0) for d in range(4) for k in (0.0, 0.1, 0.2) for t in (0.5, 1.0) if d != 2 or k < 0.2]
    rows += [("A", DAY, 0.0, 0.5, 0.9, False), ("B", DAY, 0.0, 0.5, None, None)]  # a point twice, a ticker without a whole grid
    t = C.history(spark.createDataFrame(rows, "ticker string, date date, k double, tenor double, iv double, observed boolean"), 3, 2)
    got = {(r.date - DAY).days: r for r in C.changes(C.same_shape(t)).collect()}
    assert sorted(got) == [0, 1, 3] and got[1].k_grid == [0.0, 0.1, 0.2] and got[1].t_grid == [0.5, 1.0]
    assert np.allclose(got[1]["values"], [[0.71, 1.21], [0.72, 1.22], [0.73, 1.23]]) and got[1].observed[1] == [True, True]
    assert got[0].change is None and np.allclose(got[3].change, 0.02) and got[0]["values"][0][0] == pytest.approx(0.8)
    assert {(r.date - DAY).days: round(r.value, 6) for r in C.series(t, 1, 1).collect()} == {0: 1.21, 1: 1.22, 3: 1.24}
    assert C.same_shape(t.limit(0)).count() == 0


def test_density_is_that_of_numpy(spark):
    from volframe.operators.surface import butterfly_verdict, density

    rng = np.random.default_rng(2)
    smiles = {"flat": (np.sort(rng.uniform(-0.3, 0.3, 15)), lambda k: 0.04 + 0 * k), "hump": (np.linspace(-0.1, 0.1, 20), lambda k: np.maximum(0.10 - 2 * k * k, 1e-4)), "two": (np.array([0.0, 0.1]), lambda k: 0.04 + k)}
    rows = [(n, DAY, 0.25, float(k), float(w)) for n, (ks, f) in smiles.items() for k, w in zip(ks, f(ks), strict=True)]
    frame = spark.createDataFrame(rows, "ticker string, as_of date, tenor double, k double, w double")
    got = {(r.ticker, r.k): r.g for r in density(frame).collect()}
    for n, (k, f) in smiles.items():
        w = f(k)
        if len(k) < 3:
            assert all(got[n, x] == 0 for x in k)
            continue
        d1 = np.gradient(w, k)
        g = (1 - k * d1 / (2 * w)) ** 2 - d1**2 / 4 * (1 / w + 0.25) + np.gradient(d1, k) / 2
        assert np.allclose([got[n, x] for x in k], g)
    assert {r.ticker: r.free for r in butterfly_verdict(frame).collect()} == {"flat": True, "hump": False, "two": True}
    assert butterfly_verdict(frame.limit(0)).count() == 0


def test_panel_regressions_are_newey_west(spark):
    from volframe.operators import study as Y

    rng, lag, rows = np.random.default_rng(4), 5, []
    for ticker, n in (("A", 60), ("B", 30), ("C", 60)):
        x, z = rng.normal(size=n), rng.normal(size=n).cumsum()
        y = 0.3 * x + np.convolve(rng.normal(size=n + 4), np.ones(5), "valid")
        rows += [(ticker, DAY + datetime.timedelta(days=i), float(x[i]), None if i % 7 == 0 else float(z[i]), 1.0, float("nan") if i == 3 else float(y[i])) for i in range(n)]
    frame = spark.createDataFrame(rows, "ticker string, date date, x double, z double, one double, y double")
    got = {(r.ticker, r.feature): r for r in Y.regressions(Y.panel(frame, ["x", "z", "one"], {"y": "y", "double": F.col("y") * 2}), lag, 40).where("target = 'y'").collect()}
    assert set(got) == {("A", "x"), ("A", "z"), ("C", "x"), ("C", "z")}
    for (ticker, feature), r in got.items():
        at = 2 if feature == "x" else 3
        d = np.array([(q[at], q[5]) for q in rows if q[0] == ticker and q[at] is not None and not math.isnan(q[5])])
        x, y = (d[:, 0] - d[:, 0].mean()) / d[:, 0].std(), d[:, 1]
        X = np.column_stack([np.ones(len(x)), x])
        b = np.linalg.lstsq(X, y, rcond=None)[0]
        s = X * (y - X @ b)[:, None]
        v = s.T @ s + sum((1 - k / (lag + 1)) * (s[k:].T @ s[:-k] + s[:-k].T @ s[k:]) for k in range(1, lag + 1))
        assert r.n == len(x) and r.slope == pytest.approx(b[1]) and r.t == pytest.approx(b[1] * len(x) / math.sqrt(v[1, 1]))
    fits = spark.createDataFrame([("y", "A", "f", 0.5, 3.0, 0.1), ("y", "B", "f", -0.1, None, 0.2), ("y", "C", "f", 0.2, -2.5, 0.3), ("y", "D", "g", 0.2, 1.0, 0.3), ("y", "E", "h", 0.2, 1.0, 0.3)], "target string, ticker string, feature string, slope double, t double, r2 double")
    s = {r.feature: r for r in Y.summarise(fits, F.when(F.col("feature") == "h", "first").otherwise("last"), ["first", "last"]).collect()}
    assert (s["f"].tickers, s["f"].median_slope, s["f"].significant, s["f"].same_sign) == (3, 0.2, 2, 2) and [s[f].place for f in "hfg"] == [1, 2, 3]


def test_exchange_time_does_not_depend_on_the_session(spark):
    from volframe.operators import market_days as M

    # the clocks change at 07:00 and 06:00 UTC
    utc = ["2024-03-10 06:59:59", "2024-03-10 07:00:00", "2024-11-03 05:59:59", "2024-11-03 06:00:00", "2024-11-29 18:30:00", "2024-07-04 15:00:00", "2024-07-05 15:59:59", "2024-07-05 16:00:00", None]
    micros = [None if x is None else int(datetime.datetime.fromisoformat(x).replace(tzinfo=datetime.timezone.utc).timestamp() * 1e6) for x in utc]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            e = spark.createDataFrame([(i, m) for i, m in enumerate(micros)], "i int, m long").select("i", M.exchange_time(F.timestamp_micros("m")).alias("announced"))
            days = M.exchange_calendar(spark.createDataFrame([(datetime.date(2024, 1, 1),), (datetime.date(2024, 12, 1),)], "date date"))
            got = {r.i: (str(r.announced), str(r.session)) for r in M.session_of(e, days).collect()}
            assert [got[i][0][11:] for i in range(4)] == ["01:59:59", "03:00:00", "01:59:59", "01:00:00"]
            assert [got[i][1] for i in range(4, 9)] == ["2024-12-02", "2024-07-05", "2024-07-05", "2024-07-08", "None"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
