"""Operators on small frames: models against plain loops, edge rows, streams."""

import datetime
import math

import numpy as np
from pyspark.sql import functions as F

DAY = datetime.date(2026, 3, 2)


def test_sabr_and_natural_svi(spark):
    from volframe.functions import pricing as P

    row = spark.createDataFrame([(100.0, 110.0, 0.5)], "f double, k double, t double")
    flat = P.sabr(F.col("f"), F.col("k"), F.col("t"), F.lit(0.2), 1.0, F.lit(0.0), F.lit(1e-9))
    money = P.sabr(F.col("f"), F.col("f"), F.col("t"), F.lit(0.2), 1.0, F.lit(-0.3), F.lit(0.4))
    x = row.select(flat.alias("flat"), money.alias("money"), P.svi_natural(F.lit(0.0), F.lit(0.01), F.lit(0.0), F.lit(-0.3), F.lit(0.04), F.lit(2.0)).alias("n")).first()
    assert abs(x.flat - 0.2) < 1e-6
    assert abs(x.money - 0.2 * (1 + 0.5 * (-0.3 * 0.4 * 0.2 / 4 + (2 - 3 * 0.09) / 24 * 0.16))) < 1e-12
    assert abs(x.n - (0.01 + 0.02 * (1 + math.sqrt(0.09 + 1 - 0.09)))) < 1e-12


def test_prices_of_expired_options(spark):
    from volframe.functions import pricing as P

    rows = spark.createDataFrame([(100.0, k, t, 0.03, s, c) for k in (90.0, 110.0) for t in (0.0, 1.0) for s in (0.0, 0.2) for c in (True, False)] + [(None, 1.0, 1.0, 0.0, 0.2, True)], "s double, k double, t double, r double, v double, c boolean")
    got = P.with_greeks(rows, "s", "k", "t", "r", "v", F.col("c")).collect()
    for g in got:
        if g.s is None:
            assert g.price is None and g.delta is None
        elif g.t == 0 or g.v == 0:
            assert g.price == max((1 if g.c else -1) * (g.s - g.k), 0) and g.gamma == 0 and g.delta == float(g.c and g.s > g.k)
    spot = rows.where("s is not null").select(P.bs_price(*map(F.col, ("s", "k", "t", "r", "v")), F.col("c")).alias("p"), "*")
    want = {(g.k, g.t, g.v, g.c): g.price for g in got}
    assert all(abs(r.p - want[(r.k, r.t, r.v, r.c)]) < 1e-9 for r in spot.collect())


def test_volatilities_come_back_and_impossible_prices_do_not():
    from volframe.operators.surface import _black, normal_cdf, solve_iv

    x = np.linspace(-9, 9, 181)
    assert np.abs(normal_cdf(x) - np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x])).max() < 1e-14
    k, s = (a.ravel() for a in np.meshgrid([60.0, 90.0, 100.0, 130.0], [0.05, 0.2, 1.5]))
    n = np.ones(len(k))
    for call in (True, False):
        price = _black(100 * n, k, 0.5 * n, s, 0.98 * n, np.full(len(k), call))
        iv = solve_iv(price, 100 * n, k, 0.5 * n, 0.98 * n, np.full(len(k), call))
        known = price - 0.98 * np.maximum((100 - k) * (1 if call else -1), 0) > 1e-6  # below that the price holds no volatility
        assert np.nanmax(np.abs(iv - s)[known & ~np.isnan(iv)]) < 1e-5 and not np.isnan(iv[(s == 0.2)]).any()
    assert np.isnan(solve_iv([0.0, 200.0, 1.0], [100.0] * 3, [100.0] * 3, [1.0, 1.0, 0.0], [1.0] * 3, np.array([True] * 3))).all()


def test_quotes_fall_back_to_quoted_volatilities(spark):
    from volframe.operators.surface import otm_quotes

    rows = [("A", DAY, 0.5, k, t, 100.0, 0.99, None, None, 0.2) for k in (80.0, 100.0, 120.0) for t in ("call", "put")] + [("A", DAY, 0.5, 500.0, "call", 100.0, 0.99, None, None, 0.2)]
    chain = spark.createDataFrame(rows, "ticker string, as_of date, T double, strike double, option_type string, spot double, discount double, bid double, ask double, implied_volatility_market double").withColumn("mid", F.lit(None).cast("double"))
    q = otm_quotes(chain).collect()
    assert {(r.strike, r.option_type) for r in q} == {(80.0, "put"), (100.0, "put"), (120.0, "call")} and all(r.source == "carry" and r.sigma == 0.2 for r in q)  # 500 is beyond the least delta
    assert otm_quotes(chain.drop("implied_volatility_market")).count() == 0


def test_wings_are_bounded():
    from volframe.operators.surface import WING_SLOPE, fit_svi

    k = np.linspace(-0.2, 0.2, 15)
    a, b, rho, m, s = fit_svi(k, 0.05 + 5 * np.abs(k), np.ones(15))  # steeper than any smile may be
    assert b * (1 + abs(rho)) <= WING_SLOPE + 1e-9


def test_asof_without_keys_and_clashing_names(spark):
    import pytest

    from volframe.operators.timeseries import asof_join

    left = spark.createDataFrame([(1, "x"), (5, "y"), (5, "y"), (None, "z")], "t int, v string")
    right = spark.createDataFrame([(1, 10), (1, 11), (4, None)], "u int, w int")
    got = sorted((str(r.t), r.v, r.w) for r in asof_join(left, right, "t", "u", values=["w"]).collect())
    assert got == [("1", "x", 11), ("5", "y", 11), ("5", "y", 11), ("None", "z", None)]
    with pytest.raises(ValueError, match="already"):
        asof_join(left, right.withColumnRenamed("w", "v"), "t", "u", values=["v"])


def test_coverage_counts_sessions(spark):
    from volframe.operators.quality import coverage, freshness
    from volframe.operators.timeseries import calendar

    day = lambda n: DAY + datetime.timedelta(days=n)  # noqa: E731  a Monday
    cal = calendar(spark.createDataFrame([(day(0),), (day(18),)], "date date"))
    rows = [("A", day(0)), ("A", day(0)), ("A", day(3)), ("A", None), ("B", day(18)), ("C", day(5)), ("C", day(8))]  # C begins on a Saturday
    have = spark.createDataFrame(rows, "ticker string, date date")
    got = {r.ticker: (r.present, r.expected, r.missing, r.first_missing) for r in coverage(have, cal).collect()}
    assert got == {"A": (2, 4, 2, [day(1), day(2)]), "B": (1, 1, 0, None), "C": (2, 2, 1, [day(7)])}
    assert {r.ticker: r.sessions_behind for r in freshness(have, cal).collect()} == {"A": 11, "B": 0, "C": 8}


def test_event_day_is_left_out(spark):
    from volframe.operators.features import historical_event_variance
    from volframe.operators.forecast import event_dataset
    from volframe.operators.timeseries import calendar, day_numbers

    rng = np.random.default_rng(2)
    day = lambda n: DAY + datetime.timedelta(days=int(n))
    closes = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, 120)))
    bars = spark.createDataFrame([("A", day(i), float(c), float(c) * 1.01, float(c) * 0.99, float(c), float(c)) for i, c in enumerate(closes)], "ticker string, date date, open double, high double, low double, close double, adj_close double")
    events = spark.createDataFrame([("A", day(n)) for n in (50, 70, 90, 100, 110)], "ticker string, event date")
    numbers = day_numbers(calendar(bars))
    rows = sorted(event_dataset(bars, events, numbers).collect(), key=lambda r: r.date)
    r = np.diff(np.log(closes))
    i = 47  # date 48; the window of 5 holds the event of date 50
    assert rows[i].ev_in_5 and abs(rows[i].y_5_ex - 252 * (r[48] ** 2 + sum(r[50:53] ** 2)) / 4) < 1e-9 and abs(rows[i].y_5 - 252 / 5 * sum(r[48:53] ** 2)) < 1e-9
    assert rows[49].ev_day and rows[49].rv_d_ex == rows[48].rv_d and not rows[48].ev_day
    none = event_dataset(bars, events.where("false"), numbers).collect()
    assert all(x.y_5_ex is None or abs(x.y_5_ex - x.y_5) < 1e-12 for x in none) and all(not x.ev_in_5 and x.ev_next is None for x in none)
    hist = sorted(historical_event_variance(bars, events).collect(), key=lambda x: x.date)
    assert hist[99].hist_var is None and hist[100].hist_var is not None  # the fourth event


def test_validation_names_all_broken_rules(spark):
    from volframe.operators import quality as Q

    rows = spark.createDataFrame([("A", DAY, 0.02), (None, DAY, 0.5), ("B", None, None)], "ticker string, date date, rate double").withColumn("tenor_years", F.lit(1.0))
    got = [r.errors for r in Q.validate(rows, Q.rates_rules()).collect()]
    assert got == [[], ["rate"], ["date", "rate"]]
    assert {r.rule: r.failed for r in Q.violations(rows, Q.rates_rules()).collect()} == {"date": 1, "tenor_years": 0, "rate": 2}
    grid = spark.createDataFrame([(0.0, 0.5, 5.0, "call", 1.0), (None, 0.0, 5.1, "x", None), (9.0, 0.5, 0.0, "put", 1.0)], "log_moneyness double, T double, implied_volatility double, option_type string, strike double")
    assert [len(r.errors) for r in Q.validate(grid, Q.surface_grid_rules()).collect()] == [0, 5, 1]
    vix = spark.createDataFrame([(DAY, 20.0, None), (DAY, -1.0, 2.0), (DAY, 0.0, 2.0)], "date date, vix double, skew double")
    assert [r.valid for r in Q.validate(vix, Q.index_rules(vix.columns)).collect()] == [True, False, True]
    iv = spark.createDataFrame([(None,), (0.0,), (10.0,), (10.1,)], "implied_volatility double")
    assert [r.valid for r in Q.validate(iv, {"iv": Q.normalised_chain_rules()["implied_volatility"]}).collect()] == [True, False, True, False]


def test_window_ends_count_sessions(spark):
    from volframe.operators.serving import window_end
    from volframe.operators.timeseries import calendar

    cal = calendar(spark.createDataFrame([(DAY,), (DAY + datetime.timedelta(days=11),)], "date date"))
    rows = spark.createDataFrame([(DAY, 5), (DAY + datetime.timedelta(days=5), 1), (DAY + datetime.timedelta(days=11), 2)], "date date, h int")
    got = {r.date: (r.window_end - DAY).days for r in window_end(rows, cal, F.col("h")).collect()}
    assert got == {DAY: 7, DAY + datetime.timedelta(days=5): 7, DAY + datetime.timedelta(days=11): 15}


def test_streams_of_ticks_and_repeats(spark, tmp_path):
    from volframe.streaming.ingest import bars_from_ticks, deduplicated, file_stream

    t0 = datetime.datetime(2026, 3, 2, 10)
    rows = spark.createDataFrame([("A", t0 + datetime.timedelta(minutes=m), p, i) for i, (m, p) in enumerate([(0, 1.0), (5, 3.0), (9, 2.0), (60 * 24 * 5, 9.0)])] + [("A", t0, 1.0, 0)], "k string, at timestamp, p double, id int")
    src = str(tmp_path / "in")
    rows.write.parquet(src)
    for f, name in ((lambda s: deduplicated(s, ["id"], "at"), "once"), (lambda s: bars_from_ticks(s, "k", "at", "p"), "bars")):
        q = f(file_stream(spark, src, rows.schema)).writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"{name}-cp")).trigger(availableNow=True).start()
        q.awaitTermination(90)
    assert spark.read.parquet(str(tmp_path / "once")).count() == 4
    bar = spark.read.parquet(str(tmp_path / "bars")).first()
    assert (bar.open, bar.high, bar.low, bar.close, bar.n) == (1.0, 3.0, 1.0, 2.0, 4)
