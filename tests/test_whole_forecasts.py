"""Monthly refits against a plain loop: all closed rows of all tickers, both horizons."""

import datetime

import numpy as np
import pytest


@pytest.mark.parametrize("h", [5, 21])
def test_refits_pool_all_closed_rows(spark, h):
    from volframe.operators.evaluate import walk_forward

    rng = np.random.default_rng(4)
    day = datetime.date(2020, 1, 1)
    rows = [(t, day + datetime.timedelta(days=i), float(np.exp(rng.normal(-3, 0.5))), float(np.exp(rng.normal(-2, 0.3))), float(np.exp(rng.normal(-3, 0.4)))) for t, n in (("A", 1500), ("B", 400), ("C", 100)) for i in range(1500 - n, 1500)]
    rows[700] = (*rows[700][:3], 0.0, rows[700][4])
    frame = spark.createDataFrame(rows, "ticker string, date date, a double, b double, y double")
    got = {(r.ticker, r.date): r for r in walk_forward(frame, "y", h, ["a", "b"], alpha=1.0, least=250).collect()}
    of = {t: [r for r in rows if r[0] == t] for t in "ABC"}
    want = {}
    for m in sorted({r[1].replace(day=1) for r in rows}):
        old = [r for rs in of.values() for i, r in enumerate(rs) if i + h < len(rs) and rs[i + h][1] < m and r[3] > 0]
        if len(old) < 250:
            continue
        x, y = np.log([r[2:4] for r in old]), np.log([r[4] for r in old])
        mu, sd = x.mean(0), x.std(0)
        z = lambda v: np.column_stack([np.ones(len(v)), (v - mu) / sd])
        c = np.linalg.solve(z(x).T @ z(x) + np.diag([0.0, 1.0, 1.0]), z(x).T @ y)
        left = y - z(x) @ c
        for r in rows:
            if r[1].replace(day=1) == m and r[3] > 0:
                mid = (z(np.log([r[2:4]])) @ c)[0]
                want[r[:2]] = (np.exp(mid) * np.exp(left).mean(), *np.exp(mid + np.quantile(left, [0.1, 0.9])), len(old))
    assert got.keys() == want.keys() and ("C", rows[-1][1]) in want
    for k, w in want.items():
        assert np.allclose((got[k].forecast, got[k].lo, got[k].hi), w[:3], rtol=1e-8) and (got[k].n_train, got[k].horizon) == (w[3], h)


def test_range_at_all_levels_and_coefficients(spark):
    from volframe.operators.evaluate import coefficients, walk_forward

    rng = np.random.default_rng(1)
    day = datetime.date(2021, 1, 4)
    rows = [("A", day + datetime.timedelta(days=i), float(np.exp(rng.normal(-3, 0.5))), float(np.exp(rng.normal(-3, 0.4))) if i % 5 else 0.05) for i in range(400)]
    frame = spark.createDataFrame(rows, "ticker string, date date, a double, y double")
    levels = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = {r.date: r for r in walk_forward(frame, "y", 2, ["a"], least=100, levels=levels).collect()}
    fits = {(r.month, r.term): (r.coefficient, r.n_train) for r in coefficients(frame, "y", 2, ["a"], least=100).collect()}
    month = datetime.date(2022, 1, 1)
    old = [r for i, r in enumerate(rows) if i + 2 < len(rows) and rows[i + 2][1] < month]
    x, y = np.log([r[2] for r in old]), np.log([r[3] for r in old])
    slope, const = np.polyfit(x, y, 1)
    assert np.allclose([fits[month, "const"][0], fits[month, "a"][0]], [const, slope]) and fits[month, "a"][1] == len(old)
    row = next(r for r in rows if r[1] == datetime.date(2022, 1, 10))
    mid = const + slope * np.log(row[2])
    assert np.allclose(got[row[1]].range, np.exp(mid + np.quantile(y - const - slope * x, levels)), rtol=1e-8)
    assert walk_forward(frame.limit(0), "y", 2, ["a"]).count() == 0 == coefficients(frame.limit(0), "y", 2, ["a"]).count()
