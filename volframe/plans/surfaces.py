"""Queries of fitted surfaces, over given smiles, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from volframe.functions import pricing as P
from volframe.operators import expiry as E
from volframe.operators import surface as S
from volframe.operators.features import DELTAS, SMILE_TENORS, TENORS_DAYS, surface_features
from volframe.plans.registry import K_GRID, T_GRID, query, r, rounded
from volframe.sources import fixtures as X

_SLICES = f"WITH RECURSIVE {X.BARS_SQL}, {X.SLICES_SQL}"
_T = ["7.0/365", "14.0/365", "30.0/365", "60.0/365", "91.0/365", "0.5", "1.0", "2.0"]
_GRID_SQL = f"""{_SLICES}, {X.brackets_sql(_T)}, ks AS (SELECT unnest(list_transform(range(0, 25), lambda i: -0.4 + 0.025 * i))::DOUBLE AS k),
g AS (SELECT ticker, as_of, k, tau AS tenor, {X.variance_sql('k')} AS w, in_t AND k >= qlo AND k <= qhi AS observed FROM br, ks)"""


@query(f"{_GRID_SQL} SELECT ticker, as_of, round(k, 6) AS k, round(tenor, 6) AS tenor, round(w, 8) AS w, round(sqrt(w / tenor), 6) AS iv, observed FROM g")
def surface_points(spark, d):
    """Total variance, volatility and whether it is observed, on the standard grid."""
    g = S.total_variance(X.slices(spark, d), K_GRID, T_GRID)
    return g.select("ticker", "as_of", r("k").alias("k"), r("tenor").alias("tenor"), r("w", 8).alias("w"), r("iv").alias("iv"), "observed")


_QC_SQL = f"""{_GRID_SQL}, c AS (SELECT *, max(greatest(w, 1e-12)) OVER (PARTITION BY ticker, as_of, k ORDER BY tenor) AS cw FROM g)"""


def _gradient_sql(y: str) -> str:
    x0, x2, y0, y2 = "lag(k) OVER s", "lead(k) OVER s", f"lag({y}) OVER s", f"lead({y}) OVER s"
    h0, h2 = f"(k - {x0})", f"({x2} - k)"
    inner = f"({h0} * {h0} * {y2} + ({h2} * {h2} - {h0} * {h0}) * {y} - {h2} * {h2} * {y0}) / ({h0} * {h2} * ({h0} + {h2}))"
    return f"CASE WHEN {x0} IS NULL THEN ({y2} - {y}) / {h2} WHEN {x2} IS NULL THEN ({y} - {y0}) / {h0} ELSE {inner} END"


_DENSITY_SQL = f"""{_QC_SQL}, e1 AS (SELECT *, {_gradient_sql('cw')} AS d1 FROM c WINDOW s AS (PARTITION BY ticker, as_of, tenor ORDER BY k)),
e2 AS (SELECT *, {_gradient_sql('d1')} AS d2 FROM e1 WINDOW s AS (PARTITION BY ticker, as_of, tenor ORDER BY k)),
dg AS (SELECT *, pow(1 - k * d1 / (2 * cw), 2) - d1 * d1 / 4 * (1 / cw + 0.25) + d2 / 2 AS g FROM e2)"""


@query(f"{_DENSITY_SQL} SELECT ticker, as_of, round(k, 6) AS k, round(tenor, 6) AS tenor, round(cw, 8) AS w, round(sqrt(cw / tenor), 6) AS iv, round(g, 5) AS g FROM dg")
def surface_density(spark, d):
    """The grid without calendar arbitrage, and the density that is negative where butterflies allow arbitrage."""
    g = S.density(S.calendar_filter(S.total_variance(X.slices(spark, d), K_GRID, T_GRID)))
    return g.select("ticker", "as_of", r("k").alias("k"), r("tenor").alias("tenor"), r("w", 8).alias("w"), r("iv").alias("iv"), r("g", 5).alias("g"))


@query(f"""{_DENSITY_SQL} SELECT ticker, as_of, round(tenor, 6) AS tenor, count(*) AS points, count(*) FILTER (g < -1e-8) = 0 AS free, count(*) FILTER (g < -1e-8) AS violations, round(min(g), 5) AS least, round(arg_min(k, g), 6) AS at FROM dg GROUP BY ticker, as_of, tenor""")
def butterfly_verdict(spark, d):
    """Whether each smile of the grid is free of butterfly arbitrage, and where its density is least."""
    v = S.butterfly_verdict(S.calendar_filter(S.total_variance(X.slices(spark, d), K_GRID, T_GRID)))
    return v.select("ticker", "as_of", r("tenor").alias("tenor"), "points", "free", "violations", r("least", 5).alias("least"), r("at").alias("at"))


@query(f"""{_GRID_SQL}, v AS (SELECT *, sqrt(w / tenor) AS iv FROM g), q AS (SELECT ticker, as_of, avg((iv IS NULL)::INT) AS missing, min(iv) AS lo, max(iv) AS hi FROM v GROUP BY 1, 2)
SELECT ticker, as_of, round(missing, 6) AS missing, round(lo, 6) AS lo, round(hi, 6) AS hi, CASE WHEN missing = 1 THEN 'empty' WHEN missing > 0.5 THEN 'mostly missing' WHEN lo <= 0.01 THEN 'too low' WHEN hi > 3 THEN 'too high' END AS reason,
 NOT (missing > 0.5 OR lo <= 0.01 OR hi > 3) AS accepted FROM q""")
def surface_verdict(spark, d):
    return rounded(S.grid_verdict(S.total_variance(X.slices(spark, d), K_GRID, T_GRID)), "missing", "lo", "hi")


@query(f"""{_GRID_SQL}, n AS (SELECT *, lead(w) OVER s AS w2, lead(tenor) OVER s AS next_tenor FROM g WINDOW s AS (PARTITION BY ticker, as_of, k ORDER BY tenor))
SELECT ticker, as_of, round(tenor, 6) AS tenor, round(next_tenor, 6) AS next_tenor, count(*) FILTER (w > w2 + 1e-8) AS violations, round(max(w - w2), 8) AS worst FROM n WHERE w2 IS NOT NULL GROUP BY ticker, as_of, tenor, next_tenor""")
def calendar_arbitrage(spark, d):
    """Adjacent tenors whose total variance falls somewhere."""
    v = S.calendar_violations(S.total_variance(X.slices(spark, d), K_GRID, T_GRID))
    return v.select("ticker", "as_of", r("tenor").alias("tenor"), r("next_tenor").alias("next_tenor"), "violations", r("worst", 8).alias("worst"))


def _strikes_sql(tenors: list[str]) -> str:
    """CTEs ds(ticker, as_of, tau, name, k): strikes of the deltas by halving."""
    return f"""{X.brackets_sql(tenors)},
dl AS (SELECT unnest(['p10', 'p25', 'c25', 'c10']) AS name, unnest([0.9, 0.75, 0.25, 0.1])::DOUBLE AS target),
hlv AS (SELECT ticker, as_of, tau, l, h, x, name, target, -4.0::DOUBLE AS lo, 3.0::DOUBLE AS hi, -0.5::DOUBLE AS k, 0 AS n FROM br, dl
       UNION ALL SELECT ticker, as_of, tau, l, h, x, name, target, CASE WHEN p > target THEN k ELSE lo END, CASE WHEN p > target THEN hi ELSE k END, (CASE WHEN p > target THEN k ELSE lo END + CASE WHEN p > target THEN hi ELSE k END) / 2, n + 1
       FROM (SELECT *, {X.ncdf_sql('z')} AS p FROM (SELECT *, -k / rw + rw / 2 AS z FROM (SELECT *, sqrt({X.variance_sql('k')}) AS rw FROM hlv WHERE n < 48)))),
ds AS (SELECT hlv.ticker, hlv.as_of, hlv.tau, name, hlv.k, l, h, x FROM hlv WHERE n = 48)"""


@query(f"""{_SLICES}, {_strikes_sql(['30.0/365', '91.0/365', '0.75', '3.0'])} SELECT ds.ticker, ds.as_of, round(ds.tau, 6) AS tenor, name AS delta, round(ds.k, 6) AS k, round(sqrt({X.variance_sql('k')} / tau), 6) AS iv FROM ds""")
def delta_strike(spark, d):
    """Strikes and volatilities of four deltas at tenors between and beyond the expiries."""
    s = E.surfaces(X.slices(spark, d)).withColumn("t", F.explode(F.array(*[F.lit(t) for t in (30 / 365, 91 / 365, 0.75, 3.0)]))).withColumn("b", E.bracket(F.col("slices"), F.col("t")))
    s = s.select("ticker", "as_of", "t", "b", *[E.delta_strike(F.col("b"), x).alias(n) for n, x in DELTAS.items()])
    s = s.unpivot(["ticker", "as_of", "t", "b"], list(DELTAS), "delta", "k")
    return s.select("ticker", "as_of", r("t").alias("tenor"), "delta", r("k").alias("k"), r(E.iv(F.col("b"), F.col("k"))).alias("iv"))


_VS_SQL = f"""vp AS (SELECT ticker, as_of, "T", i, -2.5 + i * 0.001 AS k, sqrt(greatest({X.wing_sql('s', '(-2.5 + i * 0.001)')}, 1e-12)) AS rw FROM slices s, (SELECT unnest(range(0, 4001)) AS i)),
vd AS (SELECT *, CASE WHEN k >= 0 THEN 1.0 ELSE -1.0 END AS sg, -k / rw + rw / 2 AS d1, -k / rw - rw / 2 AS d2 FROM vp), ve AS (SELECT *, sg * d1 AS z1, sg * d2 AS z2 FROM vd),
vs AS (SELECT ticker, as_of, "T", sum(2 * 0.001 * CASE WHEN i IN (0, 4000) THEN 0.5 ELSE 1 END * sg * ({X.ncdf_sql('z1')} - exp(k) * {X.ncdf_sql('z2')}) * exp(-k)) AS vs_w FROM ve GROUP BY 1, 2, 3)"""


@query(f"""{_SLICES}, {_VS_SQL} SELECT ticker, as_of, round("T", 6) AS "T", round(vs_w, 7) AS vs_w, round(sqrt(vs_w / "T"), 6) AS vol FROM vs""")
def variance_swap(spark, d):
    """Fair variance of each expiry from its smile, as a sum over the strikes."""
    v = E.variance_swaps(X.slices(spark, d).drop("spot"))
    return v.select("ticker", "as_of", r("T").alias("T"), r("vs_w", 7).alias("vs_w"), r(F.sqrt(F.col("vs_w") / F.col("T"))).alias("vol"))


_FEATURES = [f"atm_{n}" for n in TENORS_DAYS] + [f"iv_{x}_{n}" for n in SMILE_TENORS for x in DELTAS] + [f"{x}_{n}" for n in SMILE_TENORS for x in ("rr25", "bf25", "rr10", "bf10", "atm_skew", "vs")] + ["ts_7_30", "ts_30_91", "ts_30_365", "fwd_carry_1y"]


def features_sql() -> str:
    """CTE sf: one row per surface with all features; needs slices, and WITH RECURSIVE."""
    days = [f"{n}.0/365" for n in TENORS_DAYS.values()]
    smile = lambda n: f"max(v) FILTER (nm = '{n[0]}' AND dy = {n[1]})"
    cols = [f"max(v) FILTER (nm = 'atm' AND dy = {y}) AS atm_{n}" for n, y in TENORS_DAYS.items()]
    for n in SMILE_TENORS:
        y = TENORS_DAYS[n]
        p = {x: smile((x, y)) for x in (*DELTAS, "up", "dn", "atm")}
        cols += [f"{p[x]} AS iv_{x}_{n}" for x in DELTAS]
        for q in ("25", "10"):
            cols += [f"{p['c' + q]} - {p['p' + q]} AS rr{q}_{n}", f"0.5 * ({p['c' + q]} + {p['p' + q]}) - {p['atm']} AS bf{q}_{n}"]
        cols += [f"({p['up']} - {p['dn']}) / 0.02 AS atm_skew_{n}", f"({p['up']} - 2 * {p['atm']} + {p['dn']}) / 0.0001 AS atm_curv_{n}"]
    atm = lambda y: smile(("atm", y))
    cols += [f"{atm(30)} - {atm(7)} AS ts_7_30", f"{atm(91)} - {atm(30)} AS ts_30_91", f"{atm(365)} - {atm(30)} AS ts_30_365"]
    swaps = ", ".join(f"max(sqrt(((1 - x) * a.vs_w + x * b.vs_w) / tau)) FILTER (inside AND round(tau * 365) = {TENORS_DAYS[n]}) AS vs_{n}" for n in SMILE_TENORS)
    return f"""{_strikes_sql(days)}, {_VS_SQL},
pt AS (SELECT ticker, as_of, tau, 'atm' AS nm, 0.0::DOUBLE AS k FROM br UNION ALL SELECT ticker, as_of, tau, 'up', 0.01 FROM br UNION ALL SELECT ticker, as_of, tau, 'dn', -0.01 FROM br UNION ALL SELECT ticker, as_of, tau, name, k FROM ds),
pv AS (SELECT pt.ticker, pt.as_of, nm, round(pt.tau * 365)::INT AS dy, CASE WHEN inside AND in_t AND pt.k >= qlo AND pt.k <= qhi THEN sqrt({X.variance_sql('pt.k').replace(' tau ', ' br.tau ')} / br.tau) END AS v FROM pt JOIN br ON br.ticker = pt.ticker AND br.as_of = pt.as_of AND br.tau = pt.tau),
f1 AS (SELECT ticker, as_of, {', '.join(cols)} FROM pv GROUP BY 1, 2),
f2 AS (SELECT br.ticker, br.as_of, {swaps} FROM br JOIN vs a ON a.ticker = br.ticker AND a.as_of = br.as_of AND a."T" = l."T" JOIN vs b ON b.ticker = br.ticker AND b.as_of = br.as_of AND b."T" = h."T" GROUP BY 1, 2),
f3 AS (SELECT ticker, as_of, max(spot) AS spot, count(*)::DOUBLE AS n_expiries, min("T") * 365 AS nearest_expiry_days, median(rmse) AS fit_rmse, avg((source = 'parity')::INT) AS parity_fraction,
       arg_min(ln(forward / spot) / "T", abs("T" - 1)) FILTER (source = 'parity' AND "T" BETWEEN 0.5 AND 1.5) AS fwd_carry_1y FROM slices GROUP BY 1, 2),
sf AS (SELECT * FROM f1 JOIN f2 USING (ticker, as_of) JOIN f3 USING (ticker, as_of))"""


@query(f"{_SLICES}, {features_sql()} SELECT ticker, as_of, {', '.join(f'round({c}, 6) AS {c}' for c in _FEATURES)}, round(atm_curv_30d, 3) AS atm_curv_30d, round(atm_curv_91d, 3) AS atm_curv_91d, n_expiries, round(nearest_expiry_days, 6) AS nearest_expiry_days, round(fit_rmse, 6) AS fit_rmse, round(parity_fraction, 6) AS parity_fraction FROM sf")
def surface_features_daily(spark, d):
    f = surface_features(X.slices(spark, d), spot="spot")
    rest = ["nearest_expiry_days", "fit_rmse", "parity_fraction"]
    return f.select("ticker", "as_of", *[r(c).alias(c) for c in _FEATURES], *[r(f"atm_curv_{n}", 3).alias(f"atm_curv_{n}") for n in SMILE_TENORS], "n_expiries", *[r(c).alias(c) for c in rest])


_STORED_SQL = f"""{_SLICES}, sg AS (SELECT ticker, as_of, "T" AS tenor, k, sqrt({X.wing_sql('s', 'k')} / "T") AS iv FROM slices s, (SELECT unnest([-0.4, -0.2, 0.0, 0.2])::DOUBLE AS k))"""


def _cell_sql(k0: str, k1: str, t0: str, t1: str, k: str, t: str) -> str:
    g = lambda kk, tt: f"max(iv) FILTER (k = {kk} AND tenor = {tt})"
    row = lambda tt: f"({g(k0, tt)} + ({g(k1, tt)} - {g(k0, tt)}) * ({k} - ({k0})) / ({k1} - ({k0})))"
    return f"({row(t0)} + ({row(t1)} - {row(t0)}) * ({t} - {t0}) / ({t1} - {t0}))"


@query(f"""{_STORED_SQL} SELECT ticker, as_of, round({_cell_sql('0.0', '0.2', '0.25', '0.5', '0.0', '0.3')}, 6) AS atm_vol, round({_cell_sql('-0.2', '0.0', '0.5', '1.0', '-0.1', '0.75')}, 6) AS inside,
round({_cell_sql('0.0', '0.2', '1.0', '2.0', '0.3', '3.0')}, 6) AS beyond, round({_cell_sql('-0.4', '-0.2', '0.02', '0.08', '-0.5', '0.01')}, 6) AS before, round({_cell_sql('0.0', '0.2', '0.25', '0.5', '0.0', '0.25')}, 6) AS term_25 FROM sg GROUP BY 1, 2""")
def stored_grid(spark, d):
    """A stored grid read back from its long form and asked between its knots and beyond them."""
    s = X.slices(spark, d).withColumn("k", F.explode(F.array(*[F.lit(k) for k in (-0.4, -0.2, 0.0, 0.2)])))
    long = s.select("ticker", "as_of", F.col("T").alias("tenor"), "k", F.sqrt(E.wing_variance(F.struct(*E.SHAPE), F.col("k")) / F.col("T")).alias("iv"))
    at = lambda k, t: r(E.bilinear(F.col("points"), F.lit(k), F.lit(t)))
    return E.from_long(long).select("ticker", "as_of", at(0.0, 0.3).alias("atm_vol"), at(-0.1, 0.75).alias("inside"), at(0.3, 3.0).alias("beyond"), at(-0.5, 0.01).alias("before"), at(0.0, 0.25).alias("term_25"))


@query(f"""WITH {X.BARS_SQL}, s AS (SELECT ticker, date AS as_of, close AS spot FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date_trunc('month', date) ORDER BY date) AS n FROM bars) WHERE n = 1),
c AS (SELECT ticker, as_of, spot, t AS "T", option_type, option_type = 'call' AS cl, CASE WHEN option_type = 'call' THEN 1.0 ELSE -1.0 END AS sg, spot * exp(0.02 * t) AS f, exp(-0.04 * t) AS dc, spot * exp(0.02 * t) * exp(-0.35 + i * 0.53 / 21) AS strike,
 0.20 + 0.01 * t - 0.025 * (-0.35 + i * 0.53 / 21) / sqrt(greatest(t, 1.0 / 52)) + 0.06 * pow(-0.35 + i * 0.53 / 21, 2) AS iv FROM s, (SELECT unnest([1.0::DOUBLE / 12, 0.25, 0.5, 1.0, 2.0]) AS t), (SELECT unnest(range(0, 22)) AS i), (SELECT unnest(['call', 'put']) AS option_type)),
e AS (SELECT *, iv * sqrt("T") AS rt, (ln(f / strike) + iv * iv * "T" / 2) / (iv * sqrt("T")) AS b1, (ln(spot / strike) + (0.04 + iv * iv / 2) * "T") / (iv * sqrt("T")) AS d1 FROM c),
z AS (SELECT *, sg * b1 AS zb1, sg * (b1 - rt) AS zb2, sg * d1 AS z1, sg * (d1 - rt) AS z2, d1 - rt AS d2, exp(-d1 * d1 / 2) / sqrt(2 * pi()) AS pdf FROM e),
n AS (SELECT *, {X.ncdf_sql('zb1')} AS nb1, {X.ncdf_sql('zb2')} AS nb2, {X.ncdf_sql('z1')} AS n1, {X.ncdf_sql('z2')} AS n2 FROM z)
SELECT ticker, as_of, round("T", 6) AS "T", round(strike, 6) AS strike, option_type, round(dc * sg * (f * nb1 - strike * nb2), 6) AS price, round(sg * n1, 6) AS delta, round(pdf / (spot * rt), 6) AS gamma, round(spot * pdf * sqrt("T"), 6) AS vega,
 round((-spot * pdf * iv / (2 * sqrt("T")) - sg * 0.04 * strike * exp(-0.04 * "T") * n2) / 365.25, 6) AS theta, round(sg * strike * "T" * exp(-0.04 * "T") * n2, 6) AS rho, round(-pdf * d2 / iv, 6) AS vanna, round(spot * pdf * sqrt("T") * d1 * d2 / iv, 6) AS volga FROM n""")
def black76_greeks(spark, d):
    """Black-76 prices and the Greeks of the spot form for the whole chain, as Column expressions."""
    c = P.with_greeks(X.chain(spark, d).withColumn("r", F.lit(0.04)), "spot", "strike", "T", "r", "iv", F.col("option_type") == "call")
    names = ["delta", "gamma", "vega", "theta", "rho", "vanna", "volga"]
    return c.select("ticker", "as_of", r("T").alias("T"), r("strike").alias("strike"), "option_type", r("mid").alias("price"), *[r(n).alias(n) for n in names])
