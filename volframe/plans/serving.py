"""Queries behind screens, positions and signals, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from volframe.operators import backtest as B
from volframe.operators import evaluate as E
from volframe.operators import expiry as Y
from volframe.operators import realized as R
from volframe.operators import serving as V
from volframe.plans.registry import _FEATURES_SQL, _OTM_SQL, query, r, rounded
from volframe.plans.surfaces import _SLICES, _strikes_sql
from volframe.sources import fixtures as X

_AS_OF = "1997-06-30"


@query(_FEATURES_SQL + f""", n AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS k FROM f WHERE date <= DATE '{_AS_OF}')
SELECT ticker, max(date) AS date, round(max(CASE WHEN k = 1 THEN rv_cc_21d END), 6) AS rv_cc_21d, count(rv_cc_21d) FILTER (k <= 63) AS points, round(arg_min(rv_cc_21d, date) FILTER (k <= 63 AND rv_cc_21d IS NOT NULL), 6) AS first_point FROM n GROUP BY 1 HAVING date_diff('day', max(date), DATE '{_AS_OF}') <= 5""")
def overview_as_of(spark, d):
    """Each ticker's last features as of a day, with the trend of the days before; stale tickers are left out."""
    o = V.overview(R.realized_features(X.bars(spark, d)), F.lit(_AS_OF).cast("date"), ["rv_cc_21d"], "rv_cc_21d")
    return o.select("ticker", "date", r("rv_cc_21d").alias("rv_cc_21d"), F.size("trend").cast("long").alias("points"), r(F.get("trend", F.lit(0))).alias("first_point"))


@query(f"""{_SLICES}, e AS (SELECT *, round("T" * 365)::INT AS days FROM slices), a AS (SELECT ticker, as_of, min(row(abs(days - 30), "T", expiration)) AS x, min(row(abs(days - 91), "T", expiration)) AS y FROM e GROUP BY 1, 2)
SELECT ticker, as_of, 0 AS place, x[3] AS expiration FROM a UNION ALL SELECT ticker, as_of, 1, y[3] FROM a WHERE y[3] <> x[3]""")
def default_expiries(spark, d):
    return V.default_expiries(X.slices(spark, d))


@query(f"""{_SLICES}, p AS (SELECT s.*, i, k_min - 0.02 + i * (k_max - k_min + 0.04) / 20 AS k FROM slices s, (SELECT unnest(range(0, 21)) AS i))
SELECT ticker, as_of, expiration, round("T" * 365)::INT AS days, i::INT AS point, round(k, 6) AS k, round(100 * exp(k), 5) AS moneyness, round(sqrt(greatest({X.wing_sql('p', 'k')}, 0) / "T"), 6) AS iv FROM p""")
def smile_curves(spark, d):
    c = V.smile_curves(X.slices(spark, d), points=21)
    return c.withColumns({"k": r("k"), "moneyness": r("moneyness", 5), "iv": r("iv")})


@query(f"""{_SLICES}, ed AS (SELECT ticker, as_of, min("T") AS t0, max("T") AS t1 FROM slices GROUP BY 1, 2), tt AS (SELECT ticker, as_of, t0 * pow(t1 / t0, i / 19.0::DOUBLE) AS tau, false AS listed FROM ed, (SELECT unnest(range(0, 20)) AS i) UNION ALL SELECT ticker, as_of, "T", true FROM slices),
nr AS (SELECT tt.ticker, tt.as_of, tau, listed, max("T") FILTER ("T" < tau) AS below, min("T") FILTER ("T" >= tau) AS above, min("T") AS t0, max("T") AS t1 FROM tt JOIN slices s ON s.ticker = tt.ticker AND s.as_of = tt.as_of GROUP BY 1, 2, 3, 4),
ng AS (SELECT *, CASE WHEN tau <= t0 THEN t0 WHEN tau >= t1 THEN t1 ELSE below END AS tl, CASE WHEN tau <= t0 THEN t0 WHEN tau >= t1 THEN t1 ELSE above END AS th FROM nr),
bq AS (SELECT n.ticker, n.as_of, tau, listed, l, h, CASE WHEN tl < th THEN (tau - tl) / (th - tl) ELSE 0 END AS x FROM ng n JOIN slices l ON l.ticker = n.ticker AND l.as_of = n.as_of AND l."T" = tl JOIN slices h ON h.ticker = n.ticker AND h.as_of = n.as_of AND h."T" = th)
SELECT ticker, as_of, listed, round(tau * 365, 4) AS days, round(sqrt({X.variance_sql('0.0')} / tau), 5) AS iv FROM bq""")
def term_structure(spark, d):
    """At-the-money volatility along the tenors and at the listed expiries."""
    return V.term_structure(X.slices(spark, d), points=20).withColumns({"days": r("days", 4), "iv": r("iv", 5)})


_LEGS_SQL = f"""{_SLICES}, lg AS (SELECT ticker, as_of, spot, tau, spot * (0.8 + 0.1 * j) AS strike, CASE WHEN j % 2 = 0 THEN 'call' ELSE 'put' END AS ot, j - 2 AS q FROM first, (SELECT unnest([0.05, 0.4, 3.0])::DOUBLE AS tau), (SELECT unnest(range(0, 5)) AS j)),
{X.brackets_sql(['0.05', '0.4', '3.0'])},
iv AS (SELECT lg.*, ln(strike / (spot * exp(0.03 * lg.tau))) AS k, l, h, x FROM lg JOIN br USING (ticker, as_of, tau)), v1 AS (SELECT *, sqrt({X.variance_sql('k')} / tau) AS iv, CASE WHEN ot = 'call' THEN 1.0 ELSE -1.0 END AS sg FROM iv),
v2 AS (SELECT *, (ln(spot / strike) + (0.03 + iv * iv / 2) * tau) / (iv * sqrt(tau)) AS d1, exp(-0.03 * tau) AS dc FROM v1), v3 AS (SELECT *, sg * d1 AS z1, sg * (d1 - iv * sqrt(tau)) AS z2, exp(-d1 * d1 / 2) / sqrt(2 * pi()) AS pdf FROM v2), v4 AS (SELECT *, {X.ncdf_sql('z1')} AS n1, {X.ncdf_sql('z2')} AS n2 FROM v3)"""


@query(f"""{_LEGS_SQL} SELECT ticker, as_of, round(sum(100 * q * sg * (spot * n1 - strike * dc * n2)), 3) AS price, round(sum(100 * q * sg * n1), 4) AS delta, round(sum(100 * q * pdf / (spot * iv * sqrt(tau))), 5) AS gamma, round(sum(100 * q * spot * pdf * sqrt(tau)), 3) AS vega,
 round(sum(100 * q * (-spot * pdf * iv / (2 * sqrt(tau)) - sg * 0.03 * strike * dc * n2) / 365.25), 4) AS theta FROM v4 GROUP BY 1, 2""")
def portfolio_greeks(spark, d):
    """Legs priced at their own moneyness and time on the day's surface, summed into a portfolio."""
    s = X.slices(spark, d)
    legs = s.select("ticker", "as_of", "spot").distinct().withColumn("T", F.explode(F.array(F.lit(0.05), F.lit(0.4), F.lit(3.0)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(4))))
    legs = legs.select("ticker", "as_of", "spot", "T", (F.col("spot") * (0.8 + 0.1 * F.col("j"))).alias("strike"), F.when(F.col("j") % 2 == 0, "call").otherwise("put").alias("option_type"), (F.col("j") - 2).alias("quantity"), F.lit(None).cast("double").alias("last_iv"))
    g = B.portfolio_greeks(B.priced_legs(legs, Y.surfaces(s), 0.03), ["ticker", "as_of"])
    return g.withColumns({"price": r("price", 3), "delta": r("delta", 4), "gamma": r("gamma", 5), "vega": r("vega", 3), "theta": r("theta", 4)})


_PNL_SQL = _FEATURES_SQL + f""", {X.IDX_SQL}, pn AS (SELECT ticker, f.date, CASE dayofyear(f.date) % 3 WHEN 0 THEN 'straddle' WHEN 1 THEN 'reversal' ELSE 'fly' END AS strategy, 1000 * r1 AS net_pnl, close, CASE WHEN vix <= 15 THEN 'low' WHEN vix <= 25 THEN 'normal' WHEN vix <= 35 THEN 'high' WHEN vix IS NOT NULL THEN 'crisis' END AS regime FROM f LEFT JOIN wide USING (date) WHERE r1 IS NOT NULL)"""


def _pnl(spark, d):
    f = R.realized_features(X.bars(spark, d)).where("ret_1d is not null").join(X.index_wide(spark, d).select("date", "vix"), "date", "left")
    n = F.dayofyear("date") % 3
    return f.select("ticker", "date", F.when(n == 0, "straddle").when(n == 1, "reversal").otherwise("fly").alias("strategy"), (1000 * F.col("ret_1d")).alias("net_pnl"), "close", E.regime_bin(F.col("vix")).alias("regime"))


@query(_PNL_SQL + " SELECT strategy, round(sum(net_pnl), 5) AS total, round(avg(net_pnl), 6) AS mean, round(avg((net_pnl > 0)::INT), 6) AS hit_rate, " + ", ".join(f"round(avg(net_pnl) FILTER (regime = '{g}'), 6) AS mean_{g}" for g in ("low", "normal", "high", "crisis")) + " FROM pn GROUP BY 1")
def pnl_by_regime(spark, d):
    """P&L of strategies, in all and by volatility regime."""
    regimes = ["low", "normal", "high", "crisis"]
    out = B.by_strategy_and_regime(_pnl(spark, d), regimes)
    return rounded(rounded(out, "mean", "hit_rate", *[f"mean_{g}" for g in regimes]), "total", digits=5)


@query(_PNL_SQL + " SELECT strategy, round(sum(net_pnl), 5) AS pnl FROM pn GROUP BY 1")
def pnl_attribution(spark, d):
    return rounded(B.pnl_attribution(_pnl(spark, d)), "pnl", digits=5)


@query(_PNL_SQL + """, c AS (SELECT ticker, date, net_pnl, close, close / lag(close) OVER w - 1 AS ret FROM pn WINDOW w AS (PARTITION BY ticker ORDER BY date))
SELECT ticker, date, round(sum(net_pnl) OVER (PARTITION BY ticker ORDER BY date), 5) AS cum_pnl, round(CASE WHEN count(ret) OVER w63 = 63 THEN CASE WHEN stddev_samp(ret) OVER w63 > 1e-12 THEN avg(ret) OVER w63 / stddev_samp(ret) OVER w63 * sqrt(252) ELSE 0 END END, 6) AS rolling_sharpe
FROM c WINDOW w63 AS (PARTITION BY ticker ORDER BY date ROWS 62 PRECEDING)""")
def equity_curve(spark, d):
    """Running P&L and the rolling Sharpe ratio."""
    f = B.rolling_sharpe(B.cumulative(_pnl(spark, d), "net_pnl", ["ticker"], "date"), "close", ["ticker"], "date")
    return f.select("ticker", "date", r("cum_pnl", 5).alias("cum_pnl"), r("rolling_sharpe").alias("rolling_sharpe"))


_SMILE_SQL = f"""{_SLICES}, sm AS (SELECT ticker, as_of, "T", spot * (0.8 + 0.05 * i) AS strike, 0.2 + 0.01 * i + CASE WHEN (i + h) % 4 = 0 THEN 0.02 ELSE 0 END AS market_iv, 0.2 + 0.01 * i AS model_iv, 1.0 + i AS wt FROM slices JOIN first USING (ticker, as_of, spot), (SELECT unnest(range(0, 9)) AS i))"""


def _smiles(spark, d):
    s = X.slices(spark, d).withColumn("h", F.dayofyear("as_of")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(8))))
    model = 0.2 + 0.01 * F.col("i")
    return s.select("ticker", "as_of", "T", (F.col("spot") * (0.8 + 0.05 * F.col("i"))).alias("strike"), (model + F.when((F.col("i") + F.col("h")) % 4 == 0, 0.02).otherwise(0.0)).alias("market_iv"), model.alias("model_iv"), (1.0 + F.col("i")).alias("wt"))


@query(f"""{_SMILE_SQL}, b AS (SELECT ticker, as_of, "T", lag(strike) OVER w AS strike_lo, strike AS strike_mid, lead(strike) OVER w AS strike_hi, (lag(market_iv) OVER w + lead(market_iv) OVER w) / 2 - market_iv AS mk, (lag(model_iv) OVER w + lead(model_iv) OVER w) / 2 - model_iv AS md FROM sm WINDOW w AS (PARTITION BY ticker, as_of, "T" ORDER BY strike))
SELECT ticker, as_of, round("T", 6) AS "T", round(strike_lo, 6) AS strike_lo, round(strike_mid, 6) AS strike_mid, round(strike_hi, 6) AS strike_hi, round(mk, 6) AS market_fly, round(md, 6) AS model_fly, round((mk - md) * 10000, 3) AS mispricing_bps FROM b WHERE abs((mk - md) * 10000) >= 50""")
def butterfly_mispricing(spark, d):
    b = B.butterfly_mispricing(_smiles(spark, d), ["ticker", "as_of", "T"])
    return rounded(b.withColumns({"T": r("T"), "mispricing_bps": r("mispricing_bps", 3)}), "strike_lo", "strike_mid", "strike_hi", "market_fly", "model_fly")


@query(f"""{_SMILE_SQL} SELECT ticker, as_of, count(*) AS n, round(sqrt(sum(wt * pow(model_iv - market_iv, 2)) / sum(wt)), 8) AS rmse FROM sm GROUP BY 1, 2""")
def weighted_rmse(spark, d):
    return rounded(B.rmse(_smiles(spark, d), "model_iv", "market_iv", ["ticker", "as_of"], "wt"), "rmse", digits=8)


@query(f"""WITH {X.IDX_SQL}, z AS (SELECT date, vix, CASE WHEN count(skew) OVER w < 2 OR stddev_samp(skew) OVER w < 1e-10 THEN 'neutral' WHEN (skew - avg(skew) OVER w) / stddev_samp(skew) OVER w > 1.5 THEN 'rich' WHEN (skew - avg(skew) OVER w) / stddev_samp(skew) OVER w < -1.5 THEN 'cheap' ELSE 'neutral' END AS sk,
 CASE WHEN abs(vix3m - vix9d) < 0.005 THEN 'FLAT' WHEN vix > vix9d AND vix > vix3m THEN 'HUMPED' WHEN vix3m < vix9d THEN 'INVERTED' ELSE 'NORMAL' END AS sh, coalesce(CASE WHEN count(vix) OVER w >= 2 AND stddev_samp(vix) OVER w > 1e-12 THEN (vix - avg(vix) OVER w) / stddev_samp(vix) OVER w END, 0) AS az
 FROM wide WHERE vix IS NOT NULL AND skew IS NOT NULL AND vix3m IS NOT NULL AND vix9d IS NOT NULL WINDOW w AS (ORDER BY date ROWS 62 PRECEDING)),
s AS (SELECT date, CASE WHEN az < -1.5 THEN abs(az) ELSE 0 END + CASE WHEN vix >= 35 THEN 2 ELSE 0 END AS s1, CASE WHEN az > 1.5 THEN abs(az) ELSE 0 END + CASE WHEN vix <= 15 THEN 1 ELSE 0 END AS s2, (sk = 'rich')::INT::DOUBLE AS s3, (sk = 'cheap')::INT::DOUBLE AS s4, (sh = 'INVERTED')::INT::DOUBLE AS s5, 0.5 * (sh = 'NORMAL')::INT AS s6 FROM z),
b AS (SELECT *, greatest(s1, s2, s3, s4, s5, s6) AS m, s1 + s2 + s3 + s4 + s5 + s6 AS t FROM s)
SELECT date, CASE WHEN m < 0.1 THEN 'neutral' WHEN s1 = m THEN 'buy_vol' WHEN s2 = m THEN 'sell_vol' WHEN s3 = m THEN 'buy_skew' WHEN s4 = m THEN 'sell_skew' WHEN s5 = m THEN 'flatten' ELSE 'steepen' END AS signal, round(CASE WHEN m < 0.1 THEN 0 ELSE m / t END, 6)::DOUBLE AS confidence FROM b""")
def composite_signal(spark, d):
    """One recommendation a day from skew, term structure, regime and level."""
    from volframe.operators.timeseries import rolling_z

    w = Window.orderBy("date").rowsBetween(-62, 0)  # one row per day
    x = X.index_wide(spark, d).dropna(subset=["vix", "skew", "vix3m", "vix9d"])
    x = x.withColumns({"_s": B.z_signal(F.col("skew"), w), "_t": B.term_shape(F.col("vix9d"), F.col("vix"), F.col("vix3m")), "_r": E.regime(F.col("vix")), "_z": rolling_z(F.col("vix"), w, 2)})
    name, sure = B.composite_signal(F.col("_s"), F.col("_t"), F.col("_r"), F.col("_z"))
    return x.select("date", name.alias("signal"), r(sure).alias("confidence"))


@query(f"""{_OTM_SQL}, {X.SLICES_SQL.strip()}, jq AS (SELECT o.*, s.expiration, CASE WHEN s.a IS NOT NULL THEN sqrt(greatest({X.wing_sql('s', 'o.k')}, 0) / s."T") END AS fit, 0.04 / (forward * exp(-pow(ln(forward / strike) / (iv * sqrt(o."T")) + iv * sqrt(o."T") / 2, 2) / 2) / sqrt(2 * pi()) * sqrt(o."T") * discount)
 * (discount * CASE WHEN option_type = 'call' THEN forward * {X.ncdf_sql('z')} - strike * {X.ncdf_sql('zc')} ELSE strike * {X.ncdf_sql('zp')} - forward * {X.ncdf_sql('y')} END) AS spread
 FROM (SELECT *, z - iv * sqrt("T") AS zc, iv * sqrt("T") - z AS zp FROM (SELECT oz.* FROM oz JOIN otm USING (ticker, as_of, "T", strike, option_type))) o LEFT JOIN (SELECT ticker, as_of, "T", a, b, rho, m, sigma, k_min, k_max, expiration, forward AS f0 FROM slices) s ON s.ticker = o.ticker AND s.as_of = o.as_of AND round(s."T", 8) = round(o."T", 8)),
md AS (SELECT *, abs(iv - fit) AS off, median(abs(iv - fit)) OVER (PARTITION BY ticker, as_of, "T") AS mid FROM jq), ma AS (SELECT *, median(abs(off - mid)) OVER (PARTITION BY ticker, as_of, "T") AS mad FROM md)
SELECT ticker, as_of, round("T", 6) AS "T", expiration, round(strike, 6) AS strike, option_type = 'call' AS is_call, round(k, 6) AS k, round(100 * exp(k), 5) AS moneyness, round(iv, 6) AS iv, round(fit, 6) AS fit, round(100 * (iv - fit), 4) AS residual, round(spread / 2, 6) AS half_spread,
 off <= greatest(4 * 1.4826 * mad, spread, 0.01) AS used, true AS ordered FROM ma""")
def smile_quotes(spark, d):
    """Quotes of the chain beside smiles by formula; the first tenor has no smile and takes the default rate."""
    s = X.slices(spark, d).withColumn("discount", F.exp(-0.04 * F.col("T")))
    q = V.smile_quotes(X.chain(spark, d), s, rate=0.04)
    ordered = (F.col("bid_iv") < F.col("iv")) & (F.col("iv") < F.col("ask_iv"))
    return q.select("ticker", "as_of", r("T").alias("T"), "expiration", r("strike").alias("strike"), "is_call", r("k").alias("k"), r("moneyness", 5).alias("moneyness"), r("iv").alias("iv"), r("fit").alias("fit"), r("residual", 4).alias("residual"), r("half_spread").alias("half_spread"), "used", ordered.alias("ordered"))


@query(f"""{_SLICES}, {_strikes_sql([f'{n}.0/365' for n in (7, 14, 30, 60, 91, 182, 365)])}, cl AS (SELECT br.ticker, br.as_of, br.tau, name, coalesce(ds.k, 0) AS k, br.l, br.h, br.x, inside, in_t, qlo, qhi FROM br LEFT JOIN ds USING (ticker, as_of, tau)
 UNION ALL SELECT ticker, as_of, tau, 'atm', 0.0, l, h, x, inside, in_t, qlo, qhi FROM br), cv AS (SELECT ticker, as_of, tau, name, CASE WHEN inside AND in_t AND k >= qlo AND k <= qhi THEN sqrt({X.variance_sql('k')} / tau) END AS v FROM cl)
SELECT ticker, as_of, CASE WHEN round(tau * 365) = 182 THEN '182d' ELSE round(tau * 365)::INT || 'd' END AS tenor, round(max(v) FILTER (name = 'p10'), 6) AS p10, round(max(v) FILTER (name = 'p25'), 6) AS p25, round(max(v) FILTER (name = 'atm'), 6) AS atm, round(max(v) FILTER (name = 'c25'), 6) AS c25, round(max(v) FILTER (name = 'c10'), 6) AS c10 FROM cv GROUP BY ticker, as_of, tau""")
def delta_tenor_table(spark, d):
    """Volatility by tenor and delta, null where nothing is quoted."""
    t = V.delta_tenor_table(X.slices(spark, d))
    names = {"10P": "p10", "25P": "p25", "ATM": "atm", "25C": "c25", "10C": "c10"}
    return t.select("ticker", "as_of", "tenor", *[r(a).alias(b) for a, b in names.items()])


@query(f"""{_SLICES}, {_strikes_sql([str(t) for t in X.SLICE_TENORS])} SELECT ds.ticker, ds.as_of, e.expiration, round(100 * exp(max(ds.k) FILTER (name = 'p25')), 4) AS put_25, round(100 * exp(max(ds.k) FILTER (name = 'c25')), 4) AS call_25
FROM ds JOIN slices e ON e.ticker = ds.ticker AND e.as_of = ds.as_of AND e."T" = ds.tau GROUP BY ds.ticker, ds.as_of, e.expiration""")
def delta_markers(spark, d):
    """Moneyness of the 25-delta put and call at each expiry."""
    m = V.delta_markers(X.slices(spark, d))
    return m.select("ticker", "as_of", "expiration", r("put_25", 4).alias("put_25"), r("call_25", 4).alias("call_25"))


@query(_FEATURES_SQL + f" SELECT ticker, date, round(rv_cc_21d, 6) AS rv_cc_21d FROM f WHERE ticker = 'ASIA' AND date BETWEEN DATE '1996-01-01' AND (SELECT max(date) FROM f WHERE ticker = 'ASIA' AND date <= DATE '{_AS_OF}')")
def ticker_history(spark, d):
    """One ticker's features up to its last date on or before a day."""
    f = R.realized_features(X.bars(spark, d))
    rows = V.history(f, "ASIA", "1996-01-01").join(V.on_or_before(f, F.lit(_AS_OF).cast("date")).select("ticker", F.col("date").alias("_last")), "ticker")
    return rows.where(F.col("date") <= F.col("_last")).select("ticker", "date", r("rv_cc_21d").alias("rv_cc_21d"))


@query(f"""WITH {X.BARS_SQL}, {X.CAL_SQL}, fc AS (SELECT ticker, date, horizon, close AS forecast FROM bars, (SELECT unnest([5, 21]) AS horizon) WHERE (dayofyear(date) + horizon) % 3 = 0), n AS (SELECT *, row_number() OVER (PARTITION BY ticker, horizon ORDER BY date DESC) AS k FROM fc WHERE date <= DATE '{_AS_OF}')
SELECT n.ticker, n.horizon, n.date, round(forecast, 6) AS forecast, e.session AS window_end FROM n LEFT JOIN cal c ON c.session = n.date LEFT JOIN cal e ON e.seq = c.seq + n.horizon WHERE k = 1""")
def forecast_windows(spark, d):
    """The newest forecast of each ticker and horizon as of a day, with the session on which its window ends."""
    b = X.bars(spark, d).select("ticker", "date", F.explode(F.array(F.lit(5), F.lit(21))).alias("horizon"), F.col("close").alias("forecast")).where((F.dayofyear("date") + F.col("horizon")) % 3 == 0)
    last = V.latest_forecasts(b, F.lit(_AS_OF).cast("date"))
    return V.window_end(last, X.sessions(spark, d), F.col("horizon")).select("ticker", "horizon", "date", r("forecast").alias("forecast"), "window_end")


@query(f"""{_SLICES}, a AS (SELECT ticker, as_of, "T" AS t, (a + b * (-rho * m + sqrt(m * m + sigma * sigma))) / "T" AS v FROM slices), c AS (SELECT ticker, as_of, t, lead(t) OVER w AS t2, v, lead(v) OVER w AS v2 FROM a WINDOW w AS (PARTITION BY ticker, as_of ORDER BY t))
SELECT ticker, as_of, round(t, 6) AS near, round(t2, 6) AS far, round(v2 * t2 - v * t, 8) AS value FROM c WHERE t2 IS NOT NULL""")
def calendar_spread_values(spark, d):
    """Total variance at the money between neighbouring expiries."""
    from volframe.functions.pricing import svi

    w = Window.partitionBy("ticker", "as_of").orderBy("T")
    iv = F.sqrt(svi(F.lit(0.0), *map(F.col, ("a", "b", "rho", "m", "sigma"))) / F.col("T"))
    s = X.slices(spark, d).select("ticker", "as_of", F.col("T").alias("near"), iv.alias("v0")).withColumnRenamed("near", "T")
    s = s.withColumns({"far": F.lead("T").over(w), "v1": F.lead("v0").over(w)}).where("far is not null")
    return s.select("ticker", "as_of", r("T").alias("near"), r("far").alias("far"), r(B.calendar_value(F.col("v0"), F.col("v1"), F.col("T"), F.col("far")), 8).alias("value"))


@query(f"""{_SLICES} SELECT ticker, as_of, round("T", 6) AS "T", round(a + sigma / 2 * (1 + rho * b * 20 * (0.1 - m) + sqrt(pow(b * 20 * (0.1 - m) + rho, 2) + 1 - rho * rho)), 8) AS w FROM slices""")
def natural_svi(spark, d):
    """Total variance at one strike by the natural parametrisation, with the slices' columns as its parameters."""
    from volframe.functions.pricing import svi_natural

    c = F.col
    return X.slices(spark, d).select("ticker", "as_of", r("T").alias("T"), r(svi_natural(F.lit(0.1), c("a"), c("m"), c("rho"), c("sigma"), c("b") * 20), 8).alias("w"))
