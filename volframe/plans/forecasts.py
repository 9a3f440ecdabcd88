"""Queries of forecasts and their evaluation. In SQL, each month's regression is solved by Cramer's rule on covariances."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from volframe.operators import evaluate as E
from volframe.operators import forecast as G
from volframe.operators import realized as R
from volframe.plans.features import _DAYS_SQL, _HIST_SQL, days
from volframe.plans.registry import _EVENTS_SQL, _HAR_SQL, _event_sessions, query, r, rounded
from volframe.sources import fixtures as X
from volframe.sources.store import kept


def _det(rows: list[list[str]]) -> str:
    n, out = len(rows), []
    for p in permutations(range(n)):
        swaps = sum(p[i] > p[j] for i in range(n) for j in range(i + 1, n))
        out.append(("-" if swaps % 2 else "+") + " " + " * ".join(rows[i][p[i]] for i in range(n)))
    return "(" + " ".join(out).lstrip("+ ") + ")"


def walk_sql(name: str, source: str, y: str, h: int, terms: list[str], least: int = 250, keep: str = "") -> str:
    """CTE `name`(ticker, date, month, horizon, forecast, lo, hi, n_train) of E.walk_forward over CTE `source`."""
    k, xs = len(terms), [f"x{i}" for i in range(len(terms))]
    cov = lambda a, b: f"c_{min(a, b)}_{max(a, b)}"
    matrix = [[cov(a, b) for b in xs] for a in xs]
    slopes = [f"{_det([[cov(xs[i], 'y') if j == col else matrix[i][j] for j in range(k)] for i in range(k)])} / {_det(matrix)}" for col in range(k)]
    sums = ", ".join([f"avg({c}) AS a_{c}" for c in (*xs, "y")] + [f"covar_pop({a}, {b}) AS c_{a}_{b}" for i, a in enumerate(xs) for b in (*xs[i:], "y")])
    fitted = "b0 + " + " + ".join(f"b{i + 1} * x{i}" for i in range(k))
    p = name
    logs = ", ".join(f"CASE WHEN {t} > 0 AND {t} < 'inf'::DOUBLE THEN ln({t}) END AS x{i}" for i, t in enumerate(terms))
    return f"""{p}_f AS (SELECT ticker, date, date_trunc('month', date)::DATE AS month, (date_trunc('month', lead(date, {h}) OVER (PARTITION BY ticker ORDER BY date)) + INTERVAL 1 MONTH)::DATE AS since, {logs}, CASE WHEN {y} > 0 THEN ln({y}) END AS y{keep} FROM {source}),
{p}_x AS (SELECT * FROM {p}_f WHERE {' AND '.join(f'{x} IS NOT NULL' for x in xs)}), {p}_k AS (SELECT * FROM {p}_x WHERE y IS NOT NULL AND since IS NOT NULL), {p}_m AS (SELECT DISTINCT month FROM {p}_x),
{p}_s AS (SELECT m.month, count(*) AS n_train, {sums} FROM {p}_m m JOIN {p}_k k ON k.since <= m.month GROUP BY 1 HAVING count(*) >= {least}),
{p}_b AS (SELECT *, {', '.join(f'{s} AS b{i + 1}' for i, s in enumerate(slopes))} FROM {p}_s), {p}_c AS (SELECT *, a_y - {' - '.join(f'b{i + 1} * a_x{i}' for i in range(k))} AS b0 FROM {p}_b),
{p}_q AS (SELECT c.month, avg(exp(y - ({fitted}))) AS smear, quantile_cont(y - ({fitted}), 0.1) AS q1, quantile_cont(y - ({fitted}), 0.9) AS q9 FROM {p}_c c JOIN {p}_k k ON k.since <= c.month GROUP BY 1),
{p} AS (SELECT ticker, date, month, {h} AS horizon, exp({fitted}) * smear AS forecast, exp({fitted} + q1) AS lo, exp({fitted} + q9) AS hi, n_train{keep} FROM {p}_x JOIN {p}_c USING (month) JOIN {p}_q USING (month))"""


_TERMS = ["rv_d", "rv_w", "rv_m"]
_BOTH = f"{_HAR_SQL}, {walk_sql('w5', 'har', 'y_5', 5, _TERMS)}, {walk_sql('w21', 'har', 'y_21', 21, _TERMS)}, w AS (SELECT *, NULL AS z FROM w5 UNION ALL SELECT *, NULL FROM w21)"


def _har(spark, d):
    h = kept(R.har_dataset(X.bars(spark, d)))
    both = [E.walk_forward(h, f"y_{n}", n, _TERMS).drop("range") for n in (5, 21)]
    return h, both[0].unionByName(both[1])


@query(f"{_BOTH} SELECT ticker, date, month, horizon, round(forecast, 6) AS forecast, round(lo, 6) AS lo, round(hi, 6) AS hi, n_train FROM w")
def har_forecast(spark, d):
    return rounded(_har(spark, d)[1], "forecast", "lo", "hi")


@query(f"""{_BOTH}, a AS (SELECT w.*, CASE WHEN w.horizon = 5 THEN y_5 ELSE y_21 END AS y FROM w JOIN har USING (ticker, date))
SELECT ticker, horizon, count(*) AS n, round(avg(y / forecast - ln(y / forecast) - 1), 6) AS qlike, round(100 * sqrt(avg(pow(sqrt(forecast) - sqrt(y), 2))), 5) AS rmse, round(100 * avg(sqrt(forecast) - sqrt(y)), 5) AS bias, round(avg((y BETWEEN lo AND hi)::INT), 6) AS covered FROM a WHERE y > 0 GROUP BY 1, 2""")
def track_record(spark, d):
    """How the closed forecasts of each ticker and horizon turned out."""
    h, f = _har(spark, d)
    actual = h.select("ticker", "date", F.explode(F.array(*[F.struct(F.lit(n).alias("horizon"), F.col(f"y_{n}").alias("y")) for n in (5, 21)])).alias("a")).select("ticker", "date", "a.horizon", "a.y")
    f = f.join(actual, ["ticker", "date", "horizon"]).select("ticker", "horizon", F.sqrt("forecast").alias("forecast_vol"), F.sqrt("lo").alias("lo80_vol"), F.sqrt("hi").alias("hi80_vol"), F.sqrt("y").alias("realised_vol"))
    return rounded(rounded(G.outcomes(f), "qlike", "covered"), "rmse", "bias", digits=5)


#: The implied columns of each day, by formula from the trailing variances: what a feature table would join.
_IMPLIED_SQL = """im AS (SELECT ticker, date, CASE WHEN dayofyear(date) % 9 <> 0 THEN 0.05 + 0.6 * sqrt(rv_m) + 0.2 * sqrt(rv_w) * rv_m / (rv_m + rv_w) END AS atm_7d, 0.06 + 0.7 * sqrt(rv_m) AS atm_14d,
 CASE WHEN dayofyear(date) % 11 <> 0 THEN 0.04 + 0.5 * sqrt(rv_m) + 0.3 * sqrt(rv_w) * rv_w / (rv_m + rv_w) END AS vs_30d, 0.05 + 0.75 * sqrt(rv_m) AS atm_30d, CASE WHEN dayofyear(date) % 4 = 0 THEN 0.02 + 0.01 * (dayofyear(date) % 3) END AS earn_implied_move FROM {0} WHERE rv_m > 0 AND rv_w > 0)"""


def _implied(rows):
    d, rm, rw = F.dayofyear("date"), F.col("rv_m"), F.col("rv_w")
    ok = (rm > 0) & (rw > 0)
    return rows.withColumns({
        "atm_7d": F.when(ok & (d % 9 != 0), 0.05 + 0.6 * F.sqrt(rm) + 0.2 * F.sqrt(rw) * rm / (rm + rw)), "atm_14d": F.when(ok, 0.06 + 0.7 * F.sqrt(rm)),
        "vs_30d": F.when(ok & (d % 11 != 0), 0.04 + 0.5 * F.sqrt(rm) + 0.3 * F.sqrt(rw) * rw / (rm + rw)), "atm_30d": F.when(ok, 0.05 + 0.75 * F.sqrt(rm)), "earn_implied_move": F.when(ok & (d % 4 == 0), 0.02 + 0.01 * (d % 3)),
    })


_DATA_SQL = f"""{_EVENTS_SQL}, {_HAR_SQL.replace('WITH ', '', 1).replace(X.BARS_SQL + ', ', '', 1).strip()}, {_DAYS_SQL}, {_HIST_SQL},
e1 AS (SELECT DISTINCT ticker, event FROM ev WHERE event IS NOT NULL), d1 AS (SELECT har.*, e1.event IS NOT NULL AS ev_day, CASE WHEN e1.event IS NULL THEN rv_d END AS ex FROM har LEFT JOIN e1 ON e1.ticker = har.ticker AND e1.event = har.date),
d2 AS (SELECT *, coalesce(ex, lag(ex) OVER o) AS rv_d_ex, CASE WHEN count(ex) OVER w5 >= 4 THEN avg(ex) OVER w5 END AS rv_w_ex, CASE WHEN count(ex) OVER w22 >= 18 THEN avg(ex) OVER w22 END AS rv_m_ex,
 CASE WHEN y_5 IS NOT NULL THEN 252 * sum(CASE WHEN ev_day THEN 0 ELSE ret * ret END) OVER f5 / nullif(sum((NOT ev_day)::INT) OVER f5, 0) END AS y_5_ex, CASE WHEN y_21 IS NOT NULL THEN 252 * sum(CASE WHEN ev_day THEN 0 ELSE ret * ret END) OVER f21 / nullif(sum((NOT ev_day)::INT) OVER f21, 0) END AS y_21_ex
 FROM d1 WINDOW o AS (PARTITION BY ticker ORDER BY date), w5 AS (PARTITION BY ticker ORDER BY date ROWS 4 PRECEDING), w22 AS (PARTITION BY ticker ORDER BY date ROWS 21 PRECEDING), f5 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), f21 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 21 FOLLOWING)),
d3 AS (SELECT d2.*, e1.event AS ev_next FROM d2 ASOF LEFT JOIN e1 ON e1.ticker = d2.ticker AND d2.date < e1.event),
ds AS (SELECT d3.*, coalesce(q.pos - p.pos <= 5, false) AS ev_in_5, coalesce(q.pos - p.pos <= 21, false) AS ev_in_21, hist_var AS ev_hist_var FROM d3 LEFT JOIN dn p ON p.day = d3.date LEFT JOIN dn q ON q.day = ev_next LEFT JOIN hv ON hv.ticker = d3.ticker AND hv.date = d3.date)"""


@query(f"""{_DATA_SQL} SELECT ticker, date, ev_day, ev_next, ev_in_5, ev_in_21, {', '.join(f'round({c}, 6) AS {c}' for c in ('rv_d_ex', 'rv_w_ex', 'rv_m_ex', 'y_5_ex', 'y_21_ex'))}, round(ev_hist_var, 10) AS ev_hist_var FROM ds""")
def event_dataset(spark, d):
    """The modelling table with release days taken out."""
    f = G.event_dataset(X.bars(spark, d), _event_sessions(spark, d), days(spark, d))
    return rounded(f.select("ticker", "date", "ev_day", "ev_next", "ev_in_5", "ev_in_21", "rv_d_ex", "rv_w_ex", "rv_m_ex", "y_5_ex", "y_21_ex", r("ev_hist_var", 10).alias("ev_hist_var")), "rv_d_ex", "rv_w_ex", "rv_m_ex", "y_5_ex", "y_21_ex")


def _event_sql(h: int, implied: str = ", iv_ex2") -> str:
    a, b = G.IMPLIED_INPUT[h]
    n, m = G.TENOR_DAYS[a], G.TENOR_DAYS[b]
    return f"""p{h} AS (SELECT ds.*, coalesce({a}, {b}) AS iv_in, CASE WHEN {a} IS NOT NULL THEN '{a}' WHEN {b} IS NOT NULL THEN '{b}' END AS iv_src, CASE WHEN {a} IS NOT NULL THEN {n} ELSE {m} END AS tenor, coalesce(earn_implied_move * earn_implied_move, ev_hist_var, 0) AS e2 FROM ds LEFT JOIN im ON im.ticker = ds.ticker AND im.date = ds.date),
v{h} AS (SELECT *, greatest(iv_in * iv_in - CASE WHEN coalesce(ev_next - date <= tenor, false) THEN e2 * 365 / tenor ELSE 0 END, 0.25 * iv_in * iv_in) AS iv_ex2, CASE WHEN ev_in_{h} THEN 252.0 / {h} * e2 ELSE 0 END AS ev_add, CASE WHEN ev_in_{h} THEN sqrt(e2) END AS ev_move, y_{h} AS y_true FROM p{h}),
{walk_sql(f'w{h}', f'v{h}', f'y_{h}_ex', h, ['rv_d_ex', 'rv_w_ex', 'rv_m_ex', *implied.split(', ')[1:]], keep=', rv_m, iv_in, iv_src, ev_add, ev_move, y_true')}"""


@query(f"""{_DATA_SQL}, {_IMPLIED_SQL.format('har')}, {_event_sql(5)}, {_event_sql(21)}, w AS (SELECT * FROM w5 UNION ALL SELECT * FROM w21)
SELECT ticker, date, horizon, round(sqrt(forecast + ev_add), 5) AS forecast_vol, round(sqrt(lo + ev_add), 5) AS lo80_vol, round(sqrt(hi + ev_add), 5) AS hi80_vol, round(iv_in, 6) AS implied_vol, iv_src AS implied_input, round(sqrt(rv_m), 6) AS trailing_vol,
 round(sqrt(y_true), 6) AS realised_vol, month AS refit_date, n_train, ev_add > 0 AS event_in_window, round(ev_move, 6) AS ev_move FROM w""")
def event_forecasts(spark, d):
    """HAR and implied volatility without releases, whose variance is added back where one falls in the window."""
    rows = kept(_implied(G.event_dataset(X.bars(spark, d), _event_sessions(spark, d), days(spark, d))))
    f = G.build_forecasts(rows)
    return rounded(rounded(f, "implied_vol", "trailing_vol", "realised_vol", "ev_move"), "forecast_vol", "lo80_vol", "hi80_vol", digits=5)


_CMP_SQL = f"""{_HAR_SQL}, {_IMPLIED_SQL.format('har')}, hi AS (SELECT har.*, vs_30d * vs_30d AS iv2 FROM har LEFT JOIN im ON im.ticker = har.ticker AND im.date = har.date),
{walk_sql('m0', 'hi', 'y_21', 21, _TERMS)}, {walk_sql('m1', 'hi', 'y_21', 21, ['iv2'])}, {walk_sql('m3', 'hi', 'y_21', 21, [*_TERMS, 'iv2'])}"""


@query(f"""{_CMP_SQL}, j AS (SELECT hi.ticker, hi.date, y_21 AS y, m0.forecast AS f0, m1.forecast AS f1, iv2 AS f2, m3.forecast AS f3 FROM hi JOIN m0 USING (ticker, date) JOIN m1 USING (ticker, date) JOIN m3 USING (ticker, date) WHERE y_21 > 0 AND iv2 > 0),
s AS (SELECT date, y, f0 AS base, unnest(['HAR', 'Implied (recalibrated)', 'Implied (raw)', 'HAR + implied']) AS model, unnest([f0, f1, f2, f3]) AS f FROM j),
sc AS (SELECT model, count(*) AS n, avg(y / f - ln(y / f) - 1) AS qlike, 100 * sqrt(avg(pow(sqrt(f) - sqrt(y), 2))) AS rmse_vol, 100 * avg(abs(sqrt(f) - sqrt(y))) AS mae_vol, 100 * avg(sqrt(f) - sqrt(y)) AS bias_vol, 1 - sum(pow(ln(y) - ln(f), 2)) / (var_pop(ln(y)) * count(*)) AS r2_log FROM s GROUP BY 1),
dd AS (SELECT model, date, avg(y / base - ln(y / base) - 1) - avg(y / f - ln(y / f) - 1) AS diff FROM s WHERE model <> 'HAR' GROUP BY 1, 2), dc AS (SELECT *, diff - avg(diff) OVER (PARTITION BY model) AS x FROM dd),
dl AS (SELECT *, x * x{''.join(f' + 2 * (1 - {k} / 22.0) * coalesce(x * lag(x, {k}) OVER w, 0)' for k in range(1, 22))} AS v FROM dc WINDOW w AS (PARTITION BY model ORDER BY date)),
dm AS (SELECT model, avg(diff) / sqrt(sum(v) / count(*) / count(*)) AS z, -abs(avg(diff) / sqrt(sum(v) / count(*) / count(*))) AS nz FROM dl GROUP BY 1)
SELECT sc.model, n, round(qlike, 5) AS qlike, round(rmse_vol, 4) AS rmse_vol, round(mae_vol, 4) AS mae_vol, round(bias_vol, 4) AS bias_vol, round(r2_log, 5) AS r2_log, round(z, 3) AS dm_stat, round(2 * {X.ncdf_sql('nz')}, 4) AS dm_p FROM sc LEFT JOIN dm ON dm.model = sc.model""")
def model_comparison(spark, d):
    """Models on their common days, scored and tested against HAR."""
    h = kept(_implied(R.har_dataset(X.bars(spark, d))))
    raw = h.select("ticker", "date", G.implied_variance(21).alias("forecast"))
    fits = {"HAR": G.har(), "Implied (recalibrated)": G.implied_regression(21), "HAR + implied": G.har_iv(21)}
    f = {n: E.walk_forward(h, "y_21", 21, t) for n, t in fits.items()} | {"Implied (raw)": raw}
    out = G.compare(f, h.select("ticker", "date", F.col("y_21").alias("y")), 21, "HAR")
    out = rounded(rounded(out, "qlike", "r2_log", digits=5), "rmse_vol", "mae_vol", "bias_vol", digits=4)
    return out.withColumns({"dm_stat": r("dm_stat", 3), "dm_p": r("dm_p", 4)})


@query(f"""{_BOTH}, {X.IDX_SQL.strip()}, a AS (SELECT w5.*, y_5 AS y FROM w5 JOIN har USING (ticker, date) WHERE y_5 > 0)
SELECT CASE WHEN vix <= 15 THEN 'low' WHEN vix <= 25 THEN 'normal' WHEN vix <= 35 THEN 'high' ELSE 'crisis' END AS regime, count(*) AS n, round(avg(y / forecast - ln(y / forecast) - 1), 6) AS qlike FROM a JOIN wide ON wide.date = a.date WHERE vix IS NOT NULL GROUP BY 1""")
def losses_by_regime(spark, d):
    h = kept(R.har_dataset(X.bars(spark, d)))
    f = E.walk_forward(h, "y_5", 5, _TERMS)
    regimes = X.index_wide(spark, d).select("date", E.regime_bin(F.col("vix")).alias("regime"))
    return rounded(G.by_regime(f, h.select("ticker", "date", F.col("y_5").alias("y")), regimes), "qlike")


_WINDOWS_SQL = f"""{_DATA_SQL}, {_IMPLIED_SQL.format('har')}, {_event_sql(5, '')}, {_event_sql(21, '')}, {walk_sql('b5', 'ds', 'y_5', 5, _TERMS)}, {walk_sql('b21', 'ds', 'y_21', 21, _TERMS)},
wj AS (SELECT w.date, w.horizon, w.ticker, b.forecast AS fb, w.forecast + w.ev_add AS fm, w.iv_in * w.iv_in AS fi, w.y_true AS y, w.ev_add > 0 AS ev, w.ev_move FROM (SELECT * FROM w5 UNION ALL SELECT * FROM w21) w JOIN (SELECT * FROM b5 UNION ALL SELECT * FROM b21) b ON b.ticker = w.ticker AND b.date = w.date AND b.horizon = w.horizon)"""


@query(f"""{_WINDOWS_SQL}, x AS (SELECT date, horizon, unnest(['all', CASE WHEN ev THEN 'release' ELSE 'no release' END]) AS windows, y / fb - ln(y / fb) - 1 AS lb, y / fm - ln(y / fm) - 1 AS lm, CASE WHEN fi > 0 THEN y / fi - ln(y / fi) - 1 END AS li FROM wj WHERE y > 0 AND fb > 0 AND fm > 0),
sc AS (SELECT horizon, windows, count(*) AS n, avg(lb) AS base, avg(lm) AS model, avg(li) AS implied FROM x GROUP BY 1, 2), d AS (SELECT horizon, windows, date, avg(lb) - avg(lm) AS diff FROM x GROUP BY 1, 2, 3),
dc AS (SELECT *, diff - avg(diff) OVER (PARTITION BY horizon, windows) AS c FROM d), l AS (SELECT horizon, windows, avg(diff) AS m, list(c ORDER BY date) AS s FROM dc GROUP BY 1, 2),
z AS (SELECT horizon, windows, m * len(s) / sqrt(list_inner_product(s, s) + list_sum(list_transform(range(1, horizon + 1), lambda k: 2 * (1 - k / (horizon + 1.0)) * list_inner_product(s[1:len(s) - k], s[k + 1:])))) AS z, len(s) AS k FROM l)
SELECT sc.horizon, sc.windows, n, round(base, 5) AS base, round(model, 5) AS model, round(implied, 5) AS implied, round(CASE WHEN k >= 10 THEN z END, 3) AS dm_stat FROM sc JOIN z ON z.horizon = sc.horizon AND z.windows = sc.windows""")
def release_comparison(spark, d):
    """HAR with releases taken out and added back against plain HAR, over windows with and without a release."""
    rows = kept(_implied(G.event_dataset(X.bars(spark, d), _event_sessions(spark, d), days(spark, d))))
    out = G.compare_windows(G.build_forecasts(rows, use_implied=False, events=False), G.build_forecasts(rows, use_implied=False))
    return rounded(out.drop("dm_p"), "base", "model", "implied", digits=5).withColumn("dm_stat", r("dm_stat", 3))


@query(f"{_WINDOWS_SQL} SELECT ticker, count(DISTINCT round(ev_move, 10)) AS releases FROM wj WHERE ev AND y IS NOT NULL GROUP BY 1")
def releases_in_windows(spark, d):
    """How many releases the windows of each ticker held."""
    rows = kept(_implied(G.event_dataset(X.bars(spark, d), _event_sessions(spark, d), days(spark, d))))
    return G.releases_seen(G.build_forecasts(rows, use_implied=False).withColumn("ev_move", F.round("ev_move", 10)))
