"""Queries of features, earnings and forecasts, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from volframe.operators import features as A
from volframe.operators import timeseries as T
from volframe.plans.registry import _EVENTS_SQL, _FEATURES_SQL, _event_sessions, query, r, rounded
from volframe.plans.surfaces import features_sql
from volframe.sources import fixtures as X
from volframe.sources.store import kept

_DAYS_SQL = """dn AS (SELECT day, sum(hit) OVER (ORDER BY day) AS pos FROM (SELECT d::DATE AS day, (isodow(d) <= 5 AND d >= a)::INT AS hit FROM (SELECT unnest(generate_series(a - 1, b + 800, INTERVAL 1 DAY)) AS d, a FROM span)))"""
_TERM_SQL = """tm AS (SELECT ticker, as_of, "T", expiration, a + b * (-rho * m + sqrt(m * m + sigma * sigma)) AS w FROM slices)"""
_NEXT_SQL = """e1 AS (SELECT DISTINCT ticker, event FROM ev WHERE event IS NOT NULL),
nx AS (SELECT f.ticker, f.as_of, min(event) FILTER (event > as_of) AS nxt, max(event) FILTER (event <= as_of) AS lst FROM first f LEFT JOIN e1 USING (ticker) GROUP BY 1, 2)"""


def days(spark, d):
    return T.day_numbers(X.sessions(spark, d))


@query(f"""{_EVENTS_SQL}, {X.SLICES_SQL.strip()}, {_DAYS_SQL}, {_TERM_SQL}, {_NEXT_SQL},
n AS (SELECT t.ticker, t.as_of, nxt, "T", expiration, w, q.pos - p.pos AS n FROM tm t JOIN nx USING (ticker, as_of) JOIN dn p ON p.day = t.as_of JOIN dn q ON q.day = t.expiration),
g AS (SELECT ticker, as_of, max(row("T", n, w)) FILTER (expiration < nxt AND n >= 1) AS pre, list(row("T", n, w) ORDER BY "T") FILTER (expiration >= nxt) AS post FROM n GROUP BY 1, 2),
e AS (SELECT ticker, as_of, post[1][1] AS t1, CASE WHEN pre IS NOT NULL THEN post[1][3] - pre[3] / pre[2] * post[1][2] WHEN post[2][2] > post[1][2] THEN post[1][3] - (post[2][3] - post[1][3]) / (post[2][2] - post[1][2]) * post[1][2] END AS e2 FROM g)
SELECT nx.ticker, nx.as_of, nxt AS event, round(CASE WHEN t1 <= 0.30 AND e2 > 0 THEN e2 END, 8) AS e2 FROM nx LEFT JOIN e USING (ticker, as_of)""")
def implied_event_variance(spark, d):
    """Variance of the next release's jump, read from the term structure of each snapshot."""
    term, number = A.atm_term(X.slices(spark, d)).withColumnRenamed("as_of", "date"), days(spark, d)
    rows = A.calendar_columns(term, _event_sessions(spark, d), number).select("ticker", F.col("date").alias("as_of"), F.col("earn_next_date").alias("event"), "term")
    return A.implied_event_variance(rows, number).select("ticker", "as_of", "event", r("e2", 8).alias("e2"))


_HIST_SQL = """hr AS (SELECT b.ticker, b.date, pow(ln(close / lag(close) OVER w), 2) AS r2, event IS NOT NULL AS is_ev FROM bars b LEFT JOIN (SELECT DISTINCT ticker, event FROM ev) e ON e.ticker = b.ticker AND event = date WINDOW w AS (PARTITION BY b.ticker ORDER BY date)),
hn AS (SELECT *, CASE WHEN count(r2) FILTER (NOT is_ev) OVER w >= 40 THEN avg(r2) FILTER (NOT is_ev) OVER w END AS normal FROM hr WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS 62 PRECEDING)),
hx AS (SELECT *, r2 - lag(normal) OVER (PARTITION BY ticker ORDER BY date) AS excess, is_ev AND r2 IS NOT NULL AS real FROM hn),
hm AS (SELECT *, CASE WHEN real AND count(excess) OVER w >= 4 THEN avg(excess) OVER w END AS mean FROM hx WINDOW w AS (PARTITION BY ticker, real ORDER BY date ROWS 7 PRECEDING)),
hv AS (SELECT ticker, date, greatest(last_value(mean IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date), CASE WHEN last_value(mean IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date) IS NOT NULL THEN 0 END) AS hist_var FROM hm)"""


@query(f"{_EVENTS_SQL}, {_HIST_SQL} SELECT ticker, date, round(hist_var, 10) AS hist_var FROM hv")
def historical_event_variance(spark, d):
    """Excess variance of past release days, as known on each day."""
    f = A.historical_event_variance(X.bars(spark, d).select("ticker", "date", "close"), _event_sessions(spark, d))
    return f.select("ticker", "date", r("hist_var", 10).alias("hist_var"))


_SCHEDULE_SQL = """sd AS (SELECT ticker, date_trunc('quarter', announced)::DATE AS q, announced FROM ann),
sc AS (SELECT s.ticker, q.q AS snapshot, s.announced + ((dayofyear(s.announced) + month(q.q)) % 5 - 2)::INT AS event FROM (SELECT DISTINCT ticker, q FROM sd) q JOIN sd s ON s.ticker = q.ticker AND s.announced >= q.q AND s.announced < q.q + 190),
ss AS (SELECT DISTINCT b.ticker, b.date, max(snapshot) AS snapshot FROM bars b JOIN sc ON sc.ticker = b.ticker AND snapshot <= date GROUP BY 1, 2)"""


@query(f"{_EVENTS_SQL}, {_SCHEDULE_SQL} SELECT b.ticker, b.date, min(event) FILTER (event > b.date) AS scheduled FROM bars b LEFT JOIN ss ON ss.ticker = b.ticker AND ss.date = b.date LEFT JOIN sc ON sc.ticker = b.ticker AND sc.snapshot = ss.snapshot GROUP BY 1, 2")
def scheduled_next(spark, d):
    """The next release as the quarter's schedule had it, which is up to two days off."""
    return A.scheduled_next(X.bars(spark, d).select("ticker", "date"), X.schedule(spark, d))


_SPOTS_SQL = "sp AS (SELECT ticker, date + 1 AS date, close * 1.01 AS spot FROM bars WHERE dayofyear(date) % 7 = 0), pr AS (SELECT ticker, date, CASE WHEN dayofyear(date) % 5 = 0 THEN NULL ELSE close END AS close FROM bars)"


@query(f"WITH {X.BARS_SQL}, {_SPOTS_SQL} SELECT coalesce(pr.ticker, sp.ticker) AS ticker, coalesce(pr.date, sp.date) AS date, round(coalesce(close, spot), 6) AS close FROM pr FULL JOIN sp ON pr.ticker = sp.ticker AND pr.date = sp.date")
def fill_closes(spark, d):
    """Closes that are missing come from the snapshots' spots."""
    b = X.bars(spark, d)
    spots = b.where(F.dayofyear("date") % 7 == 0).select("ticker", F.date_add("date", 1).alias("date"), (F.col("close") * 1.01).alias("spot"))
    prices = b.select("ticker", "date", F.when(F.dayofyear("date") % 5 != 0, F.col("close")).alias("close"))
    return A.fill_closes(prices, spots).select("ticker", "date", r("close").alias("close"))


_DYN = ("rv_cc_10d", "close")


@query(_FEATURES_SQL.replace("WITH ", f"WITH {X.CAL_SQL.strip()}, ", 1) + """, g AS (SELECT f.*, seq FROM f JOIN cal ON session = date)
SELECT g.ticker, g.date, """ + ", ".join(f"""round(g.{c} - (SELECT any_value(x.{c}) FROM g x WHERE x.ticker = g.ticker AND x.seq = g.seq - 1), 6) AS {c}_d1, round(g.{c} - (SELECT any_value(x.{c}) FROM g x WHERE x.ticker = g.ticker AND x.seq = g.seq - 5), 6) AS {c}_d5,
round(CASE WHEN count({c}) OVER w63 >= 20 AND stddev_samp({c}) OVER w63 > 1e-12 THEN ({c} - avg({c}) OVER w63) / stddev_samp({c}) OVER w63 END, 5) AS {c}_z63,
round(CASE WHEN g.{c} IS NOT NULL AND count({c}) OVER w252 >= 20 THEN (len(list_filter(list({c}) OVER w252, lambda x: x < g.{c})) + (len(list_filter(list({c}) OVER w252, lambda x: x = g.{c})) + 1) / 2) / count({c}) OVER w252 END, 6) AS {c}_pct252""" for c in _DYN) + """
FROM g WINDOW w63 AS (PARTITION BY ticker ORDER BY seq RANGE BETWEEN 62 PRECEDING AND CURRENT ROW), w252 AS (PARTITION BY ticker ORDER BY seq RANGE BETWEEN 251 PRECEDING AND CURRENT ROW)""")
def feature_dynamics(spark, d):
    """Changes, z-scores and percentile ranks over sessions of the calendar, gaps included."""
    from volframe.operators import realized as R

    f = A.add_dynamics(R.realized_features(X.bars(spark, d)).select("ticker", "date", *_DYN), X.sessions(spark, d), _DYN)
    return f.select("ticker", "date", *[r(f"{c}_{x}", 5 if x == "z63" else 6).alias(f"{c}_{x}") for c in _DYN for x in ("d1", "d5", "z63", "pct252")])


_REST_SQL = _FEATURES_SQL.split(X.BARS_SQL + ",", 1)[1].strip()
_TABLE_SQL = f"""{_EVENTS_SQL.replace('WITH ', 'WITH RECURSIVE ', 1)}, {X.SLICES_SQL.strip()}, {features_sql()}, {_REST_SQL}, {X.IDX_SQL.strip()}, {X.MACRO_SQL.strip()}, {_DAYS_SQL}, {_TERM_SQL}, {_NEXT_SQL}, {_HIST_SQL},
iv_n AS (SELECT t.ticker, t.as_of, nxt, "T", expiration, w, q.pos - p.pos AS n FROM tm t JOIN nx USING (ticker, as_of) JOIN dn p ON p.day = t.as_of JOIN dn q ON q.day = t.expiration),
iv_g AS (SELECT ticker, as_of, max(row("T", n, w)) FILTER (expiration < nxt AND n >= 1) AS pre, list(row("T", n, w) ORDER BY "T") FILTER (expiration >= nxt) AS post FROM iv_n GROUP BY 1, 2),
iv_e AS (SELECT ticker, as_of, post[1][1] AS t1, CASE WHEN pre IS NOT NULL THEN post[1][3] - pre[3] / pre[2] * post[1][2] WHEN post[2][2] > post[1][2] THEN post[1][3] - (post[2][3] - post[1][3]) / (post[2][2] - post[1][2]) * post[1][2] END AS e2 FROM iv_g),
mc AS (SELECT sf.*, macro.value AS macro FROM sf ASOF LEFT JOIN macro ON sf.as_of >= macro.published),
ft AS (SELECT mc.ticker, mc.as_of AS date, atm_30d, vs_30d, rr25_30d, rv_cc_21d, rv_yz_21d, atm_30d - rv_cc_21d AS vrp_30d, vs_30d * vs_30d - rv_cc_21d * rv_cc_21d AS vrp_var_30d, vix AS mkt_vix, skew AS mkt_skew, macro, nxt AS earn_next_date, pn.pos - p0.pos AS earn_days_to, p0.pos - pl.pos AS earn_days_since,
 sqrt(CASE WHEN t1 <= 0.30 AND e2 > 0 THEN e2 END) AS earn_implied_move, sqrt(hist_var) AS earn_hist_move
 FROM mc LEFT JOIN f ON f.ticker = mc.ticker AND f.date = mc.as_of LEFT JOIN wide ON wide.date = mc.as_of LEFT JOIN nx ON nx.ticker = mc.ticker AND nx.as_of = mc.as_of LEFT JOIN iv_e ON iv_e.ticker = mc.ticker AND iv_e.as_of = mc.as_of LEFT JOIN hv ON hv.ticker = mc.ticker AND hv.date = mc.as_of
 LEFT JOIN dn p0 ON p0.day = mc.as_of LEFT JOIN dn pn ON pn.day = nxt LEFT JOIN dn pl ON pl.day = lst)"""
_MACRO_NAMES = [f"macro_{c.lower()}" for c in X.MACRO_SERIES]
_MORE_NAMES = [f"mkt_{c}" for c in X.MORE_INDICES]


def _context_sql(name: str, source: str, date: str) -> str:
    """CTEs up to `name`: rows of source with the further indices and each macro series as last published."""
    steps, last = [], source
    for c in X.MACRO_SERIES:
        steps.append(f"{name}_{c.lower()} AS (SELECT x.*, m.value AS macro_{c.lower()} FROM {last} x ASOF LEFT JOIN mw_{c.lower()} m ON x.{date} >= m.published)")
        last = f"{name}_{c.lower()}"
    return f"{X.macro_wide_sql(A.MACRO_LAGS)}, {X.MORE_SQL}, {', '.join(steps)}, {name} AS (SELECT x.*, {', '.join(f'more.{c} AS mkt_{c}' for c in X.MORE_INDICES)} FROM {last} x LEFT JOIN more ON more.date = x.{date})"


@query(f"WITH {X.BARS_SQL}, dd AS (SELECT DISTINCT date FROM bars), {_context_sql('ct', 'dd', 'date')} SELECT date, {', '.join(f'round({c}, 9) AS {c}' for c in (*_MORE_NAMES, *_MACRO_NAMES))} FROM ct")
def market_context(spark, d):
    """Further indices and seven macro series on each date, the latter as they were public by then."""
    days = A.available_asof(X.bars(spark, d).select("date").distinct(), X.macro_wide(spark, d))
    f = days.join(X.market_more(spark, d).select("date", *[F.col(c).alias(A.MARKET_COLUMNS[c]) for c in X.MORE_INDICES]), "date", "left")
    return f.select("date", *[r(c, 9).alias(c) for c in (*_MORE_NAMES, *_MACRO_NAMES)])


_TABLE = ["atm_30d", "vs_30d", "rr25_30d", "rv_cc_21d", "rv_yz_21d", "vrp_30d", "vrp_var_30d", "earn_implied_move", "earn_hist_move"]
_GIVEN = ["mkt_vix", "mkt_skew", "macro"]  # means of decimals: nine digits, as six would meet ties


def _feature_table(spark, d):
    slices, number, events = X.slices(spark, d), days(spark, d), _event_sessions(spark, d)
    surface = kept(A.surface_features(slices, spot="spot").withColumnRenamed("as_of", "date"))  # dynamics join it with itself
    term = A.atm_term(slices).withColumnRenamed("as_of", "date")
    earnings = A.earnings_features(term, events, number, closes=X.bars(spark, d).select("ticker", "date", "close"))
    market = X.index_wide(spark, d).join(X.market_more(spark, d), "date", "full_outer")
    macro = X.macro(spark, d).select("published", F.col("value").alias("macro")).join(A.published(X.macro_wide(spark, d)), "published", "full_outer")
    return A.feature_table(surface, X.bars(spark, d), market, macro, earnings, X.sessions(spark, d), ["atm_30d"])


@query(f"{_TABLE_SQL}, {_context_sql('fu', 'ft', 'date')} SELECT ticker, date, {', '.join(f'round({c}, 6) AS {c}' for c in _TABLE)}, {', '.join(f'round({c}, 9) AS {c}' for c in (*_GIVEN, *_MORE_NAMES, *_MACRO_NAMES))}, earn_next_date, earn_days_to, earn_days_since, '{A.FEATURE_VERSION}' AS feature_version FROM fu")
def feature_table(spark, d):
    """Surface, realised, market, macro and earnings columns of each snapshot in one table."""
    return _feature_table(spark, d).select("ticker", "date", *[r(c).alias(c) for c in _TABLE], *[r(c, 9).alias(c) for c in (*_GIVEN, *_MORE_NAMES, *_MACRO_NAMES)], "earn_next_date", "earn_days_to", "earn_days_since", "feature_version")


_LABELS_SQL = """lb AS (SELECT ticker, date, CASE WHEN count(r1) OVER w = 21 THEN sqrt(252.0 / 21 * sum(r1 * r1) OVER w) END AS label_rv_21 FROM ret WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 21 FOLLOWING))"""


@query(_FEATURES_SQL + f", {_LABELS_SQL} SELECT f.ticker, f.date, round(rv_cc_21d, 6) AS rv_cc_21d, round(rv_yz_21d, 6) AS rv_yz_21d, round(label_rv_21, 6) AS label_rv_21 FROM f JOIN lb USING (ticker, date) WHERE rv_cc_21d IS NOT NULL AND rv_yz_21d IS NOT NULL AND label_rv_21 IS NOT NULL")
def training_frame(spark, d):
    """Features with the label of the days that follow, on rows that have all of them."""
    from volframe.operators import realized as R

    b = X.bars(spark, d)
    out = A.training_frame(R.realized_features(b), R.labels(b), ["rv_cc_21d", "rv_yz_21d"], "label_rv_21")
    return rounded(out, "rv_cc_21d", "rv_yz_21d", "label_rv_21")


@query(f"WITH {X.BARS_SQL}, {X.CAL_SQL}, s AS (SELECT bars.*, seq FROM bars JOIN cal ON session = date) SELECT a.ticker, a.date, round(b.close - a.close, 6) AS label_atm_5, round(c.close - a.close, 6) AS label_atm_21 FROM s a LEFT JOIN s b ON b.ticker = a.ticker AND b.seq = a.seq + 5 LEFT JOIN s c ON c.ticker = a.ticker AND c.seq = a.seq + 21")
def forward_changes(spark, d):
    """Change of a column over the sessions ahead."""
    out = A.label_atm(X.bars(spark, d).select("ticker", "date", "close"), X.sessions(spark, d), "close")
    return out.select("ticker", "date", r("label_atm_5").alias("label_atm_5"), r("label_atm_21").alias("label_atm_21"))


_STUDY = ["rv_cc_10d", "rv_cc_63d", "rv_yz_21d", "ret_5d", "ret_21d"]
_STUDY_SQL = _FEATURES_SQL + f""", lb AS (SELECT ticker, date, CASE WHEN count(r1) OVER w = 21 THEN sum(r1) OVER w END AS ahead, CASE WHEN count(r1) OVER w = 21 THEN sum(r1 * r1) OVER w END AS v FROM ret WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 21 FOLLOWING)),
sx AS (SELECT f.ticker, f.date, rv_cc_10d, rv_cc_63d, rv_yz_21d, r5 AS ret_5d, r21 AS ret_21d, ahead AS "forward return", ln(252.0 / 21 * v) - ln(rv_cc_21d * rv_cc_21d) AS "excess variance" FROM f JOIN lb USING (ticker, date)),
s1 AS (UNPIVOT sx ON {', '.join(_STUDY)} INTO NAME feature VALUE x), s2 AS (UNPIVOT s1 ON "forward return", "excess variance" INTO NAME target VALUE y),
s3 AS (SELECT *, count(*) OVER g AS n, (x - avg(x) OVER g) / stddev_pop(x) OVER g AS z, y - avg(y) OVER g AS dy FROM s2 WINDOW g AS (PARTITION BY ticker, target, feature)),
s4 AS (SELECT *, avg(z * dy) OVER g AS b FROM s3 WHERE n >= 100 WINDOW g AS (PARTITION BY ticker, target, feature)),
s5 AS (SELECT ticker, target, feature, max(n) AS n, max(b) AS slope, 1 - sum(pow(dy - b * z, 2)) / sum(dy * dy) AS r2, list(z * (dy - b * z) ORDER BY date) AS s FROM s4 GROUP BY 1, 2, 3),
fit AS (SELECT ticker, target, feature, n, slope, r2, slope * n / sqrt(list_inner_product(s, s) + list_sum(list_transform(range(1, 22), lambda k: 2 * (1 - k / 22.0) * list_inner_product(s[1:len(s) - k], s[k + 1:])))) AS t FROM s5)"""


def _study_fits(spark, d):
    from volframe.operators import realized as R
    from volframe.operators import study as Y

    b = X.bars(spark, d)
    rows = R.realized_features(b).join(R.labels(b).select("ticker", "date", "label_rv_21", "label_ret_21"), ["ticker", "date"])
    targets = {"forward return": "label_ret_21", "excess variance": F.log(F.col("label_rv_21") ** 2) - F.log(F.col("rv_cc_21d") ** 2)}
    return Y.regressions(Y.panel(rows, _STUDY, targets), 21)


@query(_STUDY_SQL + " SELECT ticker, target, feature, n, round(slope, 6) AS slope, round(t, 5) AS t, round(r2, 6) AS r2 FROM fit")
def predictive_panel(spark, d):
    """Every feature against every target, ticker by ticker, with Newey-West errors."""
    return _study_fits(spark, d).select("ticker", "target", "feature", "n", r("slope").alias("slope"), r("t", 5).alias("t"), r("r2").alias("r2"))


@query(_STUDY_SQL + """, m AS (SELECT *, CASE WHEN ticker IN ('AMERICA', 'EUROPE') THEN 'west' WHEN ticker = 'ASIA' THEN 'east' ELSE 'rest' END AS "group" FROM fit),
md AS (SELECT *, median(slope) OVER (PARTITION BY target, "group", feature) AS med FROM m),
su AS (SELECT target, "group", feature, count(DISTINCT ticker) AS tickers, max(med) AS median_slope, count(*) FILTER (abs(t) > 2) AS significant, count(*) FILTER (sign(slope) = sign(med)) AS same_sign, median(r2) AS median_r2 FROM md GROUP BY 1, 2, 3)
SELECT target, "group", feature, tickers, round(median_slope, 6) AS median_slope, significant, same_sign, round(median_r2, 6) AS median_r2, row_number() OVER (PARTITION BY target ORDER BY CASE "group" WHEN 'west' THEN 1 WHEN 'east' THEN 2 ELSE 3 END, significant DESC, "group", feature)::INT AS place FROM su""")
def feature_study(spark, d):
    """Features by target and group: how strong, how often significant, how often of one sign."""
    from volframe.operators import study as Y

    group = F.when(F.col("ticker").isin("AMERICA", "EUROPE"), "west").when(F.col("ticker") == "ASIA", "east").otherwise("rest")
    return rounded(Y.summarise(_study_fits(spark, d), group, ["west", "east"]), "median_slope", "median_r2")
