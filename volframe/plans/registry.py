"""All queries of the library over the given tables, with their SQL for DuckDB. Doubles are rounded on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from volframe.functions import pricing as P
from volframe.operators import backtest as B
from volframe.operators import evaluate as E
from volframe.operators import quality as Q
from volframe.operators import realized as R
from volframe.operators import surface as S
from volframe.operators import timeseries as T
from volframe.sources import fixtures as X

#: The standard grid: forward log-moneyness and tenors in years.
K_GRID = [round(-0.4 + 0.025 * i, 3) for i in range(25)]
T_GRID = [7 / 365, 14 / 365, 30 / 365, 60 / 365, 91 / 365, 0.5, 1.0, 2.0]
_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def r(c: Column | str, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})


_FEATURES_SQL = f"""
WITH {X.BARS_SQL},
ret AS (SELECT *, ln(adj_close / lag(adj_close, 1) OVER w) AS r1, ln(adj_close / lag(adj_close, 5) OVER w) AS r5, ln(adj_close / lag(adj_close, 21) OVER w) AS r21,
               ln(open / lag(close) OVER w) AS o, ln(close / open) AS c, ln(high / close) * ln(high / open) + ln(low / close) * ln(low / open) AS rs FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)),
f AS (SELECT *, CASE WHEN count(r1) OVER w21 = 21 THEN sqrt(252 * avg(r1 * r1) OVER w21) END AS rv_cc_21d,
             CASE WHEN count(r1) OVER w63 = 63 THEN sqrt(252 * avg(r1 * r1) OVER w63) END AS rv_cc_63d,
             CASE WHEN count(r1) OVER w10 = 10 THEN sqrt(252 * avg(r1 * r1) OVER w10) END AS rv_cc_10d,
             CASE WHEN count(o) OVER w21 = 21 AND count(c) OVER w21 = 21 THEN sqrt(252 * greatest(var_samp(o) OVER w21 + (0.34 / (1.34 + 22.0 / 20)) * var_samp(c) OVER w21 + (1 - 0.34 / (1.34 + 22.0 / 20)) * avg(rs) OVER w21, 0)) END AS rv_yz_21d
      FROM ret WINDOW w10 AS (PARTITION BY ticker ORDER BY date ROWS 9 PRECEDING), w21 AS (PARTITION BY ticker ORDER BY date ROWS 20 PRECEDING), w63 AS (PARTITION BY ticker ORDER BY date ROWS 62 PRECEDING))"""


@query(_FEATURES_SQL + "SELECT ticker, date, round(r1, 6) AS ret_1d, round(r5, 6) AS ret_5d, round(r21, 6) AS ret_21d, round(rv_cc_10d, 6) AS rv_cc_10d, round(rv_cc_21d, 6) AS rv_cc_21d, round(rv_cc_63d, 6) AS rv_cc_63d, round(rv_yz_21d, 6) AS rv_yz_21d FROM f")
def realized_vol(spark, d):
    cols = ["ret_1d", "ret_5d", "ret_21d", "rv_cc_10d", "rv_cc_21d", "rv_cc_63d", "rv_yz_21d"]
    return R.realized_features(X.bars(spark, d)).select("ticker", "date", *[r(c).alias(c) for c in cols])


@query(f"WITH {X.BARS_SQL} SELECT ticker, date, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low, round(close, 6) AS close, volume FROM bars")
def daily_bars(spark, d):
    return rounded(X.bars(spark, d).select("ticker", "date", "open", "high", "low", "close", "volume"), "open", "high", "low", "close")


@query(f"""WITH {X.BARS_SQL}, w AS (SELECT *, avg(close) OVER z AS m, stddev_samp(close) OVER z AS s, count(close) OVER z AS n FROM bars WINDOW z AS (PARTITION BY ticker ORDER BY date ROWS 62 PRECEDING))
SELECT ticker, date, round(CASE WHEN n >= 20 AND s > 1e-12 THEN (close - m) / s END, 6) AS z63 FROM w""")
def rolling_zscore(spark, d):
    return X.bars(spark, d).select("ticker", "date", r(T.rolling_z(F.col("close"), T.trailing("ticker", "date", 63), 20)).alias("z63"))


@query(f"""WITH {X.BARS_SQL}, w AS (SELECT *, list(close) OVER (PARTITION BY ticker ORDER BY date ROWS 251 PRECEDING) AS v FROM bars)
SELECT ticker, date, round(CASE WHEN len(v) >= 20 THEN (len(list_filter(v, lambda x: x < close)) + (len(list_filter(v, lambda x: x = close)) + 1) / 2) / len(v) END, 6) AS pct252 FROM w""")
def rolling_pct_rank(spark, d):
    return X.bars(spark, d).select("ticker", "date", r(T.rolling_rank(F.col("close"), T.trailing("ticker", "date", 252), 20)).alias("pct252"))


@query(f"""WITH {X.BARS_SQL}, {X.CAL_SQL}, s AS (SELECT bars.*, seq FROM bars JOIN cal ON session = date)
SELECT a.ticker, a.date, round(a.close - b.close, 6) AS d1, round(a.close - c.close, 6) AS d5 FROM s a LEFT JOIN s b ON b.ticker = a.ticker AND b.seq = a.seq - 1 LEFT JOIN s c ON c.ticker = a.ticker AND c.seq = a.seq - 5""")
def calendar_gap_diff(spark, d):
    f = T.align(X.bars(spark, d).select("ticker", "date", "close"), X.sessions(spark, d), "ticker", "date")
    f = T.shifted(T.shifted(f, "ticker", "close", 1, "c1"), "ticker", "close", 5, "c5")
    return f.select("ticker", "date", r(F.col("close") - F.col("c1")).alias("d1"), r(F.col("close") - F.col("c5")).alias("d5"))


@query(f"WITH {X.BARS_SQL}, {X.MACRO_SQL} SELECT ticker, date, round(value, 9) AS value FROM bars ASOF LEFT JOIN macro ON date >= published")
def asof_macro(spark, d):
    return T.asof_join(X.bars(spark, d).select("ticker", "date"), X.macro(spark, d).select("published", "value"), "date", "published", values=["value"]).select("ticker", "date", r("value", 9).alias("value"))


@query(f"""WITH {X.BARS_SQL}, {X.RATES_SQL}, b AS (SELECT DISTINCT date FROM bars),
a AS (SELECT date, rate AS r25 FROM b ASOF LEFT JOIN (SELECT date AS t, rate FROM rates WHERE tenor_years = 0.25) ON date >= t),
c AS (SELECT date, r25, rate AS r1 FROM a ASOF LEFT JOIN (SELECT date AS t, rate FROM rates WHERE tenor_years = 1.0) ON date >= t),
e AS (SELECT date, r25, r1, rate AS r10 FROM c ASOF LEFT JOIN (SELECT date AS t, rate FROM rates WHERE tenor_years = 10.0) ON date >= t)
SELECT date, round(r25, 6) AS r_0_1, round(r25 + (r1 - r25) * (0.5 - 0.25) / 0.75, 6) AS r_0_5, round(r1 + (r10 - r1) * (2.0 - 1.0) / 9, 6) AS r_2 FROM e WHERE r25 IS NOT NULL AND r1 IS NOT NULL AND r10 IS NOT NULL""")
def asof_rates_interp(spark, d):
    wide = X.rates(spark, d).groupBy("date").pivot("tenor_years", [0.25, 1.0, 10.0]).agg(F.max("rate")).toDF("t", "r25", "r1", "r10")
    days = T.asof_join(X.bars(spark, d).select("date").distinct(), wide, "date", "t", values=["r25", "r1", "r10"]).where("r25 is not null and r1 is not null and r10 is not null")
    curve = F.array(*[F.struct(F.lit(t).alias("x"), F.col(c).alias("y")) for t, c in ((0.25, "r25"), (1.0, "r1"), (10.0, "r10"))])
    return days.select("date", *[r(P.interpolate(F.lit(t), curve)).alias(n) for t, n in ((0.1, "r_0_1"), (0.5, "r_0_5"), (2.0, "r_2"))])


_EVENTS_SQL = f"""WITH {X.BARS_SQL}, {X.CAL_SQL},
rel AS (SELECT r_name AS ticker, min(struct_pack(d := o_orderdate, k := o_orderkey)) AS f FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, date_trunc('quarter', o_orderdate)),
ann AS (SELECT ticker, f.d::DATE AS announced, (f.k % 24)::INT AS hour FROM rel),
ev AS (SELECT DISTINCT ticker, CASE WHEN hour >= 12 AND a.session = announced THEN b.session ELSE a.session END AS event FROM (
    SELECT ann.*, (SELECT min(session) FROM cal WHERE session >= announced) AS s0, (SELECT min(session) FROM cal WHERE session > announced) AS s1 FROM ann) q
    JOIN cal a ON a.session = q.s0 LEFT JOIN cal b ON b.session = q.s1)
"""


def _event_sessions(spark, d) -> DataFrame:
    """Release to session: on or after its date; from noon on a session, the next one."""
    cal = X.sessions(spark, d)
    e = T.asof_join(X.releases(spark, d), cal.withColumnRenamed("session", "s0").withColumn("t", F.col("s0")), "announced", "t", values=["s0"], forward=True)
    e = T.asof_join(e, cal.withColumnRenamed("session", "s1").withColumn("t", F.col("s1")), "announced", "t", values=["s1"], forward=True, strict=True)
    e = e.withColumn("event", F.when((F.col("hour") >= 12) & (F.col("s0") == F.col("announced")), F.col("s1")).otherwise(F.col("s0")))
    return e.where("s0 is not null and event is not null").select("ticker", "event").distinct()


@query(_EVENTS_SQL + "SELECT ticker, event FROM ev WHERE event IS NOT NULL")
def event_sessions(spark, d):
    return _event_sessions(spark, d)


@query(_EVENTS_SQL + """, b AS (SELECT ticker, date FROM bars), n AS (SELECT b.ticker, b.date, event AS next_event FROM b ASOF LEFT JOIN (SELECT * FROM ev WHERE event IS NOT NULL) e ON b.ticker = e.ticker AND b.date < e.event),
p AS (SELECT n.ticker, n.date, next_event, event AS last_event FROM n ASOF LEFT JOIN (SELECT * FROM ev WHERE event IS NOT NULL) e ON n.ticker = e.ticker AND n.date >= e.event)
SELECT p.ticker, p.date, next_event, last_event, c2.seq - c1.seq AS sessions_to FROM p LEFT JOIN cal c1 ON c1.session = p.date LEFT JOIN cal c2 ON c2.session = next_event""")
def next_prev_event(spark, d):
    ev, cal = _event_sessions(spark, d), X.sessions(spark, d)
    b = T.asof_join(X.bars(spark, d).select("ticker", "date"), ev.withColumnRenamed("event", "next_event").withColumn("t", F.col("next_event")), "date", "t", ["ticker"], ["next_event"], strict=True, forward=True)
    b = T.asof_join(b, ev.withColumnRenamed("event", "last_event").withColumn("t", F.col("last_event")), "date", "t", ["ticker"], ["last_event"])
    b = b.join(cal.toDF("date", "q1"), "date", "left").join(cal.toDF("next_event", "q2"), "next_event", "left")
    return b.select("ticker", "date", "next_event", "last_event", (F.col("q2") - F.col("q1")).cast("long").alias("sessions_to"))


@query(f"""WITH {X.IDX_SQL}, snap AS (SELECT date, series, CASE WHEN lag = 0 THEN NULL ELSE value + lag END AS value, date + lag AS snap FROM idx, (SELECT unnest([0, 1, 2, 3, 4]) AS lag))
SELECT date, series, round(arg_max(value, snap), 9) AS value FROM snap WHERE value IS NOT NULL GROUP BY 1, 2""")
def snapshot_merge_newest_nonnull(spark, d):
    s = X.index_long(spark, d).withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("snap", F.date_add("date", F.col("lag")))
    s = s.withColumn("value", F.when(F.col("lag") > 0, F.col("value") + F.col("lag")))
    return T.newest_non_null(s, ["date", "series"], "value", "snap").select("date", "series", r("value", 9).alias("value"))


@query(f"""WITH {X.IDX_SQL}, old AS (SELECT date, vix, vix3m FROM wide WHERE dayofmonth(date) <= 20), new AS (SELECT date, CASE WHEN dayofmonth(date) % 2 = 0 THEN vix + 1 END AS vix, vix9d FROM wide WHERE dayofmonth(date) >= 10)
SELECT coalesce(n.date, o.date) AS date, round(coalesce(n.vix, o.vix), 9) AS vix, round(vix9d, 9) AS vix9d, round(vix3m, 9) AS vix3m FROM new n FULL JOIN old o ON n.date = o.date""")
def upsert_coalesce(spark, d):
    w = X.index_wide(spark, d)
    old = w.where(F.dayofmonth("date") <= 20).select("date", "vix", "vix3m")
    new = w.where(F.dayofmonth("date") >= 10).select("date", F.when(F.dayofmonth("date") % 2 == 0, F.col("vix") + 1).alias("vix"), "vix9d")
    return rounded(T.upsert(old, new, ["date"]), "vix", "vix9d", "vix3m", digits=9)


@query("SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2")
def dedup_keep_last(spark, d):
    e = X.table(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return T.keep_last(e, ["user_id", "event_type"], ["event_id"])


@query("""WITH old AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderdate < DATE '1998-01-01'), new AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1998-01-01' AND o_orderstatus = 'P')
SELECT * FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new) UNION ALL SELECT * FROM new""")
def replace_by_key(spark, d):
    o, cut = X.table(spark, d, "orders"), F.lit("1998-01-01").cast("timestamp")
    cols = ["o_custkey", "o_orderkey", "o_totalprice"]
    return T.replace_by_key(o.where(F.col("o_orderdate") < cut).select(*cols), o.where((F.col("o_orderdate") >= cut) & (F.col("o_orderstatus") == "P")).select(*cols), "o_custkey")


@query(f"WITH {X.IDX_SQL} SELECT date, series, round(value, 9) AS value FROM (UNPIVOT wide ON vix, vix3m, vix9d, vvix, skew INTO NAME series VALUE value)")
def wide_to_long(spark, d):
    w = X.index_wide(spark, d)
    return w.unpivot(["date"], list(X.SERIES.values()), "series", "value").where("value is not null").withColumn("value", r("value", 9))


@query("""WITH s AS (SELECT o_orderkey, 'SYM' || (o_custkey % 7) || strftime(o_orderdate, '%y%m%d') || CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE 'P' END || lpad(((o_orderkey * 125) % 90000000)::VARCHAR, 8, '0') AS symbol FROM orders)
SELECT o_orderkey, substr(symbol, 1, length(symbol) - 15) AS root, strptime('20' || substr(symbol, length(symbol) - 14, 6), '%Y%m%d')::DATE AS expiration, CASE substr(symbol, length(symbol) - 8, 1) WHEN 'C' THEN 'call' ELSE 'put' END AS option_type, right(symbol, 8)::DOUBLE / 1000 AS strike FROM s""")
def occ_parse(spark, d):
    o = X.table(spark, d, "orders")
    s = F.concat(F.lit("SYM"), (F.col("o_custkey") % 7).cast("string"), F.date_format("o_orderdate", "yyMMdd"), F.when(F.col("o_orderkey") % 2 == 0, "C").otherwise("P"), F.lpad(((F.col("o_orderkey") * 125) % 90000000).cast("string"), 8, "0"))
    return o.select("o_orderkey", s.alias("symbol")).select("o_orderkey", *[c.alias(n) for n, c in P.occ_symbol(F.col("symbol")).items()])


@query("SELECT event_id, user_id, (props->>'$.k')::INT AS k, value FROM events WHERE (props->>'$.k')::INT >= 50")
def json_filter(spark, d):
    k = F.get_json_object("props", "$.k").try_cast("int")
    return X.table(spark, d, "events").select("event_id", "user_id", k.alias("k"), "value").where("k >= 50")


_COVER_SQL = f"""WITH {X.BARS_SQL}, {X.CAL_SQL}, have AS (SELECT ticker, date FROM bars WHERE (dayofyear(date) + length(ticker)) % 11 <> 0), sp AS (SELECT ticker, min(date) AS first, max(date) AS last, count(*) AS present FROM have GROUP BY 1),
ex AS (SELECT ticker, session FROM sp JOIN cal ON session BETWEEN first AND last), mi AS (SELECT * FROM ex WHERE NOT EXISTS (SELECT 1 FROM have WHERE have.ticker = ex.ticker AND have.date = ex.session))
"""


def _present(spark, d):
    return X.bars(spark, d).select("ticker", "date").where((F.dayofyear("date") + F.length("ticker")) % 11 != 0)


@query(_COVER_SQL + "SELECT sp.ticker, first, last, present, e.n AS expected, coalesce(m.n, 0) AS missing, round(100.0 * (e.n - coalesce(m.n, 0)) / e.n, 6) AS coverage FROM sp JOIN (SELECT ticker, count(*) AS n FROM ex GROUP BY 1) e USING (ticker) LEFT JOIN (SELECT ticker, count(*) AS n FROM mi GROUP BY 1) m USING (ticker)")
def coverage_gaps(spark, d):
    return Q.coverage(_present(spark, d), X.sessions(spark, d)).select("ticker", "first", "last", "present", "expected", "missing", r("coverage").alias("coverage"))


@query(_COVER_SQL + "SELECT ticker, latest, (SELECT count(*) FROM cal WHERE session > latest AND session <= (SELECT max(date) FROM have)) AS sessions_behind, (SELECT count(*) FROM cal WHERE session > latest AND session <= (SELECT max(date) FROM have)) > 0 AS lags FROM (SELECT ticker, max(date) AS latest FROM have GROUP BY 1)")
def freshness(spark, d):
    return Q.freshness(_present(spark, d), X.sessions(spark, d))


@query(f"""WITH {X.IDX_SQL}, {X.CAL_SQL}, g AS (SELECT session, series, (SELECT count(*) FROM idx WHERE idx.date = session AND idx.series = s.series) > 0 AS ok FROM cal, (SELECT DISTINCT series FROM idx) s WHERE session <= (SELECT max(date) FROM idx)),
k AS (SELECT series, sum(ok::INT) OVER (PARTITION BY series ORDER BY session DESC) AS seen FROM g) SELECT series, count(*) FILTER (seen = 0) AS streak FROM k GROUP BY 1""")
def missing_streak(spark, d):
    idx = X.index_long(spark, d)
    last = idx.agg(F.max("date").alias("last"))
    grid = X.sessions(spark, d).join(last, F.col("session") <= F.col("last")).select("session").join(idx.select("series").distinct())
    have = idx.select(F.col("date").alias("session"), "series", F.lit(True).alias("ok"))
    return T.missing_streak(grid.join(have, ["session", "series"], "left").withColumn("ok", F.coalesce("ok", F.lit(False))), "series", "session", "ok")


@query(_FEATURES_SQL + ", n AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS k FROM f) SELECT ticker, max(date) AS date, round(max(CASE WHEN k = 1 THEN rv_cc_21d END), 6) AS rv_cc_21d, count(*) FILTER (k <= 63 AND rv_cc_21d IS NOT NULL) AS trend_points, round(avg(rv_cc_21d) FILTER (k <= 63), 6) AS trend_mean FROM n GROUP BY 1")
def overview_latest(spark, d):
    f = R.realized_features(X.bars(spark, d)).withColumn("k", F.row_number().over(Window.partitionBy("ticker").orderBy(F.col("date").desc()))).where("k <= 63")
    return f.groupBy("ticker").agg(F.max("date").alias("date"), r(F.max(F.when(F.col("k") == 1, F.col("rv_cc_21d")))).alias("rv_cc_21d"), F.count("rv_cc_21d").alias("trend_points"), r(F.avg("rv_cc_21d")).alias("trend_mean"))


@query(_FEATURES_SQL + """SELECT ticker, date, round(CASE WHEN count(r1) OVER w5 = 5 THEN sqrt(252.0 / 5 * sum(r1 * r1) OVER w5) END, 6) AS label_rv_5, round(CASE WHEN count(r1) OVER w21 = 21 THEN sqrt(252.0 / 21 * sum(r1 * r1) OVER w21) END, 6) AS label_rv_21,
round(ln(lead(adj_close, 5) OVER o / adj_close), 6) AS label_ret_5, round(ln(lead(adj_close, 21) OVER o / adj_close), 6) AS label_ret_21
FROM ret WINDOW o AS (PARTITION BY ticker ORDER BY date), w5 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), w21 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 21 FOLLOWING)""")
def forward_labels(spark, d):
    cols = [f"label_{k}_{h}" for k in ("rv", "ret") for h in (5, 21)]
    return rounded(R.labels(X.bars(spark, d)).select("ticker", "date", *cols), *cols)


_HAR_SQL = f"""WITH {X.BARS_SQL}, q AS (SELECT ticker, date, 252 * (pow(ln(open / lag(close) OVER w), 2) + greatest(0.5 * pow(ln(high / low), 2) - (2 * ln(2.0) - 1) * pow(ln(close / open), 2), 0)) AS rv_d, ln(close / lag(close) OVER w) AS ret FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)),
h AS (SELECT *, CASE WHEN count(rv_d) OVER w5 = 5 THEN avg(rv_d) OVER w5 END AS rv_w, CASE WHEN count(rv_d) OVER w22 = 22 THEN avg(rv_d) OVER w22 END AS rv_m, CASE WHEN count(ret) OVER f5 = 5 THEN 252.0 / 5 * sum(ret * ret) OVER f5 END AS y_5, CASE WHEN count(ret) OVER f21 = 21 THEN 252.0 / 21 * sum(ret * ret) OVER f21 END AS y_21
 FROM q WINDOW w5 AS (PARTITION BY ticker ORDER BY date ROWS 4 PRECEDING), w22 AS (PARTITION BY ticker ORDER BY date ROWS 21 PRECEDING), f5 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), f21 AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 21 FOLLOWING)),
har AS (SELECT * FROM h WHERE ret IS NOT NULL)
"""


@query(_HAR_SQL + "SELECT ticker, date, round(rv_d, 6) AS rv_d, round(rv_w, 6) AS rv_w, round(rv_m, 6) AS rv_m, round(y_5, 6) AS y_5, round(y_21, 6) AS y_21 FROM har")
def har_dataset(spark, d):
    cols = ["rv_d", "rv_w", "rv_m", "y_5", "y_21"]
    return rounded(R.har_dataset(X.bars(spark, d)).select("ticker", "date", *cols), *cols)


@query(_HAR_SQL + ", s AS (SELECT * FROM har WHERE y_21 > 0 AND rv_m > 0) SELECT ticker, count(*) AS n, round(avg(y_21 / rv_m - ln(y_21 / rv_m) - 1), 6) AS qlike, round(sqrt(avg(pow(y_21 - rv_m, 2))), 6) AS rmse, round(avg(abs(y_21 - rv_m)), 6) AS mae, round(avg(rv_m - y_21), 6) AS bias, round(1 - sum(pow(ln(y_21) - ln(rv_m), 2)) / (var_pop(ln(y_21)) * count(*)), 5) AS log_r2 FROM s GROUP BY 1")
def qlike_scores(spark, d):
    return rounded(rounded(E.scores(R.har_dataset(X.bars(spark, d)), "y_21", "rv_m", ["ticker"]), "qlike", "rmse", "mae", "bias"), "log_r2", digits=5)


_LOSS_SQL = _HAR_SQL + ", l AS (SELECT ticker, date, y_5 / rv_d - ln(y_5 / rv_d) - 1 AS lb, y_5 / rv_m - ln(y_5 / rv_m) - 1 AS lm FROM har WHERE y_5 > 0 AND rv_d > 0 AND rv_m > 0), e AS (SELECT ticker, date, lb - lm AS diff FROM l)"


@query(_LOSS_SQL + """, c AS (SELECT *, diff - avg(diff) OVER (PARTITION BY ticker) AS x FROM e), g AS (SELECT *, x * lag(x, 1) OVER w AS c1, x * lag(x, 2) OVER w AS c2, x * lag(x, 3) OVER w AS c3, x * lag(x, 4) OVER w AS c4 FROM c WINDOW w AS (PARTITION BY ticker ORDER BY date))
SELECT ticker, count(*) AS n, round(avg(diff) / sqrt((sum(x * x) + 2 * (4 / 5 * sum(c1) + 3 / 5 * sum(c2) + 2 / 5 * sum(c3) + 1 / 5 * sum(c4))) / count(*) / count(*)), 5) AS dm, round(avg(diff), 6) AS mean_gain FROM g GROUP BY 1""")
def diebold_mariano(spark, d):
    h = R.har_dataset(X.bars(spark, d)).where("y_5 > 0 and rv_d > 0 and rv_m > 0")
    h = h.select("ticker", "date", P.qlike(F.col("y_5"), F.col("rv_d")).alias("lb"), P.qlike(F.col("y_5"), F.col("rv_m")).alias("lm"))
    return E.diebold_mariano(h, "lb", "lm", "date", ["ticker"], 4).select("ticker", "n", r("dm", 5).alias("dm"), r("mean_gain").alias("mean_gain"))


@query(f"""WITH {X.IDX_SQL} SELECT CASE WHEN vix >= 35 THEN 'Crisis' WHEN vix >= 25 THEN 'High' WHEN vix <= 15 THEN 'Low' ELSE 'Normal' END AS regime, count(*) AS days, round(avg(vix), 6) AS mean_vix, round(avg(skew), 6) AS mean_skew FROM wide WHERE vix IS NOT NULL GROUP BY 1""")
def regime_scores(spark, d):
    w = X.index_wide(spark, d).where("vix is not null").withColumn("regime", E.regime(F.col("vix")))
    return w.groupBy("regime").agg(F.count("*").alias("days"), r(F.avg("vix")).alias("mean_vix"), r(F.avg("skew")).alias("mean_skew"))


@query(f"""WITH {X.IDX_SQL} SELECT date, CASE WHEN vix <= 15 THEN 'low' WHEN vix <= 25 THEN 'normal' WHEN vix <= 35 THEN 'high' ELSE 'crisis' END AS bin FROM wide WHERE vix IS NOT NULL""")
def regime_bins(spark, d):
    return X.index_wide(spark, d).where("vix is not null").select("date", E.regime_bin(F.col("vix")).alias("bin"))


@query(f"WITH {X.IDX_SQL} SELECT date, round(vix3m / vix, 6) AS vix3m_vix, round(vix / vix9d, 6) AS vix_vix9d, round(vvix / vix, 6) AS vvix_vix FROM wide")
def vix_ratios(spark, d):
    v = lambda a, b: r(F.try_divide(F.col(a), F.col(b)))
    return X.index_wide(spark, d).select("date", v("vix3m", "vix").alias("vix3m_vix"), v("vix", "vix9d").alias("vix_vix9d"), v("vvix", "vix").alias("vvix_vix"))


@query(_HAR_SQL + """, a AS (SELECT ticker, date, rv_m AS x0, y_5 AS y FROM har WHERE rv_m IS NOT NULL AND y_5 IS NOT NULL), b AS (SELECT *, (x0 - avg(x0) OVER p) / stddev_pop(x0) OVER p AS x FROM a WINDOW p AS (PARTITION BY ticker)),
f AS (SELECT ticker, regr_slope(y, x) AS slope, regr_r2(y, x) AS r2, avg(y) AS my FROM b GROUP BY 1), e AS (SELECT b.ticker, date, x * (y - my - slope * x) AS s FROM b JOIN f USING (ticker)), m AS (SELECT *, s - avg(s) OVER (PARTITION BY ticker) AS u FROM e),
g AS (SELECT *, u * lag(u, 1) OVER w AS c1, u * lag(u, 2) OVER w AS c2 FROM m WINDOW w AS (PARTITION BY ticker ORDER BY date)), v AS (SELECT ticker, count(*) AS n, (sum(u * u) + 2 * (2 / 3 * sum(c1) + 1 / 3 * sum(c2))) / count(*) / count(*) AS variance FROM g GROUP BY 1)
SELECT ticker, n, round(slope, 6) AS slope, round(slope / sqrt(variance), 4) AS t, round(r2, 6) AS r2 FROM f JOIN v USING (ticker)""")
def predictive_regression(spark, d):
    h = R.har_dataset(X.bars(spark, d))
    return E.predictive_regression(h, "rv_m", "y_5", "date", ["ticker"], 2).select("ticker", "n", r("slope").alias("slope"), r("t", 4).alias("t"), r("r2").alias("r2"))


@query(f"""WITH {X.IDX_SQL}, x AS (SELECT date, series, value - lag(value) OVER (PARTITION BY series ORDER BY date) AS diff FROM idx), y AS (SELECT *, lag(diff) OVER (PARTITION BY series ORDER BY date) AS before FROM x)
SELECT series, count(diff) AS n, round(stddev_samp(diff), 6) AS sd, round(corr(diff, before), 6) AS autocorr, round(max(abs(diff)), 6) AS largest FROM y GROUP BY 1""")
def noise_stats(spark, d):
    w = Window.partitionBy("series").orderBy("date")
    x = X.index_long(spark, d).withColumn("diff", F.col("value") - F.lag("value").over(w)).withColumn("before", F.lag("diff").over(w))
    return x.groupBy("series").agg(F.count("diff").alias("n"), r(F.stddev_samp("diff")).alias("sd"), r(F.corr("diff", "before")).alias("autocorr"), r(F.max(F.abs("diff"))).alias("largest"))


@query(f"WITH {X.IDX_SQL}, a AS (SELECT date, vix, vix3m FROM wide WHERE vix IS NOT NULL AND vix3m IS NOT NULL) SELECT count(*) AS n, round(corr(vix, vix3m), 6) AS level_corr, round(avg(vix - vix3m), 6) AS mean_diff, round(avg(abs(vix - vix3m)), 6) AS mean_abs, round(stddev_samp(vix) / stddev_samp(vix3m), 6) AS sd_ratio FROM a")
def benchmark_corr(spark, d):
    a = X.index_wide(spark, d).where("vix is not null and vix3m is not null")
    diff = F.col("vix") - F.col("vix3m")
    return a.agg(F.count("*").alias("n"), r(F.corr("vix", "vix3m")).alias("level_corr"), r(F.avg(diff)).alias("mean_diff"), r(F.avg(F.abs(diff))).alias("mean_abs"), r(F.stddev_samp("vix") / F.stddev_samp("vix3m")).alias("sd_ratio"))


@query(f"""WITH {X.IDX_SQL}, z AS (SELECT date, skew, (skew - avg(skew) OVER w) / stddev_samp(skew) OVER w AS z, count(skew) OVER w AS n, stddev_samp(skew) OVER w AS s FROM wide WHERE skew IS NOT NULL WINDOW w AS (ORDER BY date ROWS 62 PRECEDING))
SELECT date, CASE WHEN n < 2 OR s < 1e-10 THEN 'neutral' WHEN z > 1.5 THEN 'rich' WHEN z < -1.5 THEN 'cheap' ELSE 'neutral' END AS signal FROM z""")
def skew_signal(spark, d):
    w = Window.orderBy("date").rowsBetween(-62, 0)  # one row per day
    return X.index_wide(spark, d).where("skew is not null").select("date", B.z_signal(F.col("skew"), w).alias("signal"))


@query(f"WITH {X.IDX_SQL} SELECT date, CASE WHEN abs(vix3m - vix9d) < 0.005 THEN 'FLAT' WHEN vix > vix9d AND vix > vix3m THEN 'HUMPED' WHEN vix3m < vix9d THEN 'INVERTED' ELSE 'NORMAL' END AS shape FROM wide WHERE vix IS NOT NULL AND vix9d IS NOT NULL AND vix3m IS NOT NULL")
def term_structure_signal(spark, d):
    w = X.index_wide(spark, d).where("vix is not null and vix9d is not null and vix3m is not null")
    return w.select("date", B.term_shape(F.col("vix9d"), F.col("vix"), F.col("vix3m")).alias("shape"))


@query(_FEATURES_SQL + """, x AS (SELECT ticker, date, r1, close, (max(close) OVER w - close) / max(close) OVER w AS dd FROM ret WINDOW w AS (PARTITION BY ticker ORDER BY date))
SELECT ticker, count(r1) AS n, round(sum(r1), 6) AS total, round(avg(r1) / stddev_samp(r1) * sqrt(252), 6) AS sharpe, round(CASE WHEN count(*) FILTER (r1 < 0) >= 2 THEN avg(r1) / sqrt(avg(r1 * r1) FILTER (r1 < 0)) * sqrt(252) ELSE 0 END, 6) AS sortino, round(avg((r1 > 0)::INT), 6) AS win_rate, round(max(dd), 6) AS max_drawdown, round(avg(r1) * 252 / max(dd), 6) AS calmar FROM x GROUP BY 1""")
def backtest_metrics(spark, d):
    f = R.realized_features(X.bars(spark, d))
    return rounded(B.metrics(f, "ret_1d", "close", ["ticker"], "date"), "total", "sharpe", "sortino", "win_rate", "max_drawdown", "calmar")


@query(f"WITH {X.BARS_SQL} SELECT ticker, date, round((max(close) OVER w - close) / max(close) OVER w, 6) AS drawdown FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)")
def max_drawdown(spark, d):
    return B.drawdown(X.bars(spark, d), "close", ["ticker"], "date").select("ticker", "date", r("drawdown").alias("drawdown"))


@query(_HAR_SQL + """, f AS (SELECT ticker, 'day' AS model, 1 AS n_params, count(*) AS n_obs, sum(pow(y_5 - rv_d, 2)) AS sse FROM har WHERE y_5 IS NOT NULL AND rv_m IS NOT NULL GROUP BY 1 UNION ALL SELECT ticker, 'month', 2, count(*), sum(pow(y_5 - rv_m, 2)) FROM har WHERE y_5 IS NOT NULL AND rv_m IS NOT NULL GROUP BY 1),
g AS (SELECT *, 2 * n_params + n_obs * (ln(2 * pi() * sse / n_obs) + 1) AS aic, ln(n_obs) * n_params + n_obs * (ln(2 * pi() * sse / n_obs) + 1) AS bic FROM f), dl AS (SELECT *, aic - min(aic) OVER (PARTITION BY ticker) AS delta_aic FROM g)
SELECT ticker, model, round(aic, 4) AS aic, round(bic, 4) AS bic, round(delta_aic, 4) AS delta_aic, round(exp(-delta_aic / 2) / sum(exp(-delta_aic / 2)) OVER (PARTITION BY ticker), 6) AS weight FROM dl""")
def model_selection(spark, d):
    h = R.har_dataset(X.bars(spark, d)).where("y_5 is not null and rv_m is not null")
    fits = [h.groupBy("ticker").agg(F.lit(n).alias("model"), F.lit(k).alias("n_params"), F.count("*").alias("n_obs"), F.sum((F.col("y_5") - F.col(c)) ** 2).alias("sse")) for n, k, c in (("day", 1, "rv_d"), ("month", 2, "rv_m"))]
    f = B.information_criteria(fits[0].unionByName(fits[1]), ["ticker"])
    return f.select("ticker", "model", r("aic", 4).alias("aic"), r("bic", 4).alias("bic"), r("delta_aic", 4).alias("delta_aic"), r("weight").alias("weight"))


_CHAIN_SQL = f"""WITH {X.BARS_SQL}, s AS (SELECT ticker, date AS as_of, close AS spot FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date_trunc('month', date) ORDER BY date) AS n FROM bars) WHERE n = 1),
ch AS (SELECT ticker, as_of, t AS "T", option_type, spot * exp(0.02 * t) AS forward, exp(-0.04 * t) AS discount, -0.35 + i * 0.53 / 21 AS k, spot * exp(0.02 * t) * exp(-0.35 + i * 0.53 / 21) AS strike, (i * 37 + dayofyear(as_of)) % 100 AS open_interest,
 0.20 + 0.01 * t - 0.025 * (-0.35 + i * 0.53 / 21) / sqrt(greatest(t, 1.0 / 52)) + 0.06 * pow(-0.35 + i * 0.53 / 21, 2) AS iv FROM s, (SELECT unnest([1.0::DOUBLE / 12, 0.25, 0.5, 1.0, 2.0]) AS t), (SELECT unnest(range(0, 22)) AS i), (SELECT unnest(['call', 'put']) AS option_type))
"""


@query(_CHAIN_SQL + "SELECT ticker, as_of, round(\"T\", 6) AS \"T\", round(strike, 6) AS strike, option_type, round(iv, 6) AS iv FROM ch")
def iv_roundtrip(spark, d):
    """Priced from the known smile, then solved for volatility again: the result must be the smile."""
    c = X.chain(spark, d)
    iv = S.implied_vol("mid", "forward", "strike", "T", "discount", F.col("option_type") == "call")
    return c.select("ticker", "as_of", r("T").alias("T"), r("strike").alias("strike"), "option_type", r(iv).alias("iv"))


@query(_CHAIN_SQL + "SELECT DISTINCT ticker, as_of, round(\"T\", 6) AS \"T\", round(forward, 5) AS forward, 'parity' AS source FROM ch")
def parity_forward(spark, d):
    return S.parity_forward(X.chain(spark, d)).select("ticker", "as_of", r("T").alias("T"), r("forward", 5).alias("forward"), "source")


_OTM_SQL = _CHAIN_SQL + f""", oz AS (SELECT *, (iv * iv * "T" / 2 - k) / (iv * sqrt("T")) AS z, k / (iv * sqrt("T")) - iv * sqrt("T") / 2 AS y FROM ch WHERE (option_type = 'call') = (strike >= forward)),
otm AS (SELECT * FROM (SELECT *, CASE WHEN option_type = 'call' THEN {X.ncdf_sql('z')} ELSE {X.ncdf_sql('y')} END AS delta FROM oz) WHERE delta >= 0.01),
qr AS (SELECT ticker, as_of, "T", count(*) AS n, min(k) AS k_min, max(k) AS k_max FROM otm GROUP BY 1, 2, 3)"""


@query(_OTM_SQL + """ SELECT ticker, as_of, round("T", 6) AS "T", 'parity' AS source, n, round(k_min, 6) AS k_min, round(k_max, 6) AS k_max, true AS close FROM qr WHERE n >= 6""")
def svi_fit_recovery(spark, d):
    """Fits of the chain use all quotes (there are no outliers), and are within 0.3 points of the known smile."""
    f = S.fit_surfaces(S.otm_quotes(X.chain(spark, d)))
    return f.select("ticker", "as_of", r("T").alias("T"), "source", F.col("n").cast("long").alias("n"), r("k_min").alias("k_min"), r("k_max").alias("k_max"), (F.col("rmse") < 0.003).alias("close"))


@query(_OTM_SQL + f""", gk AS (SELECT unnest(list_transform(range(0, 25), lambda i: -0.393 + 0.025 * i))::DOUBLE AS k), gt AS (SELECT unnest([7.0 / 365, 14.0 / 365, 30.0 / 365, 60.0 / 365, 91.0 / 365, 0.5, 1.0, 2.0])::DOUBLE AS tau),
ed AS (SELECT ticker, as_of, tau, max("T") FILTER ("T" < tau) AS lo, min("T") FILTER ("T" >= tau) AS hi, min("T") AS t0, max("T") AS t1 FROM qr, gt GROUP BY 1, 2, 3),
ob AS (SELECT ed.*, CASE WHEN tau <= t0 THEN t0 WHEN tau >= t1 THEN t1 ELSE lo END AS l, CASE WHEN tau >= t1 THEN t1 ELSE hi END AS h FROM ed WHERE (tau > t0 AND tau < t1) OR abs(tau - t0) <= 1e-8 + 1e-5 * t0 OR abs(tau - t1) <= 1e-8 + 1e-5 * t1),
ce AS (SELECT ob.ticker, ob.as_of, k FROM ob JOIN qr a ON a.ticker = ob.ticker AND a.as_of = ob.as_of AND a."T" = l JOIN qr b ON b.ticker = ob.ticker AND b.as_of = ob.as_of AND b."T" = h, gk WHERE k >= greatest(a.k_min, b.k_min) AND k <= least(a.k_max, b.k_max))
SELECT ticker, as_of, count(*) AS observed, count(*) AS close FROM ce GROUP BY 1, 2""")
def grid_recovery(spark, d):
    """Observed cells of the fitted grid, and how many of them are within 0.3 points of the known surface."""
    g = S.total_variance(S.fit_surfaces(S.otm_quotes(X.chain(spark, d))), [round(k + 0.007, 3) for k in K_GRID], T_GRID).where("observed")  # no edge of quotes
    k, t = F.col("k"), F.col("tenor")
    true = lambda at: at * (0.20 + 0.01 * at - 0.025 * k / F.sqrt(F.greatest(at, F.lit(1 / 52))) + 0.06 * k * k) ** 2
    tenors = F.array(*map(F.lit, X.TENORS))
    lo, hi = F.array_max(F.filter(tenors, lambda x: x < t)), F.array_min(F.filter(tenors, lambda x: x >= t))
    lo = F.coalesce(lo, hi)
    w = F.when(lo == hi, true(hi)).otherwise(true(lo) + (true(hi) - true(lo)) * (t - lo) / (hi - lo))
    near = F.abs(F.col("iv") - F.sqrt(w / t)) <= 0.003
    return g.groupBy("ticker", "as_of").agg(F.count("*").alias("observed"), F.count_if(near).alias("close"))


@query()
def surface_grid(spark, d):
    """SVI slices on a grid of strikes and tenors, made free of calendar arbitrage, with density and verdict."""
    slices = S.fit_surfaces(S.otm_quotes(X.chain(spark, d)))
    grid = S.density(S.calendar_filter(S.total_variance(slices, K_GRID, T_GRID)))
    return rounded(grid.select("ticker", "as_of", r("k").alias("k"), r("tenor").alias("tenor"), "w", "iv", "g"), "w", "iv", "g", digits=4)


@query()
def grid_qc(spark, d):
    slices = S.fit_surfaces(S.otm_quotes(X.chain(spark, d)))
    return rounded(S.grid_verdict(S.total_variance(slices, K_GRID, T_GRID)), "missing", "lo", "hi", digits=4)


def _more() -> None:
    """The modules that register further queries with query()."""
    from volframe.plans import corpus, features, forecasts, health, markets, serving, stores, surfaces  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _more()
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    _more()
    return dict(_SQL)
