"""Exchange days, term structures, SABR fits, spot volatilities and snapshot documents, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from volframe.functions import pricing as P
from volframe.operators import backtest as B
from volframe.operators import market_days as M
from volframe.operators import sabr as A
from volframe.operators import snapshot as N
from volframe.operators import surface as S
from volframe.plans.features import _TABLE_SQL, _feature_table
from volframe.plans.registry import query, r, rounded
from volframe.plans.surfaces import _SLICES
from volframe.sources import fixtures as X

#: Good Fridays from almanacs; the operator finds them by rule.
_FRIDAYS = "1992-04-17 1993-04-09 1994-04-01 1995-04-14 1996-04-05 1997-03-28 1998-04-10 1999-04-02 2000-04-21 2001-04-13 2002-03-29 2023-04-07 2024-03-29 2025-04-18 2026-04-03".split()
_DAYS_SQL = f"""all_days AS (SELECT day, isodow(day) AS w, month(day) AS m, day(day) AS n, row_number() OVER (PARTITION BY year(day), month(day), isodow(day) ORDER BY day) AS nth, row_number() OVER (PARTITION BY year(day), month(day), isodow(day) ORDER BY day DESC) AS back
  FROM (SELECT unnest(generate_series(DATE '1991-12-01', DATE '2027-01-31', INTERVAL 1 DAY))::DATE AS day)),
off AS (SELECT day FROM all_days WHERE w = 1 AND ((m = 1 AND nth = 3 AND year(day) >= 1998) OR (m = 2 AND nth = 3) OR (m = 5 AND back = 1) OR (m = 9 AND nth = 1)) OR (w = 4 AND m = 11 AND nth = 4)
  UNION SELECT day + CASE w WHEN 6 THEN -1 WHEN 7 THEN 1 ELSE 0 END FROM all_days WHERE (m = 7 AND n = 4) OR (m = 12 AND n = 25) OR (m = 6 AND n = 19 AND year(day) >= 2022) OR (m = 1 AND n = 1 AND w <> 6)
  UNION SELECT unnest([{', '.join(f"DATE '{d}'" for d in _FRIDAYS)}])),
closing AS (SELECT day, CASE WHEN (w <= 4 AND ((m = 7 AND n = 3) OR (m = 12 AND n = 24))) OR day IN (SELECT day + 1 FROM all_days WHERE w = 4 AND m = 11 AND nth = 4) THEN 780 ELSE 960 END AS close_minute FROM all_days WHERE w <= 5 AND day NOT IN (SELECT day FROM off))"""


@query(f"WITH {_DAYS_SQL} SELECT l_shipdate::DATE AS date, count(*) AS items, any_value(close_minute) IS NOT NULL AS session, any_value(close_minute) AS close_minute FROM lineitem LEFT JOIN closing ON day = l_shipdate::DATE GROUP BY 1")
def exchange_sessions(spark, d):
    """Each date of the line items: whether it is a session of the exchange, and when that closes."""
    days = X.table(spark, d, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("date")).agg(F.count("*").alias("items"))
    return days.withColumn("session", M.is_session(F.col("date"))).withColumn("close_minute", M.close_minute(F.col("date")))


@query(f"""WITH {_DAYS_SQL}, e AS (SELECT ts, ts::DATE + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS as_of FROM events), s AS (SELECT as_of, ts::DATE AS day, extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60 + floor(extract(second FROM ts)) AS sec, close_minute AS c, ts FROM e LEFT JOIN closing ON day = as_of)
SELECT as_of, CASE WHEN ts::DATE <> as_of THEN 'other day' WHEN c IS NULL THEN 'no session' WHEN sec < 60 * c + 900 THEN 'intraday' ELSE 'ok' END AS status, coalesce(ts::DATE = as_of AND sec >= 60 * c - 1800 AND sec < 60 * c, false) AS preclose, count(*) AS n FROM s GROUP BY 1, 2, 3""")
def collection_guard(spark, d):
    """Events as collections of quotes: how many give closing quotes of their day, and why the others don't."""
    as_of = F.expr("date_add(cast(ts as date), if(event_id % 5 = 0, 1, 0))")
    e = X.table(spark, d, "events").select("ts", as_of.alias("as_of"))
    return e.groupBy("as_of", M.collection_status(F.col("as_of"), F.col("ts")).alias("status"), M.preclose_allowed(F.col("as_of"), F.col("ts")).alias("preclose")).agg(F.count("*").alias("n"))


_ATM_SQL = """atm AS (SELECT ticker, as_of, "T" AS t, sqrt((a + b * (-rho * m + sqrt(m * m + sigma * sigma))) / "T") AS iv FROM slices)"""


def _atm(spark, d):
    w = P.svi(F.lit(0.0), *map(F.col, ("a", "b", "rho", "m", "sigma")))
    return X.slices(spark, d).select("ticker", "as_of", "T", F.sqrt(w / F.col("T")).alias("iv"))


@query(f"""{_SLICES}, {_ATM_SQL}, g AS (SELECT ticker, as_of, count(*) AS n, var_pop(t) AS xx, var_pop(t * t) AS ss, covar_pop(t, t * t) AS xs, covar_pop(t, iv) AS xy, covar_pop(t * t, iv) AS sy, arg_min(iv, t) AS first, arg_max(iv, t) AS last, max(iv) AS top FROM atm GROUP BY 1, 2)
SELECT ticker, as_of, n, round(xy / xx, 6) AS slope, round((xx * sy - xs * xy) / (xx * ss - xs * xs), 6) AS curvature, round(last - first, 6) AS spread, CASE WHEN abs(xy / xx) < 0.005 THEN 'FLAT' WHEN top > first + 0.005 AND top > last + 0.005 THEN 'HUMPED' WHEN xy < 0 THEN 'INVERTED' ELSE 'NORMAL' END AS shape FROM g""")
def term_fit(spark, d):
    """Slope, curvature and shape of each snapshot's term structure."""
    f = B.term_fit(_atm(spark, d), ["ticker", "as_of"])
    return f.select("ticker", "as_of", "n", r("slope").alias("slope"), r("curvature").alias("curvature"), r("spread").alias("spread"), "shape")


@query(f"{_SLICES}, {_ATM_SQL} SELECT a.ticker, a.as_of, a.t AS near, b.t AS far FROM atm a JOIN atm b ON a.ticker = b.ticker AND a.as_of = b.as_of AND a.t < b.t AND a.iv > b.iv + 0.01")
def term_inversions(spark, d):
    """Pairs of tenors of a snapshot of which the nearer has the higher volatility."""
    return B.inversions(_atm(spark, d), ["ticker", "as_of"])


@query(f"""{_SLICES} SELECT ticker, as_of, "T", 15 AS n, round(0.15 + 0.01 * (dayofyear(as_of) % 12), 4)::DOUBLE AS alpha, round(-0.6 + 0.1 * (dayofyear(as_of) % 8), 3)::DOUBLE AS rho, round(0.3 + 0.1 * (dayofyear(as_of) % 6), 3)::DOUBLE AS nu, true AS close FROM slices WHERE "T" >= 0.25""")
def sabr_recovery(spark, d):
    """SABR fits of smiles that have known parameters, which SQL states; beta is 0.5 and strikes are moneyness."""
    h = F.dayofyear("as_of")
    s = X.slices(spark, d).where("T >= 0.25").select("ticker", "as_of", "T", (0.15 + 0.01 * (h % 12)).alias("alpha"), (-0.6 + 0.1 * (h % 8)).alias("rho"), (0.3 + 0.1 * (h % 6)).alias("nu"))
    q = s.withColumn("strike", F.explode(F.transform(F.sequence(F.lit(0), F.lit(14)), lambda i: F.exp(-0.35 + 0.05 * i)))).withColumn("forward", F.lit(1.0))
    q = q.withColumn("iv", P.sabr(F.col("forward"), F.col("strike"), F.col("T"), F.col("alpha"), 0.5, F.col("rho"), F.col("nu"))).drop("alpha", "rho", "nu")
    f = A.calibrate(q.withColumn("tenor", F.col("T")), ["ticker", "as_of", "tenor"])
    return f.select("ticker", "as_of", F.col("tenor").alias("T"), F.col("n").cast("int").alias("n"), r("alpha", 4).alias("alpha"), r("rho", 3).alias("rho"), r("nu", 3).alias("nu"), (F.col("rmse") < 1e-6).alias("close"))


@query(f"""{_SLICES} SELECT ticker, as_of, "T", i, CASE WHEN i % 9 = 8 THEN NULL ELSE round(0.1 + 0.03 * i + 0.01 * (dayofyear(as_of) % 5), 6)::DOUBLE END AS iv FROM slices, (SELECT unnest(range(0, 18)) AS i) WHERE "T" >= 0.25""")
def spot_volatility(spark, d):
    """Volatilities solved from spot prices of calls and puts; every ninth price is below its intrinsic value and has none."""
    s = X.slices(spark, d).where("T >= 0.25").select("ticker", "as_of", "spot", "T", F.explode(F.sequence(F.lit(0), F.lit(17))).alias("i"))
    s = s.withColumn("sigma", 0.1 + 0.03 * F.col("i") + 0.01 * (F.dayofyear("as_of") % 5)).withColumn("strike", F.col("spot") * (0.9 + 0.2 * F.col("i") / 17)).withColumn("is_call", F.col("i") % 2 == 0)
    price = P.bs_price(F.col("spot"), F.col("strike"), F.col("T"), F.lit(0.03), F.col("sigma"), F.col("is_call"))
    s = s.withColumn("price", F.when(F.col("i") % 9 == 8, -price).otherwise(price))
    iv = S.spot_implied_vol("price", "spot", "strike", "T", F.lit(0.03), "is_call")
    return s.select("ticker", "as_of", "T", F.col("i").cast("long").alias("i"), r(iv).alias("iv"))


_AS_OF = "1997-06-05"
_KNOWN = {"atm_30d", "vs_30d", "rr25_30d", "rv_cc_21d", "rv_yz_21d", "vrp_30d", "mkt_vix", "mkt_skew", "earn_days_to", "earn_implied_move", "earn_hist_move"}


def _num_sql(c: str, factor: float, digits: int, row: str = "l") -> str:
    v = f"round({row}.{c}::DOUBLE * {factor}, {digits})"
    return f"CASE WHEN {v} = 0 THEN 0.0::DOUBLE ELSE {v} END" if c in _KNOWN else "NULL::DOUBLE"


def _struct_sql(fields: dict[str, str]) -> str:
    return "{" + ", ".join(f"'{c}': {fields[c]}" for c in sorted(fields)) + "}"


def _document_sql() -> str:
    part = lambda spec, row="l": {n: _num_sql(*x, row) for n, x in spec.items()}
    release = "l.earn_next_date::DATE::VARCHAR"
    fields = {n: _struct_sql(part(spec)) for n, spec in N.SECTIONS.items()} | {
        "ticker": "l.ticker", "as_of": "l.date::DATE::VARCHAR", "history_available_days": "l.days", "history_note": f"printf('{N.NOTE}', l.days)", "spot": "NULL::DOUBLE", "variance_risk_premium_30d_pts": _num_sql("vrp_30d", 100, 2),
        "earnings": f"CASE WHEN l.earn_next_date IS NOT NULL THEN {_struct_sql({'next_release_session': release, **part(N.EARNINGS)})} END", "asset_group": "l.g",
        "peers": f"coalesce((SELECT list({_struct_sql({'ticker': 'p.ticker', **part(N.PEER, 'p')})} ORDER BY p.ticker) FROM last p WHERE p.ticker <> l.ticker AND (p.g = l.g OR p.ticker = 'EUROPE') AND date_diff('day', p.date::DATE, DATE '{_AS_OF}') <= 5), [])",
        "volatility_forecast": "NULL::VARCHAR",
    }
    return _struct_sql(fields)


@query(f"""{_TABLE_SQL}, last AS (SELECT *, substr(ticker, 1, 1) AS g FROM (SELECT *, count(*) OVER (PARTITION BY ticker) AS days, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS k FROM ft WHERE date <= DATE '{_AS_OF}') WHERE k = 1),
doc AS (SELECT ticker, date, to_json({_document_sql()})::VARCHAR AS document FROM last l)
SELECT ticker, date::DATE AS as_of, document, substr(sha256(document || '|v1'), 1, 16) AS digest FROM doc""")
def snapshot_documents(spark, d):
    """Each ticker's snapshot as JSON with its digest; groups go by the first letter, EUROPE is the market."""
    groups = X.table(spark, d, "region").select(F.col("r_name").alias("ticker"), F.substring("r_name", 1, 1).alias("asset_group"))
    s = N.snapshots(_feature_table(spark, d).select("ticker", "date", "earn_next_date", *sorted(_KNOWN)), groups, F.lit(_AS_OF).cast("date"), market="EUROPE")
    return s.select("ticker", "as_of", N.as_json(F.col("document")).alias("document"), N.digest(F.col("document"), "v1").alias("digest"))


_INSTANTS_SQL = f"""{_DAYS_SQL}, iv AS (SELECT event_id, (ts + to_days((event_id % 400)::INT)) AS u FROM events), lo AS (SELECT event_id, (u AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local FROM iv)"""


@query(f"""WITH {_INSTANTS_SQL}, cs AS (SELECT day FROM closing)
SELECT event_id, strftime(local, '%Y-%m-%d %H:%M:%S') AS local, CASE WHEN extract(hour FROM local) >= 12 AND local::DATE IN (SELECT day FROM cs) THEN (SELECT min(day) FROM cs WHERE day > local::DATE) ELSE (SELECT min(day) FROM cs WHERE day >= local::DATE) END AS session FROM lo""")
def event_instants(spark, d):
    """Events spread over more than a year as instants: exchange time across both changes of the clock, and the session moved."""
    e = X.table(spark, d, "events")
    utc = F.col("ts").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("event_id") % 400).cast("int"))
    e = e.select("event_id", M.exchange_time(F.timestamp_micros(F.round(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), utc)).cast("long"))).alias("announced"))
    days = M.exchange_calendar(e.select(F.date_sub(F.col("announced").cast("date"), 10).alias("date")), after=30)
    return M.session_of(e, days).select("event_id", F.date_format("announced", "yyyy-MM-dd HH:mm:ss").alias("local"), "session")


_SNAPS_SQL = f"""WITH {X.IDX_SQL.strip()}, sn AS (SELECT y, date, CASE WHEN date >= make_date(y, 12, 1) THEN NULL ELSE vix + 0.001 * (y - 1990) END AS vix, CASE WHEN y % 2 = 0 THEN vix3m + 0.001 * (y - 1990) END AS vix3m, CASE WHEN y % 2 = 1 THEN skew END AS skew
 FROM wide, (SELECT unnest(range(1992, 1999)) AS y) WHERE date >= make_date((y - 1)::INT, 9, 1) AND date <= make_date(y::INT, 12, 31) UNION ALL SELECT 0, date, vix - 1, NULL, skew - 1 FROM wide)"""


@query(f"""{_SNAPS_SQL} SELECT date, round(arg_max(vix, y) FILTER (vix IS NOT NULL), 9) AS vix, round(arg_max(vix3m, y) FILTER (vix3m IS NOT NULL), 9) AS vix3m, round(arg_max(skew, y) FILTER (skew IS NOT NULL), 9) AS skew FROM sn GROUP BY date""")
def index_snapshots(spark, d):
    """Overlapping snapshot files of a year each, of different columns, unsettled in their last month, and a backfill: read
    back by the versions in their names as one history.
    """
    from volframe.sources import snapshots as N
    from volframe.sources.store import kept, scratch

    folder, wide = scratch(spark), kept(X.index_wide(spark, d))
    for y in range(1992, 1999):
        own = wide.where(F.col("date").between(f"{y - 1}-09-01", f"{y}-12-31"))
        other = (F.col("vix3m") + F.lit(0.001 * (y - 1990))).alias("vix3m") if y % 2 == 0 else F.col("skew")
        N.save_index_snapshot(own.select("date", F.when(F.col("date") < f"{y}-12-01", F.col("vix") + F.lit(0.001 * (y - 1990))).alias("vix"), other), folder, f"{y}-12-31")
    N.save_backfill(wide.select("date", (F.col("vix") - 1).alias("vix"), (F.col("skew") - 1).alias("skew")), folder)
    return rounded(N.index_history(spark, folder), "vix", "vix3m", "skew", digits=9)
