"""Queries of data quality, health and vendors' files, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from volframe.operators import quality as Q
from volframe.operators import surface as S
from volframe.plans.registry import _COVER_SQL, _present, query, r, rounded
from volframe.sources import fixtures as X
from volframe.sources import vendors as V

_FLAWED = f"WITH {X.BARS_SQL}, {X.FLAWED_SQL}"


@query(f"{_FLAWED} SELECT ticker, as_of, count(*) AS rows FROM flawed WHERE open_interest >= 10 AND coalesce((ask - bid) / mid, 1) <= 0.5 GROUP BY 1, 2")
def chain_quality_filters(spark, d):
    return S.quality_filter(X.flawed_chain(spark, d)).groupBy("ticker", "as_of").agg(F.count("*").alias("rows"))


@query(f"""{_FLAWED} SELECT ticker, as_of, count(*) AS rows, count(DISTINCT expiration) AS expiries, round(avg((bid IS NULL OR ask IS NULL)::INT), 6) AS null_share, round(avg(coalesce(bid < 0 OR ask < 0, false)::INT), 6) AS negative_share, round(avg(coalesce(bid > ask, false)::INT), 6) AS crossed_share,
 round(median((ask - bid) / mid), 6) AS spread, count(*) - count(DISTINCT (expiration, strike, option_type)) AS duplicates, count(*) < 200 AS thin, count(DISTINCT expiration) < 4 AS few_expiries FROM flawed GROUP BY 1, 2""")
def quality_report(spark, d):
    """Shares of missing, negative and crossed quotes, duplicates and spreads of each snapshot."""
    return rounded(Q.chain_quality(X.flawed_chain(spark, d)), "null_share", "negative_share", "crossed_share", "spread")


@query(f"""{_FLAWED}, c AS (SELECT count(*) AS n, count(*) FILTER (bid < 0) AS b, count(*) FILTER (ask < 0) AS a, count(*) FILTER (mid < 0) AS m, count(*) FILTER (open_interest < 0) AS o, count(*) FILTER (NOT coalesce(strike > 0, false)) AS s FROM flawed)
SELECT unnest(['ticker', 'as_of', 'expiration', 'strike', 'option_type', 'T', 'bid', 'ask', 'mid', 'open_interest']) AS rule, n AS rows, unnest([0, 0, 0, s, 0, 0, b, a, m, o]) AS failed FROM c""")
def chain_violations(spark, d):
    """How many rows break each rule of a raw chain."""
    f = X.flawed_chain(spark, d)
    return Q.violations(f, Q.raw_chain_rules(f.columns))


@query(f"""{_FLAWED}, v AS (SELECT *, list_filter([CASE WHEN NOT strike > 80 THEN 'strike' END, CASE WHEN NOT coalesce(bid >= 0, true) THEN 'bid' END], lambda x: x IS NOT NULL) AS errors FROM flawed)
SELECT ticker, count(*) AS rows, count(*) FILTER (len(errors) = 0) AS valid, count(*) FILTER (list_contains(errors, 'bid')) AS bad_bid FROM v GROUP BY 1""")
def chain_validation(spark, d):
    """Rows with the names of the rules they break."""
    f = X.flawed_chain(spark, d)
    rules = {"strike": F.col("strike") > 80, "bid": Q.raw_chain_rules()["bid"]}
    v = Q.validate(f, rules)
    return v.groupBy("ticker").agg(F.count("*").alias("rows"), F.count_if("valid").alias("valid"), F.count_if(F.array_contains("errors", "bid")).alias("bad_bid"))


@query(_COVER_SQL + """, la AS (SELECT ticker, max(date) AS latest FROM have GROUP BY 1), be AS (SELECT ticker FROM la WHERE (SELECT count(*) FROM cal WHERE session > latest AND session <= (SELECT max(date) FROM have)) > 0),
pb AS (SELECT 'no chains: ATLANTIS' AS p, 0 AS k UNION ALL SELECT 'behind: ' || ticker, 1 FROM be WHERE ticker IN ('ASIA', 'EUROPE', 'AFRICA'))
SELECT 'freshness' AS "check", false AS ok, string_agg(p, '; ' ORDER BY k, p) AS problems FROM pb""")
def check_freshness(spark, d):
    """Tickers without a chain and tickers that lag behind, as one row."""
    wanted = spark.createDataFrame([("ASIA",), ("EUROPE",), ("AFRICA",), ("ATLANTIS",)], "ticker string")
    return Q.check_freshness(_present(spark, d), X.sessions(spark, d), wanted)


@query(f"""WITH {X.BARS_SQL}, {X.SLICES_SQL}, dy AS (SELECT DISTINCT ticker, as_of AS date FROM slices), ok AS (SELECT DISTINCT ticker, date FROM dy WHERE (month(date) + length(ticker)) % 5 <> 0 OR year(date) < 1995),
j AS (SELECT dy.*, ok.date IS NOT NULL AS built FROM dy LEFT JOIN ok USING (ticker, date)), p AS (SELECT ticker, max(date) AS last, max(date) FILTER (built) AS b FROM j GROUP BY 1),
s AS (SELECT p.ticker, last, count(j.date) AS streak FROM p LEFT JOIN j ON j.ticker = p.ticker AND (b IS NULL OR j.date > b) GROUP BY 1, 2)
SELECT ticker, streak, streak = 0 OR (ticker = 'ASIA' AND streak < 3) AS ok FROM s WHERE last = (SELECT max(last) FROM s)""")
def check_surfaces(spark, d):
    """Tickers of the newest day and for how many of their chains in a row no surface was built."""
    days = X.slices(spark, d).select("ticker", F.col("as_of").alias("date")).distinct()
    built = days.where(((F.month("date") + F.length("ticker")) % 5 != 0) | (F.year("date") < 1995))
    return Q.check_surfaces(days, built, best_effort=["ASIA"])


@query(f"""WITH {X.BARS_SQL}, {X.SLICES_SQL}, f AS (SELECT ticker, as_of, median(rmse) AS rmse, avg((source = 'parity')::INT) AS parity, min("T") AS t FROM slices WHERE month(as_of) % 3 <> 0 GROUP BY 1, 2), dy AS (SELECT DISTINCT ticker, as_of FROM slices)
SELECT dy.ticker, count(*) AS chains, count(rmse) AS surfaces, count(*) - count(rmse) AS missing, round(median(rmse), 8) AS rmse, round(avg(parity), 6) AS parity, round(min(t), 6) AS "least_T" FROM dy LEFT JOIN f USING (ticker, as_of) GROUP BY 1""")
def surface_status(spark, d):
    """Chains, surfaces and fit figures per ticker."""
    s = X.slices(spark, d).withColumn("date", F.col("as_of"))
    out = Q.surface_status(s.select("ticker", "date"), s.where(F.month("as_of") % 3 != 0))
    return out.withColumns({"rmse": r("rmse", 8), "parity": r("parity"), "least_T": r("least_T")})


@query(f"WITH {X.IDX_SQL} SELECT count(*) AS rows, min(date) AS first, max(date) AS last, round(count(vix) / count(*), 6) AS vix_share, round(count(skew) / count(*), 6) AS skew_share FROM wide")
def index_status(spark, d):
    return rounded(Q.table_status(X.index_wide(spark, d), ["vix", "skew"]), "vix_share", "skew_share")


@query(f"""WITH {X.IDX_SQL}, a AS (SELECT date, vix, vix3m FROM (SELECT *, row_number() OVER (ORDER BY date DESC) AS n FROM wide) WHERE n <= 63 AND vix IS NOT NULL AND vix3m IS NOT NULL), b AS (SELECT *, vix - lag(vix) OVER (ORDER BY date) AS da, vix3m - lag(vix3m) OVER (ORDER BY date) AS db FROM a),
c AS (SELECT count(*) AS n, corr(da, db) AS change_corr, avg(abs(vix - vix3m)) AS mean_abs_diff, arg_max(abs(vix - vix3m), date) AS latest_gap FROM b)
SELECT 'accuracy' AS "check", n < 20 OR (change_corr >= 0.8 AND mean_abs_diff <= 1.5 AND latest_gap <= 3) AS ok, n, round(change_corr, 6) AS change_corr, round(mean_abs_diff, 6) AS mean_abs_diff, round(latest_gap, 6) AS latest_gap FROM c""")
def check_accuracy(spark, d):
    """Our series against an outside one over the last 63 rows."""
    return rounded(Q.check_accuracy(X.index_wide(spark, d), "vix", "vix3m"), "change_corr", "mean_abs_diff", "latest_gap")


@query(f"WITH {X.BARS_SQL}, {X.IDX_SQL} SELECT 'features' AS \"check\", (SELECT max(date) FROM bars) >= (SELECT max(date) FROM wide) AS ok, (SELECT max(date) FROM bars) AS ends, (SELECT max(date) FROM wide) AS wanted")
def check_newest(spark, d):
    return Q.check_newest("features", X.bars(spark, d), X.index_wide(spark, d))


@query("""SELECT o_orderkey, o_orderdate::DATE AS as_of, o_orderdate::DATE + (o_orderkey % 90)::INT AS expiration, s AS option_type, (o_custkey % 500)::DOUBLE AS strike, (o_orderkey % 7)::DOUBLE * 0.1 + CASE WHEN s = 'put' THEN 0.05 ELSE 0 END AS implied_volatility_market, (o_orderkey % 10)::DOUBLE AS bid, (o_orderkey % 10)::DOUBLE + 1 AS ask,
 (o_orderkey % 10)::DOUBLE + 0.5 AS mid, round((o_orderkey % 90) / 365.0, 9)::DOUBLE AS "T", 'SPY' AS ticker FROM orders, (SELECT unnest(['call', 'put']) AS s) WHERE o_orderkey % 90 > 0 AND (s = 'put' OR o_orderkey % 7 > 0)""")
def vendor_wide(spark, d):
    """A vendor's wide table with bracketed headers as a chain."""
    o, k = X.table(spark, d, "orders"), F.col("o_orderkey")
    iv = (k % 7).cast("double") * 0.1
    bid = (k % 10).cast("double")
    raw = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("[QUOTE_DATE]"), F.date_format(F.date_add("o_orderdate", (k % 90).cast("int")), "yyyy-MM-dd").alias(" [EXPIRE_DATE]"), (F.col("o_custkey") % 500).cast("string").alias("[STRIKE]"), iv.alias("[C_IV]"), (iv + 0.05).alias("[P_IV]"), bid.alias("[C_BID]"), (bid + 1).alias("[C_ASK]"), bid.alias("[P_BID]"), (bid + 1).alias("[P_ASK]"))
    out = V.normalised(raw, keep=("o_orderkey",))
    return out.select("o_orderkey", "as_of", "expiration", "option_type", "strike", "implied_volatility_market", "bid", "ask", "mid", r("T", 9).alias("T"), "ticker")


@query("""WITH c AS (SELECT o_orderdate::DATE AS date, avg(o_totalprice) AS close FROM orders WHERE o_orderkey % 3 > 0 GROUP BY 1)
SELECT o_orderkey, o_orderdate::DATE AS as_of, o_orderdate::DATE + (o_orderkey % 50)::INT AS expiration, CASE o_orderkey % 3 WHEN 0 THEN 'call' ELSE 'put' END AS option_type, (o_custkey % 500)::DOUBLE AS strike, CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 10)::DOUBLE END AS bid, (o_orderkey % 10)::DOUBLE + 1 AS ask,
 CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 10)::DOUBLE + 0.5 END AS mid, round(close, 6) AS underlying_price FROM orders JOIN c ON c.date = o_orderdate::DATE WHERE o_orderkey % 50 > 0 AND o_orderkey % 3 < 2""")
def vendor_records(spark, d):
    """A vendor's records of strings, with closes from elsewhere."""
    o, k = X.table(spark, d, "orders"), F.col("o_orderkey")
    text = lambda c: c.cast("string")
    rec = F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.date_format(F.date_add("o_orderdate", (k % 50).cast("int")), "yyyy-MM-dd").alias("expiration"), text(F.col("o_custkey") % 500).alias("strike"), F.when(k % 3 == 0, "Call").when(k % 3 == 1, " put").otherwise("bond").alias("type"), F.when(k % 5 == 0, "n/a").otherwise(text(k % 10)).alias("bid"), text(k % 10 + 1).alias("ask"), F.lit("0.2").alias("implied_volatility")))
    records = o.select(k, F.from_json(rec, V.RECORD).alias("r")).select("o_orderkey", "r.*")
    spots = o.where(k % 3 > 0).groupBy(F.to_date("o_orderdate").alias("date")).agg(F.avg("o_totalprice").alias("close"))
    out = V.normalise_records(records, spots, keep=("o_orderkey",))
    return out.select("o_orderkey", "as_of", "expiration", "option_type", "strike", "bid", "ask", "mid", r("underlying_price", 6).alias("underlying_price"))


@query("""WITH p AS (SELECT o_custkey, (o_orderdate + INTERVAL 30 YEAR)::DATE AS as_of, o_orderkey FROM orders WHERE o_orderkey % 2 = 0)
SELECT o_orderkey::VARCHAR AS ticker, as_of, as_of + (20 + o_custkey % 9)::INT AS expiration, CASE WHEN o_custkey % 2 = 0 THEN 'call' ELSE 'put' END AS option_type, (o_custkey % 900)::DOUBLE / 8 AS strike, 1.5::DOUBLE AS bid, 2.5::DOUBLE AS ask, 2.0::DOUBLE AS mid, CASE WHEN o_custkey % 4 > 0 THEN (o_custkey % 4)::DOUBLE END AS implied_volatility_market,
 CASE WHEN o_custkey % 3 > 0 THEN (o_custkey % 3)::DOUBLE ELSE 7.0 END AS underlying_price FROM p""")
def vendor_payloads(spark, d):
    """A vendor's delayed quotes, nested JSON with option symbols, as a chain."""
    o, c = X.table(spark, d, "orders").where("o_orderkey % 2 = 0"), F.col("o_custkey")
    day = F.add_months(F.to_date("o_orderdate"), 360)  # two digits of a year are of this century
    expiry = F.date_add(day, (20 + c % 9).cast("int"))
    symbol = F.concat(F.lit("SPX"), F.date_format(expiry, "yyMMdd"), F.when(c % 2 == 0, "C").otherwise("P"), F.lpad((c % 900 * 125).cast("string"), 8, "0"))
    option = F.struct(symbol.alias("option"), F.lit(1.5).alias("bid"), F.lit(2.5).alias("ask"), (c % 4).cast("double").alias("iv"), F.lit(3.0).alias("open_interest"))
    body = F.to_json(F.struct(F.struct(F.lit("SPX").alias("symbol"), (c % 3).cast("double").alias("current_price"), F.lit(7.0).alias("close"), F.array(option).alias("options")).alias("data")))
    out = V.delayed_quotes(o.select(F.col("o_orderkey").cast("string").alias("ticker"), day.alias("as_of"), body.alias("payload")))
    return out.select("ticker", "as_of", "expiration", "option_type", "strike", "bid", "ask", "mid", "implied_volatility_market", "underlying_price")


_EDGES_SQL = f"""WITH {X.BARS_SQL}, {X.SLICES_SQL}, ed AS (SELECT *, (h + round(100 * "T")::INT) % 6 AS n FROM (SELECT s.*, dayofyear(as_of) AS h FROM slices s)),
v AS (SELECT CASE n WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 10 WHEN 3 THEN 10.5 WHEN 4 THEN 5 ELSE 0.2 END::DOUBLE AS iv, CASE n WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -1 ELSE 20 END::DOUBLE AS vix, "T", spot FROM ed)"""


@query(f"""{_EDGES_SQL}, c AS (SELECT count(*) AS n, count(*) FILTER (iv <= 0 OR iv > 10) AS a, count(*) FILTER (NOT coalesce(iv > 0 AND iv <= 5, false)) AS b, count(*) FILTER (vix < 0) AS c FROM v)
SELECT unnest(['normalised chain', 'surface grid', 'index']) AS "table", unnest(['implied_volatility', 'implied_volatility', 'vix']) AS rule, n AS rows, unnest([a, b, c]) AS failed FROM c""")
def rule_edges(spark, d):
    """Values on the edges of the rules of chains, grids and indices: 0, null and the upper bounds."""
    n = F.expr("(dayofyear(as_of) + cast(round(100 * T) as int)) % 6")
    pick = lambda *v: F.get(F.array(*[F.lit(x).cast("double") for x in v]), n)
    f = X.slices(spark, d).select("T", F.col("as_of").alias("date"), pick(None, 0, 10, 10.5, 5, 0.2).alias("implied_volatility"), pick(None, 0, -1, 20, 20, 20).alias("vix"))
    rules = {("normalised chain", "implied_volatility"): Q.normalised_chain_rules()["implied_volatility"], ("surface grid", "implied_volatility"): Q.surface_grid_rules()["implied_volatility"], ("index", "vix"): Q.index_rules(["date", "vix"])["vix"]}
    out = Q.violations(f, {f"{t}/{c}": rule for (t, c), rule in rules.items()})
    return out.select(F.split("rule", "/")[0].alias("table"), F.split("rule", "/")[1].alias("rule"), "rows", "failed")


@query(f"""{_FLAWED}, f1 AS (SELECT ticker, as_of, CASE WHEN month(as_of) % 2 = 0 AND open_interest < 25 THEN 0 ELSE bid END AS bid, ask FROM flawed WHERE month(as_of) <> 5), f2 AS (SELECT ticker, as_of, bid, ask FROM flawed WHERE month(as_of) % 4 <> 0),
a AS (SELECT ticker, as_of, count(*) AS n, count(*) FILTER (bid > 0 AND ask > 0) AS two FROM f1 GROUP BY 1, 2), b AS (SELECT ticker, as_of, count(*) AS n, count(*) FILTER (bid > 0 AND ask > 0) AS two FROM f2 GROUP BY 1, 2)
SELECT ticker, as_of, CASE WHEN coalesce(a.two >= 0.6 * a.n, false) OR coalesce(b.two, 0) <= coalesce(a.two, 0) THEN 'first' ELSE 'second' END AS source, CASE WHEN coalesce(a.two >= 0.6 * a.n, false) OR coalesce(b.two, 0) <= coalesce(a.two, 0) THEN a.n ELSE b.n END AS rows FROM a FULL JOIN b USING (ticker, as_of)""")
def chosen_source(spark, d):
    """Of two vendors' chains the first, unless it is empty or thin and the second has more two-sided quotes."""
    from volframe.sources.vendors import better_source

    c = X.flawed_chain(spark, d).select("ticker", "as_of", "bid", "ask", "open_interest")
    thin = (F.month("as_of") % 2 == 0) & (F.col("open_interest") < 25)
    first = c.where(F.month("as_of") != 5).withColumn("bid", F.when(thin, 0.0).otherwise(F.col("bid"))).withColumn("source", F.lit("first"))
    second = c.where(F.month("as_of") % 4 != 0).withColumn("source", F.lit("second"))
    return better_source(first, second).groupBy("ticker", "as_of", "source").agg(F.count("*").alias("rows"))


@query(f"""WITH {X.BARS_SQL}, {X.IDX_SQL}, {X.RATES_SQL}, {X.MACRO_SQL}, b AS (SELECT count(*) AS n, min(date) AS a, max(date) AS z FROM bars), i AS (SELECT count(*) AS n, min(date) AS a, max(date) AS z, avg((vix IS NOT NULL)::INT) AS f FROM wide WHERE date < (SELECT z - 40 FROM b)),
r AS (SELECT count(*) AS n, min(date) AS a, max(date) AS z, min(rate) AS lo, max(rate) AS hi FROM rates), m AS (SELECT count(*) AS n, min(mdate) AS a, max(mdate) AS z FROM macro WHERE mdate < (SELECT min(mdate) + 21 FROM macro)),
late AS (SELECT count(*) AS k FROM (SELECT unnest(generate_series((SELECT z + 1 FROM i), (SELECT z FROM b), INTERVAL 1 DAY))::DATE AS day) WHERE isodow(day) <= 5)
SELECT * FROM (VALUES ('tables', 'prices', true), ('tables', 'indices', NULL), ('tables', 'rates', NULL), ('tables', 'thin', false), ('tables', 'absent', false), ('tables', 'broken', false), ('run', 'run', false), ('freshness', 'freshness', NULL)) v(section, "check", ok0)
JOIN (SELECT 'prices' AS c, n AS rows, a AS first, z AS last, NULL::DOUBLE AS figure, true AS ok FROM b UNION ALL SELECT 'indices', n, a, z, round(f, 6), (SELECT k FROM late) <= 1 FROM i UNION ALL SELECT 'rates', n, a, z, round(hi, 6), lo >= -0.05 AND hi <= 0.3 FROM r
 UNION ALL SELECT 'thin', n, a, z, NULL, false FROM m UNION ALL SELECT 'absent', NULL, NULL, NULL, NULL, false UNION ALL SELECT 'broken', NULL, NULL, NULL, NULL, false UNION ALL SELECT 'run', NULL, NULL, NULL, NULL, false
 UNION ALL SELECT 'freshness', NULL, NULL, NULL, NULL, (SELECT count(*) FROM (SELECT ticker, max(date) AS l FROM bars GROUP BY 1) WHERE (SELECT count(*) FROM (SELECT unnest(generate_series(l + 1, (SELECT z FROM b), INTERVAL 1 DAY))::DATE AS day) WHERE isodow(day) <= 5) > 0) = 0) x ON x.c = v."check" """.replace("SELECT * FROM (VALUES", "SELECT section, \"check\", rows, first, last, figure, ok FROM (VALUES"))
def health_report(spark, d):
    """Tables of different shape, one stale, one thin, one absent and one broken, beside a run and a check of freshness."""
    from volframe.operators import health as H

    bars, wide = X.bars(spark, d), X.index_wide(spark, d)
    last = bars.agg(F.max("date")).first()[0]
    macro, day = X.macro(spark, d), F.lit(last).cast("date")
    start = macro.agg(F.min("date")).first()[0]
    tables = [
        H.Table("prices", lambda: bars),
        H.Table("indices", lambda: wide.where(F.col("date") < F.date_sub(day, 40)), figures={"share": F.avg(F.col("vix").isNotNull().cast("double"))}, reaches="prices", most_behind=1),
        H.Table("rates", lambda: X.rates(spark, d), figures={"lo": F.min("rate"), "hi": F.max("rate")}, least={"lo": -0.05}, most={"hi": 0.3}, reaches="prices", most_behind=9999),
        H.Table("thin", lambda: macro.where(F.col("date") < F.date_add(F.lit(start), 21)), least_rows=20, reaches="prices", most_behind=9999),
        H.Table("absent", lambda: spark.read.parquet(f"{d}/nowhere.parquet")),
        H.Table("broken", lambda: bars.withColumn("date", F.when(F.col("close") > 0, F.raise_error(F.lit("damaged"))).otherwise(F.col("date")))),
    ]
    fresh = lambda: H.as_report("freshness", Q.check_freshness(bars.select("ticker", "date"), X.sessions(spark, d), bars.select("ticker").distinct()), "check", "ok", "problems")
    rows = H.report(H.table_checks(spark, tables, last), H.run_check(spark, ["Market closed today", "no quotes for ASIA"]), H.guarded(spark, "freshness", fresh))
    return rows.select("section", "check", "rows", "first", "last", r(F.coalesce(F.try_element_at("figures", F.lit("share")), F.try_element_at("figures", F.lit("hi")))).alias("figure"), "ok")
