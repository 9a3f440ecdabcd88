"""Queries that write stores and read them back, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from volframe.plans.registry import query, r
from volframe.sources import fixtures as X
from volframe.sources.store import kept, scratch
from volframe.sources.tables import Tables
from volframe.streaming.ingest import file_stream, upsert_stream, upserted


@query(f"""WITH {X.BARS_SQL}, old AS (SELECT ticker, date, close, volume FROM bars WHERE date < DATE '1997-06-01'), new AS (SELECT ticker, date, CASE WHEN dayofyear(date) % 3 = 0 THEN NULL ELSE close * 1.01 END AS close, adj_close FROM bars WHERE date >= DATE '1996-06-01' AND ticker <> 'ASIA')
SELECT coalesce(n.ticker, o.ticker) AS ticker, coalesce(n.date, o.date) AS date, round(coalesce(n.close, o.close), 6) AS close, round(adj_close, 6) AS adj_close, volume FROM new n FULL JOIN old o ON n.ticker = o.ticker AND n.date = o.date
WHERE coalesce(n.ticker, o.ticker) IN ('ASIA', 'EUROPE', 'AFRICA') AND coalesce(n.date, o.date) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""")
def price_store(spark, d):
    """Prices saved in two overlapping batches with different columns and gaps, then read for some tickers and years."""
    t, b = Tables(spark, scratch(spark)), kept(X.bars(spark, d))
    t.save("prices", b.where("date < '1997-06-01'").select("ticker", "date", "close", "volume"))
    close = F.when(F.dayofyear("date") % 3 != 0, F.col("close") * 1.01).alias("close")
    t.save("prices", b.where("date >= '1996-06-01' and ticker <> 'ASIA'").select("ticker", "date", close, "adj_close"))
    out = t.load("prices", ["ASIA", "EUROPE", "AFRICA"], "1996-01-01", "1998-12-31")
    return out.select("ticker", "date", r("close").alias("close"), r("adj_close").alias("adj_close"), "volume")


@query(f"""WITH {X.BARS_SQL}, {X.RATES_SQL}, b AS (SELECT DISTINCT date FROM bars WHERE month(date) = 3), k AS (SELECT * FROM rates WHERE month(date) <> 2 OR tenor_years <> 1.0),
a AS (SELECT date, rate AS r25 FROM b ASOF LEFT JOIN (SELECT date AS t, rate FROM k WHERE tenor_years = 0.25) ON date >= t),
c AS (SELECT date, r25, rate AS r1 FROM a ASOF LEFT JOIN (SELECT date AS t, rate FROM k WHERE tenor_years = 1.0) ON date >= t)
SELECT date, round(coalesce(r25 + (r1 - r25) * (0.4 - 0.25) / 0.75, r25, r1, 0.05), 6) AS rate FROM c""")
def rate_store(spark, d):
    """The rate of a tenor between two others, from a store of curves written year by year."""
    t, rates = Tables(spark, scratch(spark)), kept(X.rates(spark, d).where("tenor_years < 5 and (month(date) <> 2 or tenor_years <> 1.0)"))
    for part in ("year(date) < 1996", "year(date) >= 1996"):
        t.save("rates", rates.where(part))
    days = X.bars(spark, d).select("date").where("month(date) = 3").distinct()
    return t.rate(days, 0.4, 0.05).select("date", r("rate").alias("rate"))


@query("""WITH o AS (SELECT r_name AS ticker, o_orderdate::DATE AS announced, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
a AS (SELECT ticker, announced, max(o_orderkey) AS k FROM o WHERE o_orderkey % 3 = 0 GROUP BY 1, 2), b AS (SELECT ticker, announced, max(o_orderkey) AS k FROM o WHERE o_orderkey % 3 = 1 AND ticker IN ('ASIA', 'EUROPE') GROUP BY 1, 2)
SELECT * FROM a WHERE ticker NOT IN (SELECT ticker FROM b) UNION ALL SELECT * FROM b""")
def earnings_store(spark, d):
    """Releases by ticker: a second fetch replaces all of a ticker's and leaves the others."""
    c = X.table(spark, d, "customer").join(X.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(X.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    o = X.table(spark, d, "orders").join(c.select("c_custkey", F.col("r_name").alias("ticker")), F.col("o_custkey") == F.col("c_custkey"))
    o = kept(o.select("ticker", F.col("o_orderdate").cast("date").alias("announced"), F.col("o_orderkey").alias("k")))
    t = Tables(spark, scratch(spark))
    t.save("earnings", o.where("k % 3 = 0"))
    t.save("earnings", o.where("k % 3 = 1 and ticker in ('ASIA', 'EUROPE')"))
    return t.load("earnings").select("ticker", "announced", "k")


@query("""WITH o AS (SELECT o_custkey AS k, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice::DOUBLE END AS price, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status FROM orders)
SELECT k, round(max_by(price, o_orderkey) FILTER (WHERE price IS NOT NULL), 6) AS price, max(o_orderkey) FILTER (WHERE price IS NOT NULL) AS price_of,
max_by(status, o_orderkey) FILTER (WHERE status IS NOT NULL) AS status, max(o_orderkey) FILTER (WHERE status IS NOT NULL) AS status_of FROM o GROUP BY k""")
def stream_upserts(spark, d):
    """Last known cells per key of a table that two streams keep: the newer half of the rows comes first, the older one late."""
    target, orders = scratch(spark), X.table(spark, d, "orders")
    half = orders.agg(F.percentile_approx("o_orderkey", 0.5)).first()[0]
    price, status = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("double")), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))
    # a pattern, because a stream takes no single file
    stream = file_stream(spark, f"{d}/orders[.]parquet", orders.schema).select(F.col("o_custkey").alias("k"), "o_orderkey", price.alias("price"), status.alias("status"))
    for part in (F.col("o_orderkey") > half, F.col("o_orderkey") <= half) if half is not None else ():
        upsert_stream(stream.where(part), f"{target}/table", ["k"], "o_orderkey", f"{target}/{uuid.uuid4().hex}", buckets=16).awaitTermination()
    out = upserted(spark, f"{target}/table")
    if out is None:
        return orders.select(F.col("o_custkey").alias("k"), price.alias("price"), F.col("o_orderkey").alias("price_of"), status.alias("status"), F.col("o_orderkey").alias("status_of")).limit(0)
    return out.select("k", r("price").alias("price"), F.col("_version_price").alias("price_of"), "status", F.col("_version_status").alias("status_of"))
