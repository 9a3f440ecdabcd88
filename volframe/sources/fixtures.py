"""The domain's inputs as views over the given tables: bars, calendar, indices, macro series, rates, events, option chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from volframe.functions import pricing
from volframe.operators.timeseries import calendar

TENORS = (1 / 12, 0.25, 0.5, 1.0, 2.0)
STRIKES = 22
SERIES = {"1-URGENT": "vix", "2-HIGH": "vix3m", "3-MEDIUM": "vix9d", "4-NOT SPECIFIED": "vvix", "5-LOW": "skew"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per region from line items: partial aggregation before the only large shuffle.

    The region of a line item comes from its supplier; suppliers, nations and regions are joined first, and the optimizer
    picks how to join them by their sizes.
    """
    place = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    place = place.select("s_suppkey", F.col("r_name").alias("ticker"))
    day = F.col("l_shipdate").cast("date")
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", day.alias("date")).where(F.weekday("date") < 5)
    items = items.withColumn("p", 100 * F.pow(F.col("l_extendedprice") / F.col("l_quantity") / 10000, F.lit(0.02)))
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    out = items.join(place, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("ticker", "date")
    out = out.agg(F.min_by("p", order).alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", order).alias("close"), F.sum("l_quantity").alias("volume"))
    return out.select("ticker", "date", "open", "high", "low", "close", F.col("close").alias("adj_close"), "volume")


BARS_SQL = """
items AS (SELECT r_name AS ticker, l_shipdate::DATE AS date, 100 * pow(l_extendedprice / l_quantity / 10000, 0.02) AS p, l_quantity,
                 row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS o
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          WHERE isodow(l_shipdate) <= 5),
bars AS (SELECT ticker, date, arg_min(p, o) AS open, max(p) AS high, min(p) AS low, arg_max(p, o) AS close, arg_max(p, o) AS adj_close, sum(l_quantity) AS volume
         FROM items GROUP BY 1, 2)"""


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar(table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("date")))


CAL_SQL = """
span AS (SELECT min(l_shipdate)::DATE AS a, max(l_shipdate)::DATE AS b FROM lineitem),
cal AS (SELECT session, row_number() OVER (ORDER BY session) AS seq FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS session FROM span) WHERE isodow(session) <= 5)"""


def index_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for kv in SERIES.items() for x in kv])
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"), F.element_at(names, F.col("o_orderpriority")).alias("series"), "o_totalprice")
    return o.groupBy("date", "series").agg((F.avg("o_totalprice") / 10000).alias("value"))


IDX_SQL = """
idx AS (SELECT o_orderdate::DATE AS date, CASE o_orderpriority WHEN '1-URGENT' THEN 'vix' WHEN '2-HIGH' THEN 'vix3m' WHEN '3-MEDIUM' THEN 'vix9d' WHEN '4-NOT SPECIFIED' THEN 'vvix' ELSE 'skew' END AS series,
               avg(o_totalprice) / 10000 AS value FROM orders GROUP BY 1, 2),
wide AS (SELECT date, max(value) FILTER (series = 'vix') AS vix, max(value) FILTER (series = 'vix3m') AS vix3m, max(value) FILTER (series = 'vix9d') AS vix9d,
                max(value) FILTER (series = 'vvix') AS vvix, max(value) FILTER (series = 'skew') AS skew FROM idx GROUP BY 1)"""


def index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_long(spark, sf_dir).groupBy("date").pivot("series", list(SERIES.values())).agg(F.max("value"))


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly series dated Friday and published five days later."""
    day = F.col("o_orderdate").cast("date")
    friday = F.date_add(F.date_trunc("week", day).cast("date"), 4)
    return table(spark, sf_dir, "orders").groupBy(friday.alias("date")).agg((F.avg("o_totalprice") / 1000).alias("value")).withColumn("published", F.date_add("date", 5))


MACRO_SQL = """
macro AS (SELECT (date_trunc('week', o_orderdate)::DATE + 4) AS mdate, avg(o_totalprice) / 1000 AS value, (date_trunc('week', o_orderdate)::DATE + 9) AS published FROM orders GROUP BY 1, 3)"""


MORE_INDICES = ("vix1d", "vxn", "vxd", "ovx", "gvz", "move")


def market_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six further indices by date, with gaps."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"), (F.col("o_orderkey") % 6).alias("n"), "o_totalprice")
    return o.groupBy("date").agg(*[(F.avg(F.when(F.col("n") == i, F.col("o_totalprice"))) / 10000).alias(c) for i, c in enumerate(MORE_INDICES)])


MORE_SQL = "more AS (SELECT o_orderdate::DATE AS date, " + ", ".join(f"avg(o_totalprice) FILTER (o_orderkey % 6 = {i}) / 10000 AS {c}" for i, c in enumerate(MORE_INDICES)) + " FROM orders GROUP BY 1)"
MACRO_SERIES = ("HY_OAS", "IG_OAS", "USD_BROAD", "BREAKEVEN_10Y", "REAL_YIELD_10Y", "STLFSI", "NFCI")


def macro_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven macro series by the date they are for: daily ones with gaps, the last two on Fridays."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"), (F.col("o_custkey") % 7).alias("n"), "o_totalprice")
    value = lambda i: F.when(F.lit(i < 5) | (F.weekday("date") == 4), F.avg(F.when(F.col("n") == i, F.col("o_totalprice"))) / 1000)
    return o.groupBy("date").agg(*[value(i).alias(c) for i, c in enumerate(MACRO_SERIES)])


def macro_wide_sql(lags: dict[str, int]) -> str:
    """CTEs mw_<series>(published, value), a series each."""
    one = lambda i, c: f"mw_{c.lower()} AS (SELECT o_orderdate::DATE + {lags[c]} AS published, avg(o_totalprice) / 1000 AS value FROM orders WHERE o_custkey % 7 = {i}" + (" AND isodow(o_orderdate) = 5" if i >= 5 else "") + " GROUP BY 1)"
    return ", ".join(one(i, c) for i, c in enumerate(MACRO_SERIES))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, tenor_years, rate: three tenors from order status, 0 to 10 %."""
    years = F.when(F.col("o_orderstatus") == "F", 0.25).when(F.col("o_orderstatus") == "O", 1.0).otherwise(10.0)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"), years.alias("tenor_years"), "o_totalprice")
    return o.groupBy("date", "tenor_years").agg((F.avg("o_totalprice") / 5000000).alias("rate"))


RATES_SQL = """
rates AS (SELECT o_orderdate::DATE AS date, CASE o_orderstatus WHEN 'F' THEN 0.25 WHEN 'O' THEN 1.0 ELSE 10.0 END AS tenor_years, avg(o_totalprice) / 5000000 AS rate FROM orders GROUP BY 1, 2)"""


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, announced, hour: the first order of each region and quarter."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    o = table(spark, sf_dir, "orders").join(c.select("c_custkey", F.col("r_name").alias("ticker")), F.col("o_custkey") == F.col("c_custkey"))
    first = o.groupBy("ticker", F.date_trunc("quarter", "o_orderdate").alias("q")).agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("f"))
    return first.select("ticker", F.col("f.o_orderdate").cast("date").alias("announced"), F.pmod("f.o_orderkey", F.lit(24)).cast("int").alias("hour"))


RELEASES_SQL = """
releases AS (SELECT r_name AS ticker, (min(row(o_orderdate, o_orderkey))).a::DATE AS announced, ((min(row(o_orderdate, o_orderkey))).b % 24)::INT AS hour FROM (
    SELECT r_name, date_trunc('quarter', o_orderdate) AS q, {'a': o_orderdate, 'b': o_orderkey} AS s, o_orderdate, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY r_name, q)"""


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option chain with a known smile on the first session of each month: 5 tenors, 22 strikes, calls and puts."""
    w = Window.partitionBy("ticker", F.date_trunc("month", "date")).orderBy("date")
    spots = bars(spark, sf_dir).withColumn("n", F.row_number().over(w)).where("n = 1").select("ticker", F.col("date").alias("as_of"), F.col("close").alias("spot"))
    spots = spots.repartition(spark.sparkContext.defaultParallelism, "ticker", "as_of")  # few rows, each of which becomes 220 to be priced
    q = spots.withColumn("T", F.explode(F.array(*map(F.lit, TENORS)))).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(STRIKES - 1)))).withColumn("option_type", F.explode(F.array(F.lit("call"), F.lit("put"))))
    q = q.withColumn("k", -0.35 + F.col("i") * 0.53 / (STRIKES - 1)).withColumn("forward", F.col("spot") * F.exp(0.02 * F.col("T"))).withColumn("discount", F.exp(-0.04 * F.col("T")))
    q = q.withColumn("strike", F.col("forward") * F.exp("k")).withColumn("expiration", F.expr("date_add(as_of, cast(round(T * 365) as int))"))
    iv = 0.20 + 0.01 * F.col("T") - 0.025 * F.col("k") / F.sqrt(F.greatest(F.col("T"), F.lit(1 / 52))) + 0.06 * F.col("k") * F.col("k")
    q = pricing.with_black76(q.withColumn("iv", iv), "mid", "forward", "strike", "T", "iv", "discount", F.col("option_type") == "call")
    return q.withColumn("bid", F.col("mid") * 0.98).withColumn("ask", F.col("mid") * 1.02).withColumn("open_interest", F.pmod(F.col("i") * 37 + F.dayofyear("as_of"), F.lit(100))).drop("i")


SLICE_TENORS = (0.02, 0.08, 0.25, 0.5, 1.0, 2.0)


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smiles by formula on the first session of each month: what a fit of a chain gives, known to SQL as well."""
    w = Window.partitionBy("ticker", F.date_trunc("month", "date")).orderBy("date")
    spots = bars(spark, sf_dir).withColumn("n", F.row_number().over(w)).where("n = 1").select("ticker", F.col("date").alias("as_of"), F.col("close").alias("spot"))
    q = spots.select("*", F.dayofyear("as_of").alias("h"), F.posexplode(F.array(*map(F.lit, SLICE_TENORS))).alias("i", "T"))
    root = F.sqrt("T")
    return q.select(
        "ticker", "as_of", "spot", "T", (F.col("spot") * F.exp(0.02 * F.col("T"))).alias("forward"), F.when((F.col("h") + F.col("i")) % 4 == 0, "carry").otherwise("parity").alias("source"),
        (0.01 * F.col("T") + 0.0001 * (F.col("h") % 7)).alias("a"), (0.08 * root).alias("b"), (-0.5 + 0.02 * (F.col("h") % 10)).alias("rho"), (0.02 * root).alias("m"), (0.1 + 0.1 * root).alias("sigma"),
        (-0.30 * root - 0.15 * (F.col("h") % 3)).alias("k_min"), (0.2 * root + 0.1).alias("k_max"), (0.001 * (1 + (F.col("h") + F.col("i")) % 5)).alias("rmse"), F.expr("date_add(as_of, cast(round(T * 365) as int))").alias("expiration"),
    )


SLICES_SQL = """
first AS (SELECT ticker, date AS as_of, close AS spot, dayofyear(date) AS h FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date_trunc('month', date) ORDER BY date) AS n FROM bars) WHERE n = 1),
slices AS (SELECT ticker, as_of, spot, t AS "T", spot * exp(0.02 * t) AS forward, CASE WHEN (h + i) % 4 = 0 THEN 'carry' ELSE 'parity' END AS source,
    0.01 * t + 0.0001 * (h % 7) AS a, 0.08 * sqrt(t) AS b, -0.5 + 0.02 * (h % 10) AS rho, 0.02 * sqrt(t) AS m, 0.1 + 0.1 * sqrt(t) AS sigma,
    -0.30 * sqrt(t) - 0.15 * (h % 3) AS k_min, 0.2 * sqrt(t) + 0.1 AS k_max, (0.001 * (1 + (h + i) % 5))::DOUBLE AS rmse, as_of + round(t * 365)::INT AS expiration
    FROM first, (SELECT unnest([0.02::DOUBLE, 0.08, 0.25, 0.5, 1.0, 2.0]) AS t, unnest([0, 1, 2, 3, 4, 5]) AS i))"""


def ncdf_sql(x: str) -> str:
    """Normal distribution function in SQL, for a column or a short expression x."""
    z = f"abs({x})"
    num, den = pricing.NUM, pricing.DEN
    horner = lambda c: "(" * (len(c) - 1) + repr(c[0]) + "".join(f" * {z} + {v!r})" for v in c[1:])
    far = f"exp(-{z} * {z} / 2) / sqrt(2 * pi()) / ({z} + 1 / ({z} + 2 / ({z} + 3 / ({z} + 4 / ({z} + 0.65)))))"
    tail = f"CASE WHEN {z} > 37 THEN 0 WHEN {z} < 7.07106781186547 THEN exp(-{z} * {z} / 2) * {horner(num)} / {horner(den)} ELSE {far} END"
    return f"(CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END)"


def wing_sql(s: str, k: str) -> str:
    """Total variance of slice alias s at k, with tangents beyond its quoted strikes."""
    svi = lambda at: f"({s}.a + {s}.b * ({s}.rho * ({at} - {s}.m) + sqrt(pow({at} - {s}.m, 2) + pow({s}.sigma, 2))))"
    slope = lambda at: f"({s}.b * ({s}.rho + ({at} - {s}.m) / sqrt(pow({at} - {s}.m, 2) + pow({s}.sigma, 2))))"
    lo, hi = f"{s}.k_min", f"{s}.k_max"
    return f"(CASE WHEN {k} < {lo} THEN {svi(lo)} + least({slope(lo)}, 0) * ({k} - {lo}) WHEN {k} > {hi} THEN {svi(hi)} + greatest({slope(hi)}, 0) * ({k} - {hi}) ELSE {svi(k)} END)"


def variance_sql(k: str) -> str:
    """Total variance at k between slices l and h of a row with weight x and tenor tau."""
    return f"greatest(CASE WHEN l.\"T\" = h.\"T\" THEN {wing_sql('l', k)} * tau / l.\"T\" ELSE (1 - x) * {wing_sql('l', k)} + x * {wing_sql('h', k)} END, 1e-10)"


def brackets_sql(tenors: list[str]) -> str:
    """CTE br(ticker, as_of, tau, l, h, x, inside): the slices around each tenor as structs. Needs slices."""
    return f"""
tn AS (SELECT unnest([{', '.join(tenors)}])::DOUBLE AS tau),
ends AS (SELECT ticker, as_of, tau, min("T") AS t0, max("T") AS t1, max("T") FILTER ("T" < tau) AS below, min("T") FILTER ("T" >= tau) AS above FROM slices, tn GROUP BY 1, 2, 3),
near AS (SELECT *, CASE WHEN tau <= t0 THEN t0 WHEN tau >= t1 THEN t1 ELSE below END AS tl, CASE WHEN tau <= t0 THEN t0 WHEN tau >= t1 THEN t1 ELSE above END AS th, tau >= t0 - 1e-12 AND tau <= t1 + 1e-12 AS inside FROM ends),
br AS (SELECT n.ticker, n.as_of, tau, inside, l, h, CASE WHEN tl < th THEN (tau - tl) / (th - tl) ELSE 0 END AS x,
       (tl <> th OR abs(tau - tl) <= 1e-8 + 1e-5 * abs(tl)) AS in_t, greatest(l.k_min, h.k_min) AS qlo, least(l.k_max, h.k_max) AS qhi
       FROM near n JOIN slices l ON l.ticker = n.ticker AND l.as_of = n.as_of AND l."T" = tl JOIN slices h ON h.ticker = n.ticker AND h.as_of = n.as_of AND h."T" = th)"""


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, snapshot, event: at the start of each quarter with a release, the releases of the next 190 days, up to two days off."""
    s = releases(spark, sf_dir).select("ticker", "announced", F.date_trunc("quarter", "announced").cast("date").alias("q"))
    starts = s.select("ticker", F.col("q").alias("snapshot")).distinct()
    near = s.join(starts, "ticker").where((F.col("announced") >= F.col("snapshot")) & (F.col("announced") < F.date_add("snapshot", 190)))
    return near.select("ticker", "snapshot", F.expr("date_add(announced, cast((dayofyear(announced) + month(snapshot)) % 5 - 2 as int))").alias("event"))


def flawed_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain with rows dropped, doubled, crossed, one-sided, negative and wide, by an integer key that SQL has, too."""
    w = Window.partitionBy("ticker", F.date_trunc("month", "date")).orderBy("date")
    spots = bars(spark, sf_dir).withColumn("n", F.row_number().over(w)).where("n = 1").select("ticker", F.col("date").alias("as_of"), F.col("close").alias("spot"))
    q = spots.select("*", F.posexplode(F.array(*map(F.lit, TENORS))).alias("j", "T")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(STRIKES - 1)))).withColumn("c", F.explode(F.array(F.lit(0), F.lit(1))))
    q = q.withColumn("key", F.col("i") + 22 * F.col("c") + 44 * F.col("j") + 220 * F.dayofyear("as_of")).where("key % 17 <> 0")
    q = q.withColumn("copy", F.explode(F.expr("sequence(1, if(key % 13 = 0, 2, 1))")))
    mid = 1.0 + F.col("i")
    wide, crossed = F.col("key") % 7 == 0, F.col("key") % 11 == 0
    bid = F.when(F.col("key") % 19 == 0, None).when(F.col("key") % 23 == 0, -mid).when(wide, 0.5 * mid).when(crossed, 1.02 * mid).otherwise(0.98 * mid)
    ask = F.when(wide, 1.5 * mid).when(crossed, 0.98 * mid).otherwise(1.02 * mid)
    return q.select(
        "ticker", "as_of", "spot", "T", F.expr("date_add(as_of, cast(round(T * 365) as int))").alias("expiration"), (F.col("spot") * (0.7 + 0.025 * F.col("i"))).alias("strike"), F.when(F.col("c") == 0, "call").otherwise("put").alias("option_type"),
        bid.alias("bid"), ask.alias("ask"), mid.alias("mid"), (F.col("key") % 40).alias("open_interest"),
    )


FLAWED_SQL = """
ff AS (SELECT ticker, date AS as_of, close AS spot FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date_trunc('month', date) ORDER BY date) AS n FROM bars) WHERE n = 1),
fk AS (SELECT *, i + 22 * c + 44 * j + 220 * dayofyear(as_of) AS key, 1.0::DOUBLE + i AS mid FROM ff, (SELECT unnest([1.0::DOUBLE / 12, 0.25, 0.5, 1.0, 2.0]) AS tau, unnest([0, 1, 2, 3, 4]) AS j), (SELECT unnest(range(0, 22)) AS i), (SELECT unnest([0, 1]) AS c)),
flawed AS (SELECT ticker, as_of, spot, tau, as_of + round(tau * 365)::INT AS expiration, spot * (0.7 + 0.025 * i) AS strike, CASE WHEN c = 0 THEN 'call' ELSE 'put' END AS option_type, mid, key % 40 AS open_interest,
  CASE WHEN key % 19 = 0 THEN NULL WHEN key % 23 = 0 THEN -mid WHEN key % 7 = 0 THEN 0.5 * mid WHEN key % 11 = 0 THEN 1.02 * mid ELSE 0.98 * mid END AS bid, CASE WHEN key % 7 = 0 THEN 1.5 * mid WHEN key % 11 = 0 THEN 0.98 * mid ELSE 1.02 * mid END AS ask
  FROM fk, (SELECT unnest([1, 2]) AS copy) WHERE key % 17 <> 0 AND (copy = 1 OR key % 13 = 0))"""
