"""Queries of the batch build of surfaces, over a chain with planted bad days, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from volframe.functions import pricing as P
from volframe.operators import corpus as C
from volframe.plans.registry import K_GRID, T_GRID, query, r
from volframe.plans.surfaces import _GRID_SQL
from volframe.sources import fixtures as X


def _planted(spark, d):
    """(chain, wanted, done): of eight days seven have a fault, or are there already, by the day of the year."""
    c = X.chain(spark, d).withColumn("n", F.dayofyear("as_of") % 8)
    wild = P.with_black76(c.withColumn("wild", F.lit(3.5)), "wild_mid", "forward", "strike", "T", "wild", "discount", F.col("option_type") == "call")
    mid = F.when(F.col("n") == 3, F.col("wild_mid")).otherwise(F.col("mid"))
    few = F.when(F.col("n") == 1, F.col("T").isin(0.25, 0.5, 1.0)).when(F.col("n") == 2, F.col("T") == 1.0).otherwise(F.col("n") != 5)
    chain = wild.where(few).select("ticker", F.col("as_of").alias("date"), "expiration", "T", "strike", "option_type", (mid * F.when(F.col("n") == 4, 1.02).otherwise(0.98)).alias("bid"), (mid * F.when(F.col("n") == 4, 0.98).otherwise(1.02)).alias("ask"), F.when(F.col("n") != 0, F.col("spot")).alias("underlying_price"))
    w = Window.partitionBy("ticker", F.date_trunc("month", "date")).orderBy("date")
    wanted = X.bars(spark, d).withColumn("_n", F.row_number().over(w)).where("_n = 1").select("ticker", "date")
    return chain, wanted, wanted.where(F.dayofyear("date") % 8 == 6)


def _outcomes(spark, d):
    chain, wanted, done = _planted(spark, d)
    return C.build(chain, wanted, K_GRID, T_GRID, X.rates(spark, d), (0.25, 1.0, 10.0), done)[1].withColumn("reason", F.regexp_replace("message", " [0-9.]+$", ""))


_OUTCOMES_SQL = f"""WITH {X.BARS_SQL}, {X.RATES_SQL}, w AS (SELECT ticker, date, close, dayofyear(date) % 8 AS n FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date_trunc('month', date) ORDER BY date) AS k FROM bars) WHERE k = 1),
a AS (SELECT w.*, rate AS r25 FROM w ASOF LEFT JOIN (SELECT date AS t, rate FROM rates WHERE tenor_years = 0.25) ON date >= t),
b AS (SELECT a.*, rate AS r1 FROM a ASOF LEFT JOIN (SELECT date AS t, rate FROM rates WHERE tenor_years = 1.0) ON date >= t),
c AS (SELECT b.*, rate AS r10 FROM b ASOF LEFT JOIN (SELECT date AS t, rate FROM rates WHERE tenor_years = 10.0) ON date >= t),
oc AS (SELECT ticker, date, CASE WHEN n IN (0, 2, 4, 5) THEN 'failed' WHEN n IN (1, 3) THEN 'rejected' WHEN n = 6 THEN 'skipped' ELSE 'built' END AS status,
 CASE n WHEN 0 THEN 'no underlying price' WHEN 1 THEN 'only 3 expiries fitted (need 4)' WHEN 2 THEN 'only 1 expiries could be fitted (need 2)' WHEN 3 THEN 'implausible largest volatility' WHEN 4 THEN 'only 0 expiries could be fitted (need 2)' WHEN 5 THEN 'no chain rows' WHEN 6 THEN 'already there' END AS reason,
 CASE n WHEN 1 THEN 132 WHEN 2 THEN 44 WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE 220 END AS n_chain_rows, CASE WHEN n NOT IN (0, 5, 6) THEN close END AS spot, CASE WHEN n NOT IN (5, 6) THEN coalesce(r25, r1, r10, 0.05) END AS r,
 CASE WHEN n = 7 THEN 5 END AS n_slices, CASE WHEN n = 7 THEN true END AS sane FROM c)"""


@query(f"{_OUTCOMES_SQL} SELECT ticker, date, status, reason, n_chain_rows, round(spot, 6) AS spot, round(r, 6) AS r, n_slices, sane FROM oc")
def corpus_outcomes(spark, d):
    """Every snapshot of the build with its outcome; sane tells that the figures of a built surface are those of the smile."""
    o, built = _outcomes(spark, d), F.col("status") == "built"
    sane = (F.abs(F.col("atm_3m") - 0.2025) < 0.02) & (F.abs(F.col("atm_1y") - 0.21) < 0.02) & F.col("skew_3m").between(0.0, 0.1) & (F.col("fit_rmse") < 0.005) & (F.col("nan_fraction") == 0) & (F.col("parity_fraction") == 1) & F.col("observed_fraction").between(0.05, 1)
    return o.select("ticker", "date", "status", "reason", "n_chain_rows", r("spot").alias("spot"), r("r").alias("r"), F.when(built, F.col("n_slices")).alias("n_slices"), F.when(built, sane).alias("sane"))


@query(f"{_OUTCOMES_SQL} SELECT ticker, status, reason, count(*) AS snapshots FROM oc GROUP BY 1, 2, 3")
def corpus_report(spark, d):
    """Counts of the build by status and reason."""
    return _outcomes(spark, d).groupBy("ticker", "status", "reason").agg(F.count("*").alias("snapshots"))


_TENSOR_SQL = f"""{_GRID_SQL}, v AS (SELECT ticker, as_of, k, tenor, sqrt(w / tenor) AS iv, observed FROM g WHERE NOT (dayofyear(as_of) % 6 = 0 AND k > 0.1)),
sh AS (SELECT ticker, as_of FROM v GROUP BY 1, 2 HAVING count(*) = 200), t AS (SELECT v.*, dense_rank() OVER (PARTITION BY ticker ORDER BY as_of) AS day FROM v JOIN sh USING (ticker, as_of))"""


@query(f"""{_TENSOR_SQL} SELECT a.ticker, a.as_of AS date, round(a.k, 6) AS k, round(a.tenor, 6) AS tenor, round(a.iv, 6) AS iv, a.observed, round(a.iv - b.iv, 6) AS change
FROM t a LEFT JOIN t b ON b.ticker = a.ticker AND b.k = a.k AND b.tenor = a.tenor AND b.day = a.day - 1""")
def surface_history(spark, d):
    """Surfaces as tensors over days, those of another shape left out; unfolded again with the change from the day before."""
    from volframe.operators import surface as S

    g = S.total_variance(X.slices(spark, d), K_GRID, T_GRID).withColumnRenamed("as_of", "date")
    g = g.where(~((F.dayofyear("date") % 6 == 0) & (F.col("k") > 0.1)))
    t = C.changes(C.same_shape(C.history(g, len(K_GRID), len(T_GRID))))
    rows = t.select("ticker", "date", "t_grid", F.explode(F.arrays_zip("k_grid", "values", "observed", F.coalesce("change", F.array_repeat(F.lit(None).cast("array<double>"), F.size("values"))).alias("change"))).alias("x"))
    cells = rows.select("ticker", "date", F.col("x.k_grid").alias("k"), F.explode(F.arrays_zip("t_grid", "x.values", "x.observed", F.coalesce("x.change", F.array_repeat(F.lit(None).cast("double"), F.size("t_grid"))).alias("change"))).alias("y"))
    return cells.select("ticker", "date", r("k").alias("k"), r("y.t_grid").alias("tenor"), r("y.values").alias("iv"), F.col("y.observed").alias("observed"), r("y.change").alias("change"))


@query(f"""{_TENSOR_SQL} SELECT ticker, as_of AS date, round(iv, 6) AS value, observed, round(iv - lag(iv) OVER (PARTITION BY ticker ORDER BY as_of), 6) AS change FROM t WHERE abs(k) < 1e-9 AND abs(tenor - 30.0 / 365) < 1e-9""")
def surface_point_series(spark, d):
    """The 30-day at-the-money volatility of each tensor, and its changes."""
    from volframe.operators import surface as S

    g = S.total_variance(X.slices(spark, d), K_GRID, T_GRID).withColumnRenamed("as_of", "date")
    g = g.where(~((F.dayofyear("date") % 6 == 0) & (F.col("k") > 0.1)))
    s = C.series(C.same_shape(C.history(g, len(K_GRID), len(T_GRID))), 16, 2)
    return s.select("ticker", "date", r("value").alias("value"), "observed", r(F.col("value") - F.lag("value").over(Window.partitionBy("ticker").orderBy("date"))).alias("change"))
