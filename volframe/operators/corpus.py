"""Batch build of surfaces: an outcome for every (ticker, day), whatever happens to one of them.

Every step is one distributed pass over all snapshots. A snapshot that cannot be built does not stop the job: it comes out
as a row with its status and the reason, and the surfaces of the others are written.

Statuses: built; skipped (the store has it from this builder); rejected (fitted, but not to be trusted); failed (nothing to
fit, or the fit raised).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from volframe.functions import pricing as P
from volframe.operators import expiry as E
from volframe.operators import surface as S
from volframe.operators.timeseries import asof_join
from volframe.sources import store

KEYS = ["ticker", "date"]
# fixed values: the tenor whose rate is kept with a surface, the rate without a curve, the fewest expiries of a surface
REFERENCE_TENOR, FALLBACK_RATE, LEAST_FITTED, LEAST_EXPIRIES = 0.25, 0.05, 2, 4
FIGURES = ["n_chain_rows", "spot", "r", "atm_3m", "atm_1y", "skew_3m", "iv_min", "iv_max", "nan_fraction", "n_slices", "fit_rmse", "observed_fraction", "parity_fraction"]


def curves(days: DataFrame, rates: DataFrame | None, tenors: Sequence[float]) -> DataFrame:
    """days(date) with `curve`: points (x tenor, y rate), of each tenor the last rate known on the day.

    rates(date, tenor_years, rate); tenors lists those that count. Without rates the curve is empty.
    """
    days = days.select("date").distinct()
    if rates is None:
        return days.withColumn("curve", F.array().cast("array<struct<x:double,y:double>>"))
    names = [f"_y{i}" for i in range(len(tenors))]
    wide = rates.groupBy(F.col("date").alias("_from")).agg(*[F.max(F.when(F.col("tenor_years") == t, F.col("rate"))).alias(n) for t, n in zip(tenors, names, strict=True)])
    out = asof_join(days, wide, "date", "_from", values=names)
    points = F.array(*[F.struct(F.lit(float(t)).alias("x"), F.col(n).cast("double").alias("y")) for t, n in sorted(zip(tenors, names, strict=True))])
    return out.select("date", F.filter(points, lambda p: p["y"].isNotNull()).alias("curve"))


def rate_at(t: Column, curve: str = "curve", fallback: float = FALLBACK_RATE) -> Column:
    return F.coalesce(P.interpolate(t, F.col(curve)), F.lit(fallback))


def grid_figures(slices: DataFrame, strikes: Sequence[float], tenors: Sequence[float]) -> DataFrame:
    """Per surface (ticker, as_of): figures of its standard grid, and volatilities read back from it."""
    g = S.calendar_filter(S.total_variance(slices, list(strikes), list(tenors)))
    bad = F.col("iv").isNull() | F.isnan("iv") | (F.abs("iv") == float("inf"))
    stats = g.groupBy("ticker", "as_of").agg(F.avg(bad.cast("double")).alias("nan_fraction"), F.min(F.when(~bad, F.col("iv"))).alias("iv_min"), F.max(F.when(~bad, F.col("iv"))).alias("iv_max"), F.avg(F.col("observed").cast("double")).alias("observed_fraction"))
    t = F.lit(0.25)
    read = E.from_long(g).withColumns({"_m": E.smile_at(F.col("points"), t), "_y": E.smile_at(F.col("points"), F.lit(1.0))})
    read = read.withColumns({"_put": E.smile_delta_strike(F.col("_m"), -0.25, t), "_call": E.smile_delta_strike(F.col("_m"), 0.25, t)})
    at = lambda smile, k: E.smile_iv(F.col(smile), k)
    read = read.select("ticker", "as_of", at("_m", F.lit(0.0)).alias("atm_3m"), at("_y", F.lit(0.0)).alias("atm_1y"), (at("_m", F.col("_put")) - at("_m", F.col("_call"))).alias("skew_3m"))
    return stats.join(read, ["ticker", "as_of"])


def build(chain: DataFrame, wanted: DataFrame, strikes: Sequence[float], tenors: Sequence[float], rates: DataFrame | None = None, rate_tenors: Sequence[float] = (), done: DataFrame | None = None, fallback: float = FALLBACK_RATE, keep: Callable[[DataFrame], DataFrame] = store.kept) -> tuple[DataFrame, DataFrame]:
    """(slices, outcomes) of the snapshots in wanted(ticker, date).

    chain has ticker, date, T, strike, option_type, bid, ask and underlying_price; a snapshot's spot is the median of it.
    Every expiry is discounted at its own tenor's rate, as known on the day. done(ticker, date) are left as they are.
    outcomes: ticker, date, status, message, and FIGURES as far as the build came. Slices are those of built surfaces.

    Repeated snapshots in wanted count once, rows of the chain without ticker or date belong to none; a quote that repeats
    enters the mean of its strike. An empty wanted gives no outcome. The fits are needed several times: keep says how.
    """
    keys = wanted.select(*KEYS).where(F.col("ticker").isNotNull() & F.col("date").isNotNull()).distinct()
    todo = keys if done is None else keys.join(done.select(*KEYS).distinct(), KEYS, "left_anti")
    if "underlying_price" not in chain.columns:
        chain = chain.withColumn("underlying_price", F.lit(None).cast("double"))
    own = chain.join(todo, KEYS, "left_semi")
    facts = own.groupBy(*KEYS).agg(F.count("*").alias("n_chain_rows"), F.median("underlying_price").alias("spot"))
    facts = facts.join(curves(facts, rates, rate_tenors), "date").withColumn("r", rate_at(F.lit(REFERENCE_TENOR), fallback=fallback))
    rows = own.drop("spot", "discount", "as_of").join(facts.where(F.col("spot").isNotNull()).select(*KEYS, "spot", "curve"), KEYS)
    rows = rows.withColumn("discount", F.exp(-rate_at(F.col("T"), fallback=fallback) * F.col("T"))).drop("curve").withColumnRenamed("date", "as_of")
    fits = keep(S.fit_outcomes(S.otm_quotes(rows)))
    good = fits.where("message is null").drop("message")
    per = fits.groupBy("ticker", "as_of").agg(F.count_if(F.col("message").isNull()).alias("n_slices"), F.min("message").alias("_raised"), F.median("rmse").alias("fit_rmse"), F.avg((F.col("source") == "parity").cast("double")).alias("parity_fraction"))
    per = per.join(grid_figures(good, strikes, tenors), ["ticker", "as_of"], "left").withColumnRenamed("as_of", "date")
    out = todo.join(facts.drop("curve"), KEYS, "left").join(per, KEYS, "left").withColumn("n_slices", F.coalesce("n_slices", F.lit(0).cast("long")))
    c = F.col
    failed = (
        F.when(c("n_chain_rows").isNull(), F.lit("no chain rows"))
        .when(c("spot").isNull(), F.lit("no underlying price"))
        .when(c("_raised").isNotNull(), c("_raised"))
        .when(c("n_slices") < LEAST_FITTED, F.concat(F.lit("only "), c("n_slices").cast("string"), F.lit(f" expiries could be fitted (need {LEAST_FITTED})")))
    )
    rejected = (
        F.when(c("iv_min").isNull(), F.lit("no finite volatility in the grid"))
        .when(c("nan_fraction") > 0.5, F.concat(F.round(100 * c("nan_fraction")).cast("int").cast("string"), F.lit("% of the grid is missing")))
        .when(c("iv_min") <= 0.01, F.concat(F.lit("implausible least volatility "), F.format_number("iv_min", 4)))
        .when(c("iv_max") > 3.0, F.concat(F.lit("implausible largest volatility "), F.format_number("iv_max", 4)))
        .when(c("n_slices") < LEAST_EXPIRIES, F.concat(F.lit("only "), c("n_slices").cast("string"), F.lit(f" expiries fitted (need {LEAST_EXPIRIES})")))
    )
    out = out.withColumn("message", F.coalesce(failed, rejected)).withColumn("status", F.when(failed.isNotNull(), "failed").when(rejected.isNotNull(), "rejected").otherwise("built"))
    accepted = c("status") == "built"  # figures of a grid that nobody trusts would only mislead
    out = out.withColumns({n: F.when(accepted, c(n)) for n in ("atm_3m", "atm_1y", "skew_3m")})
    out = out.select(*KEYS, "status", "message", *FIGURES)
    if done is not None:
        have = keys.join(done.select(*KEYS).distinct(), KEYS, "left_semi").withColumn("status", F.lit("skipped")).withColumn("message", F.lit("already there"))
        out = out.unionByName(have, allowMissingColumns=True)
    slices = good.withColumnRenamed("as_of", "date").join(out.where("status = 'built'").select(*KEYS, "spot", "r"), KEYS)
    return slices, out


def counts(outcomes: DataFrame) -> DataFrame:
    """Per ticker and status the number of snapshots; reasons of one kind are not told apart."""
    return outcomes.groupBy("ticker", "status").agg(F.count("*").alias("snapshots"))


def summary(outcomes: DataFrame) -> DataFrame:
    """One row: snapshots attempted, a map of counts by status, and figures of the surfaces built (null without any)."""
    b = F.col("status") == "built"
    by = outcomes.groupBy("status").agg(F.count("*").alias("n"), F.median(F.when(b, F.col("atm_3m"))).alias("atm_3m"), F.min(F.when(b, F.col("atm_3m"))).alias("lo"), F.max(F.when(b, F.col("atm_3m"))).alias("hi"), F.min(F.when(b, F.col("iv_min"))).alias("iv_min"), F.max(F.when(b, F.col("iv_max"))).alias("iv_max"))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("attempted"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("counts"), F.max("atm_3m").alias("atm_3m_median"), F.min("lo").alias("atm_3m_min"), F.max("hi").alias("atm_3m_max"), F.min("iv_min").alias("iv_min"), F.max("iv_max").alias("iv_max"))


def build_corpus(spark: SparkSession, chains: str, surfaces: str, strikes: Sequence[float], tenors: Sequence[float], tickers: Sequence[str] | None = None, dates: Sequence | None = None, start=None, end=None, overwrite: bool = False, builder: str = store.BUILDER, rates: DataFrame | None = None, rate_tenors: Sequence[float] = (), report: str | None = None) -> DataFrame:
    """Build the surfaces of a store of chains into a store of surfaces; the outcomes, staged.

    What the store has from this builder is skipped unless overwrite is set. A surface that was there and could not be built
    again is not kept: its partition is replaced by a row that names the reason and belongs to no builder, which readers of
    surfaces pass over. All partitions are replaced in one write, so a run that was cut off can be run again.

    Explicit dates are wanted of every ticker, whether or not there is a chain. Without a store of chains nothing is wanted.
    """
    if not store.exists(spark, chains):
        return spark.createDataFrame([], "ticker string, date date, status string, message string, " + ", ".join(f"{c} {'long' if c in ('n_chain_rows', 'n_slices') else 'double'}" for c in FIGURES))
    wanted = store.load(spark, chains, tickers, start, end).select(*KEYS).distinct()
    if dates is not None:
        days = spark.createDataFrame([(d,) for d in dates], "date date").where(F.lit(True) if start is None else F.col("date") >= F.lit(start).cast("date")).where(F.lit(True) if end is None else F.col("date") <= F.lit(end).cast("date"))
        names = spark.createDataFrame([(t,) for t in tickers], "ticker string") if tickers is not None else store.available(spark, chains).select("ticker").distinct()
        wanted = names.join(F.broadcast(days))  # a list that the caller wrote
    there = store.load_surfaces(spark, surfaces, None).select(*KEYS, "builder").distinct() if store.exists(spark, surfaces) else None
    done = None if overwrite or there is None else there.where(F.col("builder") == builder)
    slices, outcomes = build(store.load(spark, chains, tickers), wanted, strikes, tenors, rates, rate_tenors, done, keep=lambda f: store.staged(f, surfaces))
    outcomes = store.staged(outcomes, report or surfaces)
    rows = slices.withColumn("builder", F.lit(builder)).withColumn("rejected", F.lit(None).cast("string"))
    if there is not None:
        stale = outcomes.where(F.col("status").isin("rejected", "failed")).join(there.select(*KEYS).distinct(), KEYS, "left_semi")
        rows = rows.unionByName(stale.select(*KEYS, F.col("message").alias("rejected")), allowMissingColumns=True)
    store.replace(store.staged(rows, surfaces), surfaces)
    return outcomes


def history(grid: DataFrame, strikes: int, tenors: int, keys: Sequence[str] = ("ticker", "date"), value: str = "iv") -> DataFrame:
    """Long grid (keys, k, tenor, value, observed) as one row per surface: k_grid, t_grid, values and observed, both arrays
    of a row for each k. Points that repeat are averaged; surfaces that aren't a whole strikes x tenors grid are left out.
    """
    one = grid.groupBy(*keys, "k", "tenor").agg(F.avg(value).alias("v"), F.max("observed").alias("o"))
    rows = one.groupBy(*keys, "k").agg(F.array_sort(F.collect_list(F.struct("tenor", "v", "o"))).alias("row"))
    out = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", "row"))).alias("rows"))
    part = lambda f: F.transform("rows", lambda x: F.transform(x["row"], lambda y: y[f]))
    out = out.select(*keys, F.transform("rows", lambda x: x["k"]).alias("k_grid"), part("tenor").alias("_t"), part("v").alias("values"), part("o").alias("observed"))
    whole = (F.size("k_grid") == strikes) & F.forall("_t", lambda t: F.size(t) == tenors) & (F.size(F.array_distinct("_t")) == 1)
    return out.where(whole).select(*keys, "k_grid", F.get("_t", F.lit(0)).alias("t_grid"), "values", "observed")


def same_shape(tensors: DataFrame, by: str = "ticker", date: str = "date") -> DataFrame:
    """Surfaces on a grid of as many strikes and tenors as the ticker's first one, so that a history is rectangular."""
    shape = F.struct(F.size("k_grid").alias("k"), F.size("t_grid").alias("t"))
    first = tensors.groupBy(by).agg(F.min_by(shape, date).alias("_first"))
    return tensors.join(first, by).where(F.col("_first") == shape).drop("_first")


def series(tensors: DataFrame, i: int, j: int, by: str = "ticker", date: str = "date") -> DataFrame:
    """(by, date, k, tenor, value, observed) at one place of every grid."""
    at = lambda c: F.get(F.get(c, F.lit(i)), F.lit(j))
    return tensors.select(by, date, F.get("k_grid", F.lit(i)).alias("k"), F.get("t_grid", F.lit(j)).alias("tenor"), at(F.col("values")).alias("value"), at(F.col("observed")).alias("observed"))


def changes(tensors: DataFrame, by: str = "ticker", date: str = "date") -> DataFrame:
    """tensors with `change`, element by element against the surface before; null for a first one or where a shape differs."""
    before = F.lag("values").over(Window.partitionBy(by).orderBy(date))
    fits = (F.size("_b") == F.size("values")) & (F.size(F.get("_b", F.lit(0))) == F.size(F.get("values", F.lit(0))))
    minus = F.zip_with("values", "_b", lambda x, y: F.zip_with(x, y, lambda a, b: a - b))
    return tensors.withColumn("_b", before).withColumn("change", F.when(fits, minus)).drop("_b")
