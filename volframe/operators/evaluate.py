"""Forecasts and their evaluation: ridge regressions on logs with monthly refits, loss functions, tests and study tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volframe.functions.pricing import ncdf, qlike
from volframe.sources.store import kept


def scores(rows: DataFrame, actual: str, forecast: str, by=()) -> DataFrame:
    """n, qlike, rmse, mae, bias, r2 of logs, on rows where both are positive."""
    a, f = F.col(actual), F.col(forecast)
    ok = rows.where((a > 0) & (f > 0))
    la, lf = F.log(a), F.log(f)
    r2 = 1 - F.try_divide(F.sum((la - lf) * (la - lf)), F.var_pop(la) * F.count("*"))
    return ok.groupBy(*by).agg(F.count("*").alias("n"), F.avg(qlike(a, f)).alias("qlike"), F.sqrt(F.avg((a - f) * (a - f))).alias("rmse"), F.avg(F.abs(a - f)).alias("mae"), F.avg(f - a).alias("bias"), r2.alias("log_r2"))


def two_sided(z: Column) -> Column:
    """p-value of a standard normal statistic, for either sign."""
    return 2 * ncdf(-F.abs(z))


def long_run_variance(rows: DataFrame, value: str, order: str, by: list[str], lags: int) -> DataFrame:
    """Per group: n, mean and the Newey-West variance of the mean with Bartlett weights up to `lags`."""
    w = Window.partitionBy(*by).orderBy(order)
    all_ = Window.partitionBy(*by)
    d = rows.where(F.col(value).isNotNull()).withColumn("_d", F.col(value) - F.avg(value).over(all_))
    d = d.select(*by, value, "_d", *[(F.col("_d") * F.lag("_d", k).over(w)).alias(f"_c{k}") for k in range(1, lags + 1)])
    total = F.sum(F.col("_d") * F.col("_d"))
    for k in range(1, lags + 1):
        total = total + 2 * (1 - k / (lags + 1)) * F.coalesce(F.sum(f"_c{k}"), F.lit(0.0))
    return d.groupBy(*by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), (total / F.count("*") / F.count("*")).alias("variance"))


def diebold_mariano(rows: DataFrame, base: str, model: str, order: str, by: list[str], lag: int) -> DataFrame:
    """Statistic of the mean loss difference; null with fewer than ten rows."""
    d = rows.withColumn("_diff", F.col(base) - F.col(model))
    v = long_run_variance(d, "_diff", order, by, lag)
    return v.select(*by, "n", F.when((F.col("n") >= 10) & (F.col("variance") > 0), F.col("mean") / F.sqrt("variance")).alias("dm"), F.col("mean").alias("mean_gain")).withColumn("p", two_sided(F.col("dm")))


def predictive_regression(rows: DataFrame, x: str, y: str, order: str, by: list[str], lag: int) -> DataFrame:
    """OLS of y on standardised x with Newey-West errors: n, slope, t, r2."""
    all_ = Window.partitionBy(*by)
    d = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    d = d.withColumn("_x", (F.col(x) - F.avg(x).over(all_)) / F.stddev_pop(x).over(all_))
    d = d.withColumn("_b", F.regr_slope(F.col(y), F.col("_x")).over(all_)).withColumn("_e", F.col(y) - F.avg(y).over(all_) - F.col("_b") * F.col("_x"))
    v = long_run_variance(d.withColumn("_s", F.col("_x") * F.col("_e")), "_s", order, by, lag).select(*by, "variance")
    fit = d.groupBy(*by).agg(F.count("*").alias("n"), F.max("_b").alias("slope"), F.regr_r2(F.col(y), F.col("_x")).alias("r2"))
    return fit.join(v, by).select(*by, "n", "slope", F.when(F.col("variance") > 0, F.col("slope") / F.sqrt("variance")).alias("t"), "r2").withColumn("p", two_sided(F.col("t")))


def regime(vix: Column) -> Column:
    return F.when(vix >= 35, "Crisis").when(vix >= 25, "High").when(vix <= 15, "Low").when(vix.isNotNull(), "Normal")


def regime_bin(vix: Column) -> Column:
    return F.when(vix <= 15, "low").when(vix <= 25, "normal").when(vix <= 35, "high").when(vix.isNotNull(), "crisis")


def _ridge(sums: dict[str, float], k: int, alpha: float) -> list[float]:
    """Intercept and slopes of the ridge on standardised terms, for terms as they are, from n, sums and cross products."""
    n, y = sums["n"], sums["y"]
    mu = np.array([sums[f"x{i}"] for i in range(k)]) / n
    cov = np.array([[sums[f"x{min(i, j)}x{max(i, j)}"] for j in range(k)] for i in range(k)]) / n - np.outer(mu, mu)
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0)) + 1e-12
    xy = np.array([sums[f"x{i}y"] for i in range(k)]) - mu * y
    slopes = np.linalg.solve(n * cov / np.outer(sd, sd) + alpha * np.eye(k), xy / sd) / sd
    return [float(y / n - slopes @ mu), *map(float, slopes)]


def log_of(c: str) -> Column:
    """Logarithm of a column, null where it isn't a positive number."""
    return F.when((F.col(c) > 0) & (F.col(c) < float("inf")), F.log(c))


# ---- refits by month

#: Bins in which residuals of a month are counted before the values around a quantile are looked at.
BINS = 512


def _months_of(since: np.ndarray, months: np.ndarray) -> np.ndarray:
    """Place of the first month that knows a row, for months in order."""
    return np.searchsorted(months, since)


def _residual_blocks(batches: Iterator[pa.RecordBatch], months: np.ndarray, coef: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first month, residuals under each month's coefficients) of the rows of a batch.

    Term by term and not as a matrix product, whose last digits may depend on the rows beside: each pass must see the same.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            b = batch.slice(at, 4096)
            left = b.column("y").to_numpy(zero_copy_only=False)[:, None] - coef[:, 0]
            for i in range(coef.shape[1] - 1):
                left = left - b.column(f"x{i}").to_numpy(zero_copy_only=False)[:, None] * coef[:, i + 1]
            yield _months_of(b.column("since").cast(pa.int32()).to_numpy(zero_copy_only=False), months), left


def _ranges(months: np.ndarray, coef: np.ndarray):
    """Per task and month: rows known, sum of exp of their residuals, least and largest residual."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, e = np.zeros(len(months), np.int64), np.zeros(len(months))
        lo, hi = np.full(len(months), np.inf), np.full(len(months), -np.inf)
        for first, left in _residual_blocks(batches, months, coef):
            known = first[:, None] <= np.arange(len(months))
            n += known.sum(axis=0)
            e += np.where(known, np.exp(left), 0).sum(axis=0)
            lo, hi = np.minimum(lo, np.where(known, left, np.inf).min(axis=0, initial=np.inf)), np.maximum(hi, np.where(known, left, -np.inf).max(axis=0, initial=-np.inf))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(e[some]), pa.array(lo[some]), pa.array(hi[some])], names=["m", "n", "e", "lo", "hi"])

    return run


def _bin(left: np.ndarray, lo: np.ndarray, width: np.ndarray) -> np.ndarray:
    return np.minimum((left - lo) / width, BINS - 1).astype(np.int64)


def _bins(months: np.ndarray, coef: np.ndarray, lo: np.ndarray, width: np.ndarray):
    """Per task, month and bin: residuals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(months) * BINS, np.int64)
        for first, left in _residual_blocks(batches, months, coef):
            known = first[:, None] <= np.arange(len(months))
            count += np.bincount((np.arange(len(months)) * BINS + _bin(left, lo, width))[known], minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array((some // BINS).astype(np.int32)), pa.array((some % BINS).astype(np.int32)), pa.array(count[some])], names=["m", "bin", "n"])

    return run


def _inside(months: np.ndarray, coef: np.ndarray, lo: np.ndarray, width: np.ndarray, wanted: np.ndarray):
    """Residuals in the bins that are wanted of each month."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, left in _residual_blocks(batches, months, coef):
            b = _bin(left, lo, width)
            hit = (first[:, None] <= np.arange(len(months))) & wanted[np.arange(len(months)), b]
            rows, ms = np.nonzero(hit)
            yield pa.RecordBatch.from_arrays([pa.array(ms.astype(np.int32)), pa.array(b[rows, ms].astype(np.int32)), pa.array(left[rows, ms])], names=["m", "bin", "v"])

    return run


def _quantiles(known: DataFrame, months: list, coef: np.ndarray, levels: Sequence[float]) -> dict[int, tuple[float, list[float]]]:
    """Per place in months: mean of exp(residual) and the exact quantiles (linear between two residuals) of all rows known
    by then, under that month's coefficients.

    Rows never meet months in a join: each task applies the coefficients of all months to its rows and sends on counts by
    month and bin; then values of the bins that hold a quantile alone, counted by value. The driver holds months x BINS
    counts.
    """
    at = np.array([(m - date(1970, 1, 1)).days for m in months], np.int32)
    part = known.select("since", "y", *[f"x{i}" for i in range(coef.shape[1] - 1)])
    got = part.mapInArrow(_ranges(at, coef), "m int, n long, e double, lo double, hi double").groupBy("m").agg(F.sum("n").alias("n"), F.sum("e").alias("e"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    n, e, lo, hi = np.zeros(len(at), np.int64), np.zeros(len(at)), np.zeros(len(at)), np.ones(len(at))
    for r in got:
        n[r.m], e[r.m], lo[r.m], hi[r.m] = r.n, r.e, r.lo, r.hi
    width = np.maximum(hi - lo, 1e-300) / BINS
    counts = np.zeros((len(at), BINS), np.int64)
    for r in part.mapInArrow(_bins(at, coef, lo, width), "m int, bin int, n long").groupBy("m", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r.m, r.bin] = r.n
    below = np.cumsum(counts, axis=1) - counts
    ranks, wanted = {}, np.zeros((len(at), BINS), bool)  # ranks: (month, bin) -> places among the month's residuals
    for m in np.flatnonzero(n):
        for p in levels:
            for rank in {math.floor(p * (n[m] - 1)), math.ceil(p * (n[m] - 1))}:
                b = int(np.searchsorted(below[m] + counts[m], rank, "right"))
                wanted[m, b] = True
                ranks.setdefault((int(m), b), set()).add(rank)
    asked = known.sparkSession.createDataFrame([(m, b, int(rank - below[m, b])) for (m, b), rs in ranks.items() for rank in rs], "m int, bin int, rank long")
    values = part.mapInArrow(_inside(at, coef, lo, width, wanted), "m int, bin int, v double").groupBy("m", "bin", "v").agg(F.count("*").alias("n"))
    values = values.withColumn("end", F.sum("n").over(Window.partitionBy("m", "bin").orderBy("v")))
    found = values.join(F.broadcast(asked), ["m", "bin"]).where((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n")))
    value = {(r.m, r.bin, r.rank): r.v for r in found.select("m", "bin", "rank", "v").collect()}

    def quantile(m: int, p: float) -> float:
        h = p * (n[m] - 1)
        bins = [int(np.searchsorted(below[m] + counts[m], k, "right")) for k in (math.floor(h), math.ceil(h))]
        a, b = (value[m, j, int(k - below[m, j])] for j, k in zip(bins, (math.floor(h), math.ceil(h)), strict=True))
        return float(a + (b - a) * (h - math.floor(h)))

    return {int(m): (float(e[m] / n[m]), [quantile(int(m), p) for p in levels]) for m in np.flatnonzero(n)}


def _monthly(rows: DataFrame, target: str, h: int, terms: Mapping[str, Column], alpha: float, least: int, keep: Sequence[str]) -> tuple[DataFrame, DataFrame, list[tuple]]:
    """Rows with their terms (kept, for the caller to give back), those of them that some month may learn from, and (month, rows
    known, coefficients).
    """
    k = len(terms)
    closed = F.lead("date", h).over(Window.partitionBy("ticker").orderBy("date"))
    f = rows.withColumn("_closed", closed).select("ticker", "date", F.trunc("date", "month").alias("month"), F.add_months(F.trunc("_closed", "month"), 1).alias("since"), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(terms.values())], log_of(target).alias("y"), *keep)
    xs = [f"x{i}" for i in range(k)]
    f = kept(f.where(" and ".join(f"{x} is not null" for x in xs)))
    known = f.where("y is not null and since is not null").select("since", "y", *xs)
    cross = [F.sum(F.col(a) * F.col(b)).alias(a + b) for i, a in enumerate(xs) for b in (*xs[i:], "y")]
    parts = known.groupBy("since").agg(F.count("*").alias("n"), F.sum("y").alias("y"), *[F.sum(x).alias(x) for x in xs], *cross).orderBy("since").collect()
    months = [r.month for r in f.select("month").distinct().orderBy("month").collect()]
    models, total, i = [], {}, 0
    for m in months:
        while i < len(parts) and parts[i].since <= m:
            for c, v in parts[i].asDict().items():
                if c != "since":
                    total[c] = total.get(c, 0) + v
            i += 1
        if total and total["n"] >= least:
            models.append((m, total["n"], _ridge(total, k, alpha)))
    return f, known, models


def coefficients(rows: DataFrame, target: str, h: int, terms: Sequence[str] | Mapping[str, Column], alpha: float = 0.0, least: int = 250) -> DataFrame:
    """month, n_train, term, coefficient of the monthly refits that walk_forward makes; the intercept's term is `const`."""
    terms = terms if isinstance(terms, Mapping) else {c: log_of(c) for c in terms}
    f, _, models = _monthly(rows, target, h, terms, alpha, least, ())
    f.unpersist()
    return rows.sparkSession.createDataFrame([(m, n, t, float(c)) for m, n, cs in models for t, c in zip(("const", *terms), cs, strict=True)], "month date, n_train int, term string, coefficient double")


def walk_forward(rows: DataFrame, target: str, h: int, terms: Sequence[str] | Mapping[str, Column], alpha: float = 0.0, least: int = 250, keep: Sequence[str] = (), levels: Sequence[float] = (0.1, 0.9)) -> DataFrame:
    """Monthly refits, pooled over tickers, on all rows whose target closed before the month began; forecasts of its rows.

    terms are columns, whose logarithms are regressed on, or expressions by name, which are taken as they are; the log of
    the target is fitted, with a ridge of alpha on standardised terms. Rows with a null term have no forecast. The target of
    a row closes with the ticker's h-th next row. Coefficients come from sums by the month from which on a row is known,
    added up over the months, of which there are few; see _quantiles for the smearing factor and the range. A month with
    fewer than `least` usable rows in the pool has no forecast. Columns: ticker, date, month, horizon, forecast, lo, hi (at
    the first and last of levels), range (at all of them), n_train and those of keep.
    """
    terms = terms if isinstance(terms, Mapping) else {c: log_of(c) for c in terms}
    f, known, models = _monthly(rows, target, h, terms, alpha, least, keep)
    spread = _quantiles(known, [m for m, _, _ in models], np.array([c for _, _, c in models]), levels) if models else {}
    f.unpersist()  # what was needed of it is in models; the forecasts read the rows once more
    models = rows.sparkSession.createDataFrame([(*model, *spread[i]) for i, model in enumerate(models)], "month date, n_train int, c array<double>, smear double, q array<double>")
    fitted = sum((F.col("c")[i + 1] * F.col(f"x{i}") for i in range(len(terms))), F.col("c")[0])
    out = f.join(F.broadcast(models), "month").withColumn("_fit", fitted)  # a row a month
    at = lambda q: F.exp(F.col("_fit") + q)
    return out.select("ticker", "date", "month", F.lit(h).alias("horizon"), (F.exp("_fit") * F.col("smear")).alias("forecast"), at(F.col("q")[0]).alias("lo"), at(F.col("q")[len(levels) - 1]).alias("hi"), F.transform("q", at).alias("range"), "n_train", *keep)
