"""Health of stored chains: coverage, freshness, quality figures, and checks as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volframe.operators.timeseries import day_numbers


def coverage(present: DataFrame, sessions: DataFrame, key: str = "ticker", date: str = "date") -> DataFrame:
    """Per key: first, last, present and expected sessions, coverage in percent, the first ten missing dates.

    Expected sessions are a difference of session numbers; only keys that miss some are laid out day by day. Repeated days
    count once, null dates and dates without a session number are not present.
    """
    numbers = day_numbers(sessions, 0)
    days = present.select(key, date).where(F.col(date).isNotNull()).distinct().join(sessions.select(F.col("session").alias(date), "seq"), date, "left")
    span = days.groupBy(key).agg(F.min(date).alias("first"), F.max(date).alias("last"), F.count("*").alias("present"), F.count("seq").alias("_have"))
    for c, n, at in (("first", "_a", F.date_add("day", 1)), ("last", "_b", F.col("day"))):
        span = span.join(numbers.select(at.alias(c), F.col("pos").alias(n)), c, "left")
    out = span.withColumn("expected", F.col("_b") - F.col("_a")).withColumn("missing", F.col("expected") - F.col("_have"))
    gaps = out.where("missing > 0").select(key, F.explode(F.sequence(F.col("_a") + 1, F.col("_b"))).alias("seq"))
    gaps = gaps.join(days.where("seq is not null").select(key, F.col("seq").cast("long").alias("seq")), [key, "seq"], "left_anti").join(sessions, "seq")
    gaps = gaps.groupBy(key).agg(F.slice(F.array_sort(F.collect_list("session")), 1, 10).alias("first_missing"))
    out = out.join(gaps, key, "left").drop("_a", "_b", "_have")
    return out.withColumn("coverage", F.when(F.col("expected") > 0, 100.0 * (F.col("expected") - F.col("missing")) / F.col("expected")))


def freshness(present: DataFrame, sessions: DataFrame, key: str = "ticker", date: str = "date") -> DataFrame:
    """Per key: latest date, sessions after it up to the newest date of all, and whether it lags; null dates don't count."""
    numbers = day_numbers(sessions, 0)
    last = present.where(F.col(date).isNotNull()).groupBy(key).agg(F.max(date).alias("latest"))
    newest = last.agg(F.max("latest").alias("day")).join(numbers, "day").select(F.col("pos").alias("_newest"))  # one row
    late = last.join(numbers, F.col("latest") == F.col("day"), "left").join(F.broadcast(newest))
    return late.select(key, "latest", (F.col("_newest") - F.col("pos")).alias("sessions_behind")).withColumn("lags", F.col("sessions_behind") > 0)


def chain_quality(chain: DataFrame, keys=("ticker", "as_of"), least_rows: int = 200, least_expiries: int = 4) -> DataFrame:
    """Per snapshot: rows, expiries, shares of null, negative and crossed quotes, median relative spread, duplicates."""
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    out = chain.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.count_distinct("expiration").alias("expiries"), share(F.col("bid").isNull() | F.col("ask").isNull()).alias("null_share"),
        share((F.col("bid") < 0) | (F.col("ask") < 0)).alias("negative_share"), share(F.col("bid") > F.col("ask")).alias("crossed_share"),
        F.median(F.try_divide(F.col("ask") - F.col("bid"), F.col("mid"))).alias("spread"), (F.count("*") - F.count_distinct("expiration", "strike", "option_type")).alias("duplicates"),
    )
    return out.withColumn("thin", F.col("rows") < least_rows).withColumn("few_expiries", F.col("expiries") < least_expiries)


def validate(frame: DataFrame, rules: dict[str, object]) -> DataFrame:
    """Adds valid and errors: the names of all rules (boolean Columns) that don't hold; null counts as failing."""
    errors = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]))
    return frame.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)


def _known(c: str, rule) -> Column:
    """A rule on a column that may be null."""
    return F.col(c).isNull() | rule(F.col(c))


def raw_chain_rules(columns: Sequence[str] | None = None) -> dict[str, Column]:
    """Rules of a chain as it arrives; those of optional columns only if the column is there."""
    c = F.col
    rules = {"ticker": c("ticker").isNotNull(), "as_of": c("as_of").isNotNull(), "expiration": c("expiration").isNotNull(), "strike": c("strike") > 0, "option_type": c("option_type").isin("call", "put"), "T": c("T") > 0}
    rules |= {n: _known(n, lambda x: x >= 0) for n in ("bid", "ask", "mid", "last_price", "volume", "open_interest")}
    rules |= {"implied_volatility_market": _known("implied_volatility_market", lambda x: x.between(0, 10)), "underlying_price": _known("underlying_price", lambda x: x > 0)}
    return rules if columns is None else {n: r for n, r in rules.items() if n in columns}


def normalised_chain_rules(columns: Sequence[str] | None = None) -> dict[str, Column]:
    """As raw_chain_rules, and a volatility column, null or above 0 and up to 10."""
    return raw_chain_rules(columns) | {"implied_volatility": _known("implied_volatility", lambda x: (x > 0) & (x <= 10))}


def surface_grid_rules() -> dict[str, Column]:
    """Rules of a grid in long form with a type and strike for each point; no value may be null."""
    c = F.col
    return {"log_moneyness": c("log_moneyness").isNotNull(), "T": c("T") > 0, "implied_volatility": (c("implied_volatility") > 0) & (c("implied_volatility") <= 5), "option_type": c("option_type").isin("call", "put"), "strike": c("strike") > 0}


def index_rules(columns: Sequence[str]) -> dict[str, Column]:
    """date must be there; each index is null or not below 0."""
    return {"date": F.col("date").isNotNull()} | {c: _known(c, lambda x: x >= 0) for c in columns if c != "date"}


def rates_rules() -> dict[str, Column]:
    return {"date": F.col("date").isNotNull(), "tenor_years": F.col("tenor_years") > 0, "rate": F.col("rate").between(-0.05, 0.30)}


def violations(frame: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, rows, failed: one pass over the frame, whatever the number of rules."""
    counts = frame.agg(F.count("*").alias("_rows"), *[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()])
    return counts.unpivot(["_rows"], list(rules), "rule", "failed").select("rule", F.col("_rows").alias("rows"), "failed")


# ---- health


def table_status(table: DataFrame, values: Sequence[str], date: str = "date") -> DataFrame:
    """One row: rows, first and last date, and of each value column the share that isn't null. An empty table has 0 rows."""
    return table.agg(F.count("*").alias("rows"), F.min(date).alias("first"), F.max(date).alias("last"), *[F.avg(F.col(v).isNotNull().cast("double")).alias(f"{v}_share") for v in values])


def surface_status(chains: DataFrame, surfaces: DataFrame) -> DataFrame:
    """Per ticker: days with a chain, with a surface, with neither outcome known, median fit error, share of parity forwards.

    chains(ticker, date) and surfaces(ticker, date, rmse, source, T), one row per slice.
    """
    days = chains.select("ticker", "date").distinct()
    fits = surfaces.groupBy("ticker", "date").agg(F.median("rmse").alias("rmse"), F.avg((F.col("source") == "parity").cast("double")).alias("parity"), F.count("*").alias("slices"), F.min("T").alias("least_T"))
    j = days.join(fits, ["ticker", "date"], "left")
    return j.groupBy("ticker").agg(F.count("*").alias("chains"), F.count("slices").alias("surfaces"), F.count_if(F.col("slices").isNull()).alias("missing"), F.median("rmse").alias("rmse"), F.avg("parity").alias("parity"), F.min("least_T").alias("least_T"))


def check_freshness(present: DataFrame, sessions: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row: check, ok, problems, for tickers without a chain or behind the newest session. wanted(ticker)."""
    late = freshness(present, sessions)
    j = wanted.select("ticker").distinct().join(late, "ticker", "left")
    out = j.agg(F.array_sort(F.collect_list(F.when(F.col("latest").isNull(), F.col("ticker")))).alias("none"), F.array_sort(F.collect_list(F.when(F.col("lags"), F.col("ticker")))).alias("behind"))
    problems = F.concat(F.transform("none", lambda t: F.concat(F.lit("no chains: "), t)), F.transform("behind", lambda t: F.concat(F.lit("behind: "), t)))
    return out.select(F.lit("freshness").alias("check"), (F.size(problems) == 0).alias("ok"), F.array_join(problems, "; ").alias("problems"))


def check_surfaces(chains: DataFrame, surfaces: DataFrame, best_effort: Sequence[str] = (), most_missing: int = 3) -> DataFrame:
    """Per ticker with a chain on the newest day: ok, and how many of its last chains in a row have no surface.

    A best-effort ticker fails only after most_missing days in a row.
    """
    have = surfaces.select("ticker", "date").distinct().withColumn("_ok", F.lit(True))
    days = chains.select("ticker", "date").distinct().join(have, ["ticker", "date"], "left")
    newest = days.agg(F.max("date").alias("_newest"))  # one row
    per = days.groupBy("ticker").agg(F.max("date").alias("last"), F.max(F.when(F.col("_ok"), F.col("date"))).alias("built"))
    gaps = days.join(per, "ticker").where("built is null or date > built").groupBy("ticker").agg(F.count("*").alias("streak"))
    out = per.join(F.broadcast(newest), F.col("last") == F.col("_newest")).join(gaps, "ticker", "left").withColumn("streak", F.coalesce("streak", F.lit(0)))
    soft = F.col("ticker").isin(list(best_effort)) if best_effort else F.lit(False)
    return out.select("ticker", "streak", ((F.col("streak") == 0) | (soft & (F.col("streak") < most_missing))).alias("ok"))


def check_newest(name: str, table: DataFrame, other: DataFrame, date: str = "date") -> DataFrame:
    """One row: whether a table reaches the newest date of another one."""
    a, b = table.agg(F.max(date).alias("ends")), other.agg(F.max(date).alias("wanted"))  # one row each
    return a.join(F.broadcast(b)).select(F.lit(name).alias("check"), F.coalesce(F.col("ends") >= F.col("wanted"), F.lit(False)).alias("ok"), "ends", "wanted")


def benchmark(rows: DataFrame, ours: str, theirs: str, order: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Ours against an outside series: n, correlation of levels and of changes, mean difference, mean absolute one, ratio of
    the changes' deviations. Rows with a null on either side are left out before changes are taken."""
    w = Window.partitionBy(*by).orderBy(order)
    ok = rows.where(F.col(ours).isNotNull() & F.col(theirs).isNotNull())
    d = ok.withColumns({"_a": F.col(ours) - F.lag(ours).over(w), "_b": F.col(theirs) - F.lag(theirs).over(w)})
    gap = F.col(ours) - F.col(theirs)
    return d.groupBy(*by).agg(F.count("*").alias("n"), F.corr(ours, theirs).alias("level_corr"), F.corr("_a", "_b").alias("change_corr"), F.avg(gap).alias("mean_diff"), F.avg(F.abs(gap)).alias("mean_abs_diff"), F.try_divide(F.stddev_samp("_a"), F.stddev_samp("_b")).alias("sd_ratio"), F.max_by(F.abs(gap), order).alias("latest_gap"))


def check_accuracy(rows: DataFrame, ours: str, theirs: str, days: int = 63, least_corr: float = 0.80, most_mean: float = 1.5, most_latest: float = 3.0, least: int = 20) -> DataFrame:
    """One row: check, ok, n and the figures over the last `days` rows; fewer than `least` of them are not judged."""
    last = rows.withColumn("_n", F.row_number().over(Window.orderBy(F.col("date").desc()))).where(F.col("_n") <= days)  # a row a day
    b = benchmark(last, ours, theirs)
    ok = (F.col("change_corr") >= least_corr) & (F.col("mean_abs_diff") <= most_mean) & (F.col("latest_gap") <= most_latest)
    return b.select(F.lit("accuracy").alias("check"), F.when(F.col("n") < least, True).otherwise(ok).alias("ok"), "n", "change_corr", "mean_abs_diff", "latest_gap")
