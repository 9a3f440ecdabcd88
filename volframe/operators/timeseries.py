"""Time-series operators on DataFrames: as-of joins, calendars, rolling and forward windows, upserts.

Frames of long tables are windows over (key, order); as-of joins are a union and one window, so both sides are shuffled
once by the key and nothing is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: Sequence[str] = (), values: Sequence[str] = (), strict: bool = False, forward: bool = False) -> DataFrame:
    """left with the last non-null value of each of `values` at or before left_on (strict: before; forward: the next one).

    Each value column looks for its own last non-null row. Rows of left without a match get nulls; a null time matches
    nothing; repeated rows of left stay repeated. A value may not have the name of a column of left. Without keys, the
    search is over the distinct times of both sides, of which there are few, and the rows of left get their values by an
    equi-join on the time; there, of values at one time, the largest counts.
    """
    by = list(by)
    if set(values) & set(left.columns):
        raise ValueError(f"left has {sorted(set(values) & set(left.columns))} already")
    if not by:
        times = left.select(F.lit(1).alias("_one"), F.col(left_on).alias("_at")).where(F.col("_at").isNotNull()).distinct()
        found = right.groupBy(F.col(right_on).alias("_t")).agg(*[F.max(v).alias(v) for v in values]).withColumn("_one", F.lit(1))
        found = asof_join(times, found, "_at", "_t", ["_one"], values, strict, forward).drop("_one")
        return left.join(found, F.col(left_on) == F.col("_at"), "left").drop("_at")
    l = left.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(left_on).alias("_t"), F.struct(*left.columns).alias("_row"), *[F.lit(None).cast(right.schema[v].dataType).alias(f"_v{i}") for i, v in enumerate(values)])
    r = right.where(F.col(right_on).isNotNull()).select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(right_on).alias("_t"), F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)])
    # at equal times the right rows come first, unless matches must be strictly on one side
    right_first = strict == forward
    side = F.when(F.col("_row").isNull(), 0 if right_first else 1).otherwise(1 if right_first else 0)
    w = Window.partitionBy(*[f"_by{i}" for i in range(len(by))]).orderBy(F.col("_t").asc(), side)
    w = w.rowsBetween(0, Window.unboundedFollowing) if forward else w.rowsBetween(Window.unboundedPreceding, 0)
    pick = F.first if forward else F.last
    out = l.unionByName(r).select("_row", "_t", *[pick(f"_v{i}", True).over(w).alias(v) for i, v in enumerate(values)])
    return out.where(F.col("_row").isNotNull()).select("_row.*", *[F.when(F.col("_t").isNotNull(), F.col(v)).alias(v) for v in values])


def calendar(dates: DataFrame, column: str = "date", holidays: Sequence = ()) -> DataFrame:
    """Weekdays from the first to the last date, without holidays: session and its number seq from 1. One row per day."""
    span = dates.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    days = span.select(F.explode(F.sequence(F.col("a").cast("date"), F.col("b").cast("date"))).alias("session")).where(F.weekday("session") < 5)
    if holidays:
        days = days.where(~F.col("session").isin(list(holidays)))
    return days.withColumn("seq", F.row_number().over(Window.orderBy("session")))


def day_numbers(sessions: DataFrame, after: int = 800) -> DataFrame:
    """day, pos: the number of the last session on or before each calendar day, up to `after` days beyond the calendar.

    Days beyond the calendar count weekdays as sessions; the day before the first session has number 0. A row per day.
    """
    span = sessions.agg(F.min("session").alias("a"), F.max("session").alias("b"))
    days = span.select(F.explode(F.sequence(F.date_sub("a", 1), F.date_add("b", after))).alias("day"), "b")
    days = days.join(sessions, F.col("day") == F.col("session"), "left")
    hit = F.when(F.col("seq").isNotNull() | ((F.col("day") > F.col("b")) & (F.weekday("day") < 5)), 1).otherwise(0)
    return days.select("day", F.sum(hit).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)).alias("pos"))


def align(frame: DataFrame, sessions: DataFrame, key: str, date: str) -> DataFrame:
    """frame with its session number, so that `seq - n` is n sessions back; dates that are no session have none.

    sessions has each session once, so rows are neither lost nor repeated; a null date has no number.
    """
    return frame.join(sessions.select(F.col("session").alias(date), "seq"), date, "left")


def shifted(frame: DataFrame, key: str, value: str, n: int, name: str) -> DataFrame:
    """frame with the value of the row n sessions earlier (n < 0: later) as name; null where no such row is.

    A window whose frame is that one session: no join, and one sort for all shifts of a key. frame has seq. Rows with a null
    key or seq get null; if (key, seq) repeats, the largest value of that session counts.
    """
    there = Window.partitionBy(key).orderBy("seq").rangeBetween(-n, -n)
    return frame.withColumn(name, F.when(F.col(key).isNotNull() & F.col("seq").isNotNull(), F.max(value).over(there)))


def trailing(key: str | Sequence[str], order: str, rows: int) -> object:
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(order).rowsBetween(-(rows - 1), 0)


def rolling_z(x: Column, w, least: int) -> Column:
    """(x - mean) / sample deviation of the frame; null with fewer than `least` values or without spread."""
    sd = F.stddev_samp(x).over(w)
    return F.when((F.count(x).over(w) >= least) & (sd > 1e-12), (x - F.avg(x).over(w)) / sd)


def rolling_rank(x: Column, w, least: int) -> Column:
    """Share of the frame's values below x, ties counted by half as average ranks do; null with fewer than `least` values."""
    values = F.collect_list(x).over(w)
    below, same = F.size(F.filter(values, lambda v: v < x)), F.size(F.filter(values, lambda v: v == x))
    return F.when(x.isNotNull() & (F.size(values) >= least), (below + (same + 1) / 2) / F.size(values))


def forward_sum(x: Column, key: str, order: str, h: int) -> Column:
    """Sum of the next h rows, this one not included; null unless all h are there and none is null.

    A key has one row per value of order; rows of a null key are a key of their own.
    """
    w = Window.partitionBy(key).orderBy(order).rowsBetween(1, h)
    return F.when(F.count(x).over(w) == h, F.sum(x).over(w))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on the keys; a new value that isn't null wins. Running it again changes nothing.

    Null keys match each other. Both sides have one row per key: repeated ones would be paired, so drop them first
    (keep_last). Columns of one side alone stay, null where that side has no row.
    """
    values = list(dict.fromkeys(c for c in (*new.columns, *old.columns) if c not in keys))
    a, b = new.alias("n"), old.alias("o")
    joined = a.join(b, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys], "full_outer")

    def pick(c: str) -> Column:
        have = [F.col(f"{s}.{c}") for s, f in (("n", new), ("o", old)) if c in f.columns]
        return F.coalesce(*have).alias(c)

    return joined.select(*[pick(c) for c in (*keys, *values)])


def newest_non_null(long: DataFrame, keys: Sequence[str], value: str, version: str) -> DataFrame:
    """Per key the value of the highest version that has one. Aggregated before the shuffle, whatever the number of versions."""
    return long.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, version).alias(value))


def keep_last(rows: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One row per key, the last by arrival (null arrivals first); the columns stay as they are."""
    order = F.struct(*arrival, *[c for c in rows.columns if c not in arrival])
    return rows.groupBy(*keys).agg(F.max(order).alias("_r")).select(*[F.col("_r")[c].alias(c) for c in rows.columns])


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows of keys that are in new go; new rows come in."""
    return old.join(new.select(key).distinct(), key, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def missing_streak(flags: DataFrame, key: str, order: str, ok: str) -> DataFrame:
    """Per key the number of last rows in a row that are not ok."""
    after = Window.partitionBy(key).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    seen = flags.withColumn("_ok", F.sum(F.when(F.col(ok), 1).otherwise(0)).over(after))
    return seen.groupBy(key).agg(F.count_if(F.col("_ok") == 0).alias("streak"))
