"""The exchange's days by rule, as Columns: sessions, closing times and the guards that keep quotes of the wrong time out.

Rules of the New York exchange as they are today, applied to the years they hold for: Martin Luther King's day from 1998,
Juneteenth from 2022. Closures for a single occasion (mourning, storms) have no rule; pass them as `closed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from volframe.operators.timeseries import day_numbers

#: Minutes after midnight, exchange time.
CLOSE, EARLY_CLOSE = 16 * 60, 13 * 60
#: Options trade for a quarter of an hour after the close; thin chains are read in the last half hour before it.
OPTIONS_LAG, PRECLOSE = 15, 30


def _nth(day: Column, month: int, weekday: int, n: int) -> Column:
    """The n-th weekday (Monday: 0) of a month; n = 0 is the last one of a month with 31 days."""
    first = 25 if n == 0 else 7 * n - 6
    return (F.month(day) == month) & (F.weekday(day) == weekday) & F.dayofmonth(day).between(first, first + 6)


def _on(day: Column, month: int, number: int) -> Column:
    return (F.month(day) == month) & (F.dayofmonth(day) == number)


def _observed(day: Column, month: int, number: int, friday: bool = True) -> Column:
    """A date, or the Monday after if it is a Sunday, or the Friday before if it is a Saturday."""
    w = F.weekday(day)
    hit = (w < 5) & _on(day, month, number) | (w == 0) & _on(F.date_sub(day, 1), month, number)
    return hit | (w == 4) & _on(F.date_add(day, 1), month, number) if friday else hit


def easter(year: Column) -> Column:
    """Easter Sunday of the years 1900 to 2099."""
    a = year % 19
    d = (19 * a + 24) % 30
    e = (2 * (year % 4) + 4 * (year % 7) + 6 * d + 5) % 7
    days = d + e - F.when((d == 29) & (e == 6) | (d == 28) & (e == 6) & (a > 10), 7).otherwise(0)
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), days.cast("int"))


def holiday(day: Column, closed: Sequence = ()) -> Column:
    """Whether a weekday is a holiday. A null day gives null."""
    year = F.year(day)
    rules = [
        _observed(day, 1, 1, friday=False), (year >= 1998) & _nth(day, 1, 0, 3), _nth(day, 2, 0, 3), F.date_add(day, 2) == easter(year), _nth(day, 5, 0, 0),
        (year >= 2022) & _observed(day, 6, 19), _observed(day, 7, 4), _nth(day, 9, 0, 1), _nth(day, 11, 3, 4), _observed(day, 12, 25),
    ]
    out = rules[0]
    for rule in rules[1:]:
        out = out | rule
    return out | day.isin(list(closed)) if closed else out


def is_session(day: Column, closed: Sequence = ()) -> Column:
    """Whether the exchange opens on a day: a weekday that is no holiday. A null day gives null."""
    return (F.weekday(day) < 5) & ~holiday(day, closed)


def close_minute(day: Column, closed: Sequence = ()) -> Column:
    """Minutes after midnight at which a session closes; null if the day is none.

    Half days are the Friday after Thanksgiving, and 3 July and 24 December from Monday to Thursday.
    """
    half = (F.weekday(day) < 4) & (_on(day, 7, 3) | _on(day, 12, 24)) | _nth(F.date_sub(day, 1), 11, 3, 4)
    return F.when(is_session(day, closed), F.when(half, EARLY_CLOSE).otherwise(CLOSE))


#: Releases from this hour on, exchange time, move the next session.
AFTER_HOUR = 12
ZONE = "America/New_York"


def exchange_time(instant: Column, zone: str = ZONE) -> Column:
    """A timestamp's date and time of day at the exchange, as a timestamp without zone, whatever the session's zone is.

    The hour that the clocks skip in spring never comes out, that which they repeat in autumn comes out twice.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(secs=(F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def exchange_calendar(dates: DataFrame, column: str = "date", after: int = 10, closed: Sequence = ()) -> DataFrame:
    """Sessions of the exchange from the first date to `after` days beyond the last one: session and its number seq from 1."""
    span = dates.agg(F.min(column).cast("date").alias("a"), F.max(column).cast("date").alias("b"))
    days = span.select(F.explode(F.sequence(F.col("a"), F.date_add("b", after))).alias("session")).where(is_session(F.col("session"), closed))
    return days.withColumn("seq", F.row_number().over(Window.orderBy("session")))  # a row a day


def session_of(events: DataFrame, sessions: DataFrame, at: str = "announced") -> DataFrame:
    """events with `session`, the session that each moves: its own day, or the next session if that is none or noon is past.

    `at` is exchange time (see exchange_time). Null before the first session, beyond the last one, and for a null time.
    """
    days = day_numbers(sessions, 0).join(sessions.select(F.col("session").alias("day"), F.col("seq").alias("_own")), "day", "left").withColumnRenamed("day", "_day")
    f = events.withColumn("_day", F.col(at).cast("date")).join(days, "_day", "left")
    seq = F.when(F.col("_own").isNull(), F.when(F.col("pos") > 0, F.col("pos") + 1)).otherwise(F.col("_own") + (F.hour(at) >= AFTER_HOUR).cast("int"))
    f = f.withColumn("_seq", seq).drop("_day", "pos", "_own")
    return f.join(sessions.select(F.col("seq").alias("_seq"), "session"), "_seq", "left").drop("_seq")


def _second(now: Column) -> Column:
    return F.hour(now) * 3600 + F.minute(now) * 60 + F.second(now)


def collection_status(as_of: Column, now: Column, closed: Sequence = ()) -> Column:
    """ok, or why quotes taken at `now` (exchange time) aren't the closing quotes of as_of.

    other day: taken on another date; no session: as_of is a day off; intraday: options still trade. Null if either is.
    """
    ready = 60 * (close_minute(as_of, closed) + OPTIONS_LAG)
    late = F.when(now.cast("date") != as_of, "other day").when(~is_session(as_of, closed), "no session").when(_second(now) < ready, "intraday").otherwise("ok")
    return F.when(as_of.isNotNull() & now.isNotNull(), late)


def preclose_allowed(as_of: Column, now: Column, closed: Sequence = ()) -> Column:
    """Whether `now` is in the last half hour before the close of as_of; false on days off, null if either is null."""
    close = 60 * close_minute(as_of, closed)
    inside = (now.cast("date") == as_of) & (_second(now) >= close - 60 * PRECLOSE) & (_second(now) < close)
    return F.when(as_of.isNotNull() & now.isNotNull(), F.coalesce(inside, F.lit(False)))
