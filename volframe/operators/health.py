"""One health report over tables of different shape: a typed row for each check, whatever becomes of a table.

Figures of a table are observed while it is read: every table is scanned once and side by side with the others, in a single
job. A table that is missing, or that fails while it is read, is a failed row and stops nothing.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "section string, check string, ok boolean, rows long, first date, last date, figures map<string, double>, message string"


@dataclass
class Table:
    """What is expected of a table: read gives it, figures are aggregates (Columns) by name, and bounds those that are judged.

    date names the column of its days, if there is one. least and most hold the smallest and largest allowed figure.
    """

    name: str
    read: Callable[[], DataFrame]
    date: str | None = "date"
    figures: Mapping[str, Column] = field(default_factory=dict)
    least: Mapping[str, float] = field(default_factory=dict)
    most: Mapping[str, float] = field(default_factory=dict)
    least_rows: int = 1
    reaches: str | None = None  # name of the table whose newest day this one must reach
    most_behind: int = 0  # sessions


def _observed(table: Table, frame: DataFrame, mark: Observation) -> DataFrame:
    day = F.col(table.date).cast("date") if table.date else F.lit(None).cast("date")
    seen = frame.observe(mark, F.count(F.lit(1)).alias("rows"), F.min(day).alias("first"), F.max(day).alias("last"), *[c.cast("double").alias(f"f_{n}") for n, c in table.figures.items()])
    return seen.agg(F.count("*").alias("_"))


def _scan(spark: SparkSession, tables: Sequence[Table]) -> dict[str, dict | str]:
    """Figures of each table, or what went wrong with it. One job for all; those of a job that failed are tried one by one."""
    frames, out = {}, {}
    for t in tables:
        mark = Observation(t.name)
        try:
            frames[t.name] = (_observed(t, t.read(), mark), mark)
        except PySparkException as e:
            out[t.name] = e.getCondition() or type(e).__name__
    try:
        _run([f for f, _ in frames.values()])
        return out | {n: mark.get for n, (_, mark) in frames.items()}
    except Exception:
        pass
    for t in tables:
        if t.name in frames:
            mark = Observation(t.name)
            try:
                _run([_observed(t, t.read(), mark)])
                out[t.name] = mark.get
            except Exception as e:
                out[t.name] = (e.getCondition() if isinstance(e, PySparkException) else None) or type(e).__name__
    return out


def _run(frames: Sequence[DataFrame]) -> None:
    if not frames:
        return
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    union.write.format("noop").mode("overwrite").save()


def _sessions_between(a: datetime.date, b: datetime.date, is_session: Callable[[datetime.date], bool]) -> int:
    return sum(is_session(a + datetime.timedelta(days=i)) for i in range(1, (b - a).days + 1))


def weekday(day: datetime.date) -> bool:
    return day.weekday() < 5


def table_checks(spark: SparkSession, tables: Sequence[Table], as_of: datetime.date, is_session: Callable[[datetime.date], bool] = weekday) -> DataFrame:
    """A row for each table: there, not thin, within its bounds, and as new as it must be.

    A table with `reaches` must reach the newest day of that table, any other as_of, but for most_behind sessions; tables
    without a date only have to be there. A bound on a figure that is null, as of an empty table, is broken.
    """
    seen, rows = _scan(spark, tables), []
    for t in tables:
        got = seen[t.name]
        if isinstance(got, str):
            rows.append(("tables", t.name, False, None, None, None, {}, f"cannot be read: {got}"))
            continue
        figures = {n: got[f"f_{n}"] for n in t.figures}
        problems = [] if got["rows"] >= t.least_rows else ["empty" if not got["rows"] else f"only {got['rows']} rows (at least {t.least_rows})"]
        problems += [f"{n} is {figures[n]} (at least {v})" for n, v in t.least.items() if figures[n] is None or figures[n] < v]
        problems += [f"{n} is {figures[n]} (at most {v})" for n, v in t.most.items() if figures[n] is None or figures[n] > v]
        if t.date and got["rows"]:
            other = seen.get(t.reaches) if t.reaches else None
            want = (None if isinstance(other, str) else other["last"]) if t.reaches else as_of
            if got["last"] is None:
                problems.append("no dates")
            elif want is not None and (n := _sessions_between(got["last"], want, is_session)) > t.most_behind:
                problems.append(f"ends {got['last']}, {n} sessions before {t.reaches or 'the day of the report'} ({want})")
        rows.append(("tables", t.name, not problems, got["rows"], got["first"], got["last"], {n: v for n, v in figures.items() if v is not None}, "; ".join(problems) or f"{got['rows']} rows"))
    return spark.createDataFrame(rows, REPORT)


def run_check(spark: SparkSession, errors: Iterable[str], ignore: Sequence[str] = ("Market closed",)) -> DataFrame:
    """A row for the errors of a run; those with a text that is to be ignored don't count."""
    bad = [e for e in errors if not any(i in e for i in ignore)]
    return spark.createDataFrame([("run", "run", not bad, None, None, None, {}, "; ".join(bad) or "no errors")], REPORT)


def as_report(section: str, checks: DataFrame, name: str | Column, ok: str | Column, message: str | Column) -> DataFrame:
    """Checks of another shape (of the module quality, say) as rows of the report."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in checks.sparkSession.createDataFrame([], REPORT).schema}
    own = {"section": F.lit(section), "check": col(name).cast("string"), "ok": F.coalesce(col(ok), F.lit(False)), "message": col(message).cast("string"), "figures": F.create_map().cast("map<string, double>")}
    return checks.select(*[(own[n].alias(n) if n in own else c) for n, c in empty.items()])


def guarded(spark: SparkSession, section: str, check: Callable[[], DataFrame]) -> DataFrame:
    """check() as rows of the report, computed now; if it fails, one failed row that says how."""
    try:
        rows = check()
        return spark.createDataFrame(rows.collect(), REPORT)  # a row a check
    except Exception as e:
        what = (e.getCondition() if isinstance(e, PySparkException) else None) or f"{type(e).__name__}: {e}"
        return spark.createDataFrame([(section, section, False, None, None, None, {}, f"cannot be run: {what}")], REPORT)


def report(*parts: DataFrame) -> DataFrame:
    """All checks in one table."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verdict(rows: DataFrame) -> DataFrame:
    """One row: whether all is well, how many checks there are and how many failed, and which, in order."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("ok"), F.concat_ws("/", "section", "check"))))
    return rows.agg((F.count_if(~F.col("ok")) == 0).alias("ok"), F.count("*").alias("checks"), F.count_if(~F.col("ok")).alias("failed"), failed.alias("which"))
