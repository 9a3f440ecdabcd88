"""The health report: stale, thin, absent and broken tables, and checks that fail themselves."""

import datetime

from pyspark.sql import functions as F

DAY = datetime.date(2026, 3, 6)  # a Friday


def test_every_table_has_a_row(spark):
    from volframe.operators import health as H

    frame = lambda n, end=DAY: spark.createDataFrame([(end - datetime.timedelta(days=i), float(i) if i % 2 else None) for i in range(n)], "date date, x double")
    share = {"share": F.avg(F.col("x").isNotNull().cast("double"))}
    tables = [
        H.Table("whole", lambda: frame(10), figures=share, least={"share": 0.5}), H.Table("gaps", lambda: frame(9), figures=share, least={"share": 0.5}), H.Table("thin", lambda: frame(3), least_rows=5), H.Table("empty", lambda: frame(1).limit(0), figures=share, most={"share": 1.0}),
        H.Table("late", lambda: frame(5, DAY - datetime.timedelta(days=7)), reaches="whole", most_behind=4), H.Table("weekend", lambda: frame(5, DAY + datetime.timedelta(days=2)), reaches="whole"), H.Table("behind nothing", lambda: frame(5), reaches="absent"),
        H.Table("absent", lambda: spark.read.parquet("/tmp/no-such-table")), H.Table("undated", lambda: spark.range(3).toDF("id"), date=None), H.Table("broken", lambda: frame(4).withColumn("x", F.raise_error(F.lit("damaged")).cast("double")), figures=share),
    ]
    got = {r.check: r for r in H.table_checks(spark, tables, DAY).collect()}
    assert {n for n, r in got.items() if r.ok} == {"whole", "weekend", "behind nothing", "undated"}
    assert got["whole"].figures == {"share": 0.5} and got["whole"].rows == 10 and got["whole"].last == DAY
    assert "share is 0.44" in got["gaps"].message and got["thin"].message == "only 3 rows (at least 5)" and got["late"].message.startswith("ends 2026-02-27, 5 sessions before whole")
    assert got["absent"].message == "cannot be read: PATH_NOT_FOUND" and got["absent"].rows is None and "cannot be read" in got["broken"].message
    assert got["empty"].message == "empty; share is None (at most 1.0)"
    v = H.verdict(H.table_checks(spark, tables, DAY)).first()
    assert (v.ok, v.checks, v.failed) == (False, 10, 6) and v.which[0] == "tables/absent"
    assert H.table_checks(spark, [], DAY).count() == 0 and H.verdict(H.table_checks(spark, [], DAY)).first().ok


def test_tables_are_read_once(spark):
    from volframe.operators import health as H

    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(len(b))
            yield b

    frame = spark.createDataFrame([(DAY, 1.0)] * 7, "date date, x double").mapInPandas(counted, "date date, x double")
    H.table_checks(spark, [H.Table(n, lambda: frame, figures={"x": F.max("x")}) for n in "ab"], DAY)
    assert reads.value == 14


def test_runs_and_checks_that_fail(spark):
    from volframe.operators import health as H

    assert H.run_check(spark, []).first().ok and H.run_check(spark, ["Market closed on Monday"]).first().ok
    bad = H.run_check(spark, ["Market closed", "A: no quotes", "B: no quotes"]).first()
    assert (bad.ok, bad.message) == (False, "A: no quotes; B: no quotes")
    checks = spark.createDataFrame([("x", True, "fine"), ("y", None, "unknown")], "name string, good boolean, text string")
    rows = {r.check: (r.section, r.ok, r.message) for r in H.guarded(spark, "own", lambda: H.as_report("own", checks, "name", "good", "text")).collect()}
    assert rows == {"x": ("own", True, "fine"), "y": ("own", False, "unknown")}
    failed = H.guarded(spark, "own", lambda: checks.select("nothing")).first()
    assert (failed.section, failed.ok) == ("own", False) and "cannot be run" in failed.message
