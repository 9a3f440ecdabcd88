"""Plain tables as stores, and a vendor's drop folder as table and stream."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

DAY = datetime.date(2026, 3, 2)


def day(n):
    return DAY + datetime.timedelta(days=n)


def test_tables_merge_by_their_rules(spark, tmp_path):
    from volframe.sources.tables import Tables

    t = Tables(spark, str(tmp_path))
    assert t.load("prices") is None and t.latest("features") is None
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    t.save("prices", frame([("A", day(0), 1.0), ("A", day(1), 2.0), ("B", day(0), 3.0)], "ticker string, date date, close double"))
    for _ in range(2):  # a second run changes nothing
        t.save("prices", frame([("A", day(1), None, 7.0), ("A", day(2), 4.0, 8.0)], "ticker string, date date, close double, open double"))
    got = {(r.ticker, (r.date - DAY).days): (r.close, r.open) for r in t.load("prices").collect()}
    assert got == {("A", 0): (1.0, None), ("A", 1): (2.0, 7.0), ("A", 2): (4.0, 8.0), ("B", 0): (3.0, None)}
    assert [r.close for r in t.load("prices", ["A"], day(1), day(1), ["close"]).collect()] == [2.0]
    with pytest.raises(Exception, match="a row without ticker or date"):
        t.save("prices", frame([("A", None, 1.0)], "ticker string, date date, close double"))

    t.save("earnings", frame([("A", day(0)), ("A", day(9)), ("B", day(1))], "ticker string, announced date"))
    t.save("earnings", frame([("A", day(8)), ("A", day(8))], "ticker string, announced date"))
    assert sorted((r.ticker, (r.announced - DAY).days) for r in t.load("earnings").collect()) == [("A", 8), ("B", 1)]
    assert t.load("earnings", start=day(2)).count() == 1

    t.save("forecasts", frame([("A", day(0), 5, 0.1), ("A", day(0), 21, 0.2)], "ticker string, date date, horizon int, vol double"))
    t.save("forecasts", frame([("A", day(0), 5, None), ("A", day(1), 5, 0.3)], "ticker string, date date, horizon int, vol double"))
    assert sorted((r.date, r.horizon, r.vol) for r in t.load("forecasts").collect()) == [(day(0), 5, None), (day(0), 21, 0.2), (day(1), 5, 0.3)]
    assert {(r.ticker, r.horizon): r.date for r in t.latest("forecasts", ["ticker", "horizon"]).collect()} == {("A", 5): day(1), ("A", 21): day(0)}

    t.save("features", frame([("A", day(0), 1.0), ("B", day(0), 1.0)], "ticker string, date date, x double"))
    t.save("features", t.load("features").where("ticker = 'A'").withColumn("x", F.col("x") + 1))
    assert [(r.ticker, r.x) for r in t.load("features").collect()] == [("A", 2.0)]


def test_rates_as_known_on_the_day(spark, tmp_path):
    from volframe.sources.tables import Tables

    t = Tables(spark, str(tmp_path))
    days = spark.createDataFrame([(day(-400),), (day(0),), (day(400),)], "date date")
    assert {r.rate for r in t.rate(days, 0.5, 0.05).collect()} == {0.05}
    t.save("rates", spark.createDataFrame([(day(-1), 0.25, 0.02), (day(-1), 1.0, 0.05), (day(300), 0.25, 0.04)], "date date, tenor_years double, rate double"))
    got = {(r.date - DAY).days: r.rate for r in t.rate(days, 0.5, 0.03).collect()}
    assert got[-400] == 0.03 and got[0] == pytest.approx(0.03) and got[400] == pytest.approx(0.04 + 0.01 / 3)
    assert t.load("rates", start=day(100)).count() == 1 and os.path.isdir(tmp_path / "rates" / "year=2026")


def payload(*strikes):
    return json.dumps({"data": {"symbol": "X", "current_price": 100.0, "options": [{"option": f"X261218C{round(k * 1000):08d}", "bid": 1.0, "ask": 1.1, "iv": 0.2, "open_interest": 5, "volume": 1, "last_trade_price": 1.0} for k in strikes]}})


def test_drops_are_read_by_name(spark, tmp_path):
    from volframe.sources import drops

    folder = tmp_path / "in"
    folder.mkdir()
    put = lambda name, text: (folder / name).write_text(text)
    put(f"AB_{day(0)}.json", payload(90, 100))
    put(f"AB_{day(1)}.json", payload(95))
    put(f"A_B_{day(1)}.json", payload(80, 81, 82))
    put(f"C_{day(1)}.json", "no json")
    put(f"D_{day(1)}.json", json.dumps({"data": {"options": []}}))
    put("notes.json", payload(1))
    put("notes.txt", "not looked at")
    rows = drops.read(spark, str(folder))
    assert {r.file[:4]: r.error for r in rows.where("error is not null").collect()} == {"C_20": "no payload", "D_20": "no options", "note": "no ticker and date in the name"}
    assert sorted((r.ticker, r.as_of, r.strike) for r in drops.quotes(rows).collect()) == sorted([("AB", day(0), 90.0), ("AB", day(0), 100.0), ("AB", day(1), 95.0), *[("A_B", day(1), k) for k in (80.0, 81.0, 82.0)]])
    one = drops.read(spark, str(folder), ["AB"], str(day(1)), str(day(1)))
    assert one.count() == 1 and drops.quotes(one).first().strike == 95.0
    scan = drops.read(spark, str(folder), start=str(day(1)))
    scan.collect()
    leaf = scan._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numFiles").value() == 5  # of six: that of the other day is dropped while files are listed


def test_streams_of_drops_read_every_file_once(spark, tmp_path):
    from volframe.sources import drops, store

    folder, chains, errors, mark = tmp_path / "in", str(tmp_path / "chains"), str(tmp_path / "errors"), str(tmp_path / "checkpoint")
    folder.mkdir()
    (folder / f"A_{day(0)}.json").write_text(payload(90, 100))
    (folder / "odd.json").write_text("?")
    go = lambda: drops.collect_stream(drops.stream(spark, str(folder)), chains, errors, mark).awaitTermination(120)
    go()
    assert store.load(spark, chains).count() == 2 and [r.file for r in spark.read.parquet(errors).collect()] == ["odd.json"]
    (folder / f"A_{day(1)}.json").write_text(payload(90, 90))
    (folder / f"A_{day(0)}.json").touch()  # known already
    go()
    go()
    assert sorted((r.date, r.strike) for r in store.load(spark, chains).collect()) == [(day(0), 90.0), (day(0), 100.0), (day(1), 90.0)]
    assert spark.read.parquet(errors).count() == 1
    batch = drops.quotes(drops.read(spark, str(folder))).distinct()
    assert batch.count() == store.load(spark, chains).count()
