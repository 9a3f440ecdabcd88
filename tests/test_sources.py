"""Stores and vendors' files: merges, pruned reads, layouts."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

DAY = datetime.date(2026, 3, 2)
CHAIN = "ticker string, as_of date, expiration date, strike double, option_type string, bid double, got int"


def _chain(spark, rows):
    return spark.createDataFrame([(t, DAY + datetime.timedelta(days=d), DAY + datetime.timedelta(days=90), k, "call", b, n) for t, d, k, b, n in rows], CHAIN)


def test_chain_store_merges_and_prunes(spark, tmp_path):
    from volframe.sources import store

    path = str(tmp_path / "chains")
    store.save_chain(_chain(spark, [("A", 0, 1.0, 1.0, 1), ("A", 0, 2.0, 1.0, 1), ("A", 1, 1.0, 1.0, 1), ("B", 0, 1.0, 1.0, 1)]), path, ["got"])
    for _ in range(2):  # a second run changes nothing
        store.save_chain(_chain(spark, [("A", 0, 2.0, 5.0, 1), ("A", 0, 3.0, 5.0, 1), ("A", 0, 3.0, 6.0, 2), ("C", 0, 1.0, 5.0, 1)]), path, ["got"])
    rows = {(r.ticker, str(r.date), r.strike): r.bid for r in store.load(spark, path).collect()}
    d0, d1 = str(DAY), str(DAY + datetime.timedelta(days=1))
    assert rows == {("A", d0, 1.0): 1.0, ("A", d0, 2.0): 5.0, ("A", d0, 3.0): 6.0, ("A", d1, 1.0): 1.0, ("B", d0, 1.0): 1.0, ("C", d0, 1.0): 5.0}
    one = store.load(spark, path, tickers=["A"], start=d1, end=d1, columns=["strike"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and "PartitionFilters" in plan and "ticker" in plan.split("PartitionFilters")[1]
    assert {(r.ticker, str(r.date)) for r in store.available(spark, path).collect()} == {k[:2] for k in rows}
    facts = {r.ticker: (r.days, r.rows, r.repeated) for r in store.integrity(spark, path).collect()}
    assert facts["A"] == (2, 4, 0)
    with pytest.raises(Exception, match="without ticker"):
        store.save_chain(_chain(spark, [(None, 0, 1.0, 1.0, 1)]), path)


def test_surfaces_of_an_old_builder_are_built_again(spark, tmp_path):
    from volframe.sources import store

    chains, surfaces = str(tmp_path / "c"), str(tmp_path / "s")
    store.save_chain(_chain(spark, [("A", 0, 1.0, 1.0, 1), ("A", 1, 1.0, 1.0, 1), ("B", 0, 1.0, 1.0, 1)]), chains)
    assert store.to_build(spark, chains, surfaces).count() == 3
    fit = lambda t, d, x: spark.createDataFrame([(t, DAY + datetime.timedelta(days=d), x)], "ticker string, as_of date, a double")
    store.save_surfaces(fit("A", 0, 0.1), surfaces)
    store.save_surfaces(fit("A", 1, 0.1), surfaces, "old/0")
    assert {(r.ticker, r.date) for r in store.to_build(spark, chains, surfaces).collect()} == {("A", DAY + datetime.timedelta(days=1)), ("B", DAY)}
    store.save_surfaces(fit("A", 1, 0.2), surfaces)
    assert sorted(r.a for r in store.load_surfaces(spark, surfaces).collect()) == [0.1, 0.2]
    rec = spark.createDataFrame([("2026-03-02T10:00:00", True)], "checked_at string, ok boolean")
    store.append_record(rec, str(tmp_path / "log"))
    store.append_record(rec.withColumn("checked_at", F.lit("2026-03-03T10:00:00")).withColumn("ok", F.lit(False)), str(tmp_path / "log"))
    assert not store.latest_record(spark, str(tmp_path / "log"), "checked_at string, ok boolean").first().ok


def test_json_files_of_both_layouts(spark, tmp_path):
    from volframe.sources.vendors import json_records, normalise_records

    rec = lambda d, k, t: {"contractID": "x", "symbol": "SPY", "expiration": "2024-06-01", "strike": str(k), "type": t, "bid": "1.0", "ask": "1.2", "volume": "3", "open_interest": "4", "date": d, "implied_volatility": "0.2"}
    days = {d: [rec(d, k, t) for k in (1, 2) for t in ("call", "put")] for d in ("2024-01-02", "2024-01-03", "2024-01-04")}
    (tmp_path / "lists.json").write_text(json.dumps(list(days.values())))
    (tmp_path / "keyed.json").write_text(json.dumps(days, indent=1))
    spots = spark.createDataFrame([(datetime.date(2024, 1, 2), 10.0), (datetime.date(2024, 1, 3), 11.0), (datetime.date(2024, 1, 4), None)], "date date, close double")
    for name in ("lists", "keyed"):
        records = json_records(spark, str(tmp_path / f"{name}.json"))
        assert records.count() == 12
        chain = normalise_records(records, spots)
        assert chain.count() == 8 and {r.mid for r in chain.collect()} == {1.1}


def test_readers_say_what_is_missing(spark):
    from volframe.sources.vendors import better_source, delayed_quotes, normalised

    with pytest.raises(ValueError, match="no columns"):
        normalised(spark.createDataFrame([(1,)], "strike int"))
    with pytest.raises(ValueError, match="neither"):
        normalised(spark.createDataFrame([("2024-01-01", "2024-02-01", 1.0)], "date string, expiration string, strike double"))
    long = spark.createDataFrame([("2024-01-01", "2024-02-01", "1", " C ", 0.2), ("2024-01-01", "2023-02-01", "1", "p", 0.2), ("2024-01-01", "2024-02-01", "1", "x", 0.2), ("2024-01-01", "2024-02-01", "1", "put", None)], "date string, expiry string, strike string, type string, iv double")
    assert [(r.option_type, r.strike) for r in normalised(long).collect()] == [("call", 1.0)]
    odd = spark.createDataFrame([("A", DAY, "no json"), ("B", DAY, "{}"), ("C", DAY, None)], "ticker string, as_of date, payload string")
    assert delayed_quotes(odd).count() == 0
    quotes = lambda *bids: spark.createDataFrame([("A", DAY, float(b), b + 1.0) for b in bids], "ticker string, as_of date, bid double, ask double")
    better = lambda a, b: {r.bid for r in better_source(quotes(*a), quotes(*b)).collect()}
    assert better((0, 1), (2, 3)) == {2.0, 3.0} and better((4, 5), (2, 3)) == {4.0, 5.0} and better((), (2, 3)) == {2.0, 3.0}
    assert better((0, 1), (0, 3)) == {0.0, 1.0}  # thin, but the other is no better
    assert better((0, 4, 5), (6, 7, 8, 9)) == {0.0, 4.0, 5.0}  # two of three are two-sided: not thin, though the other has more


def test_headers_in_any_spelling(spark):
    from volframe.sources.vendors import header, resolved

    assert [header(c) for c in ("[QUOTE_DATE]", " [C_IV] ", "(P_BID)", "expire-date", "Expire Date", "[ Strike ]")] == ["quote_date", "c_iv", "p_bid", "expire_date", "expire_date", "strike"]
    names = ["[DATA_DATE]", "quote_date", "exp_date", "(Strike-Price)", "stock price", "impl_volatility_c", "best_bid_c", "call_open_interest"]
    got = resolved(spark.createDataFrame([tuple("x" for _ in names)], names))
    assert got == {"as_of": "quote_date", "expiration": "exp_date", "strike": "(Strike-Price)", "underlying_price": "stock price", "call_iv": "impl_volatility_c", "call_bid": "best_bid_c", "call_open_interest": "call_open_interest"}
