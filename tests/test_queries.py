"""Queries against their SQL on the smallest tables, and operators on small frames."""

import decimal
import glob
import math
import os

import duckdb
import pytest

from volframe.plans import registry

#: Every query with SQL, by name: each must give SQL's rows on the smallest tables.
NAMES = sorted(registry.oracle_sql())


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 6) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    got = registry.queries()[name](spark, sf_dir)
    want = con.execute(registry.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    order = sorted(got.columns)
    assert sorted(cols) == order
    text = lambda row: tuple(map(str, row))
    a = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=text)
    b = sorted((tuple(plain(r[cols.index(c)]) for c in order) for r in want.fetchall()), key=text)
    assert a == b


def test_prices_keep_parity(spark):
    from pyspark.sql import functions as F

    from volframe.functions import pricing as P

    rows = spark.createDataFrame([(100.0, k, t, s) for k in (60.0, 100.0, 160.0) for t in (0.05, 1.0) for s in (0.1, 0.6)], "f double, k double, t double, s double")
    c, p = (P.black76(F.col("f"), F.col("k"), F.col("t"), F.col("s"), F.lit(0.97), F.lit(call)) for call in (True, False))
    gap = rows.select(F.max(F.abs(c - p - 0.97 * (F.col("f") - F.col("k"))))).first()[0]
    assert gap < 1e-11


def test_smile_is_recovered():
    import numpy as np

    from volframe.operators.surface import fit_svi

    k = np.linspace(-0.4, 0.3, 25)
    w = 0.02 + 0.1 * (-0.4 * (k - 0.05) + np.sqrt((k - 0.05) ** 2 + 0.04))
    a, b, rho, m, s = fit_svi(k, w, np.ones(25))
    assert np.abs(a + b * (rho * (k - m) + np.sqrt((k - m) ** 2 + s * s)) - w).max() < 1e-5


def test_asof_matches_ties_and_nulls(spark):
    from volframe.operators.timeseries import asof_join

    left = spark.createDataFrame([(1,), (5,), (None,), (5,)], "t int")
    right = spark.createDataFrame([(1, 10), (3, None), (5, 50)], "u int, v int")
    at = lambda **k: sorted(map(str, (r.v for r in asof_join(left, right, "t", "u", values=["v"], **k).collect())))
    assert at() == ["10", "50", "50", "None"]
    assert at(strict=True) == ["10", "10", "None", "None"]


def test_stream_upsert_equals_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    from volframe.operators.timeseries import newest_non_null
    from volframe.streaming.ingest import file_stream, upsert_stream

    rows = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("b", 1, 3.0), ("b", 3, 4.0)], "k string, ver int, x double")
    src = str(tmp_path / "in")
    rows.write.parquet(src)
    q = upsert_stream(file_stream(spark, src, rows.schema), str(tmp_path / "out"), ["k"], "ver", str(tmp_path / "cp"))
    q.awaitTermination(60)
    got = {r.k: r.x for r in spark.read.parquet(str(tmp_path / "out/v0")).collect()}
    want = {r.k: r.x for r in newest_non_null(rows, ["k"], "x", "ver").select("k", F.col("x")).collect()}
    assert got == want
