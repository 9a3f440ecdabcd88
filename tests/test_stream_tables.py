"""Tables kept by upsert_stream: only touched buckets are written, other checkpoints go on, failed batches leave no trace."""

import glob
import os

import pytest


def run(spark, src, out, cp, schema, **k):
    from volframe.streaming.ingest import file_stream, upsert_stream

    upsert_stream(file_stream(spark, src, schema), out, ["k"], "ver", cp, **k).awaitTermination(120)


def add(spark, src, rows, schema="k int, ver int, x double"):
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    frame.write.mode("append").parquet(src)
    return frame.schema


def test_only_touched_buckets_are_written(spark, tmp_path):
    from volframe.streaming.ingest import superseded, upserted

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    assert upserted(spark, out) is None and superseded(spark, out) == []
    schema = add(spark, src, [(k, 1, float(k)) for k in range(200)])
    run(spark, src, out, str(tmp_path / "cp"), schema, buckets=16)
    for ver, x in ((2, -1.0), (3, -2.0), (0, 9.0)):
        add(spark, src, [(7, ver, x)])
        run(spark, src, out, str(tmp_path / "cp"), schema, buckets=16)
    assert [len(glob.glob(f"{out}/v{n}/_bucket=*")) for n in range(4)] == [16, 1, 1, 1]
    got = {r.k: (r.x, r._version_x) for r in upserted(spark, out).collect()}
    assert got == {k: (float(k), 1) for k in range(200)} | {7: (-2.0, 3)}
    old = superseded(spark, out)  # v3 holds the bucket now, v2 would be read again if batch 3 ran twice
    assert [f.split("/")[-2] for f in old] == ["v0", "v1"] and all(os.path.isdir(f) for f in old)


def test_another_checkpoint_goes_on(spark, tmp_path):
    from volframe.streaming.ingest import upserted

    a, b, out = str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "out")
    schema = add(spark, a, [(1, 5, 1.0), (2, 5, 2.0)])
    add(spark, b, [(2, 9, 3.0), (3, None, 4.0), (None, 1, 5.0), (1, 4, None)])
    run(spark, a, out, str(tmp_path / "cpa"), schema, buckets=4)
    run(spark, b, out, str(tmp_path / "cpb"), schema, buckets=4)
    want = {1: 1.0, 2: 3.0, 3: 4.0, None: 5.0}
    assert {r.k: r.x for r in upserted(spark, out).collect()} == want
    run(spark, a, out, str(tmp_path / "fresh"), schema, buckets=4)  # the same file once more: nothing newer in it
    assert {r.k: r.x for r in upserted(spark, out).collect()} == want
    from pyspark.errors import StreamingQueryException

    with pytest.raises(StreamingQueryException, match="has 4 buckets"):
        run(spark, a, out, str(tmp_path / "other"), schema, buckets=8)


def test_a_batch_that_runs_twice(spark, tmp_path):
    from volframe.streaming.ingest import upserted

    src, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = add(spark, src, [(1, 1, 1.0), (2, 1, 2.0)])
    run(spark, src, out, cp, schema)
    add(spark, src, [(1, 1, 7.0)])
    run(spark, src, out, cp, schema)
    for f in ("1", ".1.crc"):  # batch 1 was written and not marked as done
        os.remove(f"{cp}/commits/{f}")
    run(spark, src, out, cp, schema)
    assert {r.k: r.x for r in upserted(spark, out).collect()} == {1: 7.0, 2: 2.0}
    assert not os.path.exists(f"{out}/v2")


def test_an_empty_batch(spark, tmp_path):
    from volframe.streaming.ingest import upserted

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = add(spark, src, [])
    run(spark, src, out, str(tmp_path / "cp"), schema)
    assert upserted(spark, out) is None
    add(spark, src, [(1, 1, 1.0)])
    run(spark, src, out, str(tmp_path / "cp"), schema)
    assert [r.x for r in upserted(spark, out).collect()] == [1.0]
