"""A late row with an older version doesn't replace a newer value, whichever batch brings it."""


def test_out_of_order_batches(spark, tmp_path):
    from volframe.streaming.ingest import file_stream, upsert_stream

    schema, src = "k string, ver int, x double, y string", str(tmp_path / "in")
    batches = [[("a", 5, 5.0, None), ("b", 1, 1.0, "b1"), (None, 2, 2.0, "n2")], [("a", 2, 2.0, "a2"), ("b", 3, None, "b3"), (None, 1, 1.0, "n1"), ("c", None, 9.0, None)]]
    for rows in batches:
        frame = spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("append").parquet(src)
        upsert_stream(file_stream(spark, src, frame.schema), str(tmp_path / "out"), ["k"], "ver", str(tmp_path / "cp")).awaitTermination(60)
    got = {r.k: (r.x, r.y) for r in spark.read.parquet(str(tmp_path / "out/v1")).collect()}
    assert got == {"a": (5.0, "a2"), "b": (1.0, "b3"), None: (2.0, "n2"), "c": (9.0, None)}
