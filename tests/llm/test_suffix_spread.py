"""op2 on an anchor of very many different runs: its rows stay spread over the tasks, and the result is the contract's."""

import random

from pyspark.sql import functions as F

from tests.llm.test_suffix_contract import by_brute_force


def test_kinds_of_a_frequent_anchor_stay_where_they_are(spark):
    from volframe.llm.suffix_dedup import with_sizes

    kinds = spark.range(0, 6000, 1, 16).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 500).alias("anchor"), F.col("id").alias("whole"))
    sizes = kinds.groupBy("anchor").agg(F.count("*").alias("size"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(keep, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        rows = with_sizes(kinds, sizes).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert sorted((r.whole, r.anchor, r.size) for r in rows) == [(i, i % 500 if i % 2 else -1, 12 if i % 2 else 3000) for i in range(6000)]
    tasks = [r.task for r in rows if r.anchor == -1]
    assert max(map(tasks.count, set(tasks))) <= 200  # of 3000; all of them in one task by a join that shuffles the key


def test_passage_in_very_many_texts(spark, tmp_path):
    from volframe.llm.queries import op2_suffix_dedup

    dice = random.Random(5)
    letters = lambda n: "".join(dice.choices("abcdefghij ", k=n))
    common, tail = letters(390), letters(10)
    # one anchor of the passage has a kind of run in each text; 400 bytes repeat only in each seventh
    rows = [(k, f"{letters(60)}{k % 10}{common}{tail if k % 7 == 0 else letters(9) + '!'}{k // 10 % 10}{letters(60)}") for k in range(1300)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(16).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op2_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got == by_brute_force(rows)
    assert 180 <= sum(r[1] > 0 for r in got.values())
