"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups, keep one row of each group.

Built from DataFrame functions alone. The grouping key is (hash, normalised text): equal texts already meet inside each
map task, so a text with a third of all rows arrives as one row per task; and texts that only share a hash stay apart.
The rows get their group back by the hash alone, except hashes with several texts, which are joined on the text as well.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volframe.llm.common import SPACE, stage, text_of


def content_hash(sha256_hex: Column) -> Column:
    """128 bits of the SHA-256."""
    return F.unhex(F.substring(sha256_hex, 1, 32))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, text_chars.

    Texts are equal when identical after deleting white space. The row with the most code points stays, then the one with
    the smallest id. A null text counts as empty, and empty texts form one group. A null id comes after all others and is
    kept only if its whole group has null ids. Rows that repeat both id and text share their flag. An empty table gives
    an empty result; other columns are not read.
    """
    keyed = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).select("doc_id", F.char_length("text").cast("long").alias("n"), F.regexp_replace("text", SPACE, "").alias("norm"))
    keyed = keyed.withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256)).withColumn("h", hash_of(F.col("sha")))
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"))).alias("best")
    variants = keyed.groupBy("h", "norm").agg(F.count("*").alias("rows"), best)
    groups = stage(variants.groupBy("h").agg(F.count("*").alias("texts"), F.first("rows").alias("rows"), F.first("best").alias("best")), "op1-groups")
    rows = keyed.drop("norm")
    collided = groups.where("texts > 1").select("h")
    if collided.isEmpty():
        return _flag(rows.join(groups, "h"))
    apart = keyed.join(collided, "h", "left_semi")
    apart = apart.join(apart.groupBy("h", "norm").agg(F.count("*").alias("rows"), best), ["h", "norm"])
    return _flag(rows.join(groups.where("texts = 1"), "h")).unionByName(_flag(apart))


def _flag(joined: DataFrame) -> DataFrame:
    return joined.select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("rows").alias("group_size"), (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n") == -F.col("best.minus_n"))).alias("kept"), F.col("sha").alias("text_sha256"), F.col("n").alias("text_chars"))
