"""The queries opN_<name>: each applies its operator to its whole table and derives the columns asked for."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volframe.llm.clusters import clusters
from volframe.llm.common import held_out, shared_dir
from volframe.llm.decontaminate import decontaminate
from volframe.llm.exact_dedup import exact_dedup
from volframe.llm.fingerprint import fingerprints
from volframe.llm.license_scan import fit_licenses, license_scan
from volframe.llm.minhash import near_dedup
from volframe.llm.mixing import mix
from volframe.llm.packing import pack
from volframe.llm.quality import fit_quality, quality
from volframe.llm.queries_sql import OP11, OP12, op13
from volframe.llm.suffix_dedup import suffix_dedup
from volframe.llm.toxicity import fit_toxicity, toxicity
from volframe.llm.variants import variants
from volframe.llm.warc import page_of, read_warc, write_warc

OPS_DIR = Path(__file__).resolve().parents[2]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"), length=400, first_stays=False)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan(docs, fit_licenses(docs)).withColumn("families", F.array_join("families", ","))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"), width=4, percent=80)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages"), path)
    records = read_warc(spark, path)  # archives just written have no gap
    page_id = F.when(F.col("quarantined"), F.raise_error(F.concat(F.lit("damaged bytes in "), "archive")).cast("long")).otherwise(page_of(F.col("record_id")))
    return records.select(page_id.alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to_id")).alias("refers_to"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))[0].select("doc_id", "size", "source_size", "target", "taken")


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clusters(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    if str(OPS_DIR) not in sys.path:
        sys.path.insert(0, str(OPS_DIR))
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_packing": op4_packing,
        "op5_quality": op5_quality,
        "op6_license_scan": op6_license_scan,
        "op7_fingerprints": op7_fingerprints,
        "op8_minhash": op8_minhash,
        "op9_warc": op9_warc,
        "op10_mixing": op10_mixing,
        "op11_variants": op11_variants,
        "op12_decontaminate": op12_decontaminate,
        "op13_clusters": op13_clusters,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the result; the others are held against brute force in tests/llm."""
    letters = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * g + 1}, 5))::INTEGER >> {s}) & 31) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))
    return {
        "op1_exact_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)""",
        "op8_minhash": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
x AS (SELECT doc_id, unnest(sh) AS g FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
m AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT n.doc_id, n.n AS n_shingles, m.component_id, n.doc_id = m.component_id AS kept FROM n JOIN m ON m.node = n.doc_id""",
        "op9_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS top FROM p)
SELECT page_id, payload_bytes, {letters} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM h""",
        "op11_variants": OP11,
        "op12_decontaminate": OP12,
        "op13_clusters": op13(),
    }
