"""Packing by concatenating and cutting, with global offsets from two passes.

Pass one tokenizes each document once and writes its ids (two bytes each where the vocabulary allows) with the number of
tokens before it in its partition. The partition totals, one small row per partition, give each partition's offset. Pass
two cuts every document at the multiples of the sequence length of its global position; a document across a border gives
one record on each side. Nothing is shuffled, and only the last sequence has padding.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volframe.llm.common import release_memory, stage, text_of

#: Tasks hand on their rows whenever they hold so many ids, so that long documents need no more memory than short ones.
SLICE_IDS = 1 << 20


#: How byte-level tokenizers split a text before merging: contractions, then words, numbers and signs, each with at most one
#: space before, then white space without the last character that a word follows.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A run of white space that is cut out before the pattern sees it, since the pattern goes back over it step by step.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def _is_byte_level(spec: dict) -> bool:
    """Whether the file asks for what encoder() does by itself: byte-level BPE without prefix, normalizer or dropout."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = all(not t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))
    odd = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    return plain and not odd and spec.get("normalizer") is None and model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)


def encoder(json_path: str):
    """text -> ids (array of uint32), as Tokenizer.from_file(json_path).encode(text, add_special_tokens=False).ids gives them.

    Of a byte-level file the merges are run by tiktoken, which yields the same ids about five times faster and in less
    memory: a text is cut at strings of special tokens, which have their ids, and around long white space, whose place in
    the pattern is known. Any other file is left to the tokenizers library.
    """
    import tiktoken

    with open(json_path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    short = max([*spec["model"]["vocab"].values(), *special.values()]) < 65536
    if not _is_byte_level(spec):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(json_path)
        return lambda text: np.array(library.encode(text, add_special_tokens=False).ids, np.uint32), short
    # the printable stand-ins of a byte-level vocabulary: printable Latin-1 stands for itself, other bytes follow from 256
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    ranks = {bytes(shown[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    split, whole = (tiktoken.Encoding("bytes", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (BYTE_LEVEL, r"[\s\S]+"))
    cuts = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) or "(?!)")
    del spec

    def between(text: str) -> Iterator[np.ndarray]:
        at = 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))  # the last one may belong to the word that follows
            yield split.encode_to_numpy(text[at : run.start()])
            yield whole.encode_to_numpy(text[run.start() : end])
            at = end
        yield split.encode_to_numpy(text[at:] if at else text)

    def encode(text: str) -> np.ndarray:
        out, at = [], 0
        for cut in cuts.finditer(text):
            out += [*between(text[at : cut.start()]), np.array([special[cut.group()]], np.uint32)]
            at = cut.end()
        out += between(text[at:] if at else text)
        return out[0] if len(out) == 1 else np.concatenate(out)

    return encode, short


def _tokenize(json_path: str, end_id: int):
    schema = pa.schema([("doc_id", pa.int64()), ("before", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, short = encoder(json_path)
        at = 0
        for batch in batches:
            out, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encode(text.as_buffer().to_pybytes().decode("utf-8", "replace")), np.uint32(end_id))
                out.append((doc_id.as_py(), at, len(ids), ids.astype("<u2" if short else "<u4").tobytes()))
                at += len(ids)
                held += len(ids)
                if held >= SLICE_IDS:
                    yield pa.record_batch(list(zip(*out, strict=True)), schema=schema)
                    out, held = [], 0
            if out:
                yield pa.record_batch(list(zip(*out, strict=True)), schema=schema)
        release_memory()

    return run


def _cut(length: int, with_ids: bool):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def rows(out: list[tuple], own: list[np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
        if not with_ids:
            return pa.record_batch(columns, names)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
        return pa.record_batch([*columns, pa.ListArray.from_arrays(ends, np.concatenate(own).astype(np.int32))], [*names, "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, own, held = [], [], 0
            for doc_id, at, n, raw in zip(*(batch.column(i) for i in range(4)), strict=True):
                doc_id, at, n, raw = doc_id.as_py(), at.as_py(), n.as_py(), raw.as_buffer()
                ids = np.frombuffer(raw, "<u2" if raw.size == 2 * n else "<u4")
                start = 0
                while start < n:
                    offset = (at + start) % length
                    take = min(n - start, length - offset)
                    piece = ids[start : start + take]
                    out.append((doc_id, start, take, zlib.crc32(piece.astype("<u4").tobytes()), n, (at + start) // length, offset))
                    own.append(piece)
                    start += take
                    held += take
                    if held >= SLICE_IDS:
                        yield rows(out, own)
                        out, own, held = [], [], 0
            if out:
                yield rows(out, own)
        release_memory()

    return run


def pack(docs: DataFrame, json_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids themselves.

    A null or empty text is one piece with the end id alone; a null id stays null; repeated rows are packed each time; the
    order is that of the input's partitions. A long text spans as many sequences as it fills. An empty table gives no
    pieces; other columns are not read. json_path must be readable on the executors.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    ids = base.mapInArrow(_tokenize(json_path, end_id), "doc_id long, before long, doc_tokens long, ids binary")
    ids = stage(ids.withColumn("part", F.spark_partition_id()), "op4-ids")
    totals = ids.groupBy("part").agg(F.sum("doc_tokens").alias("n")).orderBy("part").collect()  # one row per partition
    base_of, at = [], 0
    for t in totals:
        base_of.append((t.part, at))
        at += t.n
    offsets = docs.sparkSession.createDataFrame(base_of, "part int, base long")
    placed = ids.join(F.broadcast(offsets) if len(base_of) <= 100_000 else offsets, "part").withColumn("at", F.col("base") + F.col("before"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return placed.select("doc_id", "at", "doc_tokens", "ids").mapInArrow(_cut(length, with_ids), schema)
