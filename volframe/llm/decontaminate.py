"""Benchmark decontamination by Wu-Manber multi-pattern search (Wu and Manber, 1994) over normalised bytes.

A text is normalised to its words, each between single spaces; a pattern is a window of an item's words in the same form,
so that an occurrence begins and ends with words. Patterns are put into classes by length. In a class only the first m
bytes of each pattern count, m being the length of its shortest one:

- the shift table tells for the block of 8 bytes that ends a stretch of m bytes how far no pattern can begin, by a hash;
- where it says 0, the bucket of that last block (with the first block of the stretch beside it, to keep buckets small)
  selects the patterns that may begin here, and their bytes are compared with the text's directly.

Texts are searched at thousands of places at once: each place walks through its own piece of a buffer by its shifts.

Patterns go to the tasks in chunks of bounded size. A benchmark that fits one chunk, as most do, needs a single pass over
the documents without any shuffle; a larger one takes a pass for each chunk, and only hits meet afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volframe.llm.common import mix, release_memory, stage, text_of

BLOCK, HASH_BITS, MOST_HEAD = 8, 20, 256
#: Bytes of patterns and item ids that are sent to tasks together.
CHUNK_BYTES = 8 << 20
#: Bytes of text that are searched together; a longer text alone.
BUFFER_BYTES = 4 << 20
LANES = 4096

#: ASCII without letters and digits parts words; A-Z become a-z.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def normal(text: bytes) -> bytes:
    """Lower-cased words with one space before, between and after them; nothing if there is no word."""
    a = np.frombuffer(b" " + text.translate(_NORMAL) + b" ", np.uint8)
    space = a == 32
    keep = np.ones(len(a), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return a[keep].tobytes() if not space.all() else b""


def windows(text: bytes, width: int) -> Iterator[bytes]:
    """Patterns of all runs of `width` words, or of all words if there are fewer."""
    t = normal(text)
    at = np.flatnonzero(np.frombuffer(t, np.uint8) == 32)
    n = min(width, len(at) - 1)
    for i in range(len(at) - n if n > 0 else 0):
        yield t[at[i] : at[i + n] + 1]


class WuManber:
    """Occurrences of any of many patterns, all of at least two bytes."""

    def __init__(self, patterns: list[bytes]):
        self.number = {p: i for i, p in enumerate(patterns)}
        self.m = m = min(MOST_HEAD, min(map(len, patterns)))
        self.block = b = min(BLOCK, m)
        self.mask = np.uint64((1 << 8 * b) - 1)
        heads = np.frombuffer(b"".join(p[:m] + bytes(BLOCK) for p in patterns), np.uint8).reshape(-1, m + BLOCK)
        at = lambda j: np.ascontiguousarray(heads[:, j : j + 8]).view(np.uint64)[:, 0] & self.mask
        self.shift = np.full(1 << HASH_BITS, m - b + 1, np.int64)
        for j in range(m - b + 1):  # later blocks give smaller shifts and overwrite
            self.shift[self.hashed(at(j))] = m - b - j
        keys = self.key(at(m - b), at(0))
        self.keys, of = np.unique(keys, return_inverse=True)
        self.lengths: list[set[int]] = [set() for _ in self.keys]
        for i, p in zip(of.tolist(), patterns, strict=True):
            self.lengths[i].add(len(p))

    @staticmethod
    def hashed(v: np.ndarray) -> np.ndarray:
        return (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)

    @staticmethod
    def key(last: np.ndarray, first: np.ndarray) -> np.ndarray:
        return mix(mix(last) + first)

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(place, number of the pattern) of every occurrence, in no order."""
        n, m, b = len(text), self.m, self.block
        if n < m:
            return
        words = np.ndarray(n, np.uint64, text + bytes(BLOCK), strides=(1,))  # the eight bytes from each place on
        step = max(64, n // LANES)
        p = np.arange(0, n - m + 1, step)
        end, zero = np.minimum(p + step, n - m + 1), []
        while len(p):
            s = self.shift[self.hashed(words[p + (m - b)] & self.mask)]
            stop = s == 0
            if stop.any():
                zero.append(p[stop])
                s[stop] = 1
            p = p + s
            live = p < end
            if not live.all():
                p, end = p[live], end[live]
        if not zero:
            return
        p = np.concatenate(zero)
        key = self.key(words[p + (m - b)] & self.mask, words[p] & self.mask)
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        same = self.keys[i] == key
        for place, bucket in zip(p[same].tolist(), i[same].tolist(), strict=True):
            for length in self.lengths[bucket]:
                found = self.number.get(text[place : place + length])  # compares the bytes
                if found is not None and place + length <= n:
                    yield place, found


class Search:
    """All patterns of a chunk, in classes by length, with the ids of the items that hold each."""

    def __init__(self, patterns: list[bytes], items: list[str | None]):
        held: dict[bytes, set[str]] = {}
        for p, item in zip(patterns, items, strict=True):
            held.setdefault(p, set()).update([] if item is None else [item])
        classes: dict[int, list[bytes]] = {}
        for p in held:
            classes.setdefault(len(p).bit_length(), []).append(p)
        self.classes = [(WuManber(c), c, [held[p] for p in c], [p.count(32) - 1 for p in c]) for c in classes.values()]

    def hits(self, texts: list[bytes]) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """Of each normalised text: word ranges [from, to) that occur in items, and ids of those items."""
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        text = b"\0".join(texts)
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        for matcher, _, held, width in self.classes:
            found = list(matcher.find(text))
            if not found:
                continue
            place, which = np.array(found).T
            doc = np.searchsorted(starts, place, "right") - 1
            word = np.searchsorted(spaces, place) - np.searchsorted(spaces, starts[doc])
            for d, w, i in zip(doc.tolist(), word.tolist(), which.tolist(), strict=True):
                spans[d].append((w, w + width[i]))
                items[d] |= held[i]
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words in maximal ranges, sorted."""
    out: list[list[int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_built: dict[str, Search] = {}


def _search(chunk: Broadcast) -> Search:
    """The tables of a chunk, built once in a worker."""
    patterns, items, key = chunk.value
    if key not in _built:
        _built.clear()
        _built[key] = Search(patterns, items)
    return _built[key]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(chunk: Broadcast, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _search(chunk)
        for batch in batches:
            texts, at = batch.column("text"), 0
            while at < batch.num_rows:
                own, size, first = [], 0, at
                while at < batch.num_rows and (not own or size < BUFFER_BYTES):
                    own.append(normal(texts[at].as_py()))
                    size += len(own[-1])
                    at += 1
                spans, items = search.hits(own)
                words = pa.array([max(0, t.count(32) - 1) for t in own], pa.int64())
                spans = pa.array([[{"start": a, "end": b} for a, b in merged(s)] for s in spans], _SPANS)
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(first, at - first), words, spans, pa.array([sorted(i) for i in items], pa.list_(pa.string()))], names=[key, "n_words", "spans", "items"])
        release_memory()

    return run


def _patterns(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own, size = [], 0
                for p in windows(text, width):
                    own.append(p)
                    size += len(p)
                    if size > BUFFER_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([item] * len(own), pa.string()), pa.array(own, pa.binary())], names=["item_id", "pattern"])
                        own, size = [], 0
                if own:
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(own), pa.string()), pa.array(own, pa.binary())], names=["item_id", "pattern"])

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [merged([(x["start"], x["end"]) for x in s]) for s in batch.column("spans").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPANS), batch.column("items")], names=["row", "spans", "items"])


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, spans (ranges [start, end) of hit words), items (sorted ids).

    Words are runs of letters and digits of ASCII and of all characters beyond it, A-Z lower-cased. A window is `width`
    consecutive words of an item; an item of fewer words is one window. A word of a document is hit if it lies in an
    occurrence of a window. Null or blank texts have no words and no windows. Items that repeat an id count once; an item
    whose id is null marks words and is not among the items. Without items, or with an empty table of documents, nothing
    is hit; repeated rows and null ids of documents each keep their row. Other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    windows_of = items.select(F.col(item_col).cast("string").alias("item_id"), text_of(item_text_col).cast("binary").alias("text"))
    patterns = stage(windows_of.mapInArrow(_patterns(width), "item_id string, pattern binary").distinct(), "op12-patterns")
    total = patterns.agg(F.sum(F.length("pattern") + F.coalesce(F.length("item_id"), F.lit(0)) + 16)).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))

    def sent(k: int) -> Broadcast:
        own = patterns if chunks == 1 else patterns.where(F.pmod(F.xxhash64("pattern", "item_id"), F.lit(chunks)) == k)
        rows = own.select("pattern", "item_id").collect()
        return spark.sparkContext.broadcast(([bytes(r.pattern) for r in rows], [r.item_id for r in rows], uuid.uuid4().hex))

    kind = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"
    if chunks == 1:
        return _counted(base.mapInArrow(_scan(sent(0), "doc_id"), f"doc_id {base.schema['doc_id'].dataType.simpleString()}, {kind}"))
    base = stage(base.withColumn("row", F.monotonically_increasing_id()), "op12-rows")
    found, words = None, None
    for k in range(chunks):
        chunk = sent(k)
        hits = stage(base.select("row", "text").mapInArrow(_scan(chunk, "row"), f"row long, {kind}").where(F.size("spans") > 0 if k else F.lit(True)), "op12-hits")
        chunk.unpersist()
        words = hits.select("row", "n_words") if words is None else words
        hits = hits.where(F.size("spans") > 0).select("row", "spans", "items")
        found = hits if found is None else found.unionByName(hits)
    found = found.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    found = found.mapInArrow(_united, "row long, spans array<struct<start: long, end: long>>, items array<string>")
    out = base.select("row", "doc_id").join(words, "row").join(found, "row", "left")
    return _counted(out.select("doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _counted(out: DataFrame) -> DataFrame:
    hit: Column = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_words", hit.alias("n_hit"), "spans", "items")
