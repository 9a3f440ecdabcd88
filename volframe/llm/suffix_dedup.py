"""Suffix-array dedup: find the bytes of windows that occur more than once, and remove later copies or all copies.

Whole corpora have no suffix array that fits one machine, so equal windows are first made to meet. Each window of
`length` bytes has one anchor, the leftmost smallest hash among its k-grams (k = ANCHOR); equal windows have equal anchors
at equal places. A run is the windows of a text with the same anchor.

1. A run whose anchor is found nowhere else has no copies. This drops nearly all of a corpus.
2. Runs that are equal as a whole are copies window by window.
3. What is left, runs that share an anchor yet differ, is compared window by window: one run of each kind is sent, with
   its bytes, to the others of its anchor. There the window starts are put in suffix order, by their bytes to the depth
   asked for. Previous and next smaller positions in that order give each start its longest previous factor; a start whose
   factor has the full length is a later copy. Where all copies go, the neighbours on both sides count. An anchor with
   more than CLASS_RUNS different runs is handled as rows of (window hash, run) instead, counted by groupBy, so no group
   is ever gathered beyond that size.

The matches of steps 1 and 2, and those of very large anchors, rest on 128 bits of hashes; step 3 compares bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volframe.llm.common import Rolling, mix, release_memory, stage, text_of

ANCHOR = 64
CLASS_RUNS = 4_000
SLICE_WINDOWS = 60_000
SLICE_RUNS = 100_000
#: A key with more than one in so many rows is joined by broadcast; there can't be more such keys than this.
HOT_KEYS = 1_000
_BLOCK = 1 << 19
_PLACE = np.uint64((1 << 20) - 1)
_SPANS = "k1 long, k2 long, a int, n int"


def longest_previous_factors(order: Sequence[int], common: Sequence[int]) -> np.ndarray:
    """For each position the length of its longest match with an earlier one.

    order: positions 0..n-1 in suffix order; common[i]: common bytes of order[i - 1] and order[i]. Going through the order,
    a position's match with the last smaller one before it (and, backwards, after it) is the least of `common` between.
    """
    out = np.zeros(len(order), np.int64)
    for seq, between in ((order, common), (order[::-1], [0, *common[:0:-1]][: len(order)])):
        stack: list[tuple[int, int]] = []  # (position, common bytes with the entry below)
        for i, n in zip(seq, between, strict=True):
            while stack and stack[-1][0] > i:
                n = min(n, stack.pop()[1])
            if stack:
                out[i] = max(out[i], n)
            stack.append((i, n if stack else 0))
    return out


def lpf(data: bytes) -> list[int]:
    """Longest previous factors of all positions of a short text."""
    order = sorted(range(len(data)), key=lambda i: data[i:])
    common = [0]
    for i, j in zip(order, order[1:], strict=False):
        k = 0
        while max(i, j) + k < len(data) and data[i + k] == data[j + k]:
            k += 1
        common.append(k)
    return longest_previous_factors(order, common[: len(order)]).tolist()


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def runs_of(data: np.ndarray, length: int, roll: Rolling) -> tuple[np.ndarray, ...]:
    """Runs of a text: hash of the anchor, hash of the whole run, first window start, number of windows."""
    k, parts = min(ANCHOR, length), []
    for s in range(0, len(data) - length + 1, _BLOCK):
        seg = data[s : min(len(data), s + _BLOCK + length - 1)]
        sums = roll.sums(seg)
        at = np.arange(len(seg) - k + 1)
        grams = mix(roll.of(sums, at, at + k))
        least = _sliding_min((grams & ~_PLACE) | at.astype(np.uint64), length - k + 1)
        place = (least & _PLACE).astype(np.int64)
        lo = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        hi = np.concatenate([lo[1:], [len(place)]])
        n = hi - lo
        whole = roll.of(sums, lo, hi - 1 + length)
        whole = mix(whole + mix((n << 20 | (place[lo] - lo)).astype(np.uint64)))
        parts.append((grams[place[lo]].view(np.int64), whole.view(np.int64), lo + s, n))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def _all_runs(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll = Rolling(1)

        def rows(found: list) -> pd.DataFrame:
            k1, k2, parts = zip(*found, strict=True)
            anchor, whole, a, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            sizes = [len(p[0]) for p in parts]
            return pd.DataFrame({"anchor": anchor, "whole": whole, "k1": np.repeat(np.array(k1, np.int64), sizes), "k2": np.repeat(np.array(k2, np.int64), sizes), "a": a.astype(np.int32), "n": n.astype(np.int32)})

        for pdf in batches:
            found, held = [], 0
            for k1, k2, text in zip(pdf.k1, pdf.k2, pdf.text, strict=True):
                data = _bytes(text)
                if len(data) >= length:
                    found.append((k1, k2, runs_of(data, length, roll)))
                    held += len(found[-1][2][0])
                if held >= SLICE_RUNS:
                    yield rows(found)
                    found, held = [], 0
            if found:
                yield rows(found)
        release_memory()

    return run


def _cut(length: int):
    """Bytes of the wanted runs of each text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["anchor", "whole", "copies", "size", "k1", "k2", "a", "n", "piece"]
        for pdf in batches:
            out = []
            for k1, k2, text, wanted in zip(pdf.k1, pdf.k2, pdf.text, pdf.wanted, strict=True):
                data = text.encode("utf-8", "surrogatepass")
                out += [(w["anchor"], w["whole"], w["copies"], w["size"], k1, k2, w["a"], w["n"], data[w["a"] : w["a"] + w["n"] - 1 + length]) for w in wanted]
                if len(out) >= 10_000:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)
        release_memory()

    return run


def _windows(pdf: pd.DataFrame, length: int, rolls: tuple[Rolling, Rolling]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each window of the runs: row, place in the run, two hashes."""
    data = np.frombuffer(b"".join(pdf.piece), np.uint8)
    n = pdf.n.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(pdf)), n)
    i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    size = n - 1 + length
    start = np.repeat(np.cumsum(size) - size, n) + i
    h1, h2 = (mix(r.of(r.sums(data), start, start + length)) for r in rolls)
    return row, i, h1, h2


def _stretches(pdf: pd.DataFrame, row: np.ndarray, i: np.ndarray) -> pd.DataFrame:
    """Maximal stretches of the given windows, as (k1, k2, a, n)."""
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (i[1:] != i[:-1] + 1)])) if len(row) else np.empty(0, np.int64)
    n = np.diff(np.concatenate([first, [len(row)]])) if len(row) else first
    at = row[first]
    return pd.DataFrame({"k1": pdf.k1.to_numpy()[at], "k2": pdf.k2.to_numpy()[at], "a": (pdf.a.to_numpy()[at] + i[first]).astype(np.int32), "n": n.astype(np.int32)})


def matched(pdf: pd.DataFrame, length: int, first_stays: bool, rolls: tuple[Rolling, Rolling]) -> pd.DataFrame:
    """Windows of these runs that match another one (an earlier one, if the first stays)."""
    pdf = pdf.drop_duplicates(["k1", "k2", "a"])  # rows that repeat id and text
    pdf = pdf.sort_values(["k1", "k2", "a"], kind="stable", ignore_index=True)  # text order, which gives positions
    row, i, h1, _ = _windows(pdf, length, rolls)
    # a window whose hash is alone has no equal; the others are put in the order of their bytes
    ranked = np.argsort(h1, kind="stable")
    twin = np.concatenate([[False], h1[ranked][1:] == h1[ranked][:-1], [False]])
    some = np.sort(ranked[twin[1:] | twin[:-1]])
    bytes_of = [pdf.piece[r][k : k + length] for r, k in zip(row[some].tolist(), i[some].tolist(), strict=True)]
    order = sorted(range(len(some)), key=bytes_of.__getitem__)
    common = [0, *(length if bytes_of[x] == bytes_of[y] else 0 for x, y in zip(order, order[1:], strict=False))][: len(order)]
    if first_stays:
        hit = longest_previous_factors(order, common) >= length
    else:
        near, hit = np.array([*common, 0]) >= length, np.zeros(len(some), bool)
        hit[np.array(order, int)] = near[:-1] | near[1:]
        hit &= (pdf.copies.to_numpy() == 1)[row[some]]
    return _stretches(pdf, row[some[hit]], i[some[hit]])


def _by_anchor(length: int, first_stays: bool):
    """matched() over whole anchors, which come in order, of about SLICE_WINDOWS windows at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolls, rest = (Rolling(2), Rolling(3)), None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            anchor, windows = pdf.anchor.to_numpy(), pdf.n.to_numpy().cumsum()
            ends = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            at = 0
            for end in ends:
                if windows[end - 1] - (windows[at - 1] if at else 0) >= SLICE_WINDOWS or end == ends[-1]:
                    yield matched(pdf.iloc[at:end], length, first_stays, rolls)
                    at = end
            rest = pdf.iloc[at:]
        if rest is not None:
            yield matched(rest, length, first_stays, rolls)
        release_memory()

    return run


def _window_rows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rolls = (Rolling(2), Rolling(3))
        for pdf in batches:
            for s in range(0, len(pdf), 500):
                part = pdf.iloc[s : s + 500].reset_index(drop=True)
                row, i, h1, h2 = _windows(part, length, rolls)
                yield pd.DataFrame({"h1": h1.view(np.int64), "h2": h2.view(np.int64), "alone": (part.copies == 1).to_numpy()[row], "k1": part.k1.to_numpy()[row], "k2": part.k2.to_numpy()[row], "a": (part.a.to_numpy()[row] + i).astype(np.int32)})

    return run


def _remove(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "n_bytes", "n_removed", "removed", "kept"]
        for pdf in batches:
            out, held = [], 0
            for doc_id, text, spans in zip(pdf.doc_id, pdf.text, pdf.spans, strict=True):
                data, merged = text.encode("utf-8", "surrogatepass"), []
                for a, e in sorted((x["a"], x["a"] + x["n"] - 1 + length) for x in (spans if spans is not None else ())):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([a, e])
                kept, at = [], 0
                for a, e in merged:
                    kept.append(data[at:a])
                    at = e
                kept = b"".join([*kept, data[at:]])
                out.append((doc_id, len(data), len(data) - len(kept), [{"start": a, "end": e} for a, e in merged], kept))
                held += len(kept)
                if held >= 1 << 23:
                    yield pd.DataFrame(out, columns=columns)
                    out, held = [], 0
            yield pd.DataFrame(out, columns=columns)
        release_memory()

    return run


def _join_hot(rows: DataFrame, counts: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """rows joined with counts (without the count), which says how often each key occurs among the `total` rows.

    Keys with more than total / HOT_KEYS rows are fewer than HOT_KEYS: these are broadcast and their rows not shuffled.
    """
    hot = F.broadcast(counts.where(F.col(count) > max(total // HOT_KEYS, 1000)).drop(count))
    rest = counts.where(F.col(count) <= max(total // HOT_KEYS, 1000)).drop(count)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys))


def with_sizes(kinds: DataFrame, sizes: DataFrame) -> DataFrame:
    """kinds with the number of kinds of their anchor; those of anchors with many stay in the tasks they are in."""
    return _join_hot(kinds, sizes.withColumn("rows", F.col("size")), ["anchor"], "rows", kinds.count())


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, first_stays: bool = True, class_runs: int = CLASS_RUNS) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, removed (start and end of each removed run), kept (bytes).

    Every byte of a window of `length` bytes that also starts elsewhere is removed: with first_stays the window that comes
    first by (id, position) is left, otherwise all copies go. Matches never cross documents, texts are bytes of UTF-8 and
    are judged as they came in. A null or short text has nothing removed. A null id sorts as id 0; rows that repeat both
    id and text count as copies of each other and get the same result (with first_stays, theirs is that of a first copy).
    An empty table gives an empty result; other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    base = base.select(F.coalesce("doc_id", F.lit(0)).alias("k1"), F.xxhash64("doc_id", "text").alias("k2"), "doc_id", "text")
    runs = stage(base.mapInPandas(_all_runs(length), "anchor long, whole long, k1 long, k2 long, a int, n int"), "op2-runs")

    # steps 1 and 2
    anchors = runs.groupBy("anchor").agg(F.count("*").alias("c"), F.min("whole").alias("w0"), F.max("whole").alias("w1")).where("c > 1")
    anchors = stage(anchors.select("anchor", "c", (F.col("w0") != F.col("w1")).alias("differ")), "op2-anchors")
    shared = stage(_join_hot(runs, anchors, ["anchor"], "c", runs.count()), "op2-shared")
    sample = F.min(F.struct("k1", "k2", "a", "n")).alias("s")
    kinds = stage(shared.groupBy("anchor", "whole").agg(F.count("*").alias("copies"), F.first("differ").alias("differ"), sample), "op2-kinds")
    whole = _join_hot(shared.select("anchor", "whole", "k1", "k2", "a", "n"), kinds.where("copies > 1").select("anchor", "whole", "copies", "s"), ["anchor", "whole"], "copies", shared.count())
    if first_stays:
        whole = whole.where("struct(k1, k2, a) <> struct(s.k1, s.k2, s.a)")
    spans = whole.select("k1", "k2", "a", "n")

    # step 3
    differing = kinds.where("differ")
    sizes = stage(differing.groupBy("anchor").agg(F.count("*").alias("size")), "op2-sizes")
    wanted = with_sizes(differing, sizes).groupBy("s.k1", "s.k2")
    wanted = wanted.agg(F.collect_list(F.struct("anchor", "whole", "copies", "size", "s.a", "s.n")).alias("wanted"))
    pieces = base.select("k1", "k2", "text").join(wanted, ["k1", "k2"])
    pieces = pieces.mapInPandas(_cut(length), "anchor long, whole long, copies long, size long, k1 long, k2 long, a int, n int, piece binary")
    if sizes.where(F.col("size") > class_runs).isEmpty():
        small = pieces
    else:
        pieces = stage(pieces.dropDuplicates(["anchor", "whole"]), "op2-pieces")
        small = pieces.where(F.col("size") <= class_runs)
        rows = stage(pieces.where(F.col("size") > class_runs).mapInPandas(_window_rows(length), "h1 long, h2 long, alone boolean, k1 long, k2 long, a int"), "op2-windows")
        again = rows.groupBy("h1", "h2").agg(F.count("*").alias("c"), F.min(F.struct("k1", "k2", "a")).alias("s")).where("c > 1")
        rows = rows.join(again, ["h1", "h2"])
        rows = rows.where("struct(k1, k2, a) <> s") if first_stays else rows.where("alone")
        spans = spans.unionByName(rows.select("k1", "k2", "a", F.lit(1).alias("n")))
    small = small.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(_by_anchor(length, first_stays), _SPANS)
    spans = spans.unionByName(small).groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "n")).alias("spans"))
    out = base.join(spans, ["k1", "k2"], "left").select(F.col("doc_id").cast("string"), "text", "spans")
    return out.mapInPandas(_remove(length), "doc_id string, n_bytes long, n_removed long, removed array<struct<start:int,end:int>>, kept binary").withColumn("doc_id", F.col("doc_id").cast("long"))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
