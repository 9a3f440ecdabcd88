"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces of paragraphs.

A paragraph is a line with its line feed; sections are runs of paragraphs that end where a paragraph's digest says so, so
that an inserted paragraph moves no later border. Below that, a paragraph is cut after white space where the bytes before
it say so. Root = digest of the section digests, section = digest of its paragraph digests, paragraph = digest of its
bytes; pieces, the leaves, have rolling hashes and lengths. The fingerprint is the root, a point, and the whole tree with
shorter digests. Equal roots are equal texts. Otherwise two trees are walked from the top: branches with equal digests are
left alone, and the runs of branches between them are compared one level down. Leaves without a partner are the edits;
the bytes of matched branches and leaves, over those of both texts, are the likeness. No text is needed for either.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volframe.llm.common import Rolling, mix, release_memory, text_of

SECTION_ODDS, PIECE_ODDS, LOOK_BACK = 4, 6, 12
#: Bytes of the stored digests of sections, paragraphs and leaves; leaves count as equal if their lengths agree, too.
SECTION_BYTES, PARAGRAPH_BYTES, LEAF_BYTES = 8, 6, 4
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


@dataclass
class Tree:
    """Digests by level, and for each branch the end of its children in the level below (of leaves: the end in bytes)."""

    root: str
    sections: list[bytes]
    section_ends: list[int]
    paragraphs: list[bytes]
    paragraph_ends: list[int]
    leaves: list[int]
    leaf_ends: list[int]

    def text(self) -> str:
        """root.base64(four counts, digests, and sizes of branches: a byte each, those of 255 or more again in four)."""
        ends = [np.diff(np.array([0, *e], np.int64)) for e in (self.section_ends, self.paragraph_ends, self.leaf_ends)]
        sizes = np.concatenate(ends)
        large = sizes[sizes >= 255].astype("<u4")
        counts = np.array([len(self.sections), len(self.paragraphs), len(self.leaves), len(large)], "<u4")
        low = (np.array(self.leaves, np.uint64) & np.uint64(0xFFFFFFFF)).astype("<u4")
        data = [counts.tobytes(), *self.sections, *self.paragraphs, low.tobytes(), np.minimum(sizes, 255).astype(np.uint8).tobytes(), large.tobytes()]
        return f"{self.root}.{base64.b64encode(b''.join(data)).decode()}"

    @classmethod
    def of_text(cls, print_: str) -> Tree:
        root, _, rest = print_.partition(".")
        data = base64.b64decode(rest)
        s, p, n, large = np.frombuffer(data, "<u4", 4).tolist()
        at = 16
        sections = [data[at + SECTION_BYTES * i : at + SECTION_BYTES * (i + 1)] for i in range(s)]
        at += SECTION_BYTES * s
        paragraphs = [data[at + PARAGRAPH_BYTES * i : at + PARAGRAPH_BYTES * (i + 1)] for i in range(p)]
        at += PARAGRAPH_BYTES * p
        low = np.frombuffer(data, "<u4", n, at).astype(np.int64)
        at += LEAF_BYTES * n
        sizes = np.frombuffer(data, np.uint8, s + p + n, at).astype(np.int64)
        sizes[sizes == 255] = np.frombuffer(data, "<u4", large, at + s + p + n)
        length = sizes[s + p :]
        return cls(root, sections, np.cumsum(sizes[:s]).tolist(), paragraphs, np.cumsum(sizes[s : s + p]).tolist(), (low | length << 32).tolist(), np.cumsum(length).tolist())


def pieces(data: bytes, roll: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the leaves, which also end at line feeds, and their rolling hashes."""
    if not data:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    d = np.frombuffer(data, np.uint8)
    sums = roll.sums(d)
    cut = np.flatnonzero(_BLANK[d]) + 1
    chosen = mix(roll.of(sums, np.maximum(cut - LOOK_BACK, 0), cut)) % np.uint64(PIECE_ODDS) == 0
    end = cut[chosen | (d[cut - 1] == 10)]
    if not len(end) or end[-1] != len(d):
        end = np.append(end, len(d))
    start = np.concatenate([[0], end[:-1]])
    return end, mix(roll.of(sums, start, end))


def tree(data: bytes, roll: Rolling) -> Tree:
    ends, hashes = pieces(data, roll)
    lines = [x + b"\n" for x in data.split(b"\n")]
    lines[-1] = lines[-1][:-1]
    if not lines[-1]:
        lines.pop()
    full = [_digest(x) for x in lines]
    above, section_ends, first = [], [], 0
    for i, digest in enumerate(full):
        if digest[0] % SECTION_ODDS == 0 or i == len(full) - 1:
            above.append(_digest(b"".join(full[first : i + 1])))
            section_ends.append(i + 1)
            first = i + 1
    root = _digest(b"".join(above) + len(data).to_bytes(8, "little")).hex()
    bytes_end = np.cumsum([len(x) for x in lines])
    length = np.diff(np.concatenate([[0], ends])).astype(np.int64)
    low = (hashes >> np.uint64(32)).astype(np.int64)
    leaf_at = np.searchsorted(ends, bytes_end, "right").tolist() if len(lines) else []
    return Tree(root, [x[:SECTION_BYTES] for x in above], section_ends, [x[:PARAGRAPH_BYTES] for x in full], leaf_at, (low | length << 32).tolist(), ends.tolist())


def fingerprint(text: str, roll: Rolling | None = None) -> str:
    return tree(text.encode("utf-8", "surrogatepass"), roll or Rolling(7)).text()


def aligned(a: Sequence, b: Sequence) -> list[tuple[int, int, int]]:
    """Common runs (place in a, place in b, length) in the order of both.

    Equal ends are taken first, then what is once on both sides (the longest rising chain of it), and so on between these;
    where nothing is once, each item takes the next equal one.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, m = todo.pop()
        n = 0
        while i + n < k and j + n < m and a[i + n] == b[j + n]:
            n += 1
        if n:
            out.append((i, j, n))
            i, j = i + n, j + n
        n = 0
        while k - n > i and m - n > j and a[k - n - 1] == b[m - n - 1]:
            n += 1
        if n:
            k, m = k - n, m - n
            out.append((k, m, n))
        if i == k or j == m:
            continue
        here, there = Counter(a[i:k]), Counter(b[j:m])
        once = {b[y]: y for y in range(j, m) if there[b[y]] == 1 and here.get(b[y]) == 1}
        if not once:
            if here.keys() & there.keys():
                out += _in_turn(a, b, i, k, j, m)
            continue
        chain = _rising([(x, once[a[x]]) for x in range(i, k) if a[x] in once])
        for x, y in chain:
            todo.append((i, x + 1, j, y + 1))  # ends in the pair itself
            i, j = x + 1, y + 1
        todo.append((i, k, j, m))
    out.sort()
    return out


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain of pairs that rises in both places; the pairs come sorted by the first."""
    tails, at, before = [], [], [-1] * len(pairs)
    for n, (_, y) in enumerate(pairs):
        p = bisect_left(tails, y)
        before[n] = at[p - 1] if p else -1
        tails[p : p + 1], at[p : p + 1] = [y], [n]
    out, n = [], at[-1]
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _in_turn(a: Sequence, b: Sequence, i: int, k: int, j: int, m: int) -> list[tuple[int, int, int]]:
    places, out = defaultdict(list), []
    for y in range(j, m):
        places[b[y]].append(y)
    for x in range(i, k):
        own = places.get(a[x])
        p = bisect_left(own, j) if own else 0
        if own and p < len(own):
            out.append((x, own[p], 1))
            j = own[p] + 1
    return out


def _gaps(runs: list[tuple[int, int, int]], i: int, k: int, j: int, m: int) -> Iterator[tuple[int, int, int, int]]:
    for x, y, n in [*runs, (k, m, 0)]:
        if x > i or y > j:
            yield i, x, j, y
        i, j = x + n, y + n


def walk(one: Tree, other: Tree) -> tuple[int, list[tuple[int, int, int, int]]]:
    """Bytes in matched branches, and the runs of leaves without a partner as (from, to, from, to) in both trees."""
    if one.root == other.root:
        return (one.leaf_ends or [0])[-1], []
    same, edits = 0, []
    start = lambda ends, i: ends[i - 1] if i else 0
    size = lambda i, n: start(one.leaf_ends, i + n) - start(one.leaf_ends, i)

    def below(gap, ends, other_ends):
        i, k, j, m = gap
        return start(ends, i), start(ends, k), start(other_ends, j), start(other_ends, m)

    top = aligned(one.sections, other.sections)
    for x, _, n in top:
        p, q = start(one.section_ends, x), start(one.section_ends, x + n)
        p, q = start(one.paragraph_ends, p), start(one.paragraph_ends, q)
        same += size(p, q - p)
    for gap in _gaps(top, 0, len(one.sections), 0, len(other.sections)):
        i, k, j, m = below(gap, one.section_ends, other.section_ends)
        middle = [(i + x, j + y, n) for x, y, n in aligned(one.paragraphs[i:k], other.paragraphs[j:m])]
        for x, _, n in middle:
            p, q = start(one.paragraph_ends, x), start(one.paragraph_ends, x + n)
            same += size(p, q - p)
        for inner in _gaps(middle, i, k, j, m):
            p, q, u, v = below(inner, one.paragraph_ends, other.paragraph_ends)
            low = [(p + x, u + y, n) for x, y, n in aligned(one.leaves[p:q], other.leaves[u:v])]
            same += sum(size(x, n) for x, _, n in low)
            edits += _gaps(low, p, q, u, v)
    return same, edits


def likeness_of(one: Tree, other: Tree) -> float:
    """0 to 1: bytes of matched branches over those of both texts; 1 for equal roots alone."""
    if one.root == other.root:
        return 1.0
    total = (one.leaf_ends or [0])[-1] + (other.leaf_ends or [0])[-1]
    return min(2 * walk(one, other)[0] / total, 1 - 1e-9) if total else 1.0


def likeness(one: str, other: str) -> float:
    return likeness_of(Tree.of_text(one), Tree.of_text(other))


def edits(one: str, other: str) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, start, end) in bytes of both texts, from two fingerprints alone, in order; [] for equal roots.

    Kinds are insert, delete, replace, and move for leaves that are only elsewhere. An edit covers whole leaves.
    """
    a, b = Tree.of_text(one), Tree.of_text(other)
    start = lambda ends, i: ends[i - 1] if i else 0
    runs = walk(a, b)[1]
    gone = {tuple(a.leaves[i:k]): n for n, (i, k, j, m) in enumerate(runs) if k > i and j == m}
    moved = {n: gone[key] for n, (i, k, j, m) in enumerate(runs) if i == k and m > j and (key := tuple(b.leaves[j:m])) in gone}
    back, out = {v: k for k, v in moved.items()}, []
    for n, (i, k, j, m) in enumerate(runs):
        if n in moved:  # reported where it was
            continue
        kind = "move" if n in back else "insert" if i == k else "delete" if j == m else "replace"
        j, m = runs[back[n]][2:] if n in back else (j, m)
        out.append((kind, start(a.leaf_ends, i), start(a.leaf_ends, k), start(b.leaf_ends, j), start(b.leaf_ends, m)))
    return out


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come in order within a bucket; each is told of the one after it, so one row is held back."""
    roll, held = Rolling(7), None

    def facts(r):
        return r, tree(r.text.encode("utf-8", "surrogatepass"), roll)

    def told(one, after):
        (r, own), (nxt, next_tree) = one, after
        half = len(r.text) // 2
        edited = r.text[: len(r.text) - half] + nxt.text[:half]
        data = edited.encode("utf-8", "surrogatepass")
        new = own if edited == r.text else tree(data, roll)
        return (r.id, len(r.text), hashlib.sha256(data).hexdigest(), own.text(), new.text(), likeness_of(own, new), likeness_of(own, next_tree))

    for pdf in batches:
        out, size = [], 0
        for r in pdf.itertuples(index=False):
            now = facts(r)
            if held is not None and held[0].bucket == r.bucket:
                out.append(told(held, now))
                size += len(out[-1][3]) + len(out[-1][4])
            held = None if r.sentinel else now
            if size > 1 << 22:
                yield pd.DataFrame(out, columns=_COLUMNS)
                out, size = [], 0
        yield pd.DataFrame(out, columns=_COLUMNS)
    release_memory()


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KEY = "struct<none:boolean,down:bigint,h:bigint>"


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 20_000, least_rows: int = 500) -> DataFrame:
    """One row per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id, after the smallest the largest; the edited text is the text with
    its last half (rounded down) replaced by as many of the first characters of the next. Rows are dealt into ranges of
    (id, hash of the text), whose borders Spark's range partitioning finds over these two alone, and the first row of each
    range is also sent to the end of the range before it; so no task sees all rows, ids that a third of all rows share are
    split, and no text is shuffled twice. A null text is empty; null ids come last; rows with equal ids are ordered by a
    hash of their texts, then by text, and rows equal in both are interchangeable. A single row is its own next one; an
    empty table gives an empty result. Other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("down"), F.xxhash64("text").alias("h"))
    out = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    keyed = base.select("doc_id", "text", key.alias("key"))
    n, parts = docs.count(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, -(-n // rows_per_range), min(parts, -(-n // least_rows)))  # the driver sees a hundred keys a range
    firsts = keyed.select("key").repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("key")).orderBy("key")
    rows = [r.key for r in firsts.collect()]  # a row for each range
    n = max(len(rows), 1)
    text = ",".join(f'{{"none":{str(k.none).lower()},"down":{k.down},"h":{k.h}}}' for k in rows)
    points = F.from_json(F.lit(f"[{text}]"), f"array<{_KEY}>")
    # the last range whose first key is not above the row's, by halving
    middle = lambda s: ((s.lo + s.hi + 1) / 2).cast("int")
    halve = lambda s, _: F.when(s.lo >= s.hi, s).when(F.get(points, middle(s)) <= F.col("key"), F.struct(middle(s).alias("lo"), s.hi.alias("hi"))).otherwise(F.struct(s.lo.alias("lo"), (middle(s) - 1).alias("hi")))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length())), F.struct(F.lit(0).alias("lo"), F.lit(n - 1).alias("hi")), halve)["lo"]
    dealt = keyed.withColumn("range", found)
    first = F.get(points, F.col("range")) == F.col("key")
    dealt = dealt.withColumn("sentinel", F.explode(F.when(first, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    dealt = dealt.withColumn("bucket", F.when(F.col("sentinel"), F.pmod(F.col("range") - 1, F.lit(n))).otherwise(F.col("range")))
    dealt = dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "sentinel", "key", "text")
    told = dealt.select("bucket", "sentinel", F.col("doc_id").cast("string").alias("id"), "text").mapInPandas(_walk, out)
    return told.withColumn("doc_id", F.col("doc_id").cast("long"))
