"""Grouping of spelling variants by neighbourhoods over a reduced alphabet.

1. Words are counted: each task adds up its own, then the sums meet by word.
2. Letters are hashed to a few symbols. A word's key is a 64-bit hash of its symbols.
3. Every word generates the keys of all reduced words one edit away from its own (symbols deleted, replaced, inserted, and
   none changed). Keys that no word has are mostly sorted out by a bitmap of fixed size before anything is shuffled.
4. The generated keys are joined with the vocabulary's, and each pair is verified on the original strings.

A key of more than `hot` words is joined in another way, so that its words are never paired with each other: they and the
words whose neighbourhoods reach it are taken again with an alphabet in which every letter is a symbol of its own, where
almost all pairs that meet are near. The result is the same.

Hashes of edited words come from prefix sums, so that a word of n letters takes time and memory in proportion to n, not to
its square.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volframe.llm.common import mix, release_memory, stage, text_of

LETTERS = "A-Za-zÀ-ÿ"
SYMBOLS, EVERY = 8, 256  # of the reduced alphabet; of the one that keeps all letters apart
#: Bits of the bitmap of keys that occur.
BITMAP_BITS = 26
#: Words with a key, beyond which it counts as hot.
HOT = 1000
#: Words that a task adds up before it sends them on; characters of a text that are taken at once; keys generated at once.
MOST_WORDS, PIECE, MOST_KEYS = 300_000, 1 << 20, 1 << 21

_RUN = re.compile(f"[{LETTERS}]+")
_GAP = re.compile(f"[^{LETTERS}]")
_BASE = 0x9E3779B97F4A7C15
_UP = np.uint64(_BASE)
_DOWN = np.uint64(pow(_BASE, -1, 1 << 64))


def runs(text: str) -> Counter[str]:
    """Maximal runs of letters with A-Z lower-cased, counted; a long text is taken piece by piece."""
    out: Counter[str] = Counter()
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = gap.start() if gap else len(text)
        out.update(_RUN.findall(text[at:end].encode().lower().decode()))  # bytes.lower() is ASCII's
        at = end
    return out


def spelled(doc_id: int | None, run: str, every: int) -> str:
    """The run as it counts: one of `every` runs of a document, chosen by hash, lacks a letter. A null id deletes none."""
    h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]


def _count(every: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sent(words: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for r, n in runs(text.as_py()).items():
                    if len(r) >= least and len(w := spelled(doc_id, r, every)) >= least:
                        words[w] += n
                if len(words) >= MOST_WORDS:
                    yield sent(words)
                    words = Counter()
        yield sent(words)
        words.clear()
        release_memory()

    return run


def symbols(word_matrix: np.ndarray, q: int) -> np.ndarray:
    """Letters (code points) as symbols below q: all apart if q is EVERY, since letters are below U+0100."""
    return word_matrix & 255 if q == EVERY else ((mix(np.arange(256, dtype=np.uint64)) >> np.uint64(11)) % np.uint64(q)).astype(np.int64)[word_matrix & 255]


def _weights(q: int) -> np.ndarray:
    return mix(np.arange(1, q + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _UP, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def _matrix(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.int64)


def keys_of(words: list[str], q: int) -> np.ndarray:
    """The key of each word."""
    out, weights = np.zeros(len(words), np.uint64), _weights(q)
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w), []).append(i)
    for n, own in by.items():
        for at in range(0, len(own), max(1, MOST_KEYS // max(n, 1))):
            some = own[at : at + max(1, MOST_KEYS // max(n, 1))]
            out[some] = (weights[symbols(_matrix([words[i] for i in some]), q)] * _powers(n)).sum(axis=1, dtype=np.uint64)
    return out


def neighbourhood(words: list[str], q: int, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in words, keys) of the reduced words within one edit of each, each once, that the bitmap may know.

    words have equal length. Positions are taken in slices, so that a very long word needs little more memory than itself.
    """
    n, weights, powers = len(words[0]), _weights(q), _powers(len(words[0]) + 1)
    x = weights[symbols(_matrix(words), q)] * powers[:n]
    before = np.zeros((len(words), n + 1), np.uint64)
    np.cumsum(x, axis=1, out=before[:, 1:])
    whole = before[:, -1:]
    at, got = [], []

    def put(keys: np.ndarray) -> None:
        keys = keys.reshape(len(words), -1)
        r, c = np.nonzero(in_bitmap(known, keys))
        at.append(r)
        got.append(keys[r, c])

    put(whole)
    step = max(1, MOST_KEYS // (q * len(words)))
    for a in range(0, n + 1, step):
        b, e = min(a + step, n), min(a + step, n + 1)
        put(before[:, a:b] + (whole - before[:, a + 1 : b + 1]) * _DOWN)
        put((whole - x[:, a:b])[:, :, None] + weights * powers[a:b, None])
        put((before[:, a:e] + (whole - before[:, a:e]) * _UP)[:, :, None] + weights * powers[a:e, None])
    place, key = np.concatenate(at), np.concatenate(got)
    order = np.lexsort((key, place))
    place, key = place[order], key[order]
    first = np.ones(len(key), bool)
    first[1:] = (place[1:] != place[:-1]) | (key[1:] != key[:-1])
    yield place[first], key[first]


def _bit(keys: np.ndarray) -> np.ndarray:
    return mix(keys) >> np.uint64(64 - BITMAP_BITS)


def in_bitmap(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    b = _bit(keys)
    return (known[(b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _keyed(q: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = keys_of(pdf.word.tolist(), q)
            bit = _bit(keys)
            yield pdf.assign(key=keys.view(np.int64), cell=(bit >> np.uint64(6)).astype(np.int32), bit=(np.uint64(1) << (bit & np.uint64(63))).view(np.int64))

    return run


def _generate(q: int, bitmap: Broadcast) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.frombuffer(bitmap.value, np.uint8)
        for pdf in batches:
            for n, own in pdf.groupby(pdf.word.str.len(), sort=False).word:
                own, step = own.tolist(), max(1, MOST_KEYS // (2 * q * (n + 1)))
                for at in range(0, len(own), step):
                    some = own[at : at + step]
                    for place, key in neighbourhood(some, q, known):
                        yield pd.DataFrame({"word": np.array(some, object)[place], "key": key.view(np.int64)})
        release_memory()

    return run


def _meet(words: DataFrame, vocabulary: DataFrame, q: int, hot: int) -> tuple[DataFrame, DataFrame | None]:
    """(word, near, near_n) with verified pairs; and, if a key is hot, (word, key) of all that reach hot keys."""
    spark = vocabulary.sparkSession
    keyed = stage(vocabulary.select("word", "n").mapInPandas(_keyed(q), "word string, n long, key long, cell int, bit long"), "op11-keys")
    cells = keyed.groupBy("cell").agg(F.bit_or("bit").alias("bit")).toPandas()  # at most 2 ** BITMAP_BITS / 64 rows
    bitmap = np.zeros(1 << BITMAP_BITS - 6, np.int64)
    bitmap[cells.cell.to_numpy(np.int64)] = cells.bit.to_numpy(np.int64)
    sent = spark.sparkContext.broadcast(bitmap.tobytes())
    reached = words.select("word").mapInPandas(_generate(q, sent), "word string, key long")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > hot).select("key")
    beyond = None
    if hot and not sizes.isEmpty():
        sizes = stage(sizes, "op11-hot")
        reached = stage(reached, "op11-reached")
        beyond, reached = reached.join(sizes, "key"), reached.join(sizes, "key", "left_anti")
        keyed = keyed.join(sizes, "key", "left_anti")
    pairs = reached.join(keyed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n")), "key")
    return pairs.where("word <> near").where(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n"), beyond


def near_words(vocabulary: DataFrame, q: int = SYMBOLS, hot: int = HOT) -> DataFrame:
    """(word, near, near_n): all pairs of words that differ by one inserted, deleted or replaced code point, both ways."""
    pairs, beyond = _meet(vocabulary, vocabulary, q, hot)
    if beyond is None:
        return pairs
    reach = stage(beyond.select("word").distinct(), "op11-reach")
    keys = stage(beyond.select("key").distinct(), "op11-crowded")
    keyed = vocabulary.select("word", "n").mapInPandas(_keyed(q), "word string, n long, key long, cell int, bit long")
    more, _ = _meet(reach, keyed.join(keys, "key", "left_semi").select("word", "n"), EVERY, 0)
    return pairs.unionByName(more)


def roots_of(links: DataFrame) -> DataFrame:
    """links(word, form), a form for each word and no cycles: (word, root), root being the last of the forms.

    Each round replaces a word's last known form by that one's own, so the distance covered doubles.
    """
    at = stage(links.select("word", F.col("form").alias("root")), "op11-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(at.join(on, "root", "left"), "op11-roots")
        if moved.where("further is not null").isEmpty():
            return at
        at = moved.select("word", F.coalesce("further", "root").alias("root"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 6, least_n: int = 5, times: int = 5, every: int = 199, q: int = SYMBOLS, hot: int = HOT) -> DataFrame:
    """One row for each word: word, form, root, n, n_near, form_n.

    Words are maximal runs of Latin letters with A-Z lower-cased, of at least `least_letters` code points and `least_n`
    occurrences. One in `every` runs of a document, by a hash of id and run, counts without one of its letters. Two words
    are near if they differ by one inserted, deleted or replaced code point. A word's form is its near word with the most
    occurrences (of equals the first in code-point order) if that has at least `times` as many as the word; following the
    forms to the last gives the root, the word itself if it has none.

    Null and blank texts have no words, a null id deletes no letter, repeated rows count each. No word gives an empty
    result, as does an empty table. Runs may be of any length; other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    counted = base.mapInArrow(_count(every, least_letters), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)
    vocabulary = stage(counted, "op11-words")
    near = near_words(vocabulary, q, hot).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near"))).alias("best"))
    out = vocabulary.join(near, "word", "left").withColumn("form_n", -F.col("best.minus_n"))
    ok = F.col("form_n") >= times * F.col("n")
    out = stage(out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(ok, F.col("best.near")).alias("form"), F.when(ok, F.col("form_n")).alias("form_n")), "op11-forms")
    roots = roots_of(out.where("form is not null").select("word", "form"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
