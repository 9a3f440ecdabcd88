"""Spelling variants, decontamination and centroid clustering against brute force on small frames."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, key string, word string, items array<string>"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", "w", ["x"]) for i, t in rows], SCHEMA)


# --- spelling variants


def forms(rows, least=6, least_n=5, times=5, every=199):
    import re

    words = Counter()
    for i, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = "".join(c.lower() if c < "[" else c for c in r)
            h = 1 if i is None else zlib.crc32(f"{i}:{r}".encode())
            words[r if h % every else r[: h % len(r)] + r[h % len(r) + 1 :]] += 1
    words = {w: n for w, n in words.items() if len(w) >= least and n >= least_n}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, c in close.items():
        best = min(c, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= times * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(close[w]), words.get(form[w]))
    return out


def speller(seed, n):
    rng = random.Random(seed)
    roots = ["colour", "neighbour", "encyclopædia", "aaaaaaa", "abababab", "Éclairer", "zzzzzz"]
    rows = []
    for i in range(n):
        out = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(roots)
            for _ in range(rng.choice([0, 0, 0, 0, 0, 0, 0, 1, 1, 2])):
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                w = w[:at] + ("" if kind == 0 else rng.choice("abÿ")) + w[at + (kind != 2) :]
            out.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((None if i == 7 else i // 2, rng.choice([" ", "-", "3"]).join(out) if i != 9 else None))
    return [*rows, (900, " ".join(["dictionary"] * 300 + ["dictionari"] * 50 + ["dictinari"] * 6))]


@pytest.mark.parametrize("q,hot", [(8, 1000), (2, 3), (1, 1)])
def test_variants(spark, q, hot):
    from volframe.llm.variants import variants

    rows = speller(3, 150)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants(frame(spark, rows), q=q, hot=hot).collect()}
    assert got == forms(rows)
    assert any(v[1] != v[0] and v[0] for v in got.values()) and len(got) > 40


def test_variants_of_very_long_words_and_of_nothing(spark):
    from volframe.llm.variants import PIECE, runs, variants

    word = "".join(random.Random(1).choices("abcdefgh", k=30_000))
    rows = [(1, " ".join([word] * 30 + [word[:-1]] * 5 + ["y" + word[1:]] * 5))]
    assert {r.word: (r.form, r.n_near) for r in variants(frame(spark, rows)).collect()} == {word: (None, 2), word[:-1]: (word, 1), "y" + word[1:]: (word, 1)}
    assert variants(frame(spark, [])).count() == 0 == variants(frame(spark, [(1, None), (2, ""), (None, "12 345")])).count()
    text = "abcdefg hijklm " * (PIECE // 10) + "x" * (PIECE + 5) + " end"
    assert runs(text) == Counter(text.split())


def test_neighbourhood_is_whole():
    from volframe.llm import variants as module

    q, words = 3, ["abca", "bbbb", "cabd"]
    known = np.full(1 << module.BITMAP_BITS - 3, 255, np.uint8)
    letters = {s: chr(c) for c in range(97, 123) for s in [int(module.symbols(np.array([[c]]), q)[0, 0])]}
    place, key = next(module.neighbourhood(words, q, known))
    for i, w in enumerate(words):
        r = "".join(letters[int(s)] for s in module.symbols(module._matrix([w]), q)[0])
        edits = {r} | {r[:j] + r[j + 1 :] for j in range(4)} | {r[:j] + c + r[j + 1 :] for j in range(4) for c in letters.values()} | {r[:j] + c + r[j:] for j in range(5) for c in letters.values()}
        assert set(key[place == i].tolist()) == set(module.keys_of(sorted(edits), q).tolist())


# --- decontamination


def leaks(rows, items, width=10):
    import re

    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    held = {}
    for item, t in items:
        w = words(t)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            held.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in held}:
            for a in range(len(w) - n + 1):
                if own := held.get(tuple(w[a : a + n])):
                    hit |= set(range(a, a + n))
                    found |= own - {None}
        out.append((i, len(w), len(hit), sorted(map(str, found))))
    return sorted(out, key=str)


def leaky(seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(["a", "be", "sea", "Ünder", "water", "12", "x-y"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 4, 9, 10, 11, 30]) if i > 5 else 25)) for i in range(20)] + [(None, say(12)), (3, say(12)), (50, None), (51, " ?! ")]
    items = [(i, t if len((t or "").split()) > 2 else None) for i, t in items]
    rows = []
    for i in range(80):
        parts = [say(rng.randint(0, 30)) for _ in range(3)] + [rng.choice(items)[1] or "" for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        rows.append((None if i == 5 else i // 2, rng.choice(["  ", ".\n", "', "]).join(parts) if i != 6 else None))
    return rows, items


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 2000])
def test_decontaminate(spark, chunk_bytes):
    from volframe.llm.decontaminate import decontaminate

    rows, items = leaky(5)
    out = decontaminate(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), chunk_bytes=chunk_bytes)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in out.collect()), key=str)
    assert got == leaks(rows, items)
    assert any(g[2] for g in got) and any(not g[2] for g in got)
    assert out.where(F.exists("spans", lambda s: s["end"] <= s["start"])).count() == 0


def test_decontaminate_long_texts_and_nothing(spark):
    from volframe.llm.decontaminate import decontaminate

    secret = " ".join(f"word{i}" for i in range(14))
    rows = [(1, "filler text " * 500_000 + secret + " more" * 500_000), (2, " " * 6_000_000 + secret), (3, "q" * 6_000_000), (4, secret.replace(" ", "") * 9)]
    items = spark.createDataFrame([("p", secret), ("q", "q" * 6_000_000)], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate(frame(spark, rows), items).collect()}
    assert got == {1: (1_500_014, 14, ["p"]), 2: (14, 14, ["p"]), 3: (1, 1, ["q"]), 4: (1, 0, [])}
    nothing = items.limit(0)
    assert decontaminate(frame(spark, []), items).count() == 0
    assert [(r.n_words, r.n_hit, r["items"]) for r in decontaminate(frame(spark, [(1, "a b")]), nothing).collect()] == [(2, 0, [])]


def test_wu_manber_shifts_past_nothing():
    from volframe.llm.decontaminate import WuManber

    rng = random.Random(1)
    for t in range(200):
        say = lambda n: b" " + b" ".join(rng.choice([b"a", b"bb", b"abc", b"the", b"muchlongerword"]) for _ in range(n)) + b" "
        patterns = list({say(rng.randint(1 + t % 5, 6)) for _ in range(rng.randint(1, 30))})
        text = say(rng.randint(1, 400))
        want = sorted((i, k) for k, p in enumerate(patterns) for i in range(len(text)) if text[i : i + len(p)] == p)
        assert sorted(WuManber(patterns).find(text)) == want


# --- clusters


def lloyd(rows, dims, k, rounds):
    import hashlib
    import math

    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [list(v) for _, v in kept[:k]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min(range(len(cents)), key=lambda c: (dist(v, cents[c]), c))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v), []).append(v)
        for c, vs in own.items():
            cents[c] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    out = [(i, c := near(v), dist(v, cents[c]), cents[c]) for i, v in kept]
    by = Counter()
    for _, c, d, _ in out:
        by[c] += d
    return sorted(((i, c, d, by[c], sum(by.values()), v) for i, c, d, v in out), key=str)


@pytest.mark.parametrize("k", [1, 3, 8])
def test_clusters(spark, monkeypatch, k):
    from volframe.llm import clusters as module

    monkeypatch.setattr(module, "BLOCK", 7)
    rng = random.Random(k)
    rows = [(i, [rng.choice([-1, 0, 0.5, 90]) + rng.random() / 50 for _ in range(4)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 0.0, 0.0]), (62, [1.0, float("nan"), 0.0, 0.0]), (63, [float("inf"), 0.0, 0.0, 0.0]), (64, [0.0] * 3), (65, []), (1, rows[1][1]), (1, rows[2][1]), (None, rows[3][1]), *[(70 + i, [0.25] * 4) for i in range(9)]]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, cluster int")
    got = sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in module.clusters(frame, k=k, rounds=4, dims=4).collect()), key=str)
    assert got == lloyd(rows, 4, k, 4)
    assert module.clusters(frame.limit(0), dims=4).count() == 0
    assert [(r.cluster, r.distance) for r in module.clusters(frame.where("vec_id = 1"), dims=4, k=8, rounds=2).collect()].count((0, 0)) >= 1


def test_clusters_refuses_what_has_no_long_distance(spark):
    from volframe.llm.clusters import clusters

    with pytest.raises(Exception, match="more than 27 bits"):
        clusters(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>"), dims=2).collect()
