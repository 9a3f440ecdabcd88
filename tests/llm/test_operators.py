"""Corpus operators against brute force, round trips and planted cases on small frames."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string"
ROWS = [
    (1, "one two three four five six", "en", "a", 27, "x"), (2, "one  two three four\nfive six", "en", "b", 28, None), (2, "one  two three four\nfive six", "en", "b", 28, None),
    (3, None, None, None, None, None), (4, "", "en", "a", 0, "y"), (None, "seven eight nine ten", "de", "a", 20, "z"), (7, "long word " * 3000, "en", None, 30000, "q"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, empty):
    from pyspark.sql import functions as F

    from volframe.llm.exact_dedup import exact_dedup

    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()}
    assert got[1] == (2, 3, False) and got[2] == (2, 3, True) and got[3] == (3, 2, True) and got[4] == (3, 2, False)
    weak = exact_dedup(docs, hash_of=lambda h: F.unhex(F.lit("00")))  # all collide: bytes alone tell the texts apart
    assert sorted(map(str, weak.collect())) == sorted(map(str, exact_dedup(docs).collect()))
    assert exact_dedup(empty).count() == 0


@pytest.mark.parametrize("first_stays", [True, False])
@pytest.mark.parametrize("class_runs", [4_000, 2])
def test_suffix_dedup(spark, monkeypatch, first_stays, class_runs):
    from volframe.llm import suffix_dedup as module

    monkeypatch.setattr(module, "SLICE_WINDOWS", 50)
    rng, length = random.Random(5), 80
    phrases = [" ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(3, 25))) for _ in range(15)]
    rows = [(i, "".join(rng.choice(phrases) if rng.random() < 0.5 else "".join(rng.choice("xyz") for _ in range(20)) for _ in range(rng.randint(0, 10)))) for i in range(40)]
    rows += [(40, "ab" * 200), (41, rows[3][1]), (42, None)]
    where = {}
    for i, t in rows:
        b = (t or "").encode()
        for a in range(len(b) - length + 1):
            where.setdefault(b[a : a + length], []).append((i, a))
    want = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - length + 1):
            p = where[b[a : a + length]]
            if len(p) > 1 and (not first_stays or min(p) != (i, a)):
                gone[a : a + length] = True
        want[i] = bytes(np.frombuffer(b, np.uint8)[~gone])
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for c in ("anchor", "k1", "spans", "whole"):
        frame = frame.withColumn(c, F.lit("clash"))
    out = module.suffix_dedup(frame, length=length, first_stays=first_stays, class_runs=class_runs)
    assert {r.doc_id: bytes(r.kept) for r in out.collect()} == want


def test_suffix_dedup_edge_rows(spark, docs, empty):
    from volframe.llm.suffix_dedup import suffix_dedup

    assert suffix_dedup(empty).count() == 0
    got = {}
    for r in suffix_dedup(docs, first_stays=False).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed))
    assert got[3] == [(0, 0)] and got[4] == [(0, 0)] and got[7] == [(30000, 30000)] and len(got[2]) == 2 and sum(map(len, got.values())) == len(ROWS)
    twice = spark.createDataFrame([(1, "abc " * 150), (1, "abc " * 150), (None, "xyz" * 200)], "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.n_bytes - r.n_removed) for r in suffix_dedup(twice, first_stays=True).collect())
    assert kept == [(0, 3), (1, 4), (1, 4)]  # the window at 3 (4) is a copy of the first; its bytes go


def test_lpf():
    from volframe.llm.suffix_dedup import lpf

    s = b"abaababaab"
    want = [max((next((k for k in range(len(s) - i + 1) if i + k == len(s) or s[j + k] != s[i + k]), 0) for j in range(i)), default=0) for i in range(len(s))]
    assert lpf(s) == want and lpf(b"") == [] and lpf(b"a") == [0]


@pytest.mark.parametrize("block", [4096, 3])
def test_near_dedup(spark, docs, empty, block):
    from volframe.llm.minhash import near_dedup

    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(100)) for _ in range(20)]
    for _ in range(30):
        t = list(base)
        for _ in range(rng.randint(0, 6)):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        texts.append(" ".join(t))
    texts += [None, "", "A b", "a B", texts[0]]
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    out = near_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width=4, block=block)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == {i: (len(sets[i]), find(i)) for i in range(len(texts))}
    if block == 3:
        assert near_dedup(docs).count() == len(ROWS) and near_dedup(empty).count() == 0


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    from volframe.llm.packing import pack
    from volframe.llm.queries import tokenizer_path

    tok = Tokenizer.from_file(tokenizer_path())
    rows = pack(docs, tokenizer_path(), length=64).collect()
    whole = {}
    for r in sorted(rows, key=lambda r: r.start):
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.offset + r.length <= 64
        whole.setdefault(r.doc_id, []).extend(r.ids)
    assert whole[7] == tok.encode(ROWS[6][1], add_special_tokens=False).ids + [1] and whole[3] == [1]
    at = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert all(s * 64 + o + n == s2 * 64 + o2 for (s, o, n), (s2, o2, _) in zip(at, at[1:], strict=False))
    assert pack(empty, tokenizer_path()).count() == 0


def test_fast_encoder_gives_the_same_ids():
    from tokenizers import Tokenizer

    from volframe.llm.packing import encoder
    from volframe.llm.queries import tokenizer_path

    encode, tok = encoder(tokenizer_path())[0], Tokenizer.from_file(tokenizer_path())
    for t in ["", " ", "Hello's  wörld\n\n 12a", "a<|endoftext|>b", "日本語 text\t\x00", "x" * 500, "it's they'LL    end "]:
        assert encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_fingerprints(spark, docs, empty):
    import xxhash

    from volframe.llm.fingerprint import fingerprint, fingerprints, likeness

    def check(rows, got):
        order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), np.int64(np.uint64(xxhash.xxh64_intdigest((r[1] or "").encode(), 42))), r[1] or ""))
        want = {}
        for i, r in enumerate(order):
            t, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
            edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
            own, new = fingerprint(t), fingerprint(edited)
            one = (r[0], len(t), hashlib.sha256(edited.encode()).hexdigest(), own, new, likeness(own, new), likeness(own, fingerprint(nxt)))
            want[one] = want.get(one, 0) + 1
        have = {}
        for r in got:
            have[tuple(r)] = have.get(tuple(r), 0) + 1
        assert have == want

    check(ROWS, fingerprints(docs, rows_per_range=2, least_rows=1).collect())
    rng = random.Random(8)
    many = [(rng.choice([None, 5, i]), "\n".join(" ".join(rng.choice(["ab", "cde", "f"]) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 6)))) for i in range(300)]
    check(many, fingerprints(spark.createDataFrame(many, "doc_id long, text string").repartition(7), rows_per_range=11, least_rows=1).collect())
    check(many[:1], fingerprints(spark.createDataFrame(many[:1], "doc_id long, text string")).collect())
    assert fingerprints(empty).count() == 0


def test_trees_locate_edits():
    from volframe.llm.fingerprint import Tree, edits, fingerprint, likeness, tree
    from volframe.llm.common import Rolling

    rng = random.Random(4)
    lines = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randint(1, 30))) + "\n" for _ in range(60)]
    text = "".join(lines)
    own = fingerprint(text)
    whole = tree(text.encode(), Rolling(7))
    assert Tree.of_text(own) == whole and whole.text() == own and len(whole.sections) > 5
    assert edits(own, own) == [] and likeness(own, own) == 1.0 and likeness(own, fingerprint("")) == 0.0 and likeness(fingerprint(""), fingerprint("")) == 1.0
    for t in ("x", "\n", "\n\n", "a\r\nb", "é" * 700, "a b " * 500):
        assert Tree.of_text(fingerprint(t)) == tree(t.encode(), Rolling(7)) and likeness(fingerprint(t), fingerprint(t)) == 1.0
    # one word changed, one line inserted, deleted, moved: one edit each, at its place
    at = text.index(lines[30])
    changed = text[: at + 1] + "ZZZ" + text[at + 4 :]
    (kind, a, b, c, d), = edits(own, fingerprint(changed))
    assert kind == "replace" and a <= at + 1 and b >= at + 4 and b - a < 400 and (a, b) == (c, d) and 0.9 < likeness(own, fingerprint(changed)) < 1
    more = text[:at] + "a whole new line\n" + text[at:]
    assert edits(own, fingerprint(more)) == [("insert", at, at, at, at + 17)]
    assert edits(fingerprint(more), own) == [("delete", at, at + 17, at, at)]
    n = len(lines[30])
    swapped = text[:at] + text[at + n :] + lines[30]
    assert edits(own, fingerprint(swapped)) == [("move", at, at + n, len(text) - n, len(text))]
    assert likeness(fingerprint("a\nb\n"), fingerprint("b\na\n")) == 0.5 and edits(fingerprint("a\nb\n"), fingerprint("b\na\n"))
    assert edits(fingerprint("a\na\n"), fingerprint("a\n")) and likeness(fingerprint("a\na\n"), fingerprint("a\n")) < 1
    for _ in range(60):  # bytes outside of the edits are equal, in order
        x = [rng.choice(lines[:12]) for _ in range(rng.randint(0, 15))]
        y = [rng.choice(lines[:12]) if rng.random() < 0.3 else z for z in x if rng.random() < 0.8]
        a, b = "".join(x), "".join(y)
        ops = edits(fingerprint(a), fingerprint(b))
        left, right = list(a), list(b)
        for _, s, e, u, v in ops:
            left[s:e], right[u:v] = [""] * (e - s), [""] * (v - u)
        assert "".join(left) == "".join(right)


def test_warc(spark, docs, empty, tmp_path):
    import gzip
    import io

    from pyspark.sql import functions as F

    from volframe.llm import warc
    from volframe.llm.warc import page_of, read_warc, salvage, write_warc

    nested = "<p>é\r\n\r\nWARC/1.1\r\n"
    pages = [(1, "http://a", nested), (2, "http://b", None), (3, None, nested), (4, "http://d", "x" * 100_000), (5, "u", ""), (None, "v", "w"), (7, "u", "r"), (7, "u", "r")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("same", F.lit("clash"))
    write_warc(frame, str(tmp_path / "w"), records_per_file=2)

    def facts(rows):
        return sorted(str((r.p, r.record_type, r.payload_bytes, r.payload_digest, r.to, None if r.payload is None else bytes(r.payload).decode())) for r in rows)

    def read(path, **size):
        rows = read_warc(spark, str(path), **size).withColumn("p", page_of(F.col("record_id"))).withColumn("to", page_of(F.col("refers_to_id")))
        assert not rows.where("quarantined").count()
        return facts(rows.collect())

    def want(page):
        i, _, t = page
        same = [p[0] for p in pages if (p[2] or "") == (t or "") and p[0] is not None]
        data = (t or "").encode()
        again = i != max(same, default=i)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        return str((i, "revisit" if again else "response", len(data), digest, max(same) if again else None, None if again else data.decode()))

    assert read(tmp_path / "w") == sorted(map(want, pages)) == read(tmp_path / "w", whole_bytes=1)
    write_warc(docs.where("false"), str(tmp_path / "none"), id_col="doc_id", url_col="lang", payload_col="text")
    assert read_warc(spark, str(tmp_path / "none")).count() == 0
    write_warc(docs, str(tmp_path / "docs"), id_col="doc_id", url_col="lang", payload_col="text")
    assert len(read(tmp_path / "docs")) == len(ROWS)

    zipped = b"".join(open(f, "rb").read() for f in map(str, sorted((tmp_path / "w").glob("part-*"))))
    parts = [(s, e) for s, e, r in salvage(zipped) if r]
    plain = b"".join(gzip.decompress(zipped[s:e]) for s, e in parts)
    ranges = [(s, e) for s, e, r in salvage(plain) if r]
    assert len(parts) == len(ranges) == len(pages)
    for data, places in ((zipped, parts), (plain, ranges)):
        for k in range(len(pages)):  # one record hurt: all others are found, and the gap is that record alone
            s, e = places[k]
            hurt = data[: s + 4] + b"#!" + data[s + 6 :] if data is plain else data[: (s + e) // 2] + bytes(64) + data[(s + e) // 2 + 64 :]
            out = list(salvage(hurt))
            assert [x[:2] for x in out if x[2] is None][0][0] == s and sum(x[2] is not None for x in out) >= len(pages) - 2
            assert out[0][0] == 0 and out[-1][1] == len(hurt) and all(x[1] == y[0] for x, y in zip(out, out[1:], strict=False))
    cut = [x for x in salvage(zipped[: parts[-1][1] - 3])]
    assert cut[-1][2] is None and len(cut) == len(pages)
    assert list(salvage(b"")) == [] and [x[2] for x in salvage(b"no archive")] == [None]
    assert sum(r is not None for *_, r in salvage(gzip.compress(plain))) == len(pages)
    whole = list(salvage(zipped))
    old, warc.CHUNK = warc.CHUNK, 7  # records longer than a chunk
    try:
        assert list(salvage(io.BytesIO(zipped))) == whole and [x[2] for x in salvage(io.BytesIO(plain))] == [x[2] for x in whole]
    finally:
        warc.CHUNK = old
    big = zlib.compressobj(6, zlib.DEFLATED, 31)
    record = plain[slice(*ranges[0])]
    member = big.compress(record) + big.flush() + warc._NOTHING
    assert [x[:2] for x in salvage(member * 2)] == [(0, len(member)), (len(member), 2 * len(member))]


def test_mixing(spark, docs, empty):
    from volframe.llm.mixing import mix

    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), f"s{min(rng.randrange(9), 3)}" if i % 10 else None) for i in range(400)] + [(400, "one two", "tiny")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix(frame, block_words=16, rows_per_bucket=20)[0].collect()
    again = {r.doc_id: r.taken for r in mix(frame.repartition(5), block_words=16, rows_per_bucket=20)[0].collect()}
    assert {r.doc_id: r.taken for r in got} == again and all(r.taken <= 3 * r.size for r in got)
    size, weight = {}, {}
    for i, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(size.values())
    while True:
        full = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 3 * size[s]]
        if not full:
            break
        for s in full:
            target[s] = 3 * size[s]
        open_ -= set(full)
        left -= sum(target[s] for s in full)
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    taken = {}
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert mix(docs)[0].count() == len(ROWS) and mix(empty)[0].count() == 0


def test_shards_are_multinomial_draws(spark):
    """Counts of a source vary between shards as independent draws do, and all slots are dealt once."""
    from volframe.llm.mixing import draws, shard_counts

    plan = spark.createDataFrame([("a", 0, 60_000), ("b", 60_000, 3), ("c", 60_003, 39_997)], "src string, first long, slots long")
    counts = {(r.src, r.shard): r.n for r in shard_counts(plan, 100_000, 100, 5).collect()}
    a = np.array([counts.get(("a", s), 0) for s in range(1000)])
    assert sum(counts.values()) == 100_000 and abs(a.mean() - 60) < 1 and 18 < a.var() < 31  # 100 * 0.6 * 0.4 = 24
    goals = spark.createDataFrame([("x", 1000, 2500.0), ("y", 50, 150.0), (None, 400, 399.0), ("z", 0, 0.0)], "source string, source_size long, target double")
    rows = draws(goals, 16, 8, 3).collect()
    per, seen = {}, {}
    for r in rows:
        per[r.source] = per.get(r.source, 0) + r.take
        seen.setdefault((r.source, r.epoch), []).append(r.block)
    assert per == {"x": 2500, "y": 150, None: 399} and all(len(set(b)) == len(b) for b in seen.values())
    shards = {}
    for r in rows:
        shards[r.shard] = shards.get(r.shard, 0) + 1
    assert max(shards.values()) <= 8
    assert draws(goals.where("false"), 16, 8, 3).count() == 0


def test_models(spark, docs, empty):
    """Held-out rows are never learned from: their labels are predicted, both classes well. Edge rows have a score each."""
    from volframe.llm.queries import op3_toxicity, op5_quality, table
    from volframe.llm.quality import fit_quality, quality
    from volframe.llm.toxicity import fit_toxicity, toxicity

    sf = "/root/testdata/sf0.01"
    corpus, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    larger = "/root/testdata/sf0.1"
    for query, label, where, least in ((op3_toxicity, "toxic", larger, (0.99, 0.75)), (op5_quality, "quality", sf, (0.9, 0.95))):
        known = {r.doc_id: r[label] for r in table(spark, where, "labels").collect()}
        rows = [(r.predicted, known[r.doc_id]) for r in query(spark, where).where("held_out").collect() if r.doc_id in known]
        for y in (0, 1):
            own = [p == y for p, t in rows if t == y]
            assert len(own) >= 10 and np.mean(own) >= least[y], (label, y, np.mean(own), len(own))
    for model, score in ((fit_quality(corpus, labels), quality), (fit_toxicity(corpus, labels), toxicity)):
        got = {}
        for r in score(docs, model).collect():
            got.setdefault(r.doc_id, []).append(r.score)
        assert sorted(map(len, got.values())) == [1, 1, 1, 1, 1, 2] and len(set(got[2])) == 1 and got[3] == got[4]
        assert all(0 <= x <= 1 for v in got.values() for x in v) and score(empty, model).count() == 0
    for fit, score in ((fit_quality, quality), (fit_toxicity, toxicity)):  # no labels, labels of no use
        odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 7, 7)], "doc_id long, quality int, toxic int")
        assert score(docs, fit(docs, odd)).count() == len(ROWS)


def test_label_model_gives_the_posteriors_of_bayes():
    """Votes drawn from a known model: rates, posteriors (by enumeration of Bayes' rule) and repeated voters."""
    from volframe.llm.toxicity import label_model

    rng = np.random.default_rng(1)
    y = rng.random(6000) < 0.2
    rates = [(0.7, 0.05), (0.5, 0.02), (0.6, 0.1), (0.3, 0.01)]
    votes = np.stack([(rng.random(6000) < np.where(y, a, b)).astype(float) for a, b in rates] + [np.zeros(6000)], axis=1)
    q, facts = label_model(votes, 0.2, np.full(5, 3.0))
    for f, (a, b) in zip(facts, rates, strict=False):
        assert abs(f["rate_toxic"] - a) < 0.04 and abs(f["rate_clean"] - b) < 0.02 and f["trust"] > 0.9
    exact = [np.log(0.2 / 0.8) + sum(np.log(a / b) if v else np.log((1 - a) / (1 - b)) for v, (a, b) in zip(row, rates, strict=False)) for row in votes]
    exact = 1 / (1 + np.exp(-np.array(exact)))
    assert np.mean((q > 0.5) == (exact > 0.5)) > 0.99 and np.abs(q - exact).max() < 0.15
    twice = np.concatenate([votes, votes[:, :1], votes[:, :1]], axis=1)  # a voter three times over is worth about one
    q3, facts3 = label_model(twice, 0.2, np.full(7, 3.0))
    assert facts3[0]["trust"] < 0.45 and np.mean((q3 > 0.5) == (exact > 0.5)) > 0.93


def test_forward_backward_against_all_paths():
    from itertools import product

    from volframe.llm.quality import forward_backward, gradient

    rng = np.random.default_rng(3)
    s, start, turn = rng.normal(size=(3, 6)) * 2, rng.normal(size=2), rng.normal(size=(2, 2))
    on = np.array([[True] * 6, [True] * 4 + [False] * 2, [True] + [False] * 5])
    good, pair, logz = forward_backward(s, on, start, turn)
    pairs = np.zeros((2, 2))
    for d in range(3):
        t, z, marginal, own = int(on[d].sum()), 0.0, np.zeros(6), np.zeros((2, 2))
        for path in product((0, 1), repeat=t):
            p = np.exp(start[path[0]] + sum((y - 0.5) * s[d, i] for i, y in enumerate(path)) + sum(turn[a, b] for a, b in zip(path, path[1:])))
            z += p
            marginal[:t] += p * np.array(path)
            for a, b in zip(path, path[1:]):
                own[a, b] += p
        assert np.allclose(good[d, :t], marginal[:t] / z) and np.isclose(logz[d], np.log(z))
        pairs += own / z
    assert np.allclose(pair, pairs)
    # the gradient is that of the log likelihood
    x, y = rng.normal(size=(3, 6, 4)), (rng.random((3, 6)) < 0.5).astype(float)
    theta = rng.normal(size=10)

    def loglik(v):
        w, st, tu = v[:4], v[4:6], v[6:].reshape(2, 2)
        total = -forward_backward(x @ w, on, st, tu)[2].sum()
        for d in range(3):
            t, lab = int(on[d].sum()), y[d].astype(int)
            total += st[lab[0]] + sum((lab[i] - 0.5) * (x[d, i] @ w) for i in range(t)) + sum(tu[lab[i], lab[i + 1]] for i in range(t - 1))
        return total

    g = gradient(theta, x, on, y)
    numeric = np.array([(loglik(theta + e) - loglik(theta - e)) / 2e-5 for e in np.eye(10) * 1e-5])
    assert np.allclose(g, numeric, atol=1e-4)


def test_license_scan(spark, docs, empty):
    from volframe.llm.license_scan import fit_licenses, license_scan

    rows = [(1, "some words\nReleased under the MIT License.\nmore"), (2, "you need a driving license"), (3, None), (4, "Licensed under the Apache License, Version 2.0.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit_licenses(frame)
    got = {r.doc_id: r.families for r in license_scan(frame, model).collect()}
    assert got == {1: ["MIT"], 2: [], 3: [], 4: ["Apache-2.0"]}
    assert license_scan(docs, model).count() == len(ROWS) and license_scan(empty, model).count() == 0
