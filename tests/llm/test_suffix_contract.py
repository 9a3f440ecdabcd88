"""op2_suffix_dedup as a query: 400-byte strings alone decide, however many words a repeated passage has."""

import hashlib
from collections import Counter

import numpy as np

LENGTH = 400


def by_brute_force(rows):
    texts = {i: (t or "").encode() for i, t in rows}
    starts = {i: [hashlib.blake2b(b[a : a + LENGTH], digest_size=16).digest() for a in range(len(b) - LENGTH + 1)] for i, b in texts.items()}
    times = Counter(h for hashes in starts.values() for h in hashes)
    want = {}
    for i, b in texts.items():
        gone = np.zeros(len(b) + 2, bool)  # one byte that stays before and after
        for a, h in enumerate(starts[i]):
            if times[h] > 1:
                gone[a + 1 : a + 1 + LENGTH] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]])
        want[i] = (len(b), len(b) - len(kept), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return want


def test_passages_of_many_words_go_only_from_400_bytes_on(spark, sf_dir, tmp_path):
    from volframe.llm.queries import op2_suffix_dedup
    from volframe.llm.suffix_dedup import suffix_dedup

    def passage(name, size):  # 57 words or one more
        return " ".join(f"{name}{k:05d}" for k in range(70))[:size]

    # other bytes stand right before and after it in each document
    planted = [f"ends in {at}{passage(name, size)}{at} begins" for name, size in (("p", 394), ("q", 399), ("r", 400)) for at in ("<", ">")]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000_000 + k, t) for k, t in enumerate([*planted, None, "é" * 199, "é" * 200, "z" * 400, "z" * 399])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")

    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op2_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got == by_brute_force(rows)
    assert all(len(passage(n, s).split()) > 50 for n, s in (("p", 394), ("q", 399), ("r", 400)))
    assert [got[10_000_000 + k][1] for k in range(6)] == [0, 0, 0, 0, 400, 400]
    shorter = {r.doc_id: r.n_removed for r in suffix_dedup(frame, length=250, first_stays=False).collect()}
    assert [shorter[10_000_000 + k] for k in range(6)] == [394, 394, 399, 399, 400, 400]
