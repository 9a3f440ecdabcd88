"""Texts and rows that are rare and legal: very long runs, very many lines, conflicting labels, rows that repeat."""

import random
import re
import zlib

import numpy as np
import pytest


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    from volframe.llm.packing import encoder
    from volframe.llm.queries import tokenizer_path

    return encoder(tokenizer_path())[0], Tokenizer.from_file(tokenizer_path())


def test_ids_around_white_space_and_special_strings(both, monkeypatch):
    from volframe.llm import packing

    monkeypatch.setattr(packing, "LONG_SPACE", re.compile(packing.LONG_SPACE.pattern.replace("10000", "3")))
    fast, library = both
    rng = random.Random(3)
    parts = ["a", "B", " ", "  ", "   ", "\n\n\n\n", "\t 　 \xa0", "12", "é", "😀", "<|endoftext|>", "'s", "!?", "\x1c\x1d\x1e", "<|end"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert fast(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("unit,n", [(" ", 5_000_000), ("\n", 5_000_000), ("a", 2_000_000), ("😀", 500_000)])
def test_ids_of_very_long_runs(both, unit, n):
    fast, library = both
    assert fast("x" + unit * n + "y").tolist() == library.encode("x" + unit * n + "y", add_special_tokens=False).ids


def test_other_tokenizer_files_are_left_to_the_library(tmp_path):
    from tokenizers import Tokenizer

    from volframe.llm.packing import encoder
    from volframe.llm.queries import tokenizer_path

    path = tokenizer_path("word_bpe_49k.json")
    text = "Some Words, twice;  Some Words"
    assert encoder(path)[0](text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_packing_of_a_document_of_white_space(spark):
    from volframe.llm.packing import pack
    from volframe.llm.queries import tokenizer_path

    rows = pack(spark.createDataFrame([(1, " " * 3_000_000), (2, "word")], "doc_id long, text string"), tokenizer_path(), with_ids=False).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 3_000_001 and all(r.ids_crc32 == zlib.crc32(np.full(r.length, 220, "<u4").tobytes()) for r in rows if r.doc_id == 1 and r.length == 2048)


def test_one_document_of_very_many_lines_does_not_stop_learning(spark):
    from volframe.llm.common import held_out
    from volframe.llm.quality import fit_quality

    rng = random.Random(1)
    ids = [r.doc_id for r in spark.range(400).withColumnRenamed("id", "doc_id").where(~held_out()).collect()]
    say = lambda good: "\n".join(" ".join(rng.choice(["harbour", "lantern", "between", "the"]) for _ in range(8)) + "." if good else "click here !!! $$$ 99" for _ in range(5))
    rows = [(i, say(i % 2), i % 2) for i in ids]
    plain = fit_quality(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int"))
    for i in ids[:3]:  # whichever of them comes first by hash
        long = [(j, "a line\n" * 300_000 if j == i else t) for j, t, _ in rows]
        model = fit_quality(spark.createDataFrame(long, "doc_id long, text string"), spark.createDataFrame([(j, y) for j, _, y in rows], "doc_id long, quality int"))
        assert model.scale != (1.0, 0.0) and np.abs(model.weights - plain.weights).max() < 1.5
        assert model.score(say(True)) > 0.5 > model.score(say(False))


def test_labels_that_contradict_each_other_are_left_out(spark):
    from volframe.llm.common import held_out
    from volframe.llm.toxicity import sample_of

    ids = [r.doc_id for r in spark.range(40).withColumnRenamed("id", "doc_id").where(~held_out()).collect()]
    labels = [(i, i % 2) for i in ids] + [(ids[0], 1 - ids[0] % 2), (ids[1], ids[1] % 2), (ids[2], None), (None, 1)]
    docs = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string")
    got = sample_of(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic", 1000, "doc_id", "text")
    assert sorted((r.doc_id, r.toxic) for r in got.collect()) == sorted((i, i % 2) for i in ids[1:])


def test_mixing_gives_each_of_several_equal_rows_its_words(spark):
    import corpus_pipeline
    from volframe.llm.mixing import mix

    text = " ".join(f"w{i}" for i in range(301))
    rows = [(1, text, "en", "a", len(text))] * 6 + [(i, "other words here " * 400, "en", "b", 6800) for i in range(2, 9)] + [(None, None, None, None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = {r.source: r.n for r in mix(docs)[0].groupBy("source").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "n").collect()}
    out = corpus_pipeline.mix_sources(spark, docs, "")
    for source in ("a", "b"):
        assert sum(len(r.text.split()) for r in out.where(out.source == source).collect()) == taken[source]
    assert out.where("doc_id is null").count() == 3
