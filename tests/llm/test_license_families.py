"""Every family is found in texts like those that carry it, and texts about licences are left alone."""

import pytest

AROUND = ["{}", "Notice to readers of these pages. {}", "{} Thanks to everybody who helped.", "(see below) {} -- the maintainers"]
PLAIN = [
    "The committee may use and copy the minutes for any purpose.", "We distribute bread to anyone free of charge.", "All rights of way were reserved for the farm.",
    "The foundation published its general report to the public.", "Version 3 of the plan was approved, version 2 was not.", "The authors of the play disclaim nothing.",
    "An artistic performance under the open sky.", "He wrote the original score and altered it later.",
]


@pytest.fixture(scope="module")
def fitted(spark):
    from volframe.llm.license_scan import fit_licenses

    lines = [f"on day {i} we walked along the river and talked about the weather in town {i % 7}" for i in range(300)] + PLAIN[:4]
    return fit_licenses(spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string"))


def test_recall_of_every_family(spark, fitted):
    from volframe.llm.license_scan import TEMPLATES, license_scan

    planted = [(f, t, a.format(t)) for f, ts in TEMPLATES.items() for t in ts for a in AROUND]
    rows = [(i, t) for i, (_, _, t) in enumerate(planted)] + [(10**6 + i, t) for i, t in enumerate(PLAIN)]
    got = {r.doc_id: r.families for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string"), fitted).collect()}
    assert [t for i, t in rows if i >= 10**6 and got[i]] == []
    missed = [(f, a, got[i]) for i, (f, _, a) in enumerate(planted) if got[i] != [f]]
    assert len(missed) <= 0.02 * len(planted), missed
    # no sentence of any family is missed in all its surroundings
    assert {(f, t) for f, t, _ in planted} == {(f, t) for i, (f, t, _) in enumerate(planted) if got[i] == [f]}


def test_results_equal_a_plain_scan(spark, fitted):
    """Words, trigrams and shares by Python, the regression by its coefficients."""
    import numpy as np

    from volframe.llm.license_scan import MIN_SHARED, TEMPLATES, UNKNOWN, _plain_words, _trigrams, license_scan

    texts = ["Released under the MIT License.\nsome words", "under the Artistic License\n\nLicensed under CC BY-ND 4.0.", "", None, PLAIN[3], "license", "Licensed under the ISC License.\nReleased under the Unlicense.\n" * 2]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (0, texts[0])], "doc_id long, text string")
    from pyspark.ml.feature import HashingTF

    from volframe.llm.license_scan import BUCKETS

    tf = HashingTF(numFeatures=BUCKETS, binary=True)
    weights, bias = fitted.regression.coefficientMatrix.toArray(), fitted.regression.interceptVector.toArray()

    def line(text):
        words = _plain_words(text)
        two = [" ".join(words[i : i + 2]) for i in range(len(words) - 1)] if len(words) >= 2 else words[:1]
        z = bias + weights[:, sorted({tf.indexOf(w) for w in words + two})].sum(1)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        family = fitted.families[int(p.argmax())]
        if family == UNKNOWN or p.max() < fitted.limits[family]:
            return None
        mine = _trigrams(words)
        shares = [max(len(mine & t) / len(t), len(mine & t) / len(mine) if len(words) >= 5 else 0) for t in (_trigrams(_plain_words(x)) for x in TEMPLATES[family])]
        return family if max(shares) >= MIN_SHARED else None

    want = []
    for r in docs.collect():
        found = [line(x) for x in (r.text or "").split("\n")] if r.text else []
        want.append((r.doc_id, len(found), sum(f is not None for f in found), sorted({f for f in found if f})))
    got = [(r.doc_id, r.n_paragraphs, r.n_licensed, r.families) for r in license_scan(docs, fitted).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
