"""Toxicity by weak supervision.

Many voters look at a text: fixed lexicons, patterns, and one voter for each word stem that labelled rows show to be
typical of toxic texts. A generative model with the true label hidden estimates, by expectation maximisation on the votes
alone, how often each voter fires in toxic and in clean texts, and from what is left of the votes' correlations how much
voters repeat each other; a voter's say is reduced by that. The posterior labels train a logistic regression on word
stems and text statistics, which scores every text. Labels are used to find stems, for the share of toxic texts, and to
calibrate the last score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volframe.llm.common import first_by_hash, held_out, release_memory, stage, text_of

# fixed values: general lexicons of insults, by language
LEXICONS = {
    "en": "bastard clown creep degenerate disgusting dumb filth fool freak garbage idiot imbecile jerk loser moron pathetic pig psycho retard rubbish scum slime stupid trash ugly vermin worthless".split(),
    "de": "abschaum arsch blöd dämlich depp dreck dumm ekelhaft hurensohn idiot schwachkopf trottel versager wertlos widerlich".split(),
    "fr": "abruti connard crétin débile dégoûtant idiot imbécile merde minable nul ordure pathétique salaud stupide".split(),
    "es": "asqueroso basura cabrón escoria estúpido idiota imbécil inútil mierda patético payaso perdedor tonto".split(),
}
STEM_LENGTHS = (4, 5, 6, 8)
_WORD = re.compile(r"[^\W\d_]+")
_YOU = re.compile(r"\b(?:you|du|tu|vous|usted)\b[^.\n]{0,40}\b(?:are|bist|es|êtes)\b", re.I)
_SHOUT = re.compile(r"!{2,}")
STATISTICS = 4
#: Chance that any of all stems without a leaning is taken for a typical one.
STEM_ERROR = 0.05


def stems_of(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in STEM_LENGTHS if len(word) >= n)]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def statistics(text: str, words: set[str]) -> list[float]:
    return [min(len(words) / 500.0, 1.0), float(bool(_SHOUT.search(text))), float(bool(_YOU.search(text))), float(text.isupper())]


class _Stems(dict):
    """word -> numbers of the known stems in it."""

    def __init__(self, known: dict[str, int]):
        self.known = known

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 400_000:
            self.clear()
        found = self[word] = tuple(self.known[s] for s in stems_of(word) if s in self.known)
        return found


@dataclass
class ToxicityModel:
    stems: list[str]
    weights: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    voters: list[dict] = field(default_factory=list)

    def scorer(self):
        look, w = _Stems({s: i for i, s in enumerate(self.stems)}), self.weights
        n, (a, b) = len(self.stems), self.scale

        def score(text: str) -> float:
            words = words_of(text)
            hit = {i for x in words for i in look[x]}
            z = self.bias + sum(w[i] for i in hit) + float(np.dot(w[n:], statistics(text, words)))
            return float(1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))))

        return score


def _count_stems(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        toxic, clean = Counter(), Counter()
        for text, label in zip(pdf.text, pdf.toxic, strict=True):
            (toxic if label else clean).update({s for w in words_of(text) for s in stems_of(w)})
        stems = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"stem": stems, "t": [toxic[s] for s in stems], "c": [clean[s] for s in stems]})


def _look(stems: list[str], lexicons: list[list[str]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look = _Stems({s: i for i, s in enumerate(stems)})
        for pdf in batches:
            out = []
            for text in pdf.text:
                words = words_of(text)
                hits = sorted({i for w in words for i in look[w]})
                sketch = min((hash_of(w) for w in words), default=0)
                out.append((hits, [float(bool(words & set(x))) for x in lexicons], statistics(text, words), sketch))
            yield pd.concat([pdf[["toxic"]].reset_index(drop=True), pd.DataFrame(out, columns=["hits", "lexicons", "stats", "sketch"])], axis=1)

    return run


def hash_of(word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word) >> 1


def label_model(votes: np.ndarray, share: float, start: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, list[dict]]:
    """Posterior of toxicity per row from votes (1 a vote, 0 none); start: first guess of each voter's leaning.

    A voter's parameters are its rates of voting in both classes, so not voting is evidence, too: little where a voter is
    rare among toxic texts, as a lexicon of another language is. After each round of expectation maximisation, correlations of votes within a class beyond what
    independence gives make up a factor for each voter, one over one plus their sum. Of the voters that speak on a row,
    the strongest counts in full and the others by their factors: voters that always agree are worth one voter, not less.
    """
    cast = (votes != 0).astype(float)
    n, m = votes.shape
    prior = np.log(share / (1 - share))
    llr, none, trust = start.astype(float), np.zeros(m), np.ones(m)
    q = np.full(n, share)
    p1 = p0 = np.full(m, 0.5)
    for _ in range(rounds):
        said = cast * llr
        top = np.abs(said).argmax(axis=1)
        strongest = said[np.arange(n), top] * (1 - trust[top])
        q = 1 / (1 + np.exp(-np.clip(prior + said @ trust + strongest + (1 - cast) @ (none * trust), -30, 30)))
        a, b = q.sum(), (1 - q).sum()
        p1, p0 = (q @ cast + 0.5) / (a + 1), ((1 - q) @ cast + 0.5) / (b + 1)
        spoke = cast.any(axis=0)  # a voter that never did has no say
        llr, none = np.where(spoke, np.log(p1 / p0), 0.0), np.where(spoke, np.log((1 - p1) / (1 - p0)), 0.0)
        left = cast - np.outer(q, p1) - np.outer(1 - q, p0)
        sd = np.sqrt((left**2).mean(axis=0)) + 1e-9
        corr = (left.T @ left) / n / np.outer(sd, sd)
        np.fill_diagonal(corr, 0)
        trust = 1 / (1 + np.clip(corr - 0.1, 0, None).sum(axis=1))
    facts = [{"rate_toxic": float(x), "rate_clean": float(y), "trust": float(t)} for x, y, t in zip(p1, p0, trust, strict=True)]
    return q, facts


def logistic(x: np.ndarray, q: np.ndarray, penalty: float, rounds: int = 25, weight: np.ndarray | None = None) -> np.ndarray:
    """Newton steps for soft labels; the last column of x is constant and not penalised."""
    w, reg = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    reg[-1] = 1e-6
    weight = np.ones(len(x)) if weight is None else weight
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - q)) + reg * w
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        h[np.diag_indices_from(h)] += reg
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def sample_of(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str, text_col: str) -> DataFrame:
    """At most `rows` labelled rows that may be learned from (first by a hash of the id), with their texts.

    Ids are chosen first, texts are joined to the chosen ones. An id that is labelled both ways is left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias(label)).where(F.col(label).isin(0, 1) & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min(label).alias(label), F.max(label).alias("_most")).where(F.col(label) == F.col("_most")).drop("_most")
    known = first_by_hash(known, rows, "doc_id")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return stage(texts.join(known, "doc_id"), "labelled")


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = 16_000, most_stems: int = 384, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Learn from at most sample_rows labelled rows (the bound of what the driver sees); see the module's text.

    Rows without a label, with labels other than 0 and 1, or held out are not learned from. Without any labelled row the
    fixed lexicons alone are used.
    """
    sample = sample_of(docs, labels, "toxic", sample_rows, id_col, text_col)
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    nt, nc = sizes.get(1, 0), sizes.get(0, 0)
    lexicons = list(LEXICONS.values())
    stems: list[str] = []
    least_ratio = 0.0
    if nt and nc:
        odds = F.log((F.col("t") + 0.5) / F.lit(nt + 1.0)) - F.log((F.col("c") + 0.5) / F.lit(nc + 1.0))
        counts = sample.select("text", "toxic").mapInPandas(_count_stems, "stem string, t long, c long").groupBy("stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        counts = stage(counts, "op3-stems")
        least_ratio = NormalDist().inv_cdf(1 - STEM_ERROR / 2 / max(1, counts.count())) ** 2
        found = counts.where(F.col("t") >= max(2, nt // 250)).withColumn("odds", odds).where("odds > 1.5").orderBy((F.col("odds") * F.sqrt("t")).desc(), F.length("stem"), "stem").limit(4 * most_stems).collect()
        stems = [r.stem for r in found]
    known = sorted({w + "$" for x in lexicons for w in x} - set(stems))
    stems += known
    rows = sample.select("text", "toxic").mapInPandas(_look(stems, lexicons), "toxic int, hits array<int>, lexicons array<double>, stats array<double>, sketch long").toPandas()
    hits = np.zeros((len(rows), len(stems)), np.float32)
    for i, h in enumerate(rows.hits):
        hits[i, np.asarray(h, int)] = 1
    truth = rows.toxic.to_numpy()
    lex = np.stack(rows.lexicons.to_numpy()) if len(rows) else np.zeros((0, len(lexicons)))
    stats = np.stack(rows.stats.to_numpy()) if len(rows) else np.zeros((0, STATISTICS))

    # near copies count once: a stem must be typical over different sketches, not in many copies of one text
    sketch = rows.sketch.to_numpy()
    use, taken = [], []
    total = {y: max(1, len(set(sketch[truth == y].tolist()))) for y in (0, 1)}
    ranked = []
    for j, s in enumerate(stems):
        on = hits[:, j] > 0
        t, c = len(set(sketch[on & (truth == 1)].tolist())), len(set(sketch[on & (truth == 0)].tolist()))
        lift = np.log((t + 0.5) / (total[1] + 1)) - np.log((c + 0.5) / (total[0] + 1))
        share1, both = total[1] / (total[0] + total[1]), t + c
        # likelihood ratio of the stem's own share of toxic texts against that of all; most of many stems are rare by chance
        ratio = 2 * (t * np.log(max(t, 1) / (both * share1)) + (c * np.log(c / (both * (1 - share1))) if c else 0.0)) if both else 0.0
        if lift > 2.0 and ratio > least_ratio:
            ranked.append((-lift * np.sqrt(t), len(s), s, j))
    for _, _, s, j in sorted(ranked):
        bare = s.rstrip("$")
        if not any(bare.startswith(x.rstrip("$")) or x.rstrip("$").startswith(bare) for x in taken):
            taken.append(s)
            use.append(j)
        if len(use) == most_stems:
            break
    use += [j for j, s in enumerate(stems) if s in known and j not in use]

    n_mined = len(taken)
    votes = np.concatenate([hits[:, use[:n_mined]], lex, stats[:, 1:3]], axis=1)
    start = np.concatenate([np.full(n_mined, 3.0), np.full(len(lexicons), 3.0), np.full(2, 0.2)])
    share = float(np.clip(truth.mean() if len(truth) else 0.1, 0.005, 0.995))
    if len(rows):
        q, voters = label_model(votes, share, start)
        x = np.concatenate([hits[:, use], stats, np.ones((len(rows), 1))], axis=1).astype(float)
        w = logistic(x, q, 0.03)
    else:
        q, voters, w = np.zeros(0), [], np.concatenate([np.full(len(use), 5.0), np.zeros(STATISTICS), [-3.0]])
    if len(rows):  # words of the fixed lexicons that no labelled row shows count as the lexicon's voter was found to
        unseen = hits[:, use].sum(axis=0) == 0
        says = [max(0.0, float(np.log(v["rate_toxic"] / v["rate_clean"]))) * v["trust"] * bool(lex[:, i].any()) for i, v in enumerate(voters[n_mined : n_mined + len(lexicons)])]
        for k in np.flatnonzero(unseen):
            w[k] = max((s for s, x in zip(says, lexicons, strict=True) if stems[use[k]].rstrip("$") in x), default=0.0)
    model = ToxicityModel([stems[j] for j in use], w[:-1], float(w[-1]), voters=voters)
    if nt >= 5 and nc >= 5:
        z = x @ w
        a, b = logistic(np.stack([z, np.ones(len(z))], axis=1), truth.astype(float), 0.05)
        if a > 0:
            model.scale = (float(np.clip(a, 0.3, 3.0)), float(b))
    return model


def _score(model: ToxicityModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = model.scorer()
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "text_key": pdf.text_key, "score": [score(t) for t in pdf.text]})
        release_memory()

    return run


def toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, text_key (128-bit hash of the text), score.

    A null text is scored as an empty one; a null id stays null; repeated rows get equal scores; an empty table gives an
    empty result. Only id and text are read.
    """
    base = docs.select(F.col(id_col).cast("string").alias("doc_id"), text_of(text_col).alias("text")).withColumn("text_key", F.md5(F.col("text").cast("binary")))
    return base.mapInPandas(_score(model), "doc_id string, text_key string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))
