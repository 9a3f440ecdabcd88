"""Quality by a linear-chain conditional random field over the lines of a document.

Each line is good or bad; its features are shares of kinds of characters and of repeated words, with those of the line
before and after. The chain is trained on lines of labelled documents: lines take their document's label at first, then
lines of bad documents that the chain finds good are relabelled, and it is trained again. A document's quality is the
mean of the lines' forward-backward marginals weighted by length, put on the scale of the labels by a logistic curve.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volframe.llm.common import release_memory, stage, text_of
from volframe.llm.toxicity import logistic, sample_of

_TAIL = re.compile(r"[^\w\s]{2,}(?=\s|$)")
FEATURES = 14


def line_features(line: str, seen: set[str]) -> list[float]:
    n = max(len(line), 1)
    words = line.split()
    m = max(len(words), 1)
    letters = sum(map(len, re.findall(r"[^\W\d_]+", line)))
    upper = len(re.findall(r"[A-ZÄÖÜÉÈÊÇÑÓÍÁÚ]", line))
    digits = len(re.findall(r"\d", line))
    spaces = line.count(" ")
    distinct = len(set(words))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out = [
        1.0, min(np.log1p(n) / 8, 1.5), letters / n, upper / max(letters, 1), digits / n, (n - letters - digits - spaces) / n,
        len(_TAIL.findall(line)) / m, 1 - distinct / m, repeats / m, min(letters / m / 12, 2.0), words.count("|") / m,
        float(line in seen), (line.count(".") + line.count(",")) / m, float(m <= 3),
    ]
    seen.add(line)
    return out


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of the non-blank lines (own, before, after) and their lengths; a blank text is one empty line."""
    lines = [x for x in text.split("\n") if x.strip()] or [""]
    seen: set[str] = set()
    own = np.array([line_features(x, seen) for x in lines])
    return with_neighbours(own), np.array([max(len(x), 1) for x in lines], float)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    edge = np.zeros((1, FEATURES))
    return np.concatenate([own, np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge])], axis=1)


@dataclass
class LineModel:
    """weights of a line's score for good over bad; turn[i, j]: score of state j after i (0 bad, 1 good)."""

    weights: np.ndarray
    start: np.ndarray
    turn: np.ndarray
    scale: tuple[float, float] = (4.0, -2.0)

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """Probability of good of each line."""
        return forward_backward(x[None] @ self.weights, np.ones((1, len(x)), bool), self.start, self.turn)[0][0]

    def mean_good(self, x: np.ndarray, length: np.ndarray) -> float:
        return float((self.marginals(x) * length).sum() / length.sum())

    def score(self, text: str) -> float:
        a, b = self.scale
        good = np.clip(self.mean_good(*document_features(text)), 1e-6, 1 - 1e-6)
        return float(1 / (1 + np.exp(-np.clip(a * np.log(good / (1 - good)) + b, -30, 30))))


def forward_backward(s: np.ndarray, on: np.ndarray, start: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """s: scores for good (documents x lines), on: which lines there are. Marginals of good, expected turns, log partition.

    Vectors are scaled to sum one at each step, so long documents don't overflow.
    """
    d, t = s.shape
    s = np.clip(s, -30, 30)
    e = np.stack([np.exp(-s / 2), np.exp(s / 2)], axis=2)
    move = np.exp(turn)
    alpha, beta, scale = np.empty((d, t, 2)), np.ones((d, t, 2)), np.ones((d, t))
    a = np.exp(start)[None] * e[:, 0]
    for i in range(t):
        if i:
            b = (alpha[:, i - 1] @ move) * e[:, i]
            a = np.where(on[:, i, None], b, alpha[:, i - 1])
        c = np.where(on[:, i], a.sum(axis=1), 1.0)
        scale[:, i] = c
        alpha[:, i] = a / c[:, None]
    for i in range(t - 2, -1, -1):
        b = (beta[:, i + 1] * e[:, i + 1]) @ move.T / scale[:, i + 1, None]
        beta[:, i] = np.where(on[:, i + 1, None], b, 1.0)
    both = alpha * beta
    good = both[:, :, 1] / both.sum(axis=2)
    pair = alpha[:, :-1, :, None] * move[None, None] * (e * beta)[:, 1:, None, :] / scale[:, 1:, None, None]
    pair = np.where(on[:, 1:, None, None], pair, 0.0).sum(axis=(0, 1)) if t > 1 else np.zeros((2, 2))
    return good, pair, np.log(scale).sum(axis=1)


Bucket = tuple[np.ndarray, np.ndarray, np.ndarray]  # documents x lines x features, which lines there are, their labels


def gradient(theta: np.ndarray, x: np.ndarray, on: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the log likelihood of the line labels y in (weights, start, turn)."""
    f = x.shape[2]
    w, start, turn = theta[:f], theta[f : f + 2], theta[f + 2 :].reshape(2, 2)
    good, pair, _ = forward_backward(x @ w, on, start, turn)
    g = np.zeros_like(theta)
    g[:f] = np.tensordot(np.where(on, y - good, 0.0), x, 2)
    g[f : f + 2] = [(good[:, 0] - y[:, 0]).sum(), (y[:, 0] - good[:, 0]).sum()]
    both = on[:, 1:]
    seen = np.array([[(both * (1 - y[:, :-1]) * (1 - y[:, 1:])).sum(), (both * (1 - y[:, :-1]) * y[:, 1:]).sum()], [(both * y[:, :-1] * (1 - y[:, 1:])).sum(), (both * y[:, :-1] * y[:, 1:]).sum()]])
    g[f + 2 :] = (seen - pair).ravel()
    return g


def in_buckets(xs: list[np.ndarray], truth: np.ndarray) -> list[Bucket]:
    """Whole documents, padded to the longest of their bucket: lengths up to a power of two are in one bucket."""
    out, sizes = [], np.array([(len(d) - 1).bit_length() for d in xs])
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        t = max(len(xs[i]) for i in own)
        x, on = np.zeros((len(own), t, xs[0].shape[1])), np.zeros((len(own), t), bool)
        for k, i in enumerate(own):
            x[k, : len(xs[i])], on[k, : len(xs[i])] = xs[i], True
        out.append((x, on, np.repeat(truth[own].astype(float)[:, None], t, axis=1)))
    return out


def train(buckets: list[Bucket], rounds: int, model: LineModel | None = None) -> LineModel:
    """Adam on the log likelihood of the line labels, summed over all buckets at each step."""
    f = buckets[0][0].shape[2]
    theta = np.zeros(f + 6) if model is None else np.concatenate([model.weights, model.start, model.turn.ravel()])
    m, v, n = np.zeros_like(theta), np.zeros_like(theta), sum(on.sum() for _, on, _ in buckets)
    for k in range(1, rounds + 1):
        g = sum(gradient(theta, *b) for b in buckets) / n - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return LineModel(theta[:f], theta[f : f + 2], theta[f + 2 :].reshape(2, 2))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for text in pdf.text:
            x, length = document_features(text)
            out.append((x[:, :FEATURES].astype(np.float32).tobytes(), length.astype(np.float32).tobytes(), len(x)))
        yield pd.concat([pdf[["doc_id", "quality"]].reset_index(drop=True), pd.DataFrame(out, columns=["x", "length", "lines"])], axis=1)


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, most_lines: int = 200_000, id_col: str = "doc_id", text_col: str = "text") -> LineModel:
    """Learn from whole labelled documents: at most sample_rows, and so many of these (in order of a hash) as have most_lines
    lines together, which bounds what the driver sees. A document with more than a hundredth of most_lines is no example,
    so that one cannot take the place of the others; all are scored.

    Rows without a label, with labels other than 0 and 1, or held out are left out. With labels of one class or none, lines
    are told apart by repeated words and symbols only.
    """
    rows = sample_of(docs, labels, "quality", sample_rows, id_col, text_col).select("doc_id", "text", "quality").mapInPandas(_features, "doc_id long, quality int, x binary, length binary, lines int")
    rows = stage(rows, "op5-lines")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "h").rowsBetween(Window.unboundedPreceding, 0)  # sample_rows small rows at most
    chosen = rows.where(F.col("lines") <= most_lines // 100).select("doc_id", "lines", F.xxhash64("x").alias("h")).withColumn("so_far", F.sum("lines").over(order))
    chosen = chosen.where(F.col("so_far") <= most_lines).select("doc_id", "h").distinct()
    rows = rows.withColumn("h", F.xxhash64("x")).join(chosen, ["doc_id", "h"]).orderBy("doc_id", "h").select("quality", "x", "length").toPandas()
    truth = rows.quality.to_numpy() if len(rows) else np.zeros(0)
    if len(set(truth.tolist())) < 2:
        w = np.zeros(3 * FEATURES)
        w[[0, 5, 6, 8, 10]] = [4.0, -8.0, -12.0, -12.0, -20.0]
        return LineModel(w, np.zeros(2), np.array([[1.0, 0.0], [0.0, 1.0]]), (1.0, 0.0))
    xs = [with_neighbours(np.frombuffer(b, np.float32).reshape(-1, FEATURES).astype(float)) for b in rows.x]
    buckets = in_buckets(xs, truth)
    model = train(buckets, 120)
    again = []
    for x, on, y in buckets:
        good, _, _ = forward_backward(x @ model.weights, on, model.start, model.turn)
        bad = y[:, :1] == 0
        new = np.where(bad & (good > 0.7), 1.0, y)
        again.append((x, on, np.where(bad & ((new * on).sum(axis=1) == on.sum(axis=1))[:, None], y, new)))  # a bad document keeps a bad line
    model = train(again, 80, model)
    means = np.clip([model.mean_good(d, np.frombuffer(n, np.float32)) for d, n in zip(xs, rows.length, strict=True)], 1e-6, 1 - 1e-6)
    a, b = logistic(np.stack([np.log(means / (1 - means)), np.ones(len(means))], axis=1), truth.astype(float), 0.05)
    model.scale = (float(max(a, 0.05)), float(b))
    return model


def _score(model: LineModel):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "score": [model.score(t) for t in pdf.text]})
        release_memory()

    return run


def quality(docs: DataFrame, model: LineModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, score. All lines of a text count, however many.

    A null or blank text is one empty line; a null id stays null; repeated rows get equal scores; an empty table gives an
    empty result. Only id and text are read.
    """
    base = docs.select(F.col(id_col).cast("string").alias("doc_id"), text_of(text_col).alias("text"))
    return base.mapInPandas(_score(model), "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))
