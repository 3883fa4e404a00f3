"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Each line is good or bad. A line is seen through statistics of its own and of the lines before and
after it, and through the labels of its neighbours (the chain). Forward-backward gives each line's
probability of being good; the document's quality is their mean, weighted by the lines' lengths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.llm.sample import labelled_sample
from lodestar.llm.store import bounded_batches
from lodestar.llm.worker import let_go

#: Labelled documents of each class that the field is fitted on, at most.
PER_CLASS = 2500
#: Lines of each class's documents, at most; a document of a fiftieth of that is not in the sample.
SAMPLE_LINES = 300_000
#: Lines in a training chain, at most: longer documents give several chains.
CHAIN = 64
_SYMBOLS = str.maketrans("", "", "#*$%&|<>{}[]~^=_@\\/")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"\d")
OWN = 11


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each line, own then the previous and the next line's, and the lines' weights.

    An empty or null text is one empty line of weight 1; an empty line has no weight beside others.
    """
    lines = (text or "").split("\n")
    seen: set[str] = set()
    own = np.zeros((len(lines), OWN))
    weight = np.zeros(len(lines))
    for i, line in enumerate(lines):
        words = line.split()
        n, size = len(words), len(line)
        if not n:
            own[i, 0] = 1
            continue
        own[i] = (
            0,
            (size - len(line.translate(_SYMBOLS))) / size,
            line.count("!") / size,
            len(_UPPER.findall(line)) / size,
            len(_DIGIT.findall(line)) / size,
            1 - len(set(words)) / n,
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
            line in seen,
            math.log1p(n) / 5,
            size / n / 10,
            line.rstrip()[-1] in ".!?,:;",
        )
        seen.add(line)
        weight[i] = size
    if not weight.any():
        weight[:] = 1
    edge = np.zeros((1, OWN))
    edge[0, 0] = 1
    around = np.concatenate([edge, own, edge])
    share = np.broadcast_to(own.T @ weight / weight.sum(), own.shape)
    return np.concatenate([own, around[:-2], around[2:], np.sqrt(own[:, 1:8]), np.sqrt(share[:, 1:8])], axis=1), weight


@dataclass
class Field:
    """Weights of a line's features for the label good, and of the four label pairs of neighbours."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray

    def marginals(self, features: np.ndarray) -> np.ndarray:
        """Each line's probability of being good, by forward-backward."""
        own = np.clip((features - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]
        good = (1 / (1 + np.exp(-np.clip(own, -30, 30)))).tolist()
        (bb, bg), (gb, gg) = np.exp(self.pairs).tolist()
        n = len(good)
        ahead = [0.0] * n
        a = good[0]
        ahead[0] = a
        for i in range(1, n):
            to_good = ((1 - a) * bg + a * gg) * good[i]
            to_bad = ((1 - a) * bb + a * gb) * (1 - good[i])
            a = to_good / (to_good + to_bad)
            ahead[i] = a
        out = [0.0] * n
        b = 0.5  # what the lines after say of this one
        for i in range(n - 1, -1, -1):
            x, y = ahead[i] * b, (1 - ahead[i]) * (1 - b)
            out[i] = x / (x + y)
            from_good, from_bad = b * good[i], (1 - b) * (1 - good[i])
            up, down = gg * from_good + gb * from_bad, bg * from_good + bb * from_bad
            b = up / (up + down)
        return np.array(out)

    def score(self, text: str | None) -> float:
        features, weight = line_features(text)
        return float(min(1.0, max(0.0, self.marginals(features) @ weight / weight.sum())))


def fit(rows: list[tuple[int, np.ndarray]], weight: dict[int, float], steps: int = 200, rate: float = 0.08, decay: float = 2e-3) -> Field:
    """Fit to chains whose lines all have their document's label, by Adam on the conditional likelihood.

    Without chains of both labels the scores are the share of label 1, or one half without rows.
    """
    width = rows[0][1].shape[1] if rows else len(line_features("")[0][0])
    chains = [(y, f[i : i + CHAIN]) for y, f in rows for i in range(0, len(f), CHAIN)]
    mass = {c: weight[c] * sum(y == c for y, _ in rows) for c in (0, 1)}
    prior = math.log((mass[1] + 0.5) / (mass[0] + 0.5)) if rows else 0.0
    if not (mass[0] and mass[1]):
        return Field(np.zeros(width), np.ones(width), np.append(np.zeros(width), prior), np.zeros((2, 2)))
    lines = np.concatenate([f for _, f in chains])
    mean, scale = lines.mean(axis=0), lines.std(axis=0) + 1e-3
    # chains of like length share a block: (chains, lines, features)
    blocks = []
    chains.sort(key=lambda c: (len(c[1]), c[0]))
    lo = 0
    while lo < len(chains):
        n = len(chains[lo][1])
        hi = lo
        while hi < len(chains) and len(chains[hi][1]) == n:
            hi += 1
        x = np.clip((np.stack([f for _, f in chains[lo:hi]]) - mean) / scale, -8, 8)
        y = np.array([c for c, _ in chains[lo:hi]])
        # a chain counts once, however long
        blocks.append((x, y, np.array([weight[int(c)] for c in y]) / n))
        lo = hi
    total = sum(w.sum() for _, _, w in blocks)
    theta = np.zeros(width + 5)
    theta[width] = prior
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        grad = np.zeros_like(theta)
        pairs = theta[width + 1 :].reshape(2, 2)
        for x, y, w in blocks:
            own = x @ theta[:width] + theta[width]
            good, couples = _expected(own, pairs)
            miss = (y[:, None] - good) * w[:, None]
            grad[:width] += np.einsum("cl,clf->f", miss, x)
            grad[width] += miss.sum()
            if couples is not None:
                n = x.shape[1] - 1
                for a in (0, 1):
                    for b in (0, 1):
                        hit = (y == a) * float(a == b) * n
                        grad[width + 1 + 2 * a + b] += ((hit - couples[:, a, b]) * w).sum()
        grad = grad / total - decay * np.where(np.arange(len(theta)) == width, 0, theta)
        m = 0.9 * m + 0.1 * grad
        s = 0.999 * s + 0.001 * grad**2
        theta += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Field(mean, scale, theta[: width + 1].copy(), theta[width + 1 :].reshape(2, 2).copy())


def _expected(own: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Of chains (rows) of equal length: P(good) of every line, and expected counts of label pairs."""
    good = 1 / (1 + np.exp(-np.clip(own, -30, 30)))
    state = np.stack([1 - good, good], axis=2)
    move = np.exp(pairs)
    n = own.shape[1]
    ahead, back = np.empty_like(state), np.ones_like(state)
    ahead[:, 0] = state[:, 0]
    for i in range(1, n):
        a = (ahead[:, i - 1] @ move) * state[:, i]
        ahead[:, i] = a / a.sum(axis=1, keepdims=True)
    for i in range(n - 2, -1, -1):
        b = (back[:, i + 1] * state[:, i + 1]) @ move.T
        back[:, i] = b / b.sum(axis=1, keepdims=True)
    both = ahead * back
    marginal = (both / both.sum(axis=2, keepdims=True))[:, :, 1]
    if n == 1:
        return marginal, None
    couple = ahead[:, :-1, :, None] * move * (back * state)[:, 1:, None, :]
    return marginal, (couple / couple.sum(axis=(2, 3), keepdims=True)).sum(axis=1)


def fit_field(docs: DataFrame, labels: DataFrame, label: str, fit_on: Column, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fit on a bounded sample of labelled documents (``PER_CLASS`` and ``SAMPLE_LINES``); classes are weighted back to their share of
    all labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [line_features(t.as_py())[0].astype(np.float32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.tobytes() for f in made], pa.binary())], names=["label", "features"])

    bounded_batches(docs)
    sample, counts = labelled_sample(docs, labels, label, fit_on, per_class, id_col, text_col, F.size(F.split(F.col(text_col), "\n")), SAMPLE_LINES)
    width = line_features("")[0].shape[1]
    found = sample.mapInArrow(run, "label int, features binary").collect()
    rows = [(r["label"], np.frombuffer(r["features"], np.float32).reshape(-1, width).astype(np.float64)) for r in found]
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))
    taken = Counter(r[0] for r in rows)
    whole, used = sum(counts.values()), len(rows)
    weight = {c: (counts.get(c, 0) / whole) / (taken[c] / used) if taken[c] else 1.0 for c in (0, 1)}
    return fit(rows, weight)


def score(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """Every input row as ``row`` (struct of its columns) with ``score``, 0 to 1; empty and null texts score
    as one empty line."""
    bounded_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        model = shared.value
        for batch in batches:
            row = batch.column(0)
            yield pa.RecordBatch.from_arrays([row, pa.array([model.score(t.as_py()) for t in row.field(at)], pa.float64())], names=["row", "score"])

    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], *StructType.fromDDL("score double").fields]))
