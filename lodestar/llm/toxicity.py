"""Toxicity: a factorization machine over hashed terms.

A text's terms are its words and their beginnings, hashed; a term weighs four times the root of its
share of the words. The machine adds to the linear weights a weight for each pair of terms, the product of two short
vectors, so that an insult beside a group's name can count for more than both alone.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.llm.sample import labelled_sample
from lodestar.llm.store import bounded_batches
from lodestar.llm.worker import let_go

HASH_BITS = 18
FACTORS = 8
#: Labelled documents of each class that the model is fitted on, at most.
PER_CLASS = 3000
#: Characters of each class's documents, at most; a document of a fiftieth of that is not in the sample.
SAMPLE_CHARS = 32_000_000
STARTS = (4, 6)
#: Standard errors more that a pair of terms must tell the classes apart by than a term: there are many more pairs.
PAIR_STRENGTH = 3
#: Terms whose pairs with all others are counted at once.
PAIR_BLOCK = 512
MAX_KNOWN = 100_000
_WORD = re.compile(r"[^\W\d_]+")


class Terms:
    """Hashed terms of texts; the hashes of frequent words are kept."""

    def __init__(self, bits: int = HASH_BITS) -> None:
        self.mask, self.known = (1 << bits) - 1, {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and their values; none for a text without letters."""
        words = Counter(_WORD.findall((text or "").lower()))
        total = words.total()
        share: dict[int, int] = {}
        known = self.known
        for word, n in words.items():
            hashes = known.get(word)
            if hashes is None:
                named = [f"={word}", *(f"{k}{word[:k]}" for k in STARTS if len(word) >= k)]
                hashes = tuple(zlib.crc32(t.encode()) & self.mask for t in named)
                if len(known) >= MAX_KNOWN:
                    known.clear()
                known[word] = hashes
            for h in hashes:
                share[h] = share.get(h, 0) + n
        return np.fromiter(share, np.int32, len(share)), 4 * np.sqrt(np.fromiter(share.values(), np.float32, len(share)) / max(total, 1))


@dataclass
class Machine:
    """Weights of the terms kept: ``place`` maps a term to its row (-1: none)."""

    place: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, terms: np.ndarray, values: np.ndarray) -> float:
        at = self.place[terms]
        x = values[at >= 0]
        at = at[at >= 0]
        vx = self.factors[at] * x[:, None]
        z = self.bias + float(self.linear[at] @ x) + 0.5 * float((vx.sum(axis=0) ** 2 - (vx**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _apart(found: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Standard errors between the shares of the two classes' rows; ``found``: class first."""
    size = np.maximum(size, 1)
    share = found.sum(axis=0) / size.sum(axis=0)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / size).sum(axis=0))
    return np.abs(found[1] / size[1] - found[0] / size[0]) / spread


class _Pairs:
    """Which of the terms that could make a telling pair are in each row of the sample, and in how many rows of each class."""

    def __init__(self, rows: list[tuple[int, np.ndarray, np.ndarray]], able: np.ndarray, found: np.ndarray, size: np.ndarray, least: int, strength: float) -> None:
        column = np.full(found.shape[1], -1, np.int32)
        column[able] = np.arange(len(able))
        own = [[t[t >= 0] for label, terms, _ in rows if label == c for t in (column[terms],)] for c in (0, 1)]
        self.columns = [np.concatenate([np.zeros(0, np.int32), *o]) for o in own]
        self.row = [np.repeat(np.arange(len(o)), [len(t) for t in o]) for o in own]
        self.able, self.found, self.size, self.least, self.strength = able, found[:, able], size, least, strength

    def _there(self, label: int, lo: int, hi: int) -> np.ndarray:
        out = np.zeros((self.size[label], hi - lo), np.float32)
        here = (self.columns[label] >= lo) & (self.columns[label] < hi)
        out[self.row[label][here], self.columns[label][here] - lo] = 1
        return out

    def telling(self, block: int) -> np.ndarray:
        """Terms of a block of ``PAIR_BLOCK`` that tell the classes apart beside some other term; pairs are counted a block at a time."""
        lo, n = block * PAIR_BLOCK, len(self.able)
        hi = min(lo + PAIR_BLOCK, n)
        mine = [self._there(c, lo, hi) for c in (0, 1)]
        tell = np.zeros(hi - lo, bool)
        for at in range(0, n, PAIR_BLOCK):
            to = min(at + PAIR_BLOCK, n)
            both = np.stack([mine[c].T @ self._there(c, at, to) for c in (0, 1)])
            paired = (both.sum(axis=0) >= self.least) & (_apart(both, self.size) >= self.strength + PAIR_STRENGTH)
            i, j = np.nonzero(paired)
            i, j = i[lo + i != at + j], j[lo + i != at + j]
            ok = np.ones(len(i), bool)
            # among the rows of either term the other must tell, else one of them does all the telling
            for one in (lo + i, at + j):
                ok &= _apart(both[:, i, j], self.found[:, one]) >= self.strength
            tell[i[ok]] = True
        return self.able[lo:hi][tell]


def _telling(rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int, least: int, strength: float, each: Callable) -> np.ndarray:
    """Terms that tell the classes apart, by themselves or by a pair that they make with another. ``each(fn, n)`` gives fn(0) to fn(n - 1)."""
    found, size = np.zeros((2, 1 << bits)), np.bincount([r[0] for r in rows], minlength=2)
    for label, terms, _ in rows:
        found[label, terms] += 1
    seen = found.sum(axis=0)
    telling = (seen >= least) & (_apart(found, size) >= strength)
    # a pair is in no more rows than either term, and tells most if in all of one class's and none of the other's
    alone = np.maximum(*(_apart(np.where(np.arange(2)[:, None] == c, found, 0), size) for c in (0, 1)))
    able = np.flatnonzero((seen >= least) & (alone >= strength + PAIR_STRENGTH))
    pairs = _Pairs(rows, able, found, size, least, strength)
    for terms in each(pairs.telling, -(-len(able) // PAIR_BLOCK)):
        telling[terms] = True
    return np.flatnonzero(telling)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], weight: dict[int, float], bits: int = HASH_BITS, factors: int = FACTORS, epochs: int = 10, least: int = 5, strength: float = 4.0, rate: float = 0.3, decay: float = 1e-5, each: Callable = lambda fn, n: map(fn, range(n))) -> Machine:
    """Fit by AdaGrad on the log loss. ``rows``: label, terms, values; ``weight``: of a row of each class.

    Terms are kept that are in ``least`` rows or more and whose shares of the two classes' rows differ by
    ``strength`` standard errors or more, or that make such a pair (by ``PAIR_STRENGTH`` more) with any other term,
    however frequent, each telling by ``strength`` among the rows of the other; the rest, nearly all, only fits noise. Without rows of both classes the score is the
    share of class 1, or one half without rows. ``each`` says where blocks of pairs are counted.
    """
    kept = _telling(rows, bits, least, strength, each)
    place = np.full(1 << bits, -1, np.int32)
    place[kept] = np.arange(len(kept))
    rng = np.random.default_rng(1)
    w, v = np.zeros(len(kept) + 1, np.float32), rng.normal(0, 0.05, (len(kept) + 1, factors)).astype(np.float32)
    mass = {c: weight[c] * sum(r[0] == c for r in rows) for c in (0, 1)}
    bias = float(np.log((mass[1] + 0.5) / (mass[0] + 0.5)))
    if not (mass[0] and mass[1]):
        return Machine(place, bias if rows else 0.0, w, v * 0)
    data = []
    for label, terms, values in rows:
        at = place[terms]
        data.append((label, at[at >= 0], values[at >= 0]))
    gw, gv, gb = np.full_like(w, 1e-6), np.full_like(v, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for lo in range(0, len(order), 64):
            batch = [data[i] for i in order[lo : lo + 64]]
            # a last, empty term of value 1 gives every row a term
            at = np.concatenate([np.append(b[1], len(kept)) for b in batch])
            x = np.concatenate([np.append(b[2], np.float32(1)) for b in batch])
            size = np.array([len(b[1]) + 1 for b in batch])
            cut = np.concatenate([[0], np.cumsum(size)[:-1]])
            row = np.repeat(np.arange(len(batch)), size)
            y = np.array([b[0] for b in batch], np.float32)
            vx = v[at] * x[:, None]
            total = np.add.reduceat(vx, cut)
            z = bias + np.add.reduceat(w[at] * x, cut) + 0.5 * (total**2 - np.add.reduceat(vx**2, cut)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * np.array([weight[int(b[0])] for b in batch], np.float32)
            terms, where = np.unique(at, return_inverse=True)
            ex = error[row] * x
            d_w = np.bincount(where, ex) + decay * w[terms]
            d_v = ex[:, None] * (total[row] - vx)
            d_v = np.stack([np.bincount(where, d_v[:, k]) for k in range(factors)], axis=1) + decay * v[terms]
            gw[terms] += d_w**2
            gv[terms] += d_v**2
            w[terms] -= rate * d_w / np.sqrt(gw[terms])
            v[terms] -= 0.25 * rate * d_v / np.sqrt(gv[terms])
            d_b = float(error.sum())
            gb += d_b**2
            bias -= rate * d_b / gb**0.5
    vx = v[-1]  # the empty term: its linear weight joins the bias, its pairs the linear weights
    return Machine(place, bias + float(w[-1]), w[:-1] + v[:-1] @ vx, v[:-1])


def fit_machine(docs: DataFrame, labels: DataFrame, label: str, fit_on: Column, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """Fit on a bounded sample of labelled documents (``PER_CLASS`` and ``SAMPLE_CHARS``); classes are weighted back to their share of
    all labels. Pairs of terms are counted by Spark's tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        terms = Terms()
        for batch in batches:
            got = [terms.of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.tobytes() for t, _ in got], pa.binary()), pa.array([v.tobytes() for _, v in got], pa.binary())],
                names=["label", "terms", "values"],
            )

    bounded_batches(docs)
    sample, counts = labelled_sample(docs, labels, label, fit_on, per_class, id_col, text_col, F.length(F.col(text_col)), SAMPLE_CHARS)
    found = sample.mapInArrow(run, "label int, terms binary, values binary").collect()
    rows = [(r["label"], np.frombuffer(r["terms"], np.int32), np.frombuffer(r["values"], np.float32)) for r in found]
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))  # whatever order the tasks ended in
    taken = Counter(r[0] for r in rows)
    whole, used = sum(counts.values()), len(rows)
    weight = {c: (counts.get(c, 0) / whole) / (taken[c] / used) if taken[c] else 1.0 for c in (0, 1)}
    spark = docs.sparkSession

    def each(fn: Callable[[int], np.ndarray], n: int) -> list[np.ndarray]:
        shared = spark.sparkContext.broadcast(fn)

        def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for b in batch.column(0).to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array(shared.value(b).astype(np.int64))], names=["term"])

        if not n:
            return []
        return [spark.range(0, n, 1, n).mapInArrow(block, "term long").toArrow()["term"].to_numpy()]  # 2**18 terms at most

    return fit(rows, weight, each=each)


def score(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """Every input row as ``row`` (struct of its columns) with ``score``, 0 to 1. A text without terms, empty
    or null, gets the score of no evidence."""
    bounded_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        terms, model = Terms(), shared.value
        for batch in batches:
            row = batch.column(0)
            yield pa.RecordBatch.from_arrays([row, pa.array([model.score(*terms.of(t.as_py())) for t in row.field(at)], pa.float64())], names=["row", "score"])

    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], *StructType.fromDDL("score double").fields]))
