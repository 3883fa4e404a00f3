"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are cut into passages. The words and pairs of neighbouring words of all passages are counted over
the whole corpus, and the rarest are a passage's seeds: so many that every alignment which scores enough to be
a match goes through one (``fewest_hits``). Where a document has a seed, the words around that place are aligned
with the passage, and the best local alignment's score, as a share of the passage's score with itself,
says how much of the passage is there, edited or not. Places whose words and pairs cannot score that much in any
order are not aligned (``Block.places``); neither step loses a match.

The passages are the small side: they are sent to the tasks in blocks of bounded size, and the corpus
is neither shuffled nor joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.llm.store import NULL_ORDER, bounded_batches, stored
from lodestar.llm.words import Powers, mix64, slices
from lodestar.llm.worker import let_go

#: Words that a match has at least: so many equal words in a row, or their score. Items of fewer words are matched by documents of
#: just these words.
LEAST_WORDS = 4
PASSAGE, STRIDE = 64, 32
#: Seeds of a passage that point to begins within so many words of each other are one place.
NEAR = 16
#: The bounds of ``fewest_hits`` and ``Block.places`` hold for these scores.
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
#: Passages sent to the tasks at once: about 4 kB each with their seeds and marks, 40 MB.
BLOCK = 10_000
#: Bits of a hash that mark what a passage has, and what all seeds of a block are.
MARK_BITS, FRONT_BITS = 10, 18
MATCHES = "array<struct<item_id: bigint, score: double, end_word: int>>"


@cache
def _points() -> tuple[np.ndarray, np.ndarray]:
    """Of each character: is it one of a word (letters, digits, the underscore), and a code."""
    word = np.array([chr(c).isalnum() for c in range(0x110000)])
    word[ord("_")] = True
    return word, mix64(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_POWERS = Powers(0xD1B54A32D192ED03)
#: Characters whose codes are summed at a time; longer only for a word that is longer.
CHUNK = 1 << 20


def batch_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the words of all texts, and where those of each text begin (and the last end).

    Words are runs of letters, digits and underscores, whatever their case. Equal words have equal codes, over 1.
    """
    lower = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join([*lower, ""]).encode("utf-32-le"), "<u4")
    is_word, code = _points()
    word = is_word[points]
    edge = np.flatnonzero(np.diff(word, prepend=False))  # words begin and end in turn; the last sign is a new line
    begin, end = edge[::2], edge[1::2]
    codes = np.empty(len(begin), np.uint64)
    lo = 0
    while lo < len(begin):
        hi = max(lo + 1, int(np.searchsorted(end, begin[lo] + CHUNK)))
        at, upto = begin[lo], end[hi - 1]
        up, down = _POWERS.upto(int(upto - at) + 1)
        total = np.zeros(upto - at + 1, np.uint64)
        np.cumsum(code[points[at:upto]] * up[: upto - at], out=total[1:])
        b, e = begin[lo:hi] - at, end[lo:hi] - at
        codes[lo:hi] = mix64((total[e] - total[b]) * down[b] + (e - b).astype(np.uint64))
        lo = hi
    sizes = np.cumsum([0, *(len(t) + 1 for t in lower)])
    return codes | np.uint64(2), np.searchsorted(begin, sizes)  # 0 and 1 stand for no word


def word_codes(text: str | None) -> np.ndarray:
    """The codes of one text's words."""
    return batch_codes([text])[0]


def batch_grams(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words and pairs of neighbouring words of all texts, and the text of each."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = np.flatnonzero(row[1:] == row[:-1])
    return np.concatenate([gram_codes(codes, 1), gram_codes(codes, 2)[inside]]), np.concatenate([row, row[inside]])


def gram_codes(codes: np.ndarray, width: int) -> np.ndarray:
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = (h ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def cut_passages(codes: np.ndarray) -> list[np.ndarray]:
    """Passages of at most 64 words, by 32; the last ends with the item. An item of no word has none."""
    if len(codes) <= PASSAGE:
        return [codes] if len(codes) else []
    starts = [*range(0, len(codes) - PASSAGE, STRIDE), len(codes) - PASSAGE]
    return [codes[s : s + PASSAGE] for s in starts]


def align(passages: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of each row of ``passages`` (0: no word) with that of ``regions`` (1: no word): best
    score and where in the region that alignment ends."""
    place = np.arange(regions.shape[1], dtype=np.int32) * -GAP
    h = np.zeros(regions.shape, np.int32)
    best, end = np.zeros(len(h), np.int32), np.zeros(len(h), np.int32)
    for i in range(passages.shape[1]):
        step = np.where(regions == passages[:, i : i + 1], np.int32(MATCH), np.int32(MISMATCH))
        step[:, 1:] += h[:, :-1]
        step = np.maximum(np.maximum(step, h + GAP), 0)
        h = np.maximum.accumulate(step + place, axis=1) - place  # gaps along the region
        at = h.argmax(axis=1)
        top = h[np.arange(len(h)), at]
        end = np.where(top > best, at, end)
        best = np.maximum(best, top)
    return best, end


def least_score(size: np.ndarray, least: float) -> np.ndarray:
    """Score from which an alignment with a passage of ``size`` words is a match."""
    return np.maximum(np.ceil(MATCH * least * size - 1e-9).astype(np.int64), MATCH * LEAST_WORDS)


def fewest_hits(words: np.ndarray, pairs: np.ndarray, score: int) -> tuple[np.ndarray, np.ndarray]:
    """Which words and pairs of a passage are seeds, from their document frequencies (one pair fewer than words).

    An alignment with m equal words and e errors scores 2m - e; its equal words stand in at most e + 1 runs, so
    it has m - e - 1 equal pairs or more. One that scores ``score`` thus has at least ``score`` - m - 1 of them. Either
    m > size - k, and one of any k words is equal; or m <= size - k, so c = ``score`` - size + k - 1 pairs are, and one of
    any size - c pairs is. For each k the k rarest words and size - c rarest pairs are therefore enough; the k is taken
    with the fewest documents to look at.
    """
    size = len(words)
    by_words, by_pairs = np.argsort(words, kind="stable"), np.argsort(pairs, kind="stable")
    k = np.arange(max(0, size - score + 2), min(size, 2 * size - score + 1) + 1)
    n_pairs = np.clip(2 * size - score + 1 - k, 0, len(pairs))
    hits = np.concatenate([[0], np.cumsum(words[by_words])])[k] + np.concatenate([[0], np.cumsum(pairs[by_pairs])])[n_pairs]
    best = hits.argmin()
    return by_words[: k[best]], by_pairs[: n_pairs[best]]


def _front(codes: np.ndarray) -> np.ndarray:
    """Marks of the first bits that any of the codes has: most other codes are told apart without a search."""
    marks = np.zeros(1 << FRONT_BITS, bool)
    marks[codes >> np.uint64(64 - FRONT_BITS)] = True
    return marks


def _among(codes: np.ndarray, front: np.ndarray) -> np.ndarray:
    return np.flatnonzero(front[codes >> np.uint64(64 - FRONT_BITS)])


def _marks(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - MARK_BITS)).astype(np.int64)


@dataclass
class Block:
    """Passages of the test items, each with the numbers it goes by, and their seeds, sorted: seed s stands in
    passage ``of[s]`` at word ``at[s]``."""

    words: np.ndarray
    size: np.ndarray
    items: list[list[int]]
    seed: np.ndarray
    of: np.ndarray
    at: np.ndarray
    #: items of too few words for an alignment, by their words
    short: dict[bytes, list[int]] = field(default_factory=dict)

    @classmethod
    def of_rows(cls, rows: list[tuple[list[int], np.ndarray]]) -> Block:
        """All words and pairs of all passages are seeds: of each passage its words, then its pairs."""
        short = {codes.tobytes(): items for items, codes in rows if len(codes) < LEAST_WORDS}
        rows = [r for r in rows if len(r[1]) >= LEAST_WORDS]
        words = np.zeros((len(rows), PASSAGE), np.uint64)
        for r, (_, codes) in enumerate(rows):
            words[r, : len(codes)] = codes
        grams = [gram_codes(codes, width) for _, codes in rows for width in (1, 2)]
        return cls(
            words,
            np.array([len(c) for _, c in rows], np.int64),
            [items for items, _ in rows],
            np.concatenate([np.zeros(0, np.uint64), *grams]),
            np.repeat(np.arange(len(grams)) // 2, [len(g) for g in grams]),
            np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)]),
            short,
        )

    def rarest(self, found: dict[int, int], least: float) -> Block:
        """With the seeds of ``fewest_hits`` only; those in no document go. ``found``: document frequencies."""
        df = np.array([found.get(g, 0) for g in self.seed.tolist()], np.int64)
        keep = np.zeros(len(df), bool)
        lo = 0
        for size, score in zip(self.size.tolist(), least_score(self.size, least).tolist(), strict=True):
            words, pairs = fewest_hits(df[lo : lo + size], df[lo + size : lo + 2 * size - 1], score)
            keep[lo + words] = keep[lo + size + pairs] = True
            lo += 2 * size - 1
        order = np.flatnonzero(keep & (df > 0))
        order = order[np.argsort(self.seed[order], kind="stable")]
        return Block(self.words, self.size, self.items, self.seed[order], self.of[order], self.at[order], self.short)

    def prepare(self) -> None:
        """Tables that are worked out where they are used: first bits of seeds, marks of each passage's words and pairs."""
        self.front = _front(self.seed)
        self.has = np.zeros((2, len(self.size), 1 << MARK_BITS), bool)
        for r, (codes, size) in enumerate(zip(self.words, self.size, strict=True)):
            for width in (1, 2):
                self.has[width - 1, r, _marks(gram_codes(codes[:size], width))] = True

    def places(self, grams: list[np.ndarray], score: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Passages, first word numbers of the places in the document where their seeds are, and the words' numbers
        (-1: none).

        An alignment that scores ``score`` has at most 2 size - ``score`` errors, so no more words are inserted: no
        match reaches further from its seed. Over the words of the document that it spans, it scores no more
        than 2 for each word that the passage has, less 1 for each other word, less 1 for each two such neighbours that
        are no pair of the passage (a word is lost between them, or one of the two is an error and costs 3 where it
        is in two such pairs at most). Places where no stretch of words reaches ``score`` so go.
        """
        n = len(grams[0])
        both, at = np.concatenate(grams), np.concatenate([np.arange(len(g)) for g in grams])
        some = _among(both, self.front)
        both, at = both[some], at[some]
        lo = np.searchsorted(self.seed, both)
        many = np.searchsorted(self.seed, both, side="right") - lo
        s = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) if len(both) else lo
        if not len(s):
            return
        begin = (np.repeat(at, many) - self.at[s]) // NEAR + PASSAGE  # of the passage in the document, roughly
        pairs = np.unique((self.of[s] << 32) + begin)
        marks = [_marks(g) for g in (grams[0], np.append(grams[1], np.uint64(0)))]
        for lo in range(0, len(pairs), 512):
            of, begin = pairs[lo : lo + 512] >> 32, (pairs[lo : lo + 512] & 0xFFFFFFFF) - PASSAGE
            reach = MATCH * self.size[of] - score[of]
            start = begin * NEAR - reach
            width = NEAR + self.size[of] + 2 * reach
            place = start[:, None] + np.arange(width.max())
            place[(place >= n) | (np.arange(width.max()) >= width[:, None])] = -1
            np.maximum(place, -1, out=place)
            words, two = (h[of[:, None], m[place]] for h, m in zip(self.has, marks, strict=True))
            words &= place >= 0
            most = np.zeros((len(of), place.shape[1] + 1), np.int16)
            most[:, 1:] = np.where(words, np.int16(MATCH), np.int16(MISMATCH))
            most[:, 2:] -= words[:, 1:] & words[:, :-1] & ~two[:, :-1]
            np.cumsum(most, axis=1, out=most)
            most -= np.minimum.accumulate(most, axis=1)
            # the first word of a stretch may have lost 1 for the word before it
            enough = most.max(axis=1) >= score[of] - 1
            if enough.any():
                yield of[enough], start[enough], place[enough]

    def candidates(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Numbers of the texts that have a seed, or no more words than a short item."""
        grams, row = batch_grams(codes, first)
        some = _among(grams, self.front)
        grams, row = grams[some], row[some]
        seeded = np.zeros(len(first) - 1, bool)
        if len(self.seed):
            seeded[row[self.seed[np.minimum(np.searchsorted(self.seed, grams), len(self.seed) - 1)] == grams]] = True
        return np.flatnonzero(seeded | (np.diff(first) < LEAST_WORDS) & bool(self.short))

    def matches(self, codes: np.ndarray, least: float) -> list[dict]:
        """Items that the document has, with the best score of their passages."""
        if len(codes) < LEAST_WORDS:
            return [{"item_id": i, "score": 1.0, "end_word": len(codes)} for i in self.short.get(codes.tobytes(), ())]
        best: dict[int, tuple[float, int]] = {}
        score = least_score(self.size, least)
        for of, start, place in self.places([gram_codes(codes, width) for width in (1, 2)], score):
            region = np.where(place >= 0, codes[place], np.uint64(1))
            top, end = align(self.words[of, : self.size[of].max()], region)
            share = top / (MATCH * self.size[of])
            for k in np.flatnonzero(top >= score[of]):
                found = (float(share[k]), int(start[k] + end[k] + 1))
                for item in self.items[of[k]]:
                    best[item] = max(best.get(item, (0.0, 0)), found)
        return [{"item_id": i, "score": s, "end_word": e} for i, (s, e) in sorted(best.items())]


def _classes(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item, whole, codes)``: every item that has passages, the digest of all its words, and its passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes = word_codes(batch.column(1)[i].as_py())
                made = [p.tobytes() for p in cut_passages(codes)]
                if made:
                    whole = hashlib.sha256(codes.tobytes()).digest()
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([whole], pa.binary()), pa.array([made], pa.list_(pa.binary()))], names=["item", "whole", "codes"])

    src = items.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ORDER)).alias("item"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "item long, whole binary, codes array<binary>")


def equal_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, member_id)``: each item beside the smallest id of the items with the same words, itself
    included. Items without passages are not there; null ids are the largest long."""
    made = _classes(items, id_col, text_col).select("whole", F.col("item").alias("member_id")).distinct()
    return made.join(made.groupBy("whole").agg(F.min("member_id").alias("item_id")), "whole").select("item_id", "member_id")


def distinct_passages(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(passage, codes)``, equal passages being one, and ``(passage, item_id)``: which items have each. Items with the same words
    are one, under the smallest id. Both are tables: a passage may be in any number of items."""
    whole = _classes(items, id_col, text_col).groupBy("whole").agg(F.min("item").alias("item_id"), F.first("codes").alias("codes"))
    having = stored(whole.select("item_id", F.explode("codes").alias("codes")).distinct(), "having")
    passages = stored(having.select("codes").distinct().select(F.monotonically_increasing_id().alias("passage"), "codes"), "passages")
    return passages, stored(having.join(passages, "codes").select("passage", "item_id"), "passage-items")


def passage_blocks(passages: DataFrame, block: int = BLOCK) -> Iterator[Block]:
    """The passages in blocks of about ``block``."""
    blocks = -(-passages.count() // block)
    for b in range(blocks):
        rows = passages.where(F.pmod(F.xxhash64("codes"), F.lit(blocks)) == b).collect()
        if rows:
            yield Block.of_rows(sorted((([r["passage"]], np.frombuffer(r["codes"], np.uint64)) for r in rows), key=lambda r: r[1].tobytes()))


def document_counts(docs: DataFrame, block: Block, text_col: str = "text") -> dict[int, int]:
    """In how many documents of the corpus each word and each pair of the block is."""
    shared = docs.sparkSession.sparkContext.broadcast(np.unique(block.seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        wanted = shared.value
        found, front = np.zeros(len(wanted), np.int64), _front(wanted)
        for batch in batches if len(wanted) else ():
            for _, texts in slices(batch, batch.column(0)):
                grams, row = batch_grams(*batch_codes(texts.to_pylist()))
                some = _among(grams, front)
                grams, row = grams[some], row[some]
                at = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
                hit = wanted[at] == grams
                found += np.bincount(np.unique(row[hit] * len(wanted) + at[hit]) % len(wanted), minlength=len(wanted))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["gram", "n"])

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    grams = shared.value
    return {int(grams[r["gram"]]): r["n"] for r in counted}


def passage_matches(docs: DataFrame, items: DataFrame, id_col: str = "item_id", item_text: str = "text", text_col: str = "text", least: float = MIN_SCORE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Every input row as ``row`` (struct of its columns) with ``matches``: the distinct passages of the test items found in it, each
    with its ``score`` (1 is a whole copy, word for word) and the word where the best alignment ends; and ``(passage, item_id)``.

    A match scores ``least`` of the passage's score with itself, and no less than four words in a row do; an item of fewer than
    four words is found in documents of just these words. Null and texts without words match nothing. A passage that many items
    share is one match; the second table, which may be of any size, has its items. Only items with the same words are
    one, the smallest of their ids (``equal_items`` has the others; null ids are the largest long).
    """
    bounded_batches(docs)
    at = docs.columns.index(text_col)
    out = docs.select(F.struct("*").alias("row"), F.array().cast(MATCHES).alias("matches"))
    schema = StructType([out.schema["row"], *StructType.fromDDL(f"matches {MATCHES}").fields])
    passages, having = distinct_passages(items, id_col, item_text)
    for part in passage_blocks(passages, block):
        seeds = part.rarest(document_counts(docs, part, text_col), least)
        out = out.mapInArrow(_aligned(docs.sparkSession.sparkContext.broadcast(seeds), at, least), schema)
    named = F.transform("matches", lambda m: F.struct(m["item_id"].alias("passage"), m["score"].alias("score"), m["end_word"].alias("end_word")))
    return out.select("row", named.alias("matches")), having


def item_matches(found: DataFrame, having: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, item_id, score, end_word)`` from the rows ``found`` of ``passage_matches``, one for each row and item of which a
    passage is found, with the best of its passages. ``keys`` are fields of ``row``."""
    hits = found.where(F.size("matches") > 0).select(F.monotonically_increasing_id().alias("_at"), *(F.col("row").getField(k).alias(k) for k in keys), "matches")
    hits = stored(hits, "hits")  # its numbers are not to be made anew
    each = hits.select("_at", F.explode("matches").alias("m")).select("_at", "m.*").join(having, "passage")
    best = each.groupBy("_at", "item_id").agg(F.max(F.struct("score", "end_word")).alias("b"))
    return best.join(hits.drop("matches"), "_at").select(*keys, "item_id", "b.score", "b.end_word")


def benchmark_matches(docs: DataFrame, items: DataFrame, id_col: str = "item_id", item_text: str = "text", text_col: str = "text", least: float = MIN_SCORE, block: int = BLOCK) -> DataFrame:
    """``passage_matches`` with the items in place of the passages: ``row`` and ``matches`` of ``item_id``, ``score``, ``end_word``.

    All items of a document are one array here, and the rows are written once to be joined with them.
    """
    found, having = passage_matches(docs, items, id_col, item_text, text_col, least, block)
    keyed = stored(found.select(F.struct(F.monotonically_increasing_id().alias("_row"), "row").alias("row"), "matches"), "found")
    best = item_matches(keyed, having, "_row").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("item_id", "score", "end_word"))).alias("_m"))
    out = keyed.select("row.*").join(best, "_row", "left")
    return out.select("row", F.coalesce("_m", F.array().cast(MATCHES)).alias("matches"))


def _aligned(shared, at: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seeds = shared.value
        seeds.prepare()
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("end_word", pa.int32())]))
        for whole in batches:
            for batch, texts in slices(whole, whole.column(0).field(at)):
                found = batch.column(1).to_pylist()  # by other blocks
                codes, first = batch_codes(texts.to_pylist())
                for k in seeds.candidates(codes, first).tolist():
                    if more := seeds.matches(codes[first[k] : first[k + 1]], least):
                        best = {m["item_id"]: m for m in found[k]}  # of an item's passages in other blocks
                        for m in more:
                            if m["item_id"] not in best or m["score"] > best[m["item_id"]]["score"]:
                                best[m["item_id"]] = m
                        found[k] = [best[i] for i in sorted(best)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["row", "matches"])

    return run
