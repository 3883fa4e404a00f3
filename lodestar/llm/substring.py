"""Substring dedup: passages of many words that an earlier document already has are cut out.

Level-wise doubling. A level has windows of one length; the windows of the next length, twice as
long, are looked at only where the shorter ones inside them repeat in another document, so each
level touches what survived the one before. The ladder ends at ``min_words`` (longer windows can
add no word to what those of ``min_words`` cover) or earlier, once no candidate survives.

The first level would be a row for every word of the corpus. It takes one window in about thirteen:
of the half-length windows inside each full window the one with the least hash (all, if tied). That
choice depends on the words inside the full window alone, so two places with the same full window
choose the same half window, and a full window can repeat only if its half window repeats. Nothing
that repeats is lost. Window identities are 128 bits.

Documents with equal word sequences are one class, worked on once through its first document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.llm.store import bounded_batches, drop_stored, row_order, stored
from lodestar.llm.words import Words, row_of, slices, span_hashes, window_hashes
from lodestar.llm.worker import let_go

MIN_WORDS = 50
_TOP = np.uint64(2**64 - 1)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """min or max (``pick``) over each run of ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[:-step], x[step:]) if step < len(x) else x[:0]
        done += step
    return x


class Windows:
    """Window positions of the rows of one slice: which are whole, which half windows stand for them."""

    def __init__(self, words: Words, min_words: int) -> None:
        self.half = (min_words + 1) // 2
        n = len(words)
        row = row_of(words.first, n)
        left = words.first[1:][row] - np.arange(n) if n else np.zeros(0, np.int64)  # words to the row's end
        self.whole = (left >= min_words)[: max(0, n - min_words + 1)]
        self.row, self.words = row, words
        wh = words.hashes(0)
        ids = window_hashes(wh, self.half)
        inside = left[: len(ids)] >= self.half
        ids = np.where(inside & (ids != _TOP) & (ids != 0), ids, np.where(inside, np.uint64(1), _TOP))
        span = min_words - self.half + 1  # half windows in a full one
        least = _sliding(ids, span, np.minimum)[: len(self.whole)]
        least = np.where(self.whole, least, np.uint64(0))
        # a half window is chosen if some full window around it has it as its least
        padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
        around = _sliding(padded, span, np.maximum)[: len(ids)]
        self.least = least
        self.ids, self.chosen = ids, np.flatnonzero((around == ids[: len(around)]) & (around != 0))
        self.span = span


def _profile(min_words: int):
    """Per document: word count, 128-bit id of the word sequence, chosen half windows and their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part, texts in slices(batch, batch.column(2)):
                words = Words(texts)
                win = Windows(words, min_words)
                lo, hi = words.first[:-1], words.first[1:]
                ids = [span_hashes(words.hashes(s), lo, hi, s).view(np.int64) for s in (0, 1)]
                cut = np.searchsorted(win.chosen, words.first).astype(np.int32)
                place = (win.chosen - lo[win.row[win.chosen]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(words.counts(), pa.int64()), pa.array(ids[0]), pa.array(ids[1]),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(win.ids[win.chosen].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(place)),
                    ],
                    names=["ord", "text_key", "n_words", "s1", "s2", "ids", "places"],
                )

    return run


def _candidates(min_words: int):
    """Full windows whose own half window repeats: (w1, w2, ord, text_key, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part, texts in slices(batch, batch.column(2)):
                words = Words(texts)
                win = Windows(words, min_words)
                hits = part.column(3)
                at = np.asarray(hits.flatten(), np.int64) + np.repeat(words.first[:-1], np.asarray(pc.list_value_length(hits)))
                alive = np.full(len(win.ids), _TOP)
                alive[at] = win.ids[at]
                start = np.flatnonzero(win.whole & (_sliding(alive, win.span, np.minimum)[: len(win.whole)] == win.least))
                if not len(start):
                    continue
                row = win.row[start]
                key = [np.asarray(part.column(k), np.int64)[row] for k in (0, 1)]
                w = [window_hashes(words.hashes(s), min_words, s)[start].view(np.int64) for s in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[0]), pa.array(w[1]), pa.array(key[0]), pa.array(key[1]), pa.array((start - words.first[row]).astype(np.int32))],
                    names=["w1", "w2", "ord", "text_key", "place"],
                )

    return run


def _cut(min_words: int, texts_at: int, fields: StructType):
    """Applies the removals: word counts, kept text and its digest, removed spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, copy, places = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            texts = row.field(texts_at).cast(pa.string())
            if row.null_count:
                texts = pc.if_else(pc.is_valid(row), texts, None)
            out: list[tuple] = []
            for r in range(len(texts)):
                text = texts[r].as_py()
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                if copy[r] and len(words) >= min_words:
                    gone[:-1] = 1
                elif places[r].is_valid:
                    at = np.asarray(places[r].values)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + min_words, -1)
                    gone = np.cumsum(gone)
                gone = gone[: len(words)] > 0
                n = int(gone.sum())
                kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g) if n else b" ".join(words)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))) if n else []
                out.append((len(words), n, kept.decode() if n else text, hashlib.sha256(kept).hexdigest(), [{"first": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]))
            names = ["n_words", "n_removed", "kept_text", "kept_sha256", "removed"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([row, *(pa.array([o[k] for o in out], kinds[k]) for k in range(5))], names=["row", *names])

    return run


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(row_order(id_col).alias("ord"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text"))


def _first_levels(src: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """Levels one and two up to their candidates: ``copies(ord, text_key)``, documents whose word sequence an
    earlier one has, and ``candidates(w1, w2, ord, text_key, place)`` of the others. Both are written."""
    profile = src.mapInArrow(_profile(min_words), "ord long, text_key long, n_words long, s1 long, s2 long, ids array<long>, places array<int>")
    profile = stored(profile.where(F.col("n_words") >= min_words), "profile")

    # of documents with the same word sequence the first is worked on, the others go whole
    first = stored(profile.groupBy("s1", "s2").agg(F.min("ord").alias("first")), "first")
    classes = profile.join(first, ["s1", "s2"])
    copies = stored(classes.where("ord > first").select("ord", "text_key").distinct(), "copies")
    reps = classes.where("ord = first").dropDuplicates(["ord", "text_key"])
    halves = reps.select("ord", "text_key", "s1", F.explode(F.arrays_zip("ids", "places")).alias("x")).select("ord", "text_key", "s1", F.col("x.ids").alias("id"), F.col("x.places").alias("place"))
    halves = stored(halves, "halves")

    # level one: half windows found in two word sequences or more
    shared = stored(halves.groupBy("id").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).where("lo < hi").select("id"), "shared")
    live = halves.join(shared, "id").groupBy("ord", "text_key").agg(F.collect_list("place").alias("hits"))
    live = stored(live, "live")

    # level two: full windows, where their half window survived
    cand = src.join(live, ["ord", "text_key"]).dropDuplicates(["ord", "text_key"]).mapInArrow(_candidates(min_words), "w1 long, w2 long, ord long, text_key long, place int")
    cand = stored(cand, "candidates")
    for table in (profile, first, halves, shared, live):
        drop_stored(table)
    return copies, cand


def _lowest(windows: DataFrame) -> DataFrame:
    """Windows found in documents of different ids, with the smallest of these."""
    return windows.groupBy("w1", "w2").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi")).where("lo < hi").select("w1", "w2", "lo")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """What to cut: ``(ord, text_key, is_copy, places)`` for each document that loses words.

    ``is_copy``: an earlier document has the same word sequence (all goes, if that has ``min_words``).
    ``places``: word positions where a window starts that also starts in an earlier document.
    """
    bounded_batches(docs)
    copies, cand = _first_levels(_source(docs, id_col, text_col), min_words)
    lowest = stored(_lowest(cand), "lowest")
    later = cand.join(lowest, ["w1", "w2"]).where("ord > lo").select("ord", "text_key", "place")
    later = later.groupBy("ord", "text_key").agg(F.collect_list("place").alias("places"))
    out = later.select("ord", "text_key", F.lit(False).alias("is_copy"), "places").union(copies.select("ord", "text_key", F.lit(True), F.lit(None).cast("array<int>")))
    out = stored(out, "removals")
    for table in (copies, cand, lowest):
        drop_stored(table)
    return out


def repeat_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The ladder climbed on past ``min_words``: ``(ord, text_key, longest)``, the greatest of ``min_words``, twice
    that, four times, ... such that a window of so many words in the document also starts in an earlier one.

    Two windows that repeat and stand end to end make one of twice the length; the climb ends when no
    candidate survives. Documents whose whole word sequence an earlier one has are not looked at.
    """
    copies, alive = _first_levels(_source(docs, id_col, text_col), min_words)
    drop_stored(copies)
    length, found = min_words, []
    while True:
        lowest = stored(_lowest(alive), "lowest")
        known = alive
        alive = stored(known.join(lowest, ["w1", "w2"]), "alive")
        for table in (known, lowest):
            drop_stored(table)
        found.append(stored(alive.where("ord > lo").select("ord", "text_key", F.lit(length).alias("longest")).distinct(), "found"))
        if alive.isEmpty():
            break
        ahead = alive.select("ord", "text_key", (F.col("place") - length).alias("place"), F.col("w1").alias("n1"), F.col("w2").alias("n2"))
        longer = alive.join(ahead, ["ord", "text_key", "place"])
        known, alive = alive, stored(longer.select(F.xxhash64("w1", "n1").alias("w1"), F.xxhash64(F.lit(length), "w2", "n2").alias("w2"), "ord", "text_key", "place"), "longer")
        drop_stored(known)
        length *= 2
    out = found[0]
    for level in found[1:]:
        out = out.union(level)
    return out.groupBy("ord", "text_key").agg(F.max("longest").alias("longest"))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Every input row as ``row`` (struct of its columns) with ``n_words``, ``n_removed``, ``kept_text``,
    ``kept_sha256`` and ``removed`` (word spans first .. end).

    A window is ``min_words`` consecutive words of one document, as they stand in the input; each word
    that some window covers goes if the window's word sequence also starts in a document with a smaller
    id. ``kept_text`` is the text itself where nothing goes, else the kept words joined by one space;
    ``kept_sha256`` is of the kept words joined by one space. Null and empty texts have no words and
    keep their value. Null ids come after all others and don't remove each other's words; nor do rows
    with the same id. Repeated rows get the same result.
    """
    removals = repeated_windows(docs, id_col, text_col, min_words)
    rows = docs.select(F.struct("*").alias("row"), row_order(id_col).alias("ord"), F.xxhash64(F.col(text_col)).alias("text_key"))
    marked = rows.join(removals, ["ord", "text_key"], "left").select("row", "is_copy", "places")
    more = StructType.fromDDL("n_words long, n_removed long, kept_text string, kept_sha256 string, removed array<struct<first: int, end: int>>")
    return marked.mapInArrow(_cut(min_words, docs.columns.index(text_col), more), StructType([marked.schema["row"], *more.fields]))
