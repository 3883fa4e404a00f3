"""Compact postings (A2): blocks of binary postings, delta and variable-byte coded.

A row is a block of a term's postings in order of document: ``(term, block, first_id, last_id, n, max_tf, data)``. ``data`` has, for each
posting, the difference to the document before it (the first: to ``first_id``, so 0) and its tf, as little-endian base-128
numbers. First and last id and the greatest tf are there to skip a block without decoding it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import shuffle_partitions

# Document ids of a block: a term has at most so many postings in one.
BLOCK_IDS = 1024
# Postings that are decoded at a time.
PIECE = 1 << 18
COMPACT = "term string, block long, first_id long, last_id long, n int, max_tf long, data binary"


def pack_numbers(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base-128 bytes of non-negative numbers, one behind the other, and how many bytes each has."""
    x = x.astype(np.uint64)
    size = np.ones(len(x), np.int64)
    rest = x >> np.uint64(7)
    while rest.any():
        size += rest > 0
        rest >>= np.uint64(7)
    start = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(start, size)
    out = (np.repeat(x, size) >> (place * 7).astype(np.uint64)) & np.uint64(127)
    out[place < np.repeat(size, size) - 1] |= np.uint64(128)
    return out.astype(np.uint8), size


def unpack_numbers(data: np.ndarray) -> np.ndarray:
    """The numbers of ``pack_numbers``."""
    ends = np.flatnonzero(data < 128)
    first = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.zeros(0, np.int64)
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))
    parts = (data & 127).astype(np.uint64) << (place * 7).astype(np.uint64)
    return np.add.reduceat(parts, first).astype(np.int64) if len(first) else np.zeros(0, np.int64)


def changes(c: pa.ChunkedArray) -> np.ndarray:
    """Whether each value after the first is another than the one before it; nulls are equal."""
    c = c.combine_chunks()
    a, b = c.slice(1), c.slice(0, len(c) - 1)
    other = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
    return other.to_numpy(zero_copy_only=False)


def compact(postings: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``COMPACT`` rows of ``(doc_id, term, tf)``; doc_id is a long. A hot term is many blocks, none larger than ``block_ids`` postings."""
    block = F.floor(F.col("doc_id") / block_ids).cast("long").alias("block")
    rows = postings.select("term", block, "doc_id", F.col("tf").cast("long").alias("tf"))
    # sorted as plain rows, not gathered in arrays: a sort spills and needs no buffer for each of a great many small groups
    rows = rows.repartition(shuffle_partitions(postings.sparkSession), "term", "block")
    rows = rows.sortWithinPartitions(F.xxhash64("term", "block"), "term", "block", "doc_id", "tf")  # numbers first: few strings are compared

    def pack(t: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        """Blocks that begin at the rows ``first``."""
        ids, tf = (t[c].to_numpy().astype(np.int64) for c in ("doc_id", "tf"))
        n = np.diff(first, append=len(ids))
        delta = np.diff(ids, prepend=ids[:1])
        delta[first] = 0
        both = np.empty(2 * len(ids), np.int64)
        both[0::2], both[1::2] = delta, tf
        data, size = pack_numbers(both)
        ends = np.cumsum(size)[2 * np.cumsum(n) - 1].tolist()
        raw = data.tobytes()
        cut = [raw[lo:hi] for lo, hi in zip([0, *ends], ends)]
        cols = [ids[first], ids[first + n - 1], n.astype(np.int32), np.maximum.reduceat(tf, first)]
        keys = [t[c].combine_chunks().take(pa.array(first)) for c in ("term", "block")]
        return pa.RecordBatch.from_arrays([*keys, *map(pa.array, cols), pa.array(cut, pa.binary())], names=[c.split()[0] for c in COMPACT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last block so far, which may go on in the next batch
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
            if not t.num_rows:
                continue
            starts = np.concatenate([[True], changes(t["term"]) | changes(t["block"])])
            first = np.flatnonzero(starts)
            rest = t.slice(first[-1])
            if len(first) > 1:
                yield pack(t.slice(0, first[-1]), first[:-1])
        if rest is not None:
            yield pack(rest, np.zeros(1, np.int64))

    return rows.mapInArrow(run, COMPACT)


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of compact rows in parts of about ``PIECE`` postings."""
    piece = np.cumsum(batch.column("n").to_numpy().astype(np.int64)) // PIECE
    for part in np.split(np.arange(len(piece)), np.flatnonzero(np.diff(piece)) + 1):
        yield batch.slice(part[0], len(part)) if len(part) else batch


def expand(blocks: DataFrame, lists: bool = False) -> DataFrame:
    """``(term, block, doc_id, tf)`` of compact rows; with ``lists`` one row for each, ``(term, block, postings)`` in order of document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in pieces(b)):
            n = batch.column("n").to_numpy().astype(np.int64)
            both = unpack_numbers(np.frombuffer(b"".join(batch.column("data").to_pylist()), np.uint8))
            of = np.repeat(np.arange(len(n)), n)
            first = np.cumsum(n) - n
            run_ = np.cumsum(both[0::2])
            ids = run_ - np.repeat(run_[first], n) + np.repeat(batch.column("first_id").to_numpy(), n) if len(of) else run_
            if lists:
                found = pa.StructArray.from_arrays([pa.array(ids), pa.array(both[1::2])], names=["doc_id", "tf"])
                ends = pa.array(np.append(first, len(of)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("term"), batch.column("block"), pa.ListArray.from_arrays(ends, found)], names=["term", "block", "postings"])
                continue
            at = pa.array(of)
            yield pa.RecordBatch.from_arrays([batch.column("term").take(at), batch.column("block").take(at), pa.array(ids), pa.array(both[1::2])], names=["term", "block", "doc_id", "tf"])

    made = "postings array<struct<doc_id: long, tf: long>>" if lists else "doc_id long, tf long"
    return blocks.select("term", "block", "first_id", "n", "data").mapInArrow(run, f"term string, block long, {made}")


def block_bounds(blocks: DataFrame) -> DataFrame:
    """``(term, block, n, max_tf)``: what a block can add at most, without its data."""
    return blocks.select("term", "block", "n", "max_tf")
