"""SimHash near-duplicates: fingerprints, links by multi-index hashing, components.

Two 64-bit fingerprints that differ in at most ``3`` bits differ in at most one bit in one of
their two 32-bit halves. So every half found in the corpus asks for itself and for the 32 halves
at one bit's distance (its Hamming ball), the table of halves answers, and the whole fingerprints
behind two halves that met are compared. Halves held by many fingerprints are cut into chunks of
bounded size; two chunks are compared inside a task that returns a spanning forest of the links
it finds, so that neither a task nor the output grows with the square of a group, and no link
between two fingerprints is lost to the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.graph import connected_components
from lodestar.llm.store import NULL_ORDER, bounded_batches, row_order, stored
from lodestar.llm.worker import let_go

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints in a chunk, about: what a task compares with one other chunk.
CHUNK = 1024


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a text: bit set where over half of the shingles' XXH64 have it; 0 without words."""
    words = (text or "").encode().lower().split()  # on ASCII bytes only: A-Z, and the six white space bytes
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, seed) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 65536):
        part = h[lo : lo + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``row`` (the input's columns as a struct) and ``fp``, the fingerprint as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["row", "fp"])

    bounded_batches(docs)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("row"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, _schema(rows.select("row"), "fp long"))


def _schema(df: DataFrame, more: str):
    from pyspark.sql.types import StructType

    extra = StructType.fromDDL(more)
    return StructType([*df.schema.fields, *extra.fields])


def linked_components(fps: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """``fps(fp)`` of distinct longs -> ``(node, root)`` over the links of at most ``max_bits`` bits.

    ``max_bits`` up to 3: the halves' Hamming balls have radius 1.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with balls of one bit find links of at most 3 bits")
    half = lambda s: (F.shiftrightunsigned("fp", 32) if s == 0 else F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).cast("long")
    members = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(s).alias("s"), half(s).alias("key")) for s in (0, 1)))).alias("x"))
    members = members.select("fp", "x.s", "x.key")
    buckets = stored(members.groupBy("s", "key").agg(F.count(F.lit(1)).alias("n")), "buckets")

    # the ball of each half, larger halves only: of two halves that are neighbours the smaller one asks
    ball = F.filter(F.array(*(F.col("key").bitwiseXOR(F.lit(1 << i)) for i in range(32))), lambda k: k > F.col("key"))
    asked = buckets.select("s", "key", F.explode(ball).alias("near"))
    known = buckets.select("s", F.col("key").alias("near"))
    met = asked.join(known, ["s", "near"]).union(buckets.where("n > 1").select("s", F.col("key").alias("near"), "key"))
    crowded = stored(buckets.where(F.col("n") > chunk).select("s", "key", F.lit(True).alias("c")), "crowded")
    met = met.join(crowded, ["s", "key"], "left").join(crowded.toDF("s", "near", "d"), ["s", "near"], "left")
    met = stored(met.select("s", "key", "near", (F.col("c").isNotNull() | F.col("d").isNotNull()).alias("crowd")), "met")

    # buckets of a chunk or less, whole
    few = members.join(crowded, ["s", "key"], "left_anti").groupBy("s", "key").agg(F.collect_list("fp").alias("fps"))
    few = stored(few, "chunks")
    left, right = few.select("s", "key", F.col("fps").alias("f1")), few.select("s", F.col("key").alias("near"), F.col("fps").alias("f2"))
    pairs = met.where("not crowd").join(left, ["s", "key"]).join(right, ["s", "near"]).select("f1", "f2")

    # a larger bucket is cut by the other half, in which linked fingerprints differ by three bits at most: so one of its four bytes is equal
    many = met.where("crowd").select("s", F.explode(F.array("key", "near")).alias("key")).distinct()
    other = F.when(F.col("s") == 0, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", 32))
    byte = F.array(*(F.lit(256 * k) + F.shiftright(other, 8 * k).bitwiseAND(F.lit(255)) for k in range(4)))
    cut = stored(members.join(many, ["s", "key"]).select("s", "key", "fp", F.explode(byte).alias("byte")), "cut")
    parts = cut.groupBy("s", "key", "byte").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("parts"))
    dealt = cut.join(parts, ["s", "key", "byte"]).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    dealt = stored(dealt.groupBy("s", "key", "byte", "part").agg(F.collect_list("fp").alias("fps")), "chunks")
    left = dealt.select("s", "key", "byte", F.col("part").alias("p1"), F.col("fps").alias("f1"))
    right = dealt.select("s", F.col("key").alias("near"), "byte", F.col("part").alias("p2"), F.col("fps").alias("f2"))
    crowd = met.where("crowd").select("s", "key", "near").join(left, ["s", "key"]).join(right, ["s", "near", "byte"])
    pairs = pairs.union(crowd.where("key <> near or p1 <= p2").select("f1", "f2"))
    edges = pairs.mapInArrow(_forests(max_bits), "a long, b long")
    return connected_components(edges)


def _forests(max_bits: int):
    def links(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """A spanning forest of the links between the two chunks."""
        near = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= max_bits
        if len(a) == 1 and len(b) == 1:  # nearly all
            return [(int(a[0]), int(b[0]))] if near[0, 0] and a[0] != b[0] else []
        nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        at_a, at_b = where[: len(a)], where[len(a) :]
        tree = np.arange(len(nodes))  # the tree that each node is in
        out = []
        for i in np.flatnonzero(near.any(axis=1)):
            met = at_b[near[i]]
            trees, at = np.unique(tree[met], return_index=True)
            mine = tree[at_a[i]]
            others = trees != mine
            if others.any():
                out += [(int(a[i]), int(nodes[j])) for j in met[at[others]]]
                tree[np.isin(tree, trees)] = mine
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for f1, f2 in zip(batch.column(0), batch.column(1), strict=True):
                found += links(*(np.array(v.values, dtype=np.int64) for v in (f1, f2)))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Near-duplicate components of documents.

    Returns ``row`` (struct of the input's columns but the text), ``fp`` (long), ``root`` (smallest
    fingerprint, as a signed long, of the component: its key) and ``component_id`` (smallest id in
    the component). Null and empty texts have fingerprint 0 and link like any other. Null ids are
    never the smallest; a component with null ids only has component_id null. Repeated rows stay
    repeated. An empty table gives an empty result.
    """
    marked = stored(with_fingerprint(docs, text_col, shingle_words), "fingerprints")
    own = F.col("row").getField(id_col).cast("long")
    fps = stored(marked.groupBy("fp").agg(F.min(F.coalesce(own, F.lit(NULL_ORDER))).alias("low")), "distinct")
    comps = linked_components(fps.select("fp"), max_bits)
    rooted = stored(fps.join(comps.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "rooted")
    lowest = stored(rooted.groupBy("root").agg(F.min("low").alias("lowest")), "lowest")
    classes = stored(rooted.join(lowest, "root").select("fp", "root", F.when(F.col("lowest") != NULL_ORDER, F.col("lowest")).alias("component_id")), "classes")
    return marked.join(classes, "fp").select("row", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs``, all columns, with one row of each near-duplicate component: the one with the smallest id.

    Null ids come last; rows that tie on id are ordered by a 64-bit hash of the text, and of rows equal
    in id and text one stays.
    """
    key = [row_order(id_col).alias("ord"), F.xxhash64(F.col(text_col)).alias("text_key")]
    comps = simhash_components(docs.select(*key, F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", shingle_words, max_bits)
    first = comps.groupBy("root").agg(F.min(F.struct("row.ord", "row.text_key")).alias("first"))
    first = stored(first.select("first.ord", "first.text_key"), "first")
    rows = docs.select(F.struct("*").alias("row"), *key)
    return rows.join(first, ["ord", "text_key"], "left_semi").dropDuplicates(["ord", "text_key"]).select("row.*")
