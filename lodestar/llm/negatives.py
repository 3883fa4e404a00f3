"""Hard-negative mining: windows of scores read from Hilbert-ordered blocks by the bounds of their zone maps.

Candidates are ordered by label and, within it, along a Hilbert curve through the vectors, and written as Parquet in blocks of
``BLOCK_ROWS`` rows or so of one label. A block's zone map has its least and greatest value of each
dimension, its label and its smallest id. By interval arithmetic the score of an anchor with any row of the block lies between
the sums over the dimensions of the lesser and of the greater of anchor * least and anchor * greatest.

Positives first: an anchor's own block gives it a k-th best score, and of its label's other blocks those are read whose greatest
score is not below. Each positive then gives a window of scores for the negatives. The block of another label with the
greatest possible score is read first; it may fill windows, and the blocks read after it are those that
can hold a score in a window not below what the window has already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.store import bounded_batches, drop_stored, stored
from lodestar.llm.vectors import dots, first_rows, matrices, numbers, pack, unpack, vector_rows
from lodestar.operators.tiling import in_parts, part_of, parts, tiles, visit

#: Rows of a block; anchors or zone maps that one task holds at a time; bits of each dimension in the curve's key.
BLOCK_ROWS, TILE, BITS = 1024, 4096, 4

_BLOCK = "block long, dim int, label long, first_id long, low binary, high binary, n_anchors int, ids binary, anchors binary, vectors binary"
_LOWEST = np.iinfo(np.int64).min


# --- the curve -----------------------------------------------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of whole numbers below 2**bits along the Hilbert curve, as bytes that sort like it.

    Skilling's transform (Programming the Hilbert curve, 2004), over all rows at once.
    """
    x = cells.astype(np.uint32).T.copy()
    dim = len(x)
    if not dim:
        return [b""] * cells.shape[0]
    for bit in range(bits - 1, 0, -1):
        low = np.uint32((1 << bit) - 1)
        for d in range(dim):
            on = (x[d] >> np.uint32(bit)) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[d]) & low).astype(np.uint32)
            x[0] ^= np.where(on, low, swap).astype(np.uint32)
            x[d] ^= swap
    for d in range(1, dim):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(bit)) & 1 == 1, (1 << bit) - 1, 0).astype(np.uint32)
    x ^= turn
    planes = np.stack([(x >> np.uint32(bit)) & 1 for bit in range(bits - 1, -1, -1)])  # bit, dimension, row
    packed = np.packbits(planes.reshape(bits * dim, -1).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _keyed(batches: Iterator[pa.RecordBatch], ranges: dict, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, packed = [b""] * batch.num_rows, [b""] * batch.num_rows
        for at, x in matrices(batch):
            low, high = ranges.get(x.shape[1], (0.0, 0.0))
            step = (high - low) / 2**bits or 1.0
            cells = np.clip(np.floor((x - low) / step), 0, 2**bits - 1)
            for r, key, v in zip(at.tolist(), hilbert_keys(cells, bits), x):
                keys[r], packed[r] = key, pack(v)
        cols = [batch.column(c) for c in ("vec_id", "dim", "label", "anchor")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], ["vec_id", "dim", "label", "anchor", "key", "v"])


# --- blocks --------------------------------------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Runs of ``rows`` ordered rows of one length and label, each with its zone map."""
    number = TaskContext.get().partitionId() << 32
    run: list[tuple] = []

    def block() -> pa.RecordBatch:
        nonlocal number
        ids = np.array([r[0] for r in run], np.int64)
        dim, label = run[0][1], run[0][2]
        x = np.concatenate([unpack(r[4], dim, 1) for r in run])
        order = np.argsort(ids, kind="stable")
        ids, x, anchors = ids[order], x[order], np.array([r[3] for r in run], np.uint8)[order]
        low, high = (x.min(0), x.max(0)) if dim else (x[0], x[0])
        row = (number, dim, label, int(ids[0]), low.astype("<f8").tobytes(), high.astype("<f8").tobytes(), int(anchors.sum()), ids.astype("<i8").tobytes(), anchors.tobytes(), pack(x))
        number += 1
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, _BLOCK_TYPES)], [c.split()[0] for c in _BLOCK.split(", ")])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("vec_id", "dim", "label", "anchor", "v")]
        for row in zip(*cols):
            if run and (len(run) == rows or run[0][1:3] != row[1:3]):
                yield block()
                run = []
            run.append(row)
    if run:
        yield block()


_BLOCK_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary())


def candidate_blocks(rows: DataFrame, label: Column, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS, bits: int = BITS) -> DataFrame:
    """Hilbert-ordered blocks, in the shared folder, of every row that has an id, a label and a usable vector.

    ``anchor`` marks the rows that are anchors. A hot label, or copies of one vector, are many blocks: rows are dealt by
    ranges of label, place on the curve and id.
    """
    bounded_batches(rows)
    given = vector_rows(rows.where(label.isNotNull()), id_col, vec_col, label=label.cast("long"), anchor=F.coalesce(anchor, F.lit(False)))
    given = stored(given, "vectors")
    sides = given.where("dim > 0").groupBy("dim").agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).collect()
    ranges = {r["dim"]: (r["low"], r["high"]) for r in sides}
    keyed = given.mapInArrow(lambda b: _keyed(b, ranges, bits), "vec_id long, dim int, label long, anchor boolean, key binary, v binary")
    ordered = keyed.repartitionByRange("dim", "label", "key", "vec_id").sortWithinPartitions("dim", "label", "key", "vec_id")
    blocks = stored(ordered.mapInArrow(lambda b: _blocks(b, block_rows), _BLOCK), "blocks")
    drop_stored(given)
    return blocks


def score_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each anchor with any vector between ``low`` and ``high`` of each block, with room for rounding."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
    room = 1e-12 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T) + 0.5
    return least - room, most + room


# --- positives -----------------------------------------------------------------------------------------------------

_HIT = "anchor_id long, positive_id long, positive_score long, rank int"


def _own_blocks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Each anchor with its best ``k`` rows of its own block."""
    for batch in batches:
        for b in batch.to_pylist():
            ids, at = numbers(b["ids"]), np.flatnonzero(numbers(b["anchors"], np.uint8))
            x = unpack(b["vectors"], b["dim"], len(ids))
            rows = []
            for lo in range(0, len(at), 512):
                some = at[lo : lo + 512]
                for a, s in zip(some.tolist(), dots(x[some], x)):
                    other = np.flatnonzero(ids != ids[a])
                    best = other[first_rows(s[other], ids[other], k)]
                    rows.append((int(ids[a]), b["dim"], b["label"], pack(x[a]), b["block"], [{"positive_id": int(ids[p]), "positive_score": int(s[p]), "rank": n + 1} for n, p in enumerate(best.tolist())]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OWN_TYPES)], [n for n, _ in _OWN])


_OWN = (("anchor_id", "long"), ("dim", "int"), ("label", "long"), ("v", "binary"), ("block", "long"), ("hits", "array<struct<positive_id: long, positive_score: long, rank: int>>"))
_OWN_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.struct([("positive_id", pa.int64()), ("positive_score", pa.int64()), ("rank", pa.int32())])))


def _zones(blocks: DataFrame, n_chunks: int) -> DataFrame:
    return blocks.select("block", "dim", "label", "first_id", "low", "high").withColumn("chunk", part_of("block", n_chunks))


def _bounded(asks: pa.Table, zones: pa.Table):
    """For each vector length: anchors and zone maps of it, their blocks' least and greatest scores, and whose labels agree."""
    for dim in pc.unique(zones.column("dim")).to_pylist():
        z, a = (t.filter(pc.equal(t.column("dim"), dim)) for t in (zones, asks))
        if a.num_rows:
            low, high = (np.stack([numbers(v, "<f8") for v in z.column(c).to_pylist()]) for c in ("low", "high"))
            q = np.concatenate([unpack(v, dim, 1) for v in a.column("v").to_pylist()])
            same = a.column("label").to_numpy()[:, None] == z.column("label").to_numpy()
            yield a, z, *score_bounds(q, low, high), same


def _positive_route(key, asks: pa.Table, zones: pa.Table) -> pa.Table:
    """Each anchor with the blocks of its label that can better its k-th best, but its own."""
    out = []
    for a, z, _, most, same in _bounded(asks, zones):
        least, kth = (pc.fill_null(a.column(c), 0).to_numpy()[:, None] for c in ("least", "least_id"))
        full = pc.is_valid(a.column("least")).to_numpy(zero_copy_only=False)[:, None]
        beyond = (most < least) | ((most < least + 1) & (z.column("first_id").to_numpy() > kth))
        i, j = np.nonzero(same & ~(full & beyond) & (a.column("own").to_numpy()[:, None] != z.column("block").to_numpy()))
        out.append(a.select(["anchor_id", "dim", "v", "least", "least_id"]).take(pa.array(i)).append_column("block", z.column("block").take(pa.array(j))))
    return pa.concat_tables(out) if out else _empty(_POSITIVE_ASK)


_POSITIVE_ASK = "anchor_id long, dim int, v binary, least long, least_id long, block long"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _empty(schema: str) -> pa.Table:
    return pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in schema.split(", ")]).empty_table()


def _table(rows: list[tuple], schema: str) -> pa.Table:
    if not rows:
        return _empty(schema)
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.Table.from_arrays([pa.array(c, _ARROW[t]) for c, t in zip(zip(*rows), kinds)], list(names))


def _scores(asks: pa.Table, block: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of each ask, and ids and scores of the block's rows for it, some asks at a time."""
    b = block.to_pylist()[0]
    ids = numbers(b["ids"])
    x = unpack(b["vectors"], b["dim"], len(ids))
    vectors = asks.column("v").to_pylist()
    for lo in range(0, len(vectors), 512):
        q = np.concatenate([unpack(v, b["dim"], 1) for v in vectors[lo : lo + 512]])
        for n, s in enumerate(dots(q, x)):
            yield lo + n, ids, s


def _positive_visit(key, asks: pa.Table, block: pa.Table, k: int) -> pa.Table:
    rows = []
    if asks.num_rows and block.num_rows:
        given = asks.select(["anchor_id", "least", "least_id"]).to_pylist()
        for n, ids, s in _scores(asks, block):
            a = given[n]
            keep = ids != a["anchor_id"]
            if a["least"] is not None:
                keep &= (s > a["least"]) | ((s == a["least"]) & (ids < a["least_id"]))
            at = np.flatnonzero(keep)
            best = at[first_rows(s[at], ids[at], k)]
            rows += [(a["anchor_id"], int(ids[p]), int(s[p]), r + 1) for r, p in enumerate(best.tolist())]
    return _table(rows, _HIT)


# --- windows -------------------------------------------------------------------------------------------------------

_NEGATIVE = "anchor_id long, positive_rank int, negative_id long, negative_score long"
_WINDOWS = pa.list_(pa.struct([("positive_rank", pa.int32()), ("low_score", pa.int64()), ("high_score", pa.int64())]))
_WINDOW_ASK = "anchor_id long, dim int, v binary, block long, windows array<struct<positive_rank: int, low_score: long, high_score: long>>"
_SEED = "anchor_id long, block long, most double"


def _reached(asks: pa.Table, zones: pa.Table):
    """For each vector length: anchors and zone maps, greatest scores, the anchors' windows behind each other, whose they are,
    and which blocks of another label can hold a score in each."""
    for a, z, least, most, same in _bounded(asks, zones):
        lists = a.column("windows").combine_chunks()
        windows, of = lists.flatten(), np.repeat(np.arange(a.num_rows), lists.value_lengths().to_numpy())
        low, high = (windows.field(c).to_numpy()[:, None] for c in ("low_score", "high_score"))
        yield a, z, most, windows, of, ~same[of] & (most[of] >= low) & (least[of] <= high)


def _window_seed(key, asks: pa.Table, zones: pa.Table) -> pa.Table:
    """For each anchor, the block that can hold the highest scores of those that can hold one in a window."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for a, z, most, _, of, reached in _reached(asks, zones):
        any_ = np.zeros(most.shape, bool)
        np.logical_or.at(any_, of, reached)
        best = np.where(any_, most, -np.inf).argmax(1)
        at = np.flatnonzero(any_.any(1))
        out.append((a.column("anchor_id").to_numpy()[at], z.column("block").to_numpy()[best[at]], most[at, best[at]]))
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], [c.split()[0] for c in _SEED.split(", ")])


def _window_route(key, asks: pa.Table, zones: pa.Table) -> pa.Table:
    """Each anchor with the blocks that can hold a score in a window, but the one read already, and with those windows."""
    out = []
    for a, z, _, windows, of, reached in _reached(asks, zones):
        reached &= (a.column("seen").to_numpy()[:, None] != z.column("block").to_numpy())[of]
        w, j = np.nonzero(reached)
        order = np.lexsort((j, of[w]))
        w, i, j = w[order], of[w[order]], j[order]
        first = np.flatnonzero(np.diff(i, prepend=-1) | np.diff(j, prepend=-1))
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(w)), pa.int32()), windows.take(pa.array(w)))
        t = a.select(["anchor_id", "dim", "v"]).take(pa.array(i[first])).append_column("block", z.column("block").take(pa.array(j[first])))
        out.append(t.append_column("windows", lists.cast(_WINDOWS)))
    return pa.concat_tables(out) if out else _empty(_WINDOW_ASK[: _WINDOW_ASK.index(", windows")]).append_column("windows", pa.array([], _WINDOWS))


def _window_visit(key, asks: pa.Table, block: pa.Table, k: int) -> pa.Table:
    """Of each window, the first ``k`` rows that the block has in it."""
    rows = []
    if asks.num_rows and block.num_rows:
        anchors, windows = asks.column("anchor_id").to_pylist(), asks.column("windows").to_pylist()
        for n, ids, s in _scores(asks, block):
            for w in windows[n]:
                at = np.flatnonzero((s >= w["low_score"]) & (s <= w["high_score"]))
                if len(at):
                    best = at[first_rows(s[at], ids[at], k)]
                    rows += [(anchors[n], w["positive_rank"], int(ids[p]), int(s[p])) for p in best.tolist()]
    return _table(rows, _NEGATIVE)


def positives(blocks: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(anchor_id, positive_id, positive_score, rank)`` of the best ``k`` rows of each anchor's own label (another id), and the anchors."""
    own = blocks.where("n_anchors > 0").mapInArrow(lambda b: _own_blocks(b, k), ", ".join(f"{n} {t}" for n, t in _OWN))
    own = own.groupBy("anchor_id").agg(F.min(F.struct("dim", "label", "v", "block", "hits")).alias("m")).select("anchor_id", "m.*")
    own = stored(own.withColumnRenamed("block", "own"), "anchors")
    kth = F.try_element_at("hits", F.lit(k))
    anchors = own.select("anchor_id", "dim", "label", "v", "own", kth["positive_score"].alias("least"), kth["positive_id"].alias("least_id"))
    n_parts, n_chunks = parts(own.count(), TILE), parts(blocks.count(), TILE)
    asks = stored(tiles(anchors.withColumn("part", part_of("anchor_id", n_parts)), n_parts, _zones(blocks, n_chunks), n_chunks, _positive_route, _POSITIVE_ASK), "positive-asks")
    late = visit(in_parts(asks, "block", "anchor_id", TILE), blocks.select("block", "dim", "ids", "vectors"), "block", lambda key, a, b: _positive_visit(key, a, b, k), _HIT)
    early = own.select("anchor_id", F.explode("hits").alias("h")).select("anchor_id", "h.*")
    best = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    every = early.unionByName(late).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return stored(every, "positives"), anchors


def hard_negatives(blocks: DataFrame, n_positives: int = 5, n_negatives: int = 3) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` from ``candidate_blocks``.

    For each anchor and each of its best ``n_positives`` rows of the same label: the best ``n_negatives`` rows of other labels (all, if
    fewer) that score from half to 95 % of the positive, ``50 p <= 100 n <= 95 p``; so none for a negative p. Higher scores come
    first, ties by smaller id. Rows with the anchor's id are never its positives; an anchor id that comes more than once is one anchor, that of
    the shortest vector, the least label and so on. Vectors of another length than the anchor's take no part for it.
    Other repeated rows are rows of their own. Scores beyond 64 bits are held at the ends of the range.
    """
    found, anchors = positives(blocks, n_positives)
    p = F.col("positive_score")
    low, high = p - F.expr("positive_score div 2"), p + F.floor(-p.cast("decimal(20,0)") / 20).cast("long")
    windows = found.where("positive_score >= 0").select("anchor_id", F.col("rank").alias("positive_rank"), low.alias("low_score"), high.alias("high_score"))
    windows = stored(windows.where("low_score <= high_score"), "windows")
    window = F.collect_list(F.struct("positive_rank", "low_score", "high_score")).alias("windows")  # n_positives at most
    n_parts, n_chunks = parts(anchors.count(), TILE), parts(blocks.count(), TILE)
    zones, pages = _zones(blocks, n_chunks), blocks.select("block", "dim", "ids", "vectors")
    anchors = anchors.select("anchor_id", "dim", "label", "v", part_of("anchor_id", n_parts).alias("part"))
    asked = anchors.join(windows.groupBy("anchor_id").agg(window), "anchor_id")
    seed = tiles(asked, n_parts, zones, n_chunks, _window_seed, _SEED).groupBy("anchor_id").agg(F.max_by("block", F.struct("most", "block")).alias("block"))
    seeded = stored(asked.drop("part").join(seed, "anchor_id"), "window-seeds")
    look = lambda key, a, b: _window_visit(key, a, b, n_negatives)
    early = stored(visit(in_parts(seeded.drop("label"), "block", "anchor_id", TILE), pages, "block", look, _NEGATIVE), "early-negatives")
    # a window that its first block has filled looks for scores from its last on
    names = ["anchor_id", "positive_rank"]
    filled = early.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.min("negative_score").alias("last")).where(F.col("n") >= n_negatives)
    higher = windows.join(filled, names, "left").withColumn("low_score", F.greatest("low_score", F.coalesce("last", "low_score")))
    known = anchors.join(seeded.select("anchor_id", F.col("block").alias("seen")), "anchor_id").join(higher.groupBy("anchor_id").agg(window), "anchor_id")
    asks = stored(tiles(known, n_parts, zones, n_chunks, _window_route, _WINDOW_ASK), "window-asks")
    late = visit(in_parts(asks, "block", "anchor_id", TILE), pages, "block", look, _NEGATIVE)
    best = Window.partitionBy(*names).orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = early.unionByName(late).withColumn("r", F.row_number().over(best)).where(F.col("r") <= n_negatives)
    out = ranked.join(found.select("anchor_id", F.col("rank").alias("positive_rank"), "positive_id", "positive_score"), names)
    return out.select("anchor_id", "positive_id", F.col("r").alias("rank"), "negative_id", "positive_score", "negative_score")
