"""Cross-tokenizer alignment: tokens of two tokenizers of one text, grouped where both have a token end.

Merge path. The token ends of A and of B are two ascending lists of byte offsets, and merging them is a
path through a grid. Diagonals at equal distances cut the path; a binary search on each finds where the path
crosses it, so the merging falls into pieces of equal work that need nothing of each other. A piece emits
the ends that both lists have, that is the overlaps it closes itself; the tokens before its first such end and after its
last are boundary pieces, stitched to those of its neighbours. The documents of an Arrow batch lie one behind the
other on one byte axis, so a long document is many pieces and a piece many short documents.

Both tokenizers have a token end wherever a space or a new line follows something else (their files are looked at for it; else
texts are encoded whole), so the ids of a segment between two such places are the same in every text and are kept.

Counts of linked id pairs over the corpus come from pairs that each batch has counted already. The pairs in most
documents, at most ``TABLE_PAIRS`` of them, go to the tasks as sorted arrays; all others are joined by key.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.llm.store import bounded_batches, stored
from lodestar.llm.worker import kept, let_go
from lodestar.llm.words import slices

#: Token ends in a piece of the merge.
PIECE = 8192
#: Pairs that a task keeps counts of; the rest meet theirs in a join.
TABLE_PAIRS = 1_000_000


def cut_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in ascending ``a`` and ``b`` where their merge is cut into runs of ``piece`` ends, both lists' ends first and last.

    A binary search on every diagonal at once: the path crosses diagonal d where the first i of a and the first d - i
    of b are the d smallest. An end that both lists have stays in one piece, which is then longer by one.
    """
    n, m = len(a), len(b)
    d = np.arange(piece, n + m, piece)
    low, high = np.maximum(0, d - m), np.minimum(d, n)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        after = open_ & (a[np.minimum(mid, n - 1)] <= b[np.clip(d - mid - 1, 0, m - 1)])
        low = np.where(after, mid + 1, low)
        high = np.where(open_ & ~after, mid, high)
    i, j = low, d - low
    if n and m:
        shared = (i > 0) & (j < m) & (a[np.maximum(i - 1, 0)] == b[np.minimum(j, m - 1)])
        j = j + shared
    return np.concatenate([[0], i, [n]]), np.concatenate([[0], j, [m]])


def _piece_overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens in ``a`` and in ``b`` after each end that both have."""
    at = np.searchsorted(b, a)
    both = np.flatnonzero(b[np.minimum(at, len(b) - 1)] == a) if len(b) else np.zeros(0, np.int64)
    return both + 1, at[both] + 1


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """First token of each group in A and in B, and one past the last: group g is ``a[ga[g]:ga[g+1]]`` and ``b[gb[g]:gb[g+1]]``.

    ``a`` and ``b`` are ascending token ends over the same bytes, so their last ends are equal. What a piece leaves open at
    its end and the next one at its start becomes one group, over as many pieces as have no shared end at all.
    """
    i, j = cut_path(a, b, piece)
    ga, gb = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    for k in range(len(i) - 1):
        x, y = _piece_overlaps(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])
        ga.append(x + i[k])
        gb.append(y + j[k])
    return np.concatenate(ga), np.concatenate(gb)


class Tokens:
    """One tokenizer: ids of segments, the bytes of each id, and whether segments can be encoded on their own."""

    def __init__(self, kind: str, data: bytes) -> None:
        if kind == "bpe":
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            t = Tokenizer.from_str(data.decode())
            t.encode_special_tokens = True
            self.encode = lambda segments: [e.ids for e in t.encode_batch_fast(segments, add_special_tokens=False)]
            # the printable stand-ins of the 256 bytes in a byte-level vocabulary
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            other = [c for c in range(256) if c not in plain]
            byte = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(other)}
            special = {i: t.content.encode() for i, t in t.get_added_tokens_decoder().items()}
            self.bytes = [b""] * t.get_vocab_size()
            for token, i in t.get_vocab().items():
                self.bytes[i] = special.get(i) or bytes(byte[c] for c in token)
            spec = json.loads(data)
            # every byte has a token, and nothing is changed before
            self.lossless = spec["normalizer"] is None and set(self.bytes) >= {bytes([c]) for c in range(256)}
            # its pattern ends a match wherever white space follows something else
            self.apart = spec["normalizer"] is None and {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}.items() <= spec["pre_tokenizer"].items()
        else:
            from sentencepiece import SentencePieceProcessor

            p = SentencePieceProcessor(model_proto=data)
            self.lossless = False
            pieces = [p.id_to_piece(i) for i in range(p.get_piece_size())]
            self.bytes = [bytes([int(x[3:5], 16)]) if p.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]
            begin, space = p.encode("a"), p.encode("a ")
            # no piece goes over a space after something else, or holds a new line
            self.apart = space[: len(begin)] == begin and not any("▁" in x.lstrip("▁") or "\n" in x for x in pieces)

            def encode(segments: list[str]) -> list[list[int]]:
                """The model puts one space before what it is given: it stands for the segment's own, or goes again."""
                found = p.encode([x[1:] if x[0] == " " else x for x in segments], num_threads=1)
                return [space[len(begin) :] if x == " " else ids if x[0] == " " else ids[1:] for x, ids in zip(segments, found)]

            self.encode = encode
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        self.kind = np.dtype("<u2" if len(self.bytes) <= 2**16 else "<u4")
        self.written: list[bytes] = []

    def names(self, last: bytes) -> list[bytes]:
        """Each id in decimal, followed by a comma, and by ``last``."""
        if not self.written:
            self.written = [b"%d%s" % (i, x) for i in range(len(self.bytes)) for x in (b",", last)]
        return self.written

    def whole(self, ids: np.ndarray | list[int], text: bytes) -> bool:
        """Do the tokens' bytes, joined, give the text?"""
        if self.lossless:
            return True
        return b"".join(map(self.bytes.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)) == text


#: Segments end where a space or a new line follows something that is not white space. Both tokenizers have a token end there.
#: (U+2581 is a space to the sentencepiece model.)
_SEGMENTS = re.compile(r"[\s▁]*+[^\s▁]++(?:(?![ \n])[\s▁]++[^\s▁]++)*+(?:(?![ \n])[\s▁]++\Z)?|[\s▁]+")
#: Segments kept by a worker (the half met most often stays when there are more), and characters given to a tokenizer at a time.
MAX_SEGMENTS, AT_ONCE = 300_000, 20_000


class _Kept:
    """Ids of numbered segments by one tokenizer, one behind the other."""

    def __init__(self, kind: np.dtype) -> None:
        self.ids, self.first = np.zeros(0, kind), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments in the order given, and how many each has."""
        size = np.diff(self.first)[numbers]
        at = np.repeat(self.first[numbers] - (np.cumsum(size) - size), size)
        return self.ids[at + np.arange(len(at))], size


class Encoder:
    """Ids of whole texts by both tokenizers; those of segments met before are looked up."""

    def __init__(self, a: Tokens, b: Tokens) -> None:
        self.a, self.b, self.apart = a, b, a.apart and b.apart
        self.number: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.kept = _Kept(self.a.kind), _Kept(self.b.kind)
        self.odd, self.met = np.zeros(0, bool), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[bool]]:
        """Ids by A and by B of a space and each (not empty) text, and whether the bytes of both give it back."""
        segments = [_SEGMENTS.findall(" " + t) if self.apart else [" " + t] for t in texts]
        every = list(chain.from_iterable(segments))
        numbers = np.array([self.number.get(x, -1) for x in every], np.int64)
        if (missing := np.flatnonzero(numbers < 0)).size:
            self._learn(list({every[k] for k in missing}))
            numbers[missing] = [self.number[every[k]] for k in missing]
        self.met += np.bincount(numbers, minlength=len(self.met))
        cut = np.cumsum([0, *map(len, segments)])
        ids = []
        for kept in self.kept:
            flat, size = kept.of(numbers)
            ids.append(np.split(flat, np.concatenate([[0], np.cumsum(size)])[cut[1:-1]]) if texts else [])
        odd = np.concatenate([[0], np.cumsum(self.odd[numbers])])[cut]
        ok = [odd[k] == odd[k + 1] or (self.a.whole(i, raw := (" " + texts[k]).encode()) and self.b.whole(j, raw)) for k, (i, j) in enumerate(zip(*ids))]
        if len(self.number) > MAX_SEGMENTS:
            self._shrink()
        return ids[0], ids[1], ok

    def _shrink(self) -> None:
        often = np.sort(np.argsort(-self.met, kind="stable")[: MAX_SEGMENTS // 2])
        kept, odd, met = [k.of(often) for k in self.kept], self.odd[often], self.met[often] // 2
        names = list(self.number)
        self.number = {names[k]: n for n, k in enumerate(often.tolist())}
        self._forget()
        for k, (ids, size) in zip(self.kept, kept):
            k.add(ids, size)
        self.odd, self.met = odd, met

    def _learn(self, new: list[str]) -> None:
        """Segments one behind the other are a text that falls into them again, so many are encoded at once."""
        plain, alone, lo = [], [], 0
        for x in new:
            (plain if self.apart and "▁" not in x and not x[-1].isspace() else alone).append(x)
        while lo < len(plain):
            hi, size = lo, 0
            while hi < len(plain) and size < AT_ONCE:
                size += len(plain[hi])
                hi += 1
            if not self._learn_run(plain[lo:hi]):
                alone += plain[lo:hi]
            lo = hi
        for x in alone:
            raw, ids = x.encode(), [t.encode([x])[0] for t in (self.a, self.b)]
            self._keep([x], [(np.array(i, t.kind), np.array([len(i)])) for i, t in zip(ids, (self.a, self.b))], not (self.a.whole(ids[0], raw) and self.b.whole(ids[1], raw)))

    def _learn_run(self, run: list[str]) -> bool:
        """Keep the ids of the segments of ``run``, if tokens end where each segment does and have its bytes."""
        raw = "".join(run).encode()
        ends, cut = np.cumsum([0, *(len(x.encode()) for x in run)]), []
        for tokens in (self.a, self.b):
            ids = np.array(tokens.encode([raw.decode()])[0], tokens.kind)
            upto = np.concatenate([[0], np.cumsum(tokens.lengths[ids])])
            at = np.searchsorted(upto, ends)
            if upto[-1] != ends[-1] or (upto[at] != ends).any() or not tokens.whole(ids, raw):
                return False
            cut.append((ids, np.diff(at)))
        self._keep(run, cut, False)
        return True

    def _keep(self, run: list[str], cut: list[tuple[np.ndarray, np.ndarray]], odd: bool) -> None:
        first = len(self.number)
        self.number.update(zip(run, range(first, first + len(run))))
        for kept, (ids, sizes) in zip(self.kept, cut):
            kept.add(ids, sizes)
        self.odd = np.concatenate([self.odd, np.full(len(run), odd)])
        self.met = np.concatenate([self.met, np.zeros(len(run), np.int64)])


def key_type(a: Tokens, b: Tokens) -> str:
    """Unsigned integers that hold every pair key: id of A * size of B's vocabulary + id of B."""
    return "<u4" if len(a.bytes) * len(b.bytes) <= 2**32 else "<u8"


def _loaded(vocab_a: bytes, vocab_b: bytes) -> Encoder:
    return kept(("align", hash(vocab_a), hash(vocab_b)), lambda: Encoder(Tokens("bpe", vocab_a), Tokens("piece", vocab_b)))


def _flat(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids behind each other, and where each document's begin."""
    first = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
    return np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64), first


def _pairs(ga: np.ndarray, gb: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, size_b: int, doc: np.ndarray, at: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair key (id of A * ``size_b`` + id of B) and number of links of each linked pair of each document.

    The equal ids of a group's side are counted before the sides meet, and links are made ``at`` at a time, so the memory
    is bounded by the distinct pairs.
    """
    na, nb = np.diff(ga), np.diff(gb)
    sa, sb = _runs(ga, na, ids_a), _runs(gb, nb, ids_b)
    n_a, n_b = np.bincount(sa[0], minlength=len(na)), np.bincount(sb[0], minlength=len(nb))
    first_b = np.concatenate([[0], np.cumsum(n_b)])
    meet = n_b[sa[0]]  # links of each distinct id of side A
    total = np.concatenate([[0], np.cumsum(meet)])
    parts, lo = [], 0
    while lo < len(meet):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + at, side="right")) - 1)
        x = np.repeat(np.arange(lo, hi), meet[lo:hi])
        g = sa[0][x]
        y = first_b[g] + np.arange(len(x)) - (total[x] - total[lo])
        parts.append(_summed(doc[g], sa[1][x] * size_b + sb[1][y], sa[2][x] * sb[2][y]))
        lo = hi
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return parts[0] if len(parts) == 1 else _summed(*(np.concatenate(p) for p in zip(*parts)))


def _runs(g: np.ndarray, n: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id and how often, for the distinct ids of each group."""
    of = np.repeat(np.arange(len(n)), n)
    ids = ids[: len(of)]
    if (n <= 1).all():
        return of, ids, np.ones(len(of), np.int64)
    return _summed(of, ids, np.ones(len(of), np.int64))


def _summed(major: np.ndarray, minor: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``n`` for each (major, minor), in that order."""
    span = int(minor.max(initial=0)) + 1
    key = major * span + minor
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[new] // span, key[new] % span, np.add.reduceat(n[order], new) if len(new) else np.zeros(0, np.int64)


def _written(ga: np.ndarray, gb: np.ndarray, fa: np.ndarray, fb: np.ndarray, a: Tokens, b: Tokens) -> list[bytes]:
    """The groups' ids as text, a part for each token of A and B in the order they are written: ``a1,a2|b1;`` ..."""
    out = np.empty(len(fa) + len(fb), np.int64)
    last_a, last_b = np.zeros(len(fa), np.int64), np.zeros(len(fb), np.int64)
    last_a[ga[1:] - 1] = last_b[gb[1:] - 1] = 1
    out[np.arange(len(fa)) + np.repeat(gb[:-1], np.diff(ga))] = 2 * fa + last_a
    out[np.arange(len(fb)) + np.repeat(ga[1:], np.diff(gb))] = 2 * (len(a.bytes) + fb) + last_b
    names = a.names(b"|") + b.names(b";")
    return list(map(names.__getitem__, out.tolist()))


def align_texts(texts: list[str | None], coder: Encoder, piece: int = PIECE) -> dict[str, list]:
    """Columns of the aligned texts: counts, digest of the groups, and the linked pairs as bytes of key and count arrays."""
    n, a, b = len(texts), coder.a, coder.b
    use = [k for k in range(n) if texts[k]]
    ids_a, ids_b, whole = coder.encode([texts[k] for k in use])
    ok = [k for k in range(len(use)) if whole[k]]
    use, ids_a, ids_b = [use[k] for k in ok], [ids_a[k] for k in ok], [ids_b[k] for k in ok]
    (fa, da), (fb, db) = _flat(ids_a), _flat(ids_b)
    ends_a, ends_b = np.cumsum(a.lengths[fa]), np.cumsum(b.lengths[fb])
    ga, gb = overlaps(ends_a, ends_b, piece)  # a document's last end is shared, so no group leaves its document
    gd = np.searchsorted(ga, da)  # groups of document k are gd[k] .. gd[k + 1]
    doc = np.repeat(np.arange(len(use)), np.diff(gd))
    links = np.concatenate([[0], np.cumsum(np.diff(ga) * np.diff(gb))])
    of, key, times = _pairs(ga, gb, fa, fb, len(b.bytes), doc)
    pd = np.searchsorted(of, np.arange(len(use) + 1))
    text = _written(ga, gb, fa, fb, a, b)
    key, times = key.astype(key_type(a, b)), times.astype("<u4")
    out = {"n_a": [0] * n, "n_b": [0] * n, "n_groups": [0] * n, "n_links": [0] * n, "groups_sha256": [""] * n, "pairs": [b""] * n, "times": [b""] * n}
    for k, row in enumerate(use):
        out["n_a"][row], out["n_b"][row] = len(ids_a[k]), len(ids_b[k])
        out["n_groups"][row] = int(gd[k + 1] - gd[k])
        out["n_links"][row] = int(links[gd[k + 1]] - links[gd[k]])
        out["groups_sha256"][row] = hashlib.sha256(b"".join(text[da[k] + db[k] : da[k + 1] + db[k + 1]])[:-1]).hexdigest()
        out["pairs"][row], out["times"][row] = key[pd[k] : pd[k + 1]].tobytes(), times[pd[k] : pd[k + 1]].tobytes()
    return out


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def aligned(docs: DataFrame, vocab_a: str, vocab_b: str, text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """Every row of ``docs`` as the struct ``row`` without its text, with its alignment.

    ``vocab_a`` is the file of a byte-level BPE (JSON of ``tokenizers``), given a space and the text; ``vocab_b`` that of a
    sentencepiece model, which puts the space there itself. ``pairs`` has the linked id pairs of the document
    as the keys of ``key_type``, ascending; ``times`` their numbers of links, unsigned 32-bit.
    Null and empty texts, and texts whose tokens' bytes are not the text's, have no tokens: zeros, and an empty digest.
    """
    bounded_batches(docs)
    spark = docs.sparkSession
    vocab = spark.sparkContext.broadcast((_content(spark, vocab_a), _content(spark, vocab_b)))  # files of a few MB
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    given = docs.select(row.alias("row"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _loaded(*vocab.value)
        for batch in batches:
            for part, texts in slices(batch, batch.column("text"), 2 << 20):
                cols = align_texts(texts.to_pylist(), coder, piece)
                yield pa.RecordBatch.from_arrays([part.column("row"), *(pa.array(v, _ARROW[c]) for c, v in cols.items())], ["row", *cols])

    schema = StructType(given.select("row").schema.fields + StructType.fromDDL(_ALIGNED).fields)
    return given.mapInArrow(run, schema)


_ARROW = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "pairs": pa.binary(), "times": pa.binary()}


def _content(spark, path: str) -> bytes:
    """Bytes of a vocabulary file, by Spark's reader where it is not a file of the driver."""
    if os.path.exists(path):
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).first()["content"])


def pair_counts(found: DataFrame, kind: str) -> DataFrame:
    """``(pair, n)``: in how many documents of ``aligned`` rows each id pair is linked; ``kind`` is the keys' type.

    Batches are counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part, packed in slices(batch, batch.column("pairs"), 16 << 20):
                keys = np.frombuffer(b"".join(packed.to_pylist()), kind).astype(np.int64)
                pair, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])

    return found.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _threshold(counts: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` pairs reach in documents."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("pairs")).collect()  # 63 rows at most
    left, p = most, 64
    for r in sorted(sizes, key=lambda r: -r["p"]):
        left -= r["pairs"]
        if left < 0:
            break
        p = r["p"]
    return 1 << p if p < 63 else 2**63 - 1


def _row_sums(x: np.ndarray, of: np.ndarray, n_rows: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(x)])
    return np.diff(total[np.searchsorted(of, np.arange(n_rows + 1))])


def token_alignment(docs: DataFrame, vocab_a: str, vocab_b: str, text_col: str = "text", table_pairs: int = TABLE_PAIRS, piece: int = PIECE) -> DataFrame:
    """``aligned`` rows with ``n_best`` and ``count_sum`` in place of the packed pairs.

    A pair's count is the number of documents of the whole table that hold it linked. ``count_sum`` adds it up over the
    links of the document; ``n_best`` counts the links whose pair's count is the highest of its A id, ties included.
    Repeated rows are documents of their own; an empty table gives no row.
    """
    spark = docs.sparkSession
    coder = _loaded(_content(spark, vocab_a), _content(spark, vocab_b))
    kind, size_b = key_type(coder.a, coder.b), len(coder.b.bytes)
    width = np.dtype(kind).itemsize
    found = stored(aligned(docs, vocab_a, vocab_b, text_col, piece).withColumn("at", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(found, kind), "pair-counts")
    best = counts.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.max("n").alias("most"))
    counts = stored(counts.withColumn("a", F.expr(f"pair div {size_b}")).join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")
    least = _threshold(counts, table_pairs)
    table = counts.where(F.col("n") >= least).toArrow()  # at most table_pairs rows
    order = np.argsort(table["pair"].to_numpy())
    known = spark.sparkContext.broadcast(tuple(table[c].to_numpy()[order] for c in ("pair", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        pair, n, top = known.value
        for batch in batches:
            for part, packed in slices(batch, batch.column("pairs"), 16 << 20):
                rows = packed.to_pylist()
                keys = np.frombuffer(b"".join(rows), kind).astype(np.int64)
                times = np.frombuffer(b"".join(part.column("times").to_pylist()), "<u4").astype(np.int64)
                of = np.repeat(np.arange(len(rows)), [len(r) // width for r in rows])
                at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
                here = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
                count, is_best = (n[at], top[at]) if len(pair) else (keys, here)
                sums = [_row_sums(np.where(here, times * x, 0), of, len(rows)) for x in (count, is_best)]
                rest = np.flatnonzero(~here)
                first = np.searchsorted(of[rest], np.arange(len(rows) + 1))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays([pa.array(keys[rest]), pa.array(times[rest])], ["pair", "times"]))
                yield pa.RecordBatch.from_arrays([part.column("at"), pa.array(sums[0]), pa.array(sums[1]), lists], ["at", "count_sum", "n_best", "rest"])

    summed = found.select("at", "pairs", "times").mapInArrow(run, "at long, count_sum long, n_best long, rest array<struct<pair: long, times: long>>")
    summed = stored(summed, "summed")
    rest = summed.select("at", F.explode("rest").alias("r")).select("at", "r.pair", "r.times").join(counts.where(F.col("n") < least), "pair")
    rest = rest.select("at", (F.col("times") * F.col("n")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"))
    sums = summed.select("at", "count_sum", "n_best").unionByName(rest).groupBy("at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.drop("pairs", "times").join(sums, "at").drop("at")
