"""Byte-level BPE: encoding by a lazily determinised finite-state transducer, streaming decoding.

Encoding. A token sequence is the BPE encoding of its bytes exactly if each two neighbours in it are
(merging the two tokens' bytes gives those two tokens back). So the merges are an automaton that
guesses tokens: a hypothesis is the last token, the bytes read since, and the tokens not yet written;
reading a byte extends the open token and, where the open bytes are a token that may follow, also
closes it. The transducer determinises this while it reads: a state is a set of hypotheses, tokens
that all of them share are written at once, and each step met is kept in a table. The open bytes are
a prefix of some token, so a token is written at most a bounded number of bytes after its end.

Decoding. An incremental UTF-8 state machine passes on whole characters as tokens arrive and holds
back the bytes of one that is not complete.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.llm.split import Pieces, splitter
from lodestar.llm.store import bounded_batches
from lodestar.llm.worker import kept

#: Transducer states (some 0.7 KB each), neighbour checks and pieces kept by a Python worker before it starts anew.
MAX_STATES, MAX_PAIRS, MAX_PIECES = 200_000, 300_000, 250_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from the content of a ``.tiktoken`` file: base64 token and rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class Transducer:
    """Bytes of one piece -> BPE token ids, by ranks in which every single byte has a token."""

    def __init__(self, ranks: dict[bytes, int], share: float = 1.0) -> None:
        self.ranks = ranks
        self.max_states, self.max_pairs = int(MAX_STATES * share), int(MAX_PAIRS * share)
        self.tokens = {rank: token for token, rank in ranks.items()}
        # trie of the tokens: child[node * 256 + byte]; a node's token (or -1) and whether a longer token goes on
        self.child: dict[int, int] = {}
        self.token_at, self.goes_on = [-1], [True]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.goes_on[node] = True
                key = node << 8 | byte
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.goes_on.append(False)
            self.token_at[node] = rank
        self.pairs: dict[tuple[int, int], bool] = {}
        self.joined: dict[int, tuple[int, int] | None] = {}
        self._clear()

    def _clear(self) -> None:
        """A hypothesis: last closed token (-1: none), trie node of the open bytes, tokens not yet written."""
        self.hypotheses: list[tuple] = []
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.ends: list[tuple[int, ...]] = []
        self.numbers: dict[tuple, int] = {}
        self._state(((-1, 0, ()),))

    def _state(self, hypotheses: tuple) -> int:
        found = self.numbers.get(hypotheses)
        if found is None:
            found = self.numbers[hypotheses] = len(self.steps)
            self.hypotheses.append(hypotheses)
            self.steps.append({})
            self.ends.append(next((todo for _, node, todo in hypotheses if not node), ()))
        return found

    def merged(self, piece: bytes, below: int | None = None) -> list[int]:
        """BPE by its definition, with ranks under ``below``: again and again merge the neighbours of lowest rank."""
        end = len(self.ranks) if below is None else below
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, end), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= end:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of this one joins; none for a single byte."""
        if token not in self.joined:
            data = self.tokens[token]
            parts = self.merged(data, token) if len(data) > 1 else []
            self.joined[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.joined[token]

    def follows(self, a: int, b: int) -> bool:
        """May token b stand after token a?

        Goes back in time through the merges that made both: while two parts met at the border, their own
        merge must not have been due before the merge that took one of them up (of equal rank, the left one
        is done first).
        """
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        x, y, ok = a, b, self.tokens[a] + self.tokens[b] not in self.ranks
        while ok:
            parts_x, parts_y = self.halves(x), self.halves(y)
            if parts_x and (not parts_y or x > y):
                due, x = x, parts_x[1]
                ok = self.ranks.get(self.tokens[x] + self.tokens[y], due) >= due
            elif parts_y:
                due, y = y, parts_y[0]
                ok = self.ranks.get(self.tokens[x] + self.tokens[y], due + 1) > due
            else:
                break
        if len(self.pairs) > self.max_pairs:
            self.pairs.clear()
        self.pairs[a, b] = ok
        return ok

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        made = []  # in order of where the open bytes begin, so equal sets are equal tuples
        child, token_at, goes_on, pairs = self.child.get, self.token_at, self.goes_on, self.pairs
        closed = None
        for last, node, todo in self.hypotheses[state]:
            to = child(node << 8 | byte)
            if to is None:
                continue
            if closed is None:  # one at most closes: the encoding of what was read so far
                token = token_at[to]
                if token >= 0:
                    ok = last < 0 or pairs.get((last, token))
                    if ok is None:
                        ok = self.follows(last, token)
                    if ok:
                        closed = (token, 0, (*todo, token))
            if goes_on[to]:
                made.append((last, to, todo))
        if closed is not None:
            made.append(closed)
        shared = made[0][2]
        if shared:
            for _, _, todo in made:
                n = 0
                for x, y in zip(shared, todo, strict=False):
                    if x != y:
                        break
                    n += 1
                shared = shared[:n]
                if not n:
                    break
            else:
                made = [(last, node, todo[len(shared) :]) for last, node, todo in made]
        step = self.steps[state][byte] = self._state(tuple(made)), shared
        return step

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.steps) > self.max_states:
            self._clear()
        steps, state, out = self.steps, 0, []
        for byte in piece:
            step = steps[state].get(byte) or self._step(state, byte)
            state = step[0]
            if step[1]:
                out += step[1]
        out += self.ends[state]
        return out


class Encoder:
    """Texts -> ids: pieces by a pattern, each through the transducer; the ids of pieces met before are kept. ``share``: of the tables' sizes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, share: float = 1.0) -> None:
        self.find = splitter(pattern)
        self.transducer = Transducer(ranks, share)
        self.pieces = Pieces(lambda piece: array("I", self.transducer.encode(piece.encode())).tobytes(), int(MAX_PIECES * share), 32)

    def stored(self, text: str | None) -> bytes:
        """The ids as unsigned 32-bit integers."""
        return self.pieces.of(self.find(text)) if text else b""

    def encode(self, text: str | None) -> list[int]:
        return array("I", self.stored(text)).tolist()


class StreamDecoder:
    """Ids -> bytes, passed on at ends of characters only; bytes that are not UTF-8 are passed on as they are.

    The state machine is the standard library's incremental decoder; stray bytes travel as lone surrogates.
    """

    def __init__(self, tokens: dict[int, bytes]) -> None:
        self.tokens = tokens
        self.machine = codecs.getincrementaldecoder("utf-8")("surrogateescape")

    def feed(self, ids: Iterable[int], last: bool = False) -> bytes:
        """Whole characters that are complete with these tokens; with ``last`` also what is left of a broken one."""
        data = b"".join(map(self.tokens.__getitem__, ids))
        return self.machine.decode(data, last).encode("utf-8", "surrogateescape")

    def finish(self) -> bytes:
        rest = self.feed((), last=True)
        self.machine.reset()
        return rest


def _encoder(data: bytes, pattern: str, share: float) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    return kept(("bpe", hashlib.sha256(data).digest(), pattern, share), lambda: Encoder(read_ranks(data), pattern, share))


def vocabulary(path: str) -> bytes:
    """The vocabulary file's content, sent to the workers as a broadcast (about 1 MB; bound 64 MB)."""
    with open(path, "rb") as f:
        data = f.read((64 << 20) + 1)
    if len(data) > 64 << 20:
        raise ValueError(f"{path}: over 64 MB, too large to broadcast")
    return data


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", digests: bool = False, with_ids: bool = True, share: float = 1.0) -> DataFrame:
    """Every input row as ``row`` (struct of its columns) with ``ids`` (array of int), unless they are not wanted.

    With ``digests`` the ids are also decoded again, by the streaming decoder, and the row has ``n_tokens``,
    ``ids_sha256`` (of the decimal ids joined by one space) and ``decoded_sha256`` (of the bytes).
    A null text is encoded as an empty one: no ids. Texts are whole whatever their length. ``share``: how large a worker's tables of
    what it has met may get, of their full size (the ids are the same); for jobs whose executors hold memory of other stages.
    """
    bounded_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern, share)
        names = {i: b"%d" % i for i in encoder.transducer.tokens}
        decoder = StreamDecoder(encoder.transducer.tokens) if digests else None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                row = part.column(0)
                ids = [encoder.stored(t.as_py()) for t in row.field(at)]
                cols = [row]
                if with_ids:
                    first = np.cumsum([0, *(len(x) // 4 for x in ids)])
                    cols.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
                if digests:
                    lists = [array("I", x).tolist() for x in ids]
                    cols += [
                        pa.array([len(x) for x in lists], pa.int64()),
                        pa.array([hashlib.sha256(b" ".join(map(names.__getitem__, x))).hexdigest() for x in lists]),
                        pa.array([_streamed(decoder, x) for x in lists]),
                    ]
                yield pa.RecordBatch.from_arrays(cols, names=made)

    more = ["ids array<int>"] * with_ids + ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"] * digests
    made = ["row", *(c.split()[0] for c in more)]
    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], *(StructType.fromDDL(", ".join(more)).fields if more else ())]))


def _streamed(decoder: StreamDecoder, ids: list[int], at_once: int = 1 << 14) -> str:
    digest = hashlib.sha256()
    for lo in range(0, len(ids), at_once):
        digest.update(decoder.feed(ids[lo : lo + at_once]))
    digest.update(decoder.finish())
    return digest.hexdigest()


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Every input row as ``row`` with ``decoded`` (binary): the bytes of its ids, null for null ids."""
    bounded_batches(encoded)
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary(path))
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = StreamDecoder({rank: token for token, rank in read_ranks(shared.value).items()})
        for batch in batches:
            row = batch.column(0)
            made = [None if x is None else decoder.feed(x) + decoder.finish() for x in row.field(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([row, pa.array(made, pa.binary())], names=["row", "decoded"])

    rows = encoded.select(F.struct("*").alias("row"))
    return rows.mapInArrow(run, StructType([rows.schema["row"], *StructType.fromDDL("decoded binary").fields]))
