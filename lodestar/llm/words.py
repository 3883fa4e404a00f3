"""Words of Arrow string batches as numpy arrays: positions, hashes of words and of word windows.

A word is a maximal run of bytes other than space, tab, newline, vertical tab, form feed and
carriage return. These are single bytes in UTF-8, so the split works on bytes. Texts are whole:
a batch is cut between rows only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE_BYTES = (9, 10, 11, 12, 13, 32)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (xor-shift and odd multiplications)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 1 << 16)
            grow = lambda b: np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(m - 1, b, np.uint64))])
            up, down = grow(self.base), grow(self.inverse)
            if m > 1 << 21:  # one very long text: not kept
                return up, down
            self.up, self.down = up, down
        return self.up, self.down


_BYTE_POWERS = {0: Powers(0x9E3779B97F4A7C15), 1: Powers(0xD6E8FEB86659FD93)}
_WORD_POWERS = {0: Powers(0xA0761D6478BD642F), 1: Powers(0xE7037ED1A0B428DB)}
_BYTE_CODES = {s: mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(s * 7919)) for s in (0, 1)}


class Words:
    """Words of the rows of one string array (null rows have none)."""

    def __init__(self, texts: pa.Array) -> None:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
        _, offsets, data = texts.buffers()
        off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        base = off[0] if len(off) else 0
        self.offsets = off - base
        n = int(self.offsets[-1]) if len(off) else 0
        self.data = np.frombuffer(data, np.uint8, count=n, offset=int(base)) if n else np.zeros(0, np.uint8)
        word = ~_IS_SPACE[self.data]
        edge = np.zeros(n + 1, bool)  # a row begins here
        edge[self.offsets] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = word[:-1]
        self.starts = np.flatnonzero(word & (~before | edge[:n]))
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = word[1:]
        self.ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        #: words of row r are first[r] .. first[r + 1]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.n_rows = len(texts)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes; seeds 0 and 1 are independent."""
        up, down = _BYTE_POWERS[seed].upto(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[seed][self.data] * up[: len(self.data)], out=total[1:])
        h = (total[self.ends] - total[self.starts]) * down[self.starts]
        return mix64(h + (self.ends - self.starts).astype(np.uint64))

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def window_hashes(word_hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``width`` words from each position on (rows are not looked at)."""
    n = len(word_hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    total, down = _prefix(word_hashes, seed)
    return mix64((total[width:] - total[:-width]) * down[: n - width + 1])


def span_hashes(word_hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the words lo .. hi of each span, by the same sums as ``window_hashes``."""
    total, down = _prefix(word_hashes, seed)
    return mix64((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def _prefix(word_hashes: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(word_hashes)
    up, down = _WORD_POWERS[seed].upto(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(word_hashes * up[:n], out=total[1:])
    return total, down


def row_of(first: np.ndarray, n_words: int) -> np.ndarray:
    """Row number of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))[:n_words]


def slices(batch: pa.RecordBatch, texts: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows with about ``max_bytes`` of text each (one row at least), so that arrays stay small."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(size)
    lo = 0
    while lo < len(texts):
        done = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, done + max_bytes, side="right")))
        yield batch.slice(lo, hi - lo), texts.slice(lo, hi - lo)
        lo = hi
