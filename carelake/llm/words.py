"""Vectorised words and word-window hashes over Arrow text, shared by the text operators.

A word is a maximal run of bytes other than space and 0x09-0x0D (ASCII white space), which in
UTF-8 equals the pattern ``[^\\x20\\x09-\\x0D]+`` on characters. Everything works on the Arrow
text buffer: no Python object is made per word.

Hashes are 64-bit: each byte is replaced by a fixed random number, a polynomial modulo 2**64
is taken over the word, and the result is mixed. Window hashes run a second polynomial over the
word hashes. Callers that need more certainty combine two seeds or compare the bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_P = 0x9E3779B97F4A7C15
_Q = _U(0xD6E8FEB86659FD93)
_SLICE = 1 << 19  # bytes hashed at a time: bounds the temporaries


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * _U(pow(base, len(out), 2**64))])
    return out[:n]


_POW = _powers(_P, _SLICE)
_INV = _powers(pow(_P, -1, 2**64), _SLICE)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser; ``seed`` picks an independent-looking variant."""
    h = h ^ _U((seed * 0xA24BAED4963EE407 + 0x9FB21C651E98DF25) % 2**64)
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; row i is bytes[offsets[i]:offsets[i + 1]], null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no rows, or too long for one 32-bit chunk
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks] or [pa.array([], pa.string())])
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(n + 1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return off - off[0], raw[off[0]:off[-1]]


def spans(offsets: np.ndarray, data: np.ndarray, between: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word of each row (n + 1 entries).
    ``between`` is True for each of the 256 bytes that separate words."""
    if len(data) == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(offsets), dtype=np.int64)
    space = between[data]
    word = ~space
    first = word.copy()
    first[1:] &= space[:-1]
    last = word.copy()
    last[:-1] &= space[1:]
    full = offsets[:-1] < offsets[1:]
    a, b = offsets[:-1][full], offsets[1:][full] - 1
    first[a] = word[a]
    last[b] = word[b]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes unchanged."""
    return _LOWER[data]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ordered, non-overlapping byte span."""
    out = np.empty(len(starts), dtype=np.uint64)
    i, n = 0, len(starts)
    while i < n:
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + _SLICE, side="right")))
        b = int(ends[j - 1])
        pows, inv = (_POW, _INV) if b - a <= _SLICE else (_powers(_P, b - a), _powers(pow(_P, -1, 2**64), b - a))
        total = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[a:b]] * pows[:b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((total[e] - total[s]) * inv[np.minimum(s, b - a - 1)] + (e - s).astype(np.uint64))
        i = j
    return out


def window_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``length`` consecutive words (len(words) - length + 1 entries, or none)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.full(n, _U((seed + 1) * 0x2545F4914F6CDD1D % 2**64))
    for k in range(length):
        h = h * _Q + words[k:k + n]
    return mix(h, seed + length)


class Words:
    """The words of an Arrow text column: spans, hashes and row bounds."""

    def __init__(self, column, fold: bool = False, between: np.ndarray = _WS):
        self.offsets, data = text_buffers(column)
        self.data = lower(data) if fold else data
        self.starts, self.ends, self.bounds = spans(self.offsets, self.data, between)
        self.counts = np.diff(self.bounds)
        self.n_rows = len(self.offsets) - 1
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hashes(self.data, self.starts, self.ends)
        return self._hashes

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), self.counts)

    def window_starts(self, length: int) -> np.ndarray:
        """True at each word at which a window of ``length`` words of one row starts."""
        left = np.repeat(self.bounds[1:], self.counts) - np.arange(len(self.starts))
        return left >= length

    def row_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def cover(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Boolean array of n words: those inside a window of ``length`` words at one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, starts, 1) if len(starts) < 64 else edge.__iadd__(np.bincount(starts, minlength=n + 1).astype(np.int32))
    ends = starts + length
    edge -= np.bincount(ends, minlength=n + 1).astype(np.int32)[:n + 1] if len(ends) else 0
    return np.cumsum(edge[:n]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[0]..starts[0]+lengths[0]-1, starts[1].., one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    skip = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.arange(total, dtype=np.int64) + np.repeat(starts - skip, lengths)
