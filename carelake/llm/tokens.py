"""Token ids of whole documents with a public tokenizer, each distinct chunk of text encoded once.

A text is cut into chunks at places where the tokenizer cuts as well, so that ids of chunks, joined, are
the ids of the text: before an ASCII white-space byte that follows an ASCII byte which is not white
space, and before one of ``.,;:!?`` that follows an ASCII letter. No pre-tokenizer pattern of the supported
files looks across such a place, and their special tokens hold none. Words follow Zipf's law, so a batch has far fewer distinct chunks than chunks, and
a bounded cache per Python worker keeps the encoded ones. New chunks that begin with white space and end with another ASCII byte
meet each other at such a place in any order, so they are encoded side by side in one text; the rest one by one.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from carelake.llm.words import _WS, ragged, span_hashes, text_buffers

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?")] = True
MAX_CACHED = 1_500_000  # chunks kept by one worker
ENCODED = 1 << 12  # chunks the tokenizer encodes at a time: its results take far more room than their ids
JOINED = 1 << 8  # chunks side by side in one text: a call of the tokenizer costs as much as a word or two


def chunk_spans(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the chunks, and the first chunk of each row (n + 1 entries)."""
    if not len(data):
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(offsets), dtype=np.int64)
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = (_WS[data[1:]] & ~_WS[data[:-1]] & (data[:-1] < 128)) | (_MARK[data[1:]] & _LETTER[data[:-1]])
    filled = offsets[:-1] < offsets[1:]
    cut[offsets[:-1][filled]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    return starts, ends, np.searchsorted(starts, offsets)


class _Cache:
    """Ids of distinct chunks by chunk hash: sorted hashes, and ragged ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.encoder = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        fast = getattr(self.encoder, "encode_batch_fast", self.encoder.encode_batch)
        flats, sizes = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        for i in range(0, len(chunks), ENCODED):
            got = [e.ids for e in fast(chunks[i:i + ENCODED], add_special_tokens=False)]
            sizes.append(np.array([len(x) for x in got], dtype=np.int64))
            flats.append(np.fromiter((i for x in got for i in x), dtype=np.uint32, count=int(sizes[-1].sum())))
        return np.concatenate(flats), np.concatenate(sizes)

    def encode_joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of chunks between which the tokenizer cuts in any order: a token belongs to the chunk it starts in."""
        flats, sizes = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        for i in range(0, len(chunks), JOINED):
            some = chunks[i:i + JOINED]
            got = self.encoder.encode("".join(some), add_special_tokens=False)
            flat = np.array(got.ids, dtype=np.uint32)
            begins = np.fromiter((a for a, _ in got.offsets), dtype=np.int64, count=len(flat))
            chunk = np.searchsorted(np.cumsum([len(x) for x in some]), begins, side="right")
            if (chunk[1:] < chunk[:-1]).any():  # offsets that do not follow the text tell nothing
                flat, size = self.encode(some)
            else:
                size = np.bincount(chunk, minlength=len(some))
            flats.append(flat)
            sizes.append(size)
        return np.concatenate(flats), np.concatenate(sizes)

    def add(self, keys, chunks, joins):
        """Keep the ids of ``chunks``; ``joins`` marks those that may stand side by side."""
        if len(self.keys) + len(keys) > MAX_CACHED:
            self.clear()
        alone, order = np.flatnonzero(~joins), np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        flat, size_joined = self.encode_joined([chunks[i] for i in order[:len(chunks) - len(alone)].tolist()])
        rest, size_alone = self.encode([chunks[i] for i in alone.tolist()])
        flat, sizes = np.concatenate([flat, rest]), np.concatenate([size_joined, size_alone])
        at, size = np.empty(len(chunks), dtype=np.int64), np.empty(len(chunks), dtype=np.int64)
        at[order], size[order] = len(self.ids) + np.cumsum(sizes) - sizes, sizes
        place = np.searchsorted(self.keys, keys)  # both are sorted
        self.keys, self.at = np.insert(self.keys, place, keys), np.insert(self.at, place, at)
        self.size, self.ids = np.insert(self.size, place, size), np.concatenate([self.ids, flat])

    def find(self, keys) -> np.ndarray:
        """Position of each key, -1 where it is missing."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[i] == keys, i, -1)


_CACHES: dict[str, _Cache] = {}


def _cache(path: str) -> _Cache:
    if path not in _CACHES:
        _CACHES.clear()
        _CACHES[path] = _Cache(path)
    return _CACHES[path]


def encode_rows(column: pa.Array | pa.ChunkedArray, path: str, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds): the ids of every row one after another, row i at ids[bounds[i]:bounds[i + 1]], each
    row followed by ``end_id`` if given. Null text is empty."""
    offsets, data = text_buffers(column)
    starts, ends, bounds = chunk_spans(offsets, data)
    cache = _cache(path)
    keys, first, index = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    found = cache.find(keys)
    for _ in range(2):  # a second time if the cache was emptied on the way
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            break
        a, z = starts[first[missing]], ends[first[missing]]
        raw = memoryview(data)
        cache.add(keys[missing], [str(raw[i:j], "utf-8", "replace") for i, j in zip(a.tolist(), z.tolist())],
                  _WS[data[a]] & ~_WS[data[z - 1]] & (data[z - 1] < 128))
        found = cache.find(keys)
    where = found[index] if len(index) else np.zeros(0, dtype=np.int64)
    size = cache.size[where]
    ids = cache.ids[ragged(cache.at[where], size)]
    at = np.concatenate([[0], np.cumsum(size)])[bounds]
    if end_id is None:
        return ids, at
    out = np.empty(len(ids) + len(offsets) - 1, dtype=np.uint32)
    ends_at = at[1:] + np.arange(len(offsets) - 1)
    body = np.ones(len(out), dtype=bool)
    body[ends_at] = False
    out[body], out[ends_at] = ids, end_id
    return out, at + np.arange(len(offsets))
