"""Sampled subword segmentation over the piece lattice, and its lossless inverse (operator 2).

The text's pieces form a lattice: an edge from character i to j for every piece of the vocabulary that spells the
characters between. A segmentation is drawn with probability proportional to the product of its pieces' weights by
forward filtering (sum the weights of all paths to every character) and backward sampling (from the end, draw the
last piece given where it ends, and go on where it begins).

No piece holds a space inside, so the lattice falls apart at spaces into chunks (the spaces before a word, and the word).
Chunks follow Zipf's law: each distinct chunk is filtered once, and kept by the worker; sampling
then walks all chunks of a batch together, one piece at a step.

A chunk of more than ``LONG`` characters (a text without spaces) is filtered and drawn alone, in windows, by a walk over its
edges: time and temporaries stay in proportion to its length.

Draws come from a counter: a mix of the row key, a seed and the place in the text. The result of a row
depends on nothing else, whatever batch, task or attempt it is in.

Weights: a unigram model's scores are log probabilities. A BPE model has merge ranks instead; its piece of rank r gets the
weight of Zipf's law, 1 / (r + 10). ``alpha`` raises weights to a power: large values give the best path.

Lossless: a character without a piece, and a literal U+2581 (the pieces' sign for a space), become byte pieces, so decoding
gives back every byte. Defined cases: null text encodes like an empty one, to no pieces; a null key is a key of its own; equal keys
and texts give equal results.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.blocks import in_slices
from carelake.llm.words import _powers, mix, ragged, text_buffers

SPACE = 0x2581
_LITERAL = 0x110000  # stands for a U+2581 of the text itself: beyond Unicode, so no piece holds it
_BASE = 0xA0761D6478BD642F
MAX_NODES = 4_000_000  # lattice characters one worker keeps
LONG = 512             # characters of a chunk that is walked alone, window by window


class Vocabulary:
    """A SentencePiece model's pieces, hashed by length, with lattice weights."""

    def __init__(self, path: str, alpha: float = 1.0):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        unigram = model.trainer_spec.model_type == 1
        names, ids, scores, self.byte_id = [], [], [], np.zeros(256, dtype=np.int32)
        raw = []
        for i, p in enumerate(model.pieces):
            if p.type == 6:  # a byte
                b = int(p.piece[3:5], 16)
                self.byte_id[b] = i
                raw.append(bytes([b]))
                continue
            raw.append(p.piece.replace("▁", " ").encode() if p.type in (1, 4) else b"")
            if p.type in (1, 4) and p.piece:
                names.append(p.piece)
                ids.append(i)
                scores.append(p.score)
        if not self.byte_id.any():
            raise ValueError("a model with byte pieces is required")
        rank = np.arange(len(names), dtype=np.float64)
        score = np.array(scores) if unigram else -np.log(rank + 10)
        score -= np.log(np.exp(score - score.max()).sum()) + score.max()
        self.longest = max(len(x) for x in names)
        keys = _keys(names)
        order = np.argsort(keys)
        self.keys, self.ids, self.weights = keys[order], np.array(ids, np.int32)[order], alpha * score[order]
        self.unknown = alpha * (score.min() - 10)
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[self.keys >> np.uint64(44)] = True
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.raw_size = np.array([len(x) for x in raw], dtype=np.int64)
        self.raw_at = np.concatenate([[0], np.cumsum(self.raw_size)[:-1]])


def _code(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64), seed=51) | np.uint64(1)


def _keys(names: list[str]) -> np.ndarray:
    """The hash of every piece, as spans of a longer text are hashed."""
    size = np.array([len(x) for x in names], dtype=np.int64)
    points = np.frombuffer("".join(names).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(len(points)) - np.repeat(at, size)
    total = np.add.reduceat(_code(points) * _powers(_BASE, int(size.max()))[place], at)
    return mix(total + size.astype(np.uint64), seed=52)


class _Points:
    """Code points with prefix sums, to hash any span of at most the longest piece."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_code(points) * _powers(_BASE, n), out=self.total[1:])
        self.inverse = _powers(pow(_BASE, -1, 2**64), n)

    def spans(self, starts, length) -> np.ndarray:
        """Hashes of the spans of given length(s) at starts."""
        return mix((self.total[starts + length] - self.total[starts]) * self.inverse[starts] + np.uint64(0) + np.asarray(length, dtype=np.uint64), seed=52)


class _Rows:
    """An array that grows at its end."""

    def __init__(self, dtype, first=()):
        self.all, self.n = np.zeros(1024, dtype=dtype), 0
        self.append(np.array(first, dtype=dtype))

    def append(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.all):
            grown = np.empty(max(int(1.5 * len(self.all)), self.n + len(rows)), dtype=self.all.dtype)
            grown[:self.n] = self.all[:self.n]
            self.all = grown
        self.all[self.n:self.n + len(rows)] = rows
        self.n += len(rows)


class Lattices:
    """Filtered lattices of distinct chunks. Node = place after a character; its edges are the pieces that end there, with
    the probability, cumulated, that backward sampling takes each (likelier pieces first)."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self):
        self.keys, self.node = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._first = _Rows(np.int64, [0])  # edges of node i: first[i]:first[i + 1]
        self._cum, self._length, self._id = _Rows(np.float32), _Rows(np.int16), _Rows(np.int32)

    first, cum, length, id = (property(lambda self, c=c: getattr(self, c).all) for c in ("_first", "_cum", "_length", "_id"))

    def find(self, keys) -> np.ndarray:
        """The node of each chunk's first character, -1 if it is not here."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[i] == keys, self.node[i], -1)

    def add(self, keys, points: np.ndarray, sizes: np.ndarray) -> None:
        """Filter the chunks (all their code points, one after another)."""
        if self._first.n + len(points) > MAX_NODES:
            self.clear()
        base = self._first.n - 1
        at = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        lo = 0
        while lo < len(sizes):  # a bounded piece at a time; a long chunk is a piece of its own
            if sizes[lo] > LONG:
                self._filter_long(points[at[lo]:at[lo] + sizes[lo]])
                lo += 1
                continue
            long = lo + np.flatnonzero(sizes[lo:lo + 100_000] > LONG)[:1]
            hi = max(lo + 1, min(int(np.searchsorted(at, at[lo] + 100_000)), int(long[0]) if len(long) else len(sizes)))
            self._filter(points[at[lo]:at[hi - 1] + sizes[hi - 1]], sizes[lo:hi])
            lo = hi
        place = np.searchsorted(self.keys, keys)  # both are sorted
        self.keys, self.node = np.insert(self.keys, place, keys), np.insert(self.node, place, base + at)

    def _edges(self, points, place, first: int = 0):
        """(end, length, weight, id) of all edges that end at the characters from ``first`` on, by end and length. ``place``: of
        each character in its chunk."""
        v, spans = self.v, _Points(points)
        ends, lengths, weights, ids = [], [], [], []
        nodes = np.arange(first, len(points))
        for length in range(1, v.longest + 1):
            nodes = nodes[place[nodes] >= length - 1]
            if not len(nodes):
                break
            h = spans.spans(nodes - length + 1, length)
            hit = np.flatnonzero(v.filter[h >> np.uint64(44)])
            h = h[hit]
            i = np.minimum(np.searchsorted(v.keys, h), len(v.keys) - 1)
            same = v.keys[i] == h
            end, i = nodes[hit[same]], i[same]
            w, piece = v.weights[i], v.ids[i]
            if length == 1:  # a character without a piece gets a byte fallback, told by its character
                bare = np.ones(len(points), dtype=bool)
                bare[end] = False
                bare = nodes[bare[nodes]]
                end = np.concatenate([end, bare])
                w = np.concatenate([w, np.full(len(bare), v.unknown)])
                piece = np.concatenate([piece, -1 - points[bare].astype(np.int32)])
            ends.append(end)
            lengths.append(np.full(len(end), length, dtype=np.int64))
            weights.append(w)
            ids.append(piece)
        end = np.concatenate(ends)
        order = np.argsort(end, kind="stable")
        return end[order], np.concatenate(lengths)[order], np.concatenate(weights)[order], np.concatenate(ids)[order]

    def _store(self, end, length, log_p, ids) -> None:
        """Keep the edges of consecutive characters, which are ordered by end; every character has one."""
        cut = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1], [True]]))
        p = np.exp(log_p)
        order = np.argsort(end + 0.5 * (1 - np.minimum(p, 1.0)), kind="stable")  # likelier edges of a character first
        p = p[order]
        cum = np.cumsum(p)
        before = np.concatenate([[0.0], cum])[cut]
        size = np.diff(cut)
        cum = (cum - np.repeat(before[:-1], size)) / np.repeat(np.diff(before), size)
        cum[cut[1:] - 1] = 1.0
        self._cum.append(cum)
        self._length.append(length[order])
        self._id.append(ids[order])
        self._first.append(self._first.all[self._first.n - 1] + cut[1:])

    def _filter(self, points, sizes) -> None:
        n = len(points)
        begin = np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64), sizes)
        place = np.arange(n) - begin
        end, length, weight, ids = self._edges(points, place)
        # forward: the log sum over all paths to each character, all chunks in step: edges by the place where they end
        by = np.argsort(place[end].astype(np.uint16), kind="stable")
        e, back, w = end[by], end[by] - length[by], weight[by]
        back = np.where(length[by] > place[e], n, back)  # paths to a chunk's beginning have weight 0
        cut = np.searchsorted(place[e], np.arange(int(sizes.max(initial=0)) + 1))
        forward = np.zeros(n + 1)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            node, paths = e[a:b], w[a:b] + forward[back[a:b]]
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            top = np.maximum.reduceat(paths, first)
            sums = np.add.reduceat(np.exp(paths - np.repeat(top, np.diff(np.append(first, b - a)))), first)
            forward[node[first]] = top + np.log(sums)
        source = np.where(length > place[end], n, end - length)
        self._store(end, length, weight + forward[source] - forward[end], ids)

    def _filter_long(self, points, window: int = 50_000) -> None:
        """One long chunk, window by window: the same sums, one character after another."""
        longest = self.v.longest
        tail = [0.0]  # the sums at the last characters before the window, and 0 at the chunk's beginning
        for a in range(0, len(points), window):
            b = min(len(points), a + window)
            lo = max(0, a - longest)
            end, length, weight, ids = self._edges(points[lo:b], np.arange(lo, b), a - lo)
            end -= a - lo
            forward, at = tail, len(tail) - 1  # forward[at + 1 + i] is the sum at the window's character i
            sizes, lengths, weights, i = np.bincount(end, minlength=b - a).tolist(), length.tolist(), weight.tolist(), 0
            for k, m in enumerate(sizes):
                paths = [weights[j] + forward[at + 1 + k - lengths[j]] for j in range(i, i + m)]
                top = max(paths)
                forward.append(top + math.log(sum([math.exp(x - top) for x in paths])))
                i += m
            f = np.array(forward)
            self._store(end, length, weight + f[at + 1 + end - length] - f[at + 1 + end], ids)
            tail = forward[-longest - 1:]


_WORKER: dict[tuple, Lattices] = {}


def _lattices(path: str, alpha: float) -> Lattices:
    if (path, alpha) not in _WORKER:
        _WORKER.clear()
        _WORKER[path, alpha] = Lattices(Vocabulary(path, alpha))
    return _WORKER[path, alpha]


def _points_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row bounds) with a space sign before each non-empty row and in place of each space."""
    text = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    is_lead = (data & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(is_lead)])[offsets]
    size = np.diff(before)
    filled = size > 0
    bounds = np.concatenate([[0], np.cumsum(size + filled)])
    out = np.full(int(bounds[-1]), SPACE, dtype=np.int64)
    body = np.ones(len(out), dtype=bool)
    body[bounds[:-1][filled]] = False
    text[text == SPACE] = _LITERAL
    text[text == 0x20] = SPACE
    out[body] = text
    return out, bounds


def _uniform(draw, place) -> np.ndarray:
    """Numbers in [0, 1) fixed by a row's draw key and a place in its text."""
    return (mix(draw + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), seed=63) >> np.uint64(11)) * 2.0**-53


def _draw_long(lattices: Lattices, node: int, size: int, draw, origin: int, window: int = 1 << 16) -> np.ndarray:
    """The pieces of one long chunk, drawn from the last to the first."""
    first, cum, length, ids = lattices.first, lattices.cum, lattices.length, lattices.id
    out, left = [], size
    while left > 0:
        low = max(0, left - window)  # the places (low, left] of this window
        u = _uniform(np.full(left - low, draw), origin + np.arange(low + 1, left + 1)).tolist()
        a, z = int(first[node + low]), int(first[node + left])
        at, c, n = (first[node + low:node + left] - a).tolist(), cum[a:z].tolist(), length[a:z].tolist()
        stop = low
        while left > stop:
            e, x = at[left - 1 - low], u[left - 1 - low]
            while x >= c[e]:
                e += 1
            out.append(a + e)
            left -= n[e]
    return ids[np.array(out, dtype=np.int64)]


def encode(column, keys: np.ndarray, path: str, alpha: float = 1.0, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds): one sampled segmentation of every row, row i at ids[bounds[i]:bounds[i + 1]].
    ``keys``: a 64-bit key of each row, which with ``seed`` fixes its draws."""
    offsets, data = text_buffers(column)
    lattices = _lattices(path, alpha)
    points, bounds = _points_of(offsets, data)
    n = len(points)
    rows = len(offsets) - 1
    if not n:
        return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
    head = points == SPACE
    head[1:] &= points[:-1] != SPACE
    head[bounds[:-1][np.diff(bounds) > 0]] = True
    start = np.flatnonzero(head)
    size = np.diff(np.append(start, n))
    spans = _Points(points)
    name = spans.spans(start, size)
    distinct, first, index = np.unique(name, return_index=True, return_inverse=True)
    node = lattices.find(distinct)
    for _ in range(2):  # the second time only if the kept lattices were dropped on the way
        lost = np.flatnonzero(node < 0)
        if len(lost):
            lattices.add(distinct[lost], points[ragged(start[first[lost]], size[first[lost]])], size[first[lost]])
            node = lattices.find(distinct)
    node = node[index]
    row = np.searchsorted(bounds, start, side="right") - 1
    draw = mix(keys.astype(np.uint64) ^ mix(np.array([seed], np.uint64), seed=61), seed=62)[row]
    # backward: every chunk draws its last piece, then the one before it, until all are at their beginnings
    ids_at, ids_of, step = [], [], []
    taken = np.zeros(len(start), dtype=np.int64)
    origin = start - bounds[row]
    short = size <= LONG
    for chunk in np.flatnonzero(~short).tolist():
        drawn = _draw_long(lattices, int(node[chunk]), int(size[chunk]), draw[chunk], int(origin[chunk]))
        taken[chunk] = len(drawn)
        ids_at.append(np.full(len(drawn), chunk))
        ids_of.append(drawn)
        step.append(np.arange(len(drawn)))
    alive = np.flatnonzero(short)
    left, last, place, key = size[alive], (node + size - 1)[alive], (origin + size)[alive], draw[alive]
    first, cum, lengths, pieces = lattices.first, lattices.cum, lattices.length, lattices.id
    drawn = 0
    while len(alive):
        u = _uniform(key, place)
        edge = first[last]
        behind = np.flatnonzero(u >= cum[edge])
        while len(behind):
            edge[behind] += 1
            behind = behind[u[behind] >= cum[edge[behind]]]
        ids_at.append(alive)
        ids_of.append(pieces[edge])
        step.append(np.full(len(alive), drawn))
        drawn += 1
        jump = lengths[edge].astype(np.int64)
        on = np.flatnonzero(left > jump)
        taken[alive] = drawn
        jump = jump[on]
        alive, left, last, place, key = alive[on], left[on] - jump, last[on] - jump, place[on] - jump, key[on]
    # put the pieces, drawn from the last to the first, in order
    total = np.concatenate([[0], np.cumsum(taken)])
    ids = np.empty(int(total[-1]), dtype=np.int64)
    who, back = np.concatenate(ids_at), np.concatenate(step)
    ids[total[who + 1] - 1 - back] = np.concatenate(ids_of)
    per_row = total[np.searchsorted(start, bounds)]
    return _spell_unknown(ids, per_row, lattices.v)


def _spell_unknown(ids: np.ndarray, bounds: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters without a piece by their bytes' pieces."""
    bare = np.flatnonzero(ids < 0)
    if not len(bare):
        return ids.astype(np.int32), bounds
    point = -1 - ids[bare]
    point = np.where(point == _LITERAL, SPACE, point)
    distinct, index = np.unique(point, return_inverse=True)
    spelled = [v.byte_id[np.frombuffer(chr(c).encode(), dtype=np.uint8)] for c in distinct.tolist()]
    width = np.array([len(s) for s in spelled])[index]
    size = np.ones(len(ids), dtype=np.int64)
    size[bare] = width
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(int(at[-1]), dtype=np.int32)
    whole = ids >= 0
    out[at[:-1][whole]] = ids[whole]
    flat, flat_at = np.concatenate(spelled), np.concatenate([[0], np.cumsum([len(s) for s in spelled])[:-1]])
    out[ragged(at[:-1][bare], width)] = flat[ragged(flat_at[index], width)]
    return out, at[bounds]


def decode(ids: np.ndarray, bounds: np.ndarray, path: str, alpha: float = 1.0) -> list[bytes]:
    """The bytes of every row's text."""
    v = _lattices(path, alpha).v
    size = v.raw_size[ids]
    data = v.raw[ragged(v.raw_at[ids], size)].tobytes()
    at = np.concatenate([[0], np.cumsum(size)])[bounds]
    return [data[a + 1:b] if b > a else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist())]  # without the first sign


def row_keys(column) -> np.ndarray:
    """64-bit keys of an id column (integers or text); null is a key of its own."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_integer(column.type):
        key = mix(np.asarray(column.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64).view(np.uint64), seed=71)
    else:
        key = np.array([zlib.crc32((x or "").encode()) | len(x or "") << 32 for x in column.cast(pa.string()).to_pylist()], dtype=np.uint64)
        key = mix(key, seed=72)
    return np.where(np.asarray(column.is_null().to_numpy(zero_copy_only=False)), np.uint64(0x5851F42D4C957F2D), key)


def _encoder(path, alpha, seed):
    def run(batches):
        for batch in batches:
            for _, part in in_slices(pa.Table.from_batches([batch]), size=2 << 20):
                ids, bounds = encode(part.column("text"), row_keys(part.column("key")), path, alpha, seed)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_pydict({"key": part.column("key").combine_chunks(), "ids": lists})
    return run


def _decoder(path):
    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            flat = np.asarray(ids.flatten(), dtype=np.int32)
            size = np.asarray(pc.list_value_length(ids).fill_null(0), dtype=np.int64)
            texts = decode(flat, np.concatenate([[0], np.cumsum(size)]), path)
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "text": pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())})
    return run


def sample_pieces(docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): a sampled segmentation of every row's text, fixed by the row's id and the seed."""
    dealt = docs.select(F.col(f"`{id_col}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return dealt.mapInArrow(_encoder(model, alpha, seed), f"key {dealt.schema['key'].dataType.simpleString()}, ids array<int>")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """(key, text): the texts of (key, ids)."""
    return encoded.mapInArrow(_decoder(model), f"key {encoded.schema['key'].dataType.simpleString()}, text string")


def _digester(path, alpha, seed):
    def run(batches):
        for batch in batches:
            for _, part in in_slices(pa.Table.from_batches([batch]), size=2 << 20):
                ids, bounds = encode(part.column("text"), row_keys(part.column("key")), path, alpha, seed)
                back = decode(ids, bounds, path, alpha)
                offsets, data = text_buffers(part.column("text"))
                raw = data.tobytes()
                ends = bounds.tolist()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("key").combine_chunks(), "n_pieces": pa.array(np.diff(bounds), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1], ends[1:])], pa.int64()),
                    "lossless": pa.array([t == raw[a:b] for t, a, b in zip(back, offsets[:-1].tolist(), offsets[1:].tolist())], pa.bool_())})
    return run


def round_trip(docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, lossless): each document is segmented and decoded, and the bytes are compared."""
    dealt = docs.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return dealt.mapInArrow(_digester(model, alpha, seed), "doc_id long, n_pieces long, ids_crc32 long, lossless boolean")
