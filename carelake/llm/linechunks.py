"""Line deduplication by content-defined chunks of lines (operator 6).

The lines of a document are cut into chunks at rolling hashes over the hashes of the last ``window`` lines: a
line whose rolling hash is 0 modulo ``mean`` ends a chunk, unless the line before it had such a hash too, so
chunks have two lines or more (a one-line document, and what ``longest`` cuts off, aside); a chunk also ends at
``longest`` lines from its own start. The cut depends on nearby content only, so a passage that is shifted by
inserted lines falls into the same chunks again. ``families`` independent cuts of the same lines find short
passages that one cut has no whole chunk in. A chunk of two or more lines that holds a word and whose bytes occur
earlier (smaller document id, then smaller line) is removed. From a removed chunk the removal goes on line by
line to both sides, up to ``reach`` lines each way, as long as the lines equal those around the earliest place.

Two exchanges of the block-bucket kind (``blocks.py``): the first finds chunk hashes that more than
one place holds; in the second only those chunks travel with their bytes, once per block, and the
bucket compares the bytes themselves: a chunk goes only if an equal one stands earlier. Chunks that
merely share a hash are kept. The lines around the earliest place are told by their 64-bit hashes. Every
removed line equals a line at an earlier place, so one copy of each stays.

Defined cases: a null text stays null and an empty one empty; a null id sorts last; rows with the same id are
compared in no particular order of their own but equal rows give equal results up to that order
(the first in (id, text) order keeps its chunks); a document whose chunks all go keeps its row with
an empty text; one line alone is never a chunk. Lines are split at ``\\n`` only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.blocks import (as_nullable, bucket_cuts, ids_of, join_replies, pack_flags, plan_blocks, rest_type,
                                 text_blocks, unpack_flags)
from carelake.llm.words import mix, runs, span_hashes, spans, text_buffers

_UP = "bucket int, block int, level int, keys binary, first binary, around binary, sizes binary, bytes binary"
_DOWN = "bucket int, block int, level int, payload binary"


Shape = tuple[int, int, int, int, int]  # window, mean, longest, families, reach


def cut_lines(hashes: np.ndarray, first: np.ndarray, window: int, mean: int, longest: int, family: int = 0) -> np.ndarray:
    """Ends (exclusive) of the chunks of the lines of many documents; ``first`` marks each document's first line."""
    n = len(hashes)
    if not n:
        return np.zeros(0, dtype=np.int64)
    line = np.arange(n)
    within = line - np.maximum.accumulate(np.where(first, line, 0))
    rolling = np.zeros(n, dtype=np.uint64)
    for k in range(window):  # the hash of the last lines, fewer at a document's start
        rolling[k:] += np.where(within[k:] >= k, mix(hashes[:n - k], seed=k + 1), np.uint64(0))
    hit = mix(rolling, seed=family) % np.uint64(mean) == 0
    end = hit & ~_shifted(hit) & ~first
    begin = np.maximum.accumulate(np.where(first | _shifted(end), line, 0))
    end |= (line - begin + 1) % longest == 0
    last = np.append(first[1:], True)
    lone = np.flatnonzero(last & ~first & _shifted(end))  # a last line alone joins the chunk before it
    end[lone - 1] = False
    return np.flatnonzero(end | last) + 1


def _shifted(flags: np.ndarray) -> np.ndarray:
    """The flag of the line before."""
    return np.concatenate([[False], flags[:-1]])


def _sequence_hashes(lines: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the line hashes a..b-1 of each chunk."""
    size = b - a
    out = size.astype(np.uint64)
    live = np.arange(len(a))
    for k in range(int(size.max(initial=0))):
        live = live[size[live] > k]
        out[live] = mix(out[live] + lines[a[live] + k], seed=3)
    return out


class _Block:
    """The chunks of one block's documents, and which of them an earlier place holds."""

    def __init__(self, table: pa.Table, shape: Shape):
        window, mean, longest, families, self.reach = shape
        order = np.lexsort((_text_rank(table), ids_of(table.column("doc_id"))))
        self.table = table.take(order)
        self.ids = ids_of(self.table.column("doc_id"))
        self.offsets, self.data = text_buffers(self.table.column("text"))
        # lines, as byte spans without the line end
        breaks = np.flatnonzero(self.data == 10)
        row = np.searchsorted(self.offsets, breaks, side="right") - 1
        n_rows = len(self.offsets) - 1
        starts = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]))
        self.line_row = np.sort(np.concatenate([np.arange(n_rows), row]))
        ends = np.sort(np.concatenate([self.offsets[1:], breaks]))
        self.line_start, self.line_end = starts, ends
        words, _, _ = spans(self.offsets, self.data)
        worded = np.concatenate([[0], np.cumsum(np.searchsorted(words, ends) > np.searchsorted(words, starts))])
        self.line_hash = span_hashes(self.data, starts, ends)
        self.bounds = np.searchsorted(self.line_row, np.arange(n_rows + 1))
        # the chunks of all cuts, each once, by place
        n = len(self.line_row)
        first = np.diff(self.line_row, prepend=-1) != 0
        cuts = [cut_lines(self.line_hash, first, window, mean, longest, f) for f in range(families)]
        every = [np.concatenate([[0], e[:-1]]) * (n + 1) + e for e in cuts if len(e)]
        chunk = np.unique(np.concatenate(every)) if every else np.zeros(0, dtype=np.int64)
        a, b = chunk // (n + 1), chunk % (n + 1)
        wanted = (b - a >= 2) & (worded[b] > worded[a])
        self.a, self.b = a[wanted], b[wanted]
        self.row = self.line_row[self.a]
        self.keys, self.index = np.unique(_sequence_hashes(self.line_hash, self.a, self.b), return_inverse=True)
        self.shared = np.bincount(self.index, minlength=len(self.keys)) > 1
        self.gone = np.zeros(len(self.a), dtype=bool)
        self.left = np.zeros(len(self.a), dtype=np.int64)  # lines that go before and after a chunk that goes
        self.right = np.zeros(len(self.a), dtype=np.int64)

    def parts(self, bits: int) -> list[tuple[int, int, int]]:
        """(bucket, first key, end) of the buckets that hold keys of this block."""
        present, cuts = bucket_cuts(self.keys, 64 - bits)
        return list(zip(present.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()))

    def mark_shared(self, replies: list[bytes], bits: int) -> None:
        for (_, a, e), r in zip(self.parts(bits), replies, strict=True):
            self.shared[a:e] |= unpack_flags(r, e - a)
        # the distinct byte strings of shared keys (items, in key order), the first chunk of each, and each chunk's item
        chunks = np.flatnonzero(self.shared[self.index])
        self.chunks = chunks[np.argsort(self.index[chunks], kind="stable")]
        known: dict[tuple[int, bytes], int] = {}
        first, self.texts, item = [], [], []
        begin, end = self.line_start[self.a], self.line_end[self.b - 1]
        for c, k in zip(self.chunks.tolist(), self.index[self.chunks].tolist()):
            text = self.data[begin[c]:end[c]].tobytes()
            i = known.setdefault((k, text), len(known))
            if i == len(first):
                first.append(c)
                self.texts.append(text)
            item.append(i)
        self.first, self.item = np.array(first, dtype=np.int64), np.array(item, dtype=np.int64)
        self.item_keys = self.keys[self.index[self.first]]

    def around(self, chunks: np.ndarray) -> np.ndarray:
        """The hashes of the ``reach`` lines before each chunk, nearest first, and of those after it; 0 outside the document."""
        k = np.arange(self.reach)
        at = np.concatenate([self.a[chunks, None] - 1 - k, self.b[chunks, None] + k], axis=1)
        row = self.row[chunks]
        inside = (at >= self.bounds[row, None]) & (at < self.bounds[row + 1, None])
        return np.where(inside, self.line_hash[np.where(inside, at, 0)], np.uint64(0))

    def remove(self, replies: list[bytes], bits: int) -> None:
        _, cuts = bucket_cuts(self.item_keys, 64 - bits)
        earlier = np.zeros(len(self.first), dtype=bool)
        source = self.around(self.first)  # the lines around each item's earliest place
        for a, e, r in zip(cuts[:-1].tolist(), cuts[1:].tolist(), replies, strict=True):
            flags = (e - a + 7) // 8
            earlier[a:e] = unpack_flags(r[:flags], e - a)
            source[a:e][earlier[a:e]] = np.frombuffer(r[flags:], dtype=np.uint64).reshape(-1, 2 * self.reach)
        goes = earlier[self.item] | (self.first[self.item] != self.chunks)
        gone, item = self.chunks[goes], self.item[goes]
        self.gone[gone] = True
        own = self.around(gone)
        same = (own == source[item]) & (own != 0)
        self.left[gone] = np.cumprod(same[:, :self.reach], axis=1).sum(axis=1)
        self.right[gone] = np.cumprod(same[:, self.reach:], axis=1).sum(axis=1)


def _text_rank(table: pa.Table) -> np.ndarray:
    """A rank that orders rows with the same id by their text (only computed where ids repeat)."""
    ids = ids_of(table.column("doc_id"))
    if len(np.unique(ids)) == len(ids):
        return np.zeros(len(ids), dtype=np.int64)
    return np.asarray(pc.rank(table.column("text").combine_chunks(), tiebreaker="dense"), dtype=np.int64)


def _rows(key, level: int, buckets: list[int], keys, first=None, around=None, sizes=None, data=None) -> pa.Table:
    n = len(buckets)
    none = [b""] * n
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "block": pa.array([key[0].as_py()] * n, pa.int32()),
                     "level": pa.array([level] * n, pa.int32()), "keys": pa.array(keys, pa.binary()),
                     "first": pa.array(first or none, pa.binary()),
                     "around": pa.array(around or none, pa.binary()), "sizes": pa.array(sizes or none, pa.binary()),
                     "bytes": pa.array(data or none, pa.binary())})


def _replies(replies: pa.Table, level: int) -> list[bytes]:
    return join_replies(replies.filter(pc.equal(replies.column("level"), level)))


def _ask_hashes(bits, shape):
    def ask(key, table):
        block = _Block(table, shape)
        parts = block.parts(bits)
        return _rows(key, 0, [b for b, _, _ in parts], [block.keys[a:e].tobytes() for _, a, e in parts])
    return ask


def _ask_bytes(bits, shape):
    def ask(key, table, replies):
        block = _Block(table, shape)
        block.mark_shared(_replies(replies, 0), bits)
        present, cuts = bucket_cuts(block.item_keys, 64 - bits)
        # a place in the corpus: document id, then the line in the document
        place = np.stack([block.ids[block.row[block.first]], block.a[block.first] - block.bounds[block.row[block.first]]], axis=1)
        around, sizes = block.around(block.first), np.array([len(t) for t in block.texts], dtype=np.int64)
        cut = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        packed = [[x[a:e].tobytes() for a, e in cut] for x in (block.item_keys, place, around, sizes)]
        return _rows(key, 1, present.tolist(), *packed, [b"".join(block.texts[a:e]) for a, e in cut])
    return ask


def _answer(table, flags: list[bytes]) -> pa.Table:
    return pa.table({c: table.column(c).cast(pa.int32()) for c in ("bucket", "block", "level")}
                    | {"payload": pa.array(flags, pa.binary())})


def _which_shared(table: pa.Table) -> pa.Table:
    """The keys of each row that another block holds too."""
    rows = [np.frombuffer(x, dtype=np.uint64) for x in table.column("keys").to_pylist()]
    every = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    _, index, count = np.unique(every, return_inverse=True, return_counts=True)
    flags, at = count[index] > 1, np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    return _answer(table, [pack_flags(flags[at[i]:at[i + 1]]) for i in range(len(rows))])


def _which_later(table: pa.Table) -> pa.Table:
    """The chunks of each row whose equal bytes stand at a smaller place in another block, and the lines around
    that place. Bytes are met one row (block) at a time; of each distinct byte string one copy is kept."""
    block = np.asarray(table.column("block"), dtype=np.int64).tolist()
    smallest: dict[tuple[int, bytes], tuple[tuple[int, int, int], bytes]] = {}
    rows = []
    for i in range(table.num_rows):
        keys = np.frombuffer(table.column("keys")[i].as_py(), dtype=np.uint64).tolist()
        place = np.frombuffer(table.column("first")[i].as_py(), dtype=np.int64).reshape(-1, 2).tolist()
        sizes = np.frombuffer(table.column("sizes")[i].as_py(), dtype=np.int64)
        around, data, ends = table.column("around")[i].as_py(), table.column("bytes")[i].as_py(), np.cumsum(sizes).tolist()
        wide = len(around) // max(1, len(keys))
        items = []
        for j, (k, (doc, line), e, n) in enumerate(zip(keys, place, ends, sizes.tolist())):
            name, at = (k, data[e - n:e]), (doc, line, block[i])
            known = smallest.get(name)
            if known is None or at < known[0]:
                smallest[name] = at, around[j * wide:(j + 1) * wide]
            items.append((name, at))
        rows.append(items)
    answers = []
    for items in rows:
        later = [smallest[name][0] < at for name, at in items]
        answers.append(pack_flags(np.array(later, dtype=bool))
                       + b"".join(smallest[name][1] for (name, _), x in zip(items, later) if x))
    return _answer(table, answers)


def _resolve(bits, shape, finish):
    def resolve(key, table, replies):
        block = _Block(table, shape)
        block.mark_shared(_replies(replies, 0), bits)
        block.remove(_replies(replies, 1), bits)
        return finish(block)
    return resolve


def _left(block: _Block) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Per row: the bytes left, the number of lines removed, and the number of chunks removed."""
    depth = np.zeros(len(block.line_row) + 1, dtype=np.int64)  # chunks overlap: count the removals over each line
    np.add.at(depth, (block.a - block.left)[block.gone], 1)
    np.add.at(depth, (block.b + block.right)[block.gone], -1)
    keep = np.cumsum(depth)[:-1] == 0
    texts = []
    for i in range(len(block.ids)):
        a, b = int(block.bounds[i]), int(block.bounds[i + 1])
        if keep[a:b].all():
            texts.append(block.data[block.offsets[i]:block.offsets[i + 1]].tobytes())
        else:
            s, e = runs(keep[a:b])
            texts.append(b"\n".join(block.data[block.line_start[a + x]:block.line_end[a + y - 1]].tobytes()
                                    for x, y in zip(s.tolist(), e.tolist())))
    lines = np.bincount(block.line_row[~keep], minlength=len(block.ids))
    chunks = np.bincount(block.row[block.gone], minlength=len(block.ids))
    return texts, lines, chunks


def _digest(block: _Block) -> pa.Table:
    texts, lines, chunks = _left(block)
    return pa.table({"doc_id": block.table.column("doc_id"),
                     "n_lines": pa.array(np.diff(block.bounds), pa.int64()), "n_removed": pa.array(lines, pa.int64()),
                     "n_chunks_removed": pa.array(chunks, pa.int64()),
                     "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())})


def _texts(block: _Block) -> pa.Table:
    texts, lines, _ = _left(block)
    return pa.table({"text": pa.array([t.decode("utf-8", "replace") for t in texts], pa.string()),
                     "n_removed": pa.array(lines, pa.int64()), "rest": as_nullable(block.table.column("rest"))})


def _find(docs, id_col, text, shape: Shape, finish, schema, rest):
    window, mean, longest, families, reach = shape
    if min(window, families, reach) < 1 or min(mean, longest) < 2:
        raise ValueError("window, families and reach of 1 or more, mean and longest of 2 or more are required")
    blocks, bits = plan_blocks(docs, text)
    bits = max(1, bits - 3)  # chunks are far fewer than words
    grouped = text_blocks(docs, id_col, text, blocks, rest).groupBy("block")
    shared = grouped.applyInArrow(_ask_hashes(bits, shape), _UP).groupBy("bucket").applyInArrow(_which_shared, _DOWN)
    later = (grouped.cogroup(shared.groupBy("block")).applyInArrow(_ask_bytes(bits, shape), _UP)
             .groupBy("bucket").applyInArrow(_which_later, _DOWN))
    return grouped.cogroup(shared.unionByName(later).groupBy("block")).applyInArrow(_resolve(bits, shape, finish), schema)


def chunk_digest(docs: DataFrame, window: int = 2, mean: int = 2, longest: int = 32, families: int = 4, reach: int = 8,
                 id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, n_chunks_removed, kept_sha256): what line deduplication leaves of each document."""
    return _find(docs, id_col, text, (window, mean, longest, families, reach), _digest,
                 "doc_id long, n_lines long, n_removed long, n_chunks_removed long, kept_sha256 string", False)


def remove_repeated_chunks(docs: DataFrame, window: int = 2, mean: int = 2, longest: int = 32, families: int = 4,
                           reach: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the line chunks that stand earlier elsewhere; every row and column stays."""
    marked = docs.withColumn("__null_text", F.col(f"`{text}`").isNull())
    found = _find(marked, id_col, text, (window, mean, longest, families, reach), _texts,
                  f"text string, n_removed long, rest {rest_type(marked, text)}", True)
    return found.select(*[(F.when(~F.col("rest.__null_text"), F.col("text")).alias(text)
                           if c == text else F.col(f"rest.`{c}`").alias(c)) for c in docs.columns])
