"""Repeated passages by a sparse suffix array (operator 8).

Of every window of ``n`` words the leftmost smallest of its ``k``-word hashes is selected (a minimiser):
the choice depends on the window's words alone, so equal windows in two documents select the same place, and only
about one word in (n - k) / 2 is selected. Only the suffixes at selected places are kept, those first whose
k-gram some other document selects as well (a block-bucket exchange, ``blocks.py``).

The kept suffixes, cut to the n words from the selected one, are sorted by content over the whole corpus
(range partitions that split equal suffixes too, so a passage that a third of all documents hold is no
hot group). Each is compared with its neighbours of another document, and the match is extended to the
right and to the left of the selected word, word by word. A match of n words or more is reported for
both documents. Matches of one document that overlap or touch are merged, so longer passages come out
whole: every n-word window inside one has its own selected place.

The suffixes are sorted twice, by what follows and by what precedes the selected word, and neighbours are compared in both
orders. Words are compared by 24-bit hashes; a match takes n of them (50 words: 1200 bits), so what is reported is
a repeat. A suffix meets its sorted neighbours only: among many near copies a partner with less agreement on either side but
more in sum can be missed at one place, and every other selected place of the passage is a chance more. Tests hold the
spans against all windows: nothing but repeats, and nearly all their words.

Defined cases: null text holds no words; documents of fewer than n words, and empty tables, give nothing; rows with
the same id are one document, which does not repeat itself; a null id is reported as null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.blocks import (NO_ID, bucket_cuts, ids_of, join_replies, pack_flags, pack_short, plan_blocks, short_keys,
                                 shuffle_partitions, text_blocks, unpack_flags, unpack_short)
from carelake.llm.words import Words, runs, window_hashes
from carelake.session import pin

_BYTES = 3  # of a word's hash in a suffix


def minimisers(words: Words, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(word positions selected by some n-word window, the k-gram hash at every word)."""
    grams = window_hashes(words.hashes, k)
    w = n - k + 1
    starts = np.flatnonzero(words.window_starts(n))
    if not len(starts):
        return starts, grams
    best, span = np.arange(len(grams)), 1
    while 2 * span <= w:  # leftmost smallest of 2, 4, 8.. k-grams from each place
        other = best[span:]
        left = best[:len(other)]
        best = np.where(grams[left] <= grams[other], left, other)
        span *= 2
    left, right = best[starts], best[starts + w - span]
    return np.unique(np.where(grams[left] <= grams[right], left, right)), grams


class _Block:
    def __init__(self, table: pa.Table, n: int, k: int, bits: int):
        ids = ids_of(table.column("doc_id"))
        self.words = Words(table.column("text"))
        self.places, grams = minimisers(self.words, n, k)
        self.row = np.searchsorted(self.words.bounds, self.places, side="right") - 1
        self.doc = ids[self.row]
        hashes = grams[self.places]
        self.keys, self.index = np.unique(short_keys(hashes, bits), return_inverse=True)
        low = np.full(len(self.keys), NO_ID)
        high = np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.index, self.doc)
        np.maximum.at(high, self.index, self.doc)
        self.inside = high > low
        self.present, self.cuts = bucket_cuts(self.keys, 32)


def _ask(n, k, bits):
    def ask(key, table):
        block = _Block(table, n, k, bits)
        return pa.table({"bucket": pa.array(block.present, pa.int32()), "block": pa.array([key[0].as_py()] * len(block.present), pa.int32()),
                         "keys": pa.array([pack_short(block.keys[a:b]) for a, b in zip(block.cuts[:-1], block.cuts[1:])], pa.binary())})
    return ask


def _shared(table: pa.Table) -> pa.Table:
    keys = [unpack_short(x) for x in table.column("keys").to_pylist()]
    every = np.concatenate(keys) if keys else np.zeros(0, np.uint32)
    _, index, count = np.unique(every, return_inverse=True, return_counts=True)
    flags = count[index] > 1 if len(every) else np.zeros(0, bool)
    at = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int64)
    return pa.table({"bucket": table.column("bucket").cast(pa.int32()), "block": table.column("block").cast(pa.int32()),
                     "payload": pa.array([pack_flags(flags[at[i]:at[i + 1]]) for i in range(len(keys))], pa.binary())})


def _binary(rows: np.ndarray) -> pa.Array:
    """A (rows, width) byte matrix as a binary column."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


def _suffixes(n, k, bits):
    """The suffixes of a block whose k-gram another document selects: n words from the place, n - k before it."""
    def suffixes(key, table, replies):
        block = _Block(table, n, k, bits)
        flags = block.inside.copy()
        for a, b, r in zip(block.cuts[:-1], block.cuts[1:], join_replies(replies), strict=True):
            flags[a:b] |= unpack_flags(r, b - a)
        kept = np.flatnonzero(flags[block.index]) if len(block.index) else np.zeros(0, np.int64)
        words = block.words
        first, last = words.bounds[:-1][block.row[kept]], words.bounds[1:][block.row[kept]]
        place = block.places[kept]
        code = np.zeros((len(words.hashes) + 1, _BYTES), dtype=np.uint8)  # the last stands for "no word"
        code[:-1] = (words.hashes >> np.uint64(40)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :_BYTES]
        out = []
        for a in range(0, max(len(kept), 1), 4096):
            p, f, e = place[a:a + 4096, None], first[a:a + 4096, None], last[a:a + 4096, None]
            right = p + np.arange(n)
            left = p - 1 - np.arange(n - k)
            right, left = np.where(right < e, right, len(words.hashes)), np.where(left >= f, left, len(words.hashes))
            out.append(pa.record_batch({
                "right": _binary(code[right].reshape(len(p), -1)), "left": _binary(code[left].reshape(len(p), -1)),
                "doc_id": pa.array(block.doc[kept[a:a + 4096]], pa.int64()), "block": pa.array([key[0].as_py()] * len(p), pa.int32()),
                "place": pa.array((p - f)[:, 0], pa.int64()), "after": pa.array((e - p)[:, 0], pa.int64())}))
        return pa.Table.from_batches(out)
    return suffixes


_FIELDS = ("right", "left", "doc_id", "block", "place", "after")


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading words that two (rows, width) byte matrices share."""
    words = a.shape[1] // _BYTES
    same = (a == b).reshape(len(a), words, _BYTES).all(axis=2)
    return np.where(same.all(axis=1), words, np.argmin(same, axis=1))


def _matches(rows: dict, i: np.ndarray, j: np.ndarray, n: int) -> list:
    """Matches of n or more words between the suffixes i and j (arrays of positions), for both documents."""
    r = _agree(rows["right"][i], rows["right"][j])
    r = np.minimum(r, np.minimum(rows["after"][i], rows["after"][j]))
    near = r > 0
    i, j, r = i[near], j[near], r[near]
    le = _agree(rows["left"][i], rows["left"][j])
    le = np.minimum(le, np.minimum(rows["place"][i], rows["place"][j]))
    good = r + le >= n
    i, j, r, le = i[good], j[good], r[good], le[good]
    return [{"doc_id": rows["doc_id"][x], "block": rows["block"][x], "first": rows["place"][x] - le, "end": rows["place"][x] + r,
             "other": rows["doc_id"][y]} for x, y in ((i, j), (j, i))]


def _load(batch) -> dict:
    n = batch.num_rows
    out = {c: np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(n, -1) for c in ("right", "left")}
    return out | {c: np.asarray(batch.column(c), dtype=np.int64) for c in _FIELDS[2:]}


def _pairs(rows: dict) -> tuple[np.ndarray, np.ndarray]:
    """Each row with the nearest row before it that is of another document, and with the nearest after it."""
    doc = rows["doc_id"]
    change = np.concatenate([[True], doc[1:] != doc[:-1]])
    start = np.flatnonzero(change)
    run = np.cumsum(change) - 1
    ends = np.append(start[1:], len(doc))
    before, after = start[run] - 1, ends[run]
    i = np.arange(len(doc))
    a, b = before >= 0, after < len(doc)
    pair = np.unique(np.concatenate([np.stack([before[a], i[a]]), np.stack([i[b], after[b]])], axis=1), axis=1)
    return pair[0], pair[1]


def _table(found: list) -> pa.RecordBatch:
    cols = {c: np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in ("doc_id", "block", "first", "end", "other")}
    return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int32() if c == "block" else pa.int64()) for c, v in cols.items()})


def _neighbours(n: int):
    """Sorted suffixes of one range: the matches of neighbours. The rows of the last two documents are carried on."""
    def neighbours(batches):
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            for at in range(0, batch.num_rows, 8192):
                rows = _load(batch.slice(at, 8192))
                if carried is not None:
                    rows = {c: np.concatenate([carried[c], rows[c]]) for c in rows}
                yield _table(_matches(rows, *_pairs(rows), n))
                # the last run of one document stays open, and one row of another document before it
                doc = rows["doc_id"]
                other = np.flatnonzero(doc != doc[-1])
                tail = np.arange(other[-1] if len(other) else 0, len(doc))
                carried = {c: v[tail] for c, v in rows.items()}
    return neighbours


def _merge(table: pa.Table) -> pa.Table:
    """The matches of one block of documents, overlapping or touching ones merged."""
    doc, a, b = (np.asarray(table.column(c), dtype=np.int64) for c in ("doc_id", "first", "end"))
    other = np.asarray(table.column("other"), dtype=np.int64)
    order = np.lexsort((a, doc))
    doc, a, b, other = doc[order], a[order], b[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(doc))))
    wide = np.int64(b.max() + 1 if len(b) else 1)
    reach = np.maximum.accumulate(b + group * wide) - group * wide  # a running maximum inside each document
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (a[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return pa.table({"doc_id": pa.array(doc[at], pa.int64(), mask=doc[at] == NO_ID), "start_word": pa.array(a[at], pa.int64()),
                     "n_words": pa.array(np.maximum.reduceat(b, at) - a[at] if len(at) else at, pa.int64()),
                     "other_doc_id": pa.array(np.minimum.reduceat(other, at) if len(at) else at, pa.int64(),
                                              mask=np.minimum.reduceat(other, at) == NO_ID if len(at) else None)})


def repeated_passages(docs: DataFrame, n: int = 50, k: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start_word, n_words, other_doc_id): the passages of n words or more of each document that another
    document holds, and the smallest document id met there as a sorted neighbour."""
    if not 1 <= k < n:
        raise ValueError("1 <= k < n is required")
    blocks, bits = plan_blocks(docs, text)
    bits = max(1, bits - 4)  # selected places are far fewer than words
    grouped = text_blocks(docs, id_col, text, blocks).groupBy("block")
    shared = (grouped.applyInArrow(_ask(n, k, bits), "bucket int, block int, keys binary")
              .groupBy("bucket").applyInArrow(_shared, "bucket int, block int, payload binary"))
    kept = pin(grouped.cogroup(shared.groupBy("block")).applyInArrow(
        _suffixes(n, k, bits), "right binary, left binary, doc_id long, block int, place long, after long"), "suffixes")
    ranges = 2 * shuffle_partitions(docs.sparkSession)
    parts = []
    # in the order of what follows, neighbours agree furthest to the right; in the order of what precedes, to the left
    for order in (["right", "left", "doc_id", "place"], ["left", "right", "doc_id", "place"]):
        ranged = kept.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        found = pin(ranged.withColumn("range", F.spark_partition_id()).mapInArrow(_edges_and_matches(n), _OUT), "matches")
        # the ends of the ranges: a few rows a range, compared in one small task
        ends = found.where("is_end").select(*_FIELDS, "range").repartition(1).sortWithinPartitions("range", *order)
        parts += [found.where("not is_end").select("doc_id", "block", "first", "end", "other"),
                  ends.drop("range").mapInArrow(_neighbours(n), _MATCH)]
    matches = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return matches.groupBy("block").applyInArrow(_merge, "doc_id long, start_word long, n_words long, other_doc_id long")


_MATCH = "doc_id long, block int, first long, end long, other long"
_OUT = ("is_end boolean, range int, right binary, left binary, doc_id long, block int, place long, after long, "
        "first long, end long, other long")


def _edges_and_matches(n: int):
    """The matches inside one range, and its first and last rows (of two documents each, where there are two)."""
    compare = _neighbours(n)

    def run(batches):
        head, tail, number = None, None, None
        at_head = True

        def through():
            nonlocal head, tail, number, at_head
            for batch in batches:
                if not batch.num_rows:
                    continue
                number = batch.column("range")[0].as_py()
                if at_head:  # rows up to the first of a second document
                    head = _ends(head, batch, first=True)
                    at_head = len(set(head.column("doc_id").to_pylist())) < 2
                tail = _ends(tail, batch, first=False)
                yield batch

        for found in compare(through()):
            if found.num_rows:
                m = found.num_rows
                yield pa.RecordBatch.from_pydict(
                    {"is_end": pa.array([False] * m), "range": pa.nulls(m, pa.int32()), "right": pa.nulls(m, pa.binary()),
                     "left": pa.nulls(m, pa.binary()), "doc_id": found.column("doc_id"), "block": found.column("block"),
                     "place": pa.nulls(m, pa.int64()), "after": pa.nulls(m, pa.int64()), "first": found.column("first"),
                     "end": found.column("end"), "other": found.column("other")})
        for part in (head, tail):
            if part is not None:
                m = part.num_rows
                yield pa.RecordBatch.from_pydict(
                    {"is_end": pa.array([True] * m), "range": pa.array([number] * m, pa.int32())}
                    | {c: part.column(c).combine_chunks() for c in _FIELDS}
                    | {c: pa.nulls(m, pa.int64()) for c in ("first", "end", "other")})
    return run


def _ends(known, batch, first: bool) -> pa.Table:
    """The outermost rows: one of the outermost document and one of the next document inwards."""
    t = pa.Table.from_batches([batch]).select(_FIELDS)
    if known is not None:
        t = pa.concat_tables([known, t])
    doc = np.asarray(t.column("doc_id"), dtype=np.int64)
    if first:
        other = np.flatnonzero(doc != doc[0])
        return t.take([0, int(other[0])] if len(other) else [0])
    other = np.flatnonzero(doc != doc[-1])
    return t.take([int(other[-1]), len(doc) - 1] if len(other) else [len(doc) - 1])
