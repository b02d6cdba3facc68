"""Substring deduplication by level-wise doubling of repeated word windows (operator 4).

Every window of ``n`` words whose word sequence also starts in a document with a smaller id is
found, and the words it covers are removed. The search goes by levels: windows of a short length
are looked up in the whole corpus, and only where a window is repeated at one length is it extended
to twice that length (the last step overlaps so that it ends at ``n``). A window of length 2L can
only be repeated where both its halves are, so each level asks about the survivors of the one
before, until the wanted length is reached or no candidate survives.

Each level is one block-bucket exchange (``blocks.py``). Below the wanted length only "does another
document hold it?" is asked, with short keys: a chance agreement adds a candidate and is dropped
at the next level. At the wanted length the keys are 64-bit hashes of an independent polynomial and
carry the smallest document id of the block (a row names only the ids it needs), and one bit comes back: is there a smaller document
elsewhere? If so, every occurrence in the block goes; if not, the block itself holds the smallest.

Defined cases: null text holds no words; a null id sorts after all others (its windows yield to every
other document's); rows with the same id are one document, so they do not remove each other's
windows, and are dealt to blocks by their texts, so that many rows of one id or without one do not meet in
one task; documents shorter than the window lose nothing; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.blocks import (as_nullable, bucket_cuts, ids_of, join_replies, pack_flags, pack_short, plan_blocks,
                                 rest_type, short_keys, text_blocks, unpack_flags, unpack_short)
from carelake.llm.words import Words, cover, window_hashes

_UP = "bucket int, block int, level int, keys binary, mins binary, docs binary"
_DOWN = "bucket int, block int, level int, payload binary"


def level_lengths(n: int, first: int) -> list[int]:
    """Window lengths of the levels: doubling from ``first``, ending at ``n``."""
    out = [min(first, n)]
    while out[-1] < n:
        out.append(min(2 * out[-1], n))
    return out


def _place_type(n: int):
    """The narrowest unsigned type for places in a list of n."""
    return np.uint8 if n <= 2**8 else np.uint16 if n <= 2**16 else np.uint32


def pack_docs(doc_ids: np.ndarray, ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(places, ids) of one bucket row's documents, one a key: only the ids that the row names travel with it, so
    its size follows its keys (at most 12 bytes each), not the documents of the block."""
    named, place = np.unique(ranks, return_inverse=True)
    return place.astype(_place_type(len(named))).tobytes(), doc_ids[named].tobytes()


def unpack_docs(places: bytes, ids: bytes) -> np.ndarray:
    doc_ids = np.frombuffer(ids, dtype=np.int64)
    return doc_ids[np.frombuffer(places, dtype=_place_type(len(doc_ids)))]


class _Block:
    """One block's words and, level by level, which window starts are still candidates."""

    def __init__(self, table: pa.Table, lengths: list[int], bits: int):
        order = np.argsort(ids_of(table.column("doc_id")), kind="stable")
        self.table = table.take(order)
        self.ids = ids_of(self.table.column("doc_id"))
        self.words = Words(self.table.column("text"))
        self.lengths, self.bits = lengths, bits
        self.row = self.words.row_of_word()
        # rows with one id are one document: its rank among the block's ids
        self.doc_ids, self.doc = np.unique(self.ids, return_inverse=True)
        self.candidates = self.words.window_starts(lengths[0])

    def ask(self, level: int):
        """(starts, key of each start, distinct keys, index of each start's key) of a level's candidates."""
        length = self.lengths[level]
        starts = np.flatnonzero(self.candidates)
        hashes = window_hashes(self.words.hashes, length, seed=level)[starts] if len(starts) else np.zeros(0, np.uint64)
        last = level == len(self.lengths) - 1
        keys, index = np.unique(hashes if last else short_keys(hashes, self.bits), return_inverse=True)
        return starts, keys, index

    def smallest(self, starts, keys, index) -> np.ndarray:
        """The block's smallest document (rank) of each key."""
        best = np.full(len(keys), len(self.doc_ids), dtype=np.int64)
        np.minimum.at(best, index, self.doc[self.row[starts]])
        return best

    def answer(self, level: int, replies: list[bytes]) -> None:
        """Narrow the candidates by one level's answers."""
        starts, keys, index = self.ask(level)
        last = level == len(self.lengths) - 1
        _, cuts = bucket_cuts(keys, 64 - self.bits if last else 32)
        flags = np.concatenate([unpack_flags(r, n) for r, n in zip(replies, np.diff(cuts), strict=True)]) \
            if len(keys) else np.zeros(0, dtype=bool)
        docs = self.doc[self.row[starts]]
        smallest = self.smallest(starts, keys, index)
        if last:
            hit = flags[index] | (docs > smallest[index])
        else:
            largest = np.full(len(keys), -1, dtype=np.int64)
            np.maximum.at(largest, index, docs)
            hit = (flags | (largest > smallest))[index]
        alive = np.zeros(len(self.row), dtype=bool)
        alive[starts[hit]] = True
        if not last:
            step = self.lengths[level + 1] - self.lengths[level]
            later = np.zeros(len(alive), dtype=bool)
            if step < len(alive):
                later[:len(alive) - step] = alive[step:]
            alive &= later & self.words.window_starts(self.lengths[level + 1])
        self.candidates = alive

    def covered(self) -> np.ndarray:
        return cover(np.flatnonzero(self.candidates), self.lengths[-1], len(self.row))


def _asker(lengths, bits, level):
    def ask(key, table: pa.Table, replies: pa.Table | None = None) -> pa.Table:
        block = _Block(table, lengths, bits)
        _apply(block, replies, level)
        starts, keys, index = block.ask(level)
        last = level == len(lengths) - 1
        present, cuts = bucket_cuts(keys, 64 - bits if last else 32)
        best = block.smallest(starts, keys, index) if last else None
        n = len(present)
        at = list(zip(cuts[:-1], cuts[1:]))
        named = [pack_docs(block.doc_ids, best[a:b]) if last else (b"", b"") for a, b in at]
        return pa.table({
            "bucket": pa.array(present, pa.int32()), "block": pa.array([key[0].as_py()] * n, pa.int32()),
            "level": pa.array([level] * n, pa.int32()),
            "keys": pa.array([keys[a:b].tobytes() if last else pack_short(keys[a:b]) for a, b in at], pa.binary()),
            "mins": pa.array([m for m, _ in named], pa.binary()), "docs": pa.array([d for _, d in named], pa.binary())})
    if level:
        return lambda key, table, replies: ask(key, table, replies)
    return lambda key, table: ask(key, table)


def _apply(block: _Block, replies: pa.Table | None, upto: int) -> None:
    for level in range(upto):
        block.answer(level, join_replies(replies.filter(pc.equal(replies.column("level"), level))))


def _combine(last: bool):
    def combine(table: pa.Table) -> pa.Table:
        """One bucket: which keys of each row does another row hold (with a smaller document, at the last level)?"""
        keys = [np.frombuffer(x, dtype=np.uint64) if last else unpack_short(x) for x in table.column("keys").to_pylist()]
        sizes = np.array([len(k) for k in keys])
        every = np.concatenate(keys) if len(keys) else np.zeros(0, np.uint64)
        flags = np.zeros(len(every), dtype=bool)
        if last:
            docs = [unpack_docs(m, d) for m, d in zip(table.column("mins").to_pylist(), table.column("docs").to_pylist())]
            order = np.argsort(every, kind="stable")
            doc = np.concatenate(docs)[order] if docs else np.zeros(0, np.int64)
            every = every[order]
            if len(every):
                first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
                smallest = np.minimum.reduceat(doc, first)
                flags[order] = doc > np.repeat(smallest, np.diff(np.concatenate([first, [len(every)]])))
        elif len(every):
            tagged = np.sort((every.astype(np.uint64) << np.uint64(32)) | np.arange(len(every), dtype=np.uint64))
            same = (tagged[1:] >> np.uint64(32)) == (tagged[:-1] >> np.uint64(32))
            twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            flags[(tagged[twice] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
        cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return pa.table({
            "bucket": table.column("bucket").cast(pa.int32()), "block": table.column("block").cast(pa.int32()),
            "level": table.column("level").cast(pa.int32()),
            "payload": pa.array([pack_flags(flags[cuts[i]:cuts[i + 1]]) for i in range(len(keys))], pa.binary())})
    return combine


def _resolve(lengths, bits, finish):
    def resolve(key, table: pa.Table, replies: pa.Table) -> pa.Table:
        block = _Block(table, lengths, bits)
        _apply(block, replies, len(lengths))
        return finish(block)
    return resolve


def _find(docs: DataFrame, id_col: str, text: str, n: int, first: int, finish, schema: str, rest: bool) -> DataFrame:
    if n >= 2**15 or first < 1 or n < 1:
        raise ValueError("1 <= first and n < 32768 are required")
    lengths = level_lengths(n, first)
    blocks, bits = plan_blocks(docs, text)
    dealt = text_blocks(docs, id_col, text, blocks, rest, by_text=True)
    grouped = dealt.groupBy("block")
    replies = None
    for level in range(len(lengths)):
        if replies is None:
            asked = grouped.applyInArrow(_asker(lengths, bits, 0), _UP)
        else:
            asked = grouped.cogroup(replies.groupBy("block")).applyInArrow(_asker(lengths, bits, level), _UP)
        answered = asked.groupBy("bucket").applyInArrow(_combine(level == len(lengths) - 1), _DOWN)
        replies = answered if replies is None else replies.unionByName(answered)
    return grouped.cogroup(replies.groupBy("block")).applyInArrow(_resolve(lengths, bits, finish), schema)


def _kept_words(block: _Block, keep: np.ndarray, i: int) -> bytes:
    a, b = block.words.bounds[i], block.words.bounds[i + 1]
    return b" ".join(compress(block.words.row_bytes(i).split(), keep[a:b].tolist()))


def _digest(block: _Block) -> pa.Table:
    gone = block.covered()
    total = np.concatenate([[0], np.cumsum(gone)])
    removed = total[block.words.bounds[1:]] - total[block.words.bounds[:-1]]
    sha = [hashlib.sha256(_kept_words(block, ~gone, i)).hexdigest() for i in range(len(block.ids))]
    return pa.table({"doc_id": block.table.column("doc_id"), "n_words": pa.array(block.words.counts, pa.int64()),
                     "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})


def _texts(block: _Block) -> pa.Table:
    gone = block.covered()
    total = np.concatenate([[0], np.cumsum(gone)])
    removed = total[block.words.bounds[1:]] - total[block.words.bounds[:-1]]
    old = block.table.column("text").to_pylist()
    new = [_kept_words(block, ~gone, i).decode("utf-8", "replace") if removed[i] else old[i] for i in range(len(old))]
    return pa.table({"text": pa.array(new, pa.string()), "n_removed": pa.array(removed, pa.int64()),
                     "rest": as_nullable(block.table.column("rest"))})


def removal_digest(docs: DataFrame, n: int = 13, first: int = 7, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): what removal of repeated windows leaves of each document."""
    return _find(docs, id_col, text, n, first, _digest,
                 "doc_id long, n_words long, n_removed long, kept_sha256 string", False)


def remove_repeats(docs: DataFrame, n: int = 13, first: int = 7, id_col: str = "doc_id", text: str = "text",
                   removed: str | None = None) -> DataFrame:
    """The documents with repeated windows removed: all columns, ``text`` replaced (kept words joined by one
    space; a document that loses nothing keeps its text as it is, null included), and with ``removed`` a column
    of that name with the number of words removed."""
    marked = docs.withColumn("__null_text", F.col(f"`{text}`").isNull())
    found = _find(marked, id_col, text, n, first, _texts,
                  f"text string, n_removed long, rest {rest_type(marked, text)}", True)
    cols = [(F.when(F.col("rest.__null_text") & (F.col("text") == ""), F.lit(None)).otherwise(F.col("text")).alias(text)
             if c == text else F.col(f"rest.`{c}`").alias(c)) for c in docs.columns]
    if removed:
        cols.append(F.col("n_removed").alias(removed))
    return found.select(*cols)
