"""N-gram Jaccard self-join by parity sketches (operator 10).

A document is the set of its distinct word shingles. Its *parity sketch* XORs shingles into bits:
each shingle flips the bit its hash names, so the Hamming distance of two sketches never exceeds
the size of the sets' symmetric difference. A pair of sizes a <= b reaches the wanted similarity
only if that difference is at most ``max_difference(a, b)``.

Candidates come from a pigeonhole join inside size bands (octaves of the set size; a document whose
partners may lie in the next octave joins both). In a band the hash space is cut into g parts and each
part of the set is XOR-ed to one key. A differing shingle spoils one part, so of the non-empty
parts of a document with k allowed differences at least (non-empty - k) agree with a linked partner;
the document may therefore leave out its (non-empty - k - 1) most frequent keys, in an order all
documents share, and still meet every linked partner at a key both keep. Keys made of passages that
thousands of documents share are exactly those that are left out. A document with too few non-empty
parts for this argument also uses its empty parts.

Components need no pairing of all rows of a group. (1) Documents with equal sets form a class and only its
smallest id goes on. (2) Each class is checked against one pivot (of the pivots it shares a key with,
the one it shares most keys with); verified links are contracted to components. (3) Only keys whose
classes are still in more than one component go on: members outside the key's largest component are the
queries, in chunks, against the members, in chunks; the sketches reject most. Of each query and
component the nearest survivor is verified on the exact sets and links are contracted; where that
leaves them apart and there were others, the next round verifies 16 times as many of that query and that component,
whichever components have become the largest meanwhile, until none is left.
Any linked pair shares a kept key, so it ends in one component: no link is lost.

Defined cases: documents without words (null, empty, only white space) have an empty set and no links; a document with
fewer words than a shingle is one shingle, its whole word sequence; a null id counts as larger than any other (a component
of null ids alone has component null); rows that share an id, with equal or other texts, are compared each; equal sets are
one class. Sets are compared as 64-bit shingle hashes, classes by a 63-bit code of their 128-bit identity.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.blocks import (bucket_cuts, ids_of, in_slices, join_replies, pack_short, plan_blocks, short_keys,
                                 text_blocks, unpack_short)
from carelake.llm.components import components
from carelake.llm.words import Words, mix, window_hashes
from carelake.session import pin

SKETCH_BITS = 2048
CHUNK = 1024  # members of a key compared at a time


# --- sets and sketches ---------------------------------------------------------------------------

def shingle_sets(words: Words, n: int):
    """The sorted distinct shingle hashes of each row."""
    grams = window_hashes(words.hashes, n)
    for i in range(words.n_rows):
        a, b = int(words.bounds[i]), int(words.bounds[i + 1])
        if b - a >= n:
            yield np.unique(grams[a:b - n + 1])
        elif b > a:
            yield window_hashes(words.hashes[a:b], b - a, seed=n)  # the whole sequence as one
        else:
            yield np.zeros(0, dtype=np.uint64)


def set_id(shingles: np.ndarray) -> tuple[int, int]:
    """128-bit identity of a set (two signed 64-bit sums)."""
    return tuple(int(mix(shingles, seed=s).sum(dtype=np.uint64).astype(np.int64)) for s in (11, 12))


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """Bit j is the parity of the shingles whose hash names j."""
    counts = np.bincount((mix(shingles, seed=21) >> np.uint64(53)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((counts & 1).astype(bool)).view(np.uint64)


class Measure:
    """The similarity threshold, as exact integer arithmetic (``num / den``, 0.8 = 80 / 100)."""

    def __init__(self, num: int = 80, den: int = 100):
        if not 0 < num <= den:
            raise ValueError("a threshold over 0 and up to 1 is required")
        self.num, self.den = num, den

    def linked(self, a: int, b: int, both: int) -> bool:
        return both > 0 and self.den * both >= self.num * (a + b - both)

    def most(self, a):
        """Largest size a linked partner of a set of size a can have."""
        return (a * self.den) // self.num

    def least(self, a):
        return -((-a * self.num) // self.den)

    def max_difference(self, a, b):
        """Largest symmetric difference of linked sets of sizes a and b."""
        total = a + b
        return total - 2 * -((-self.num * total) // (self.num + self.den))

    def bands(self, a: int) -> list[int]:
        """The octaves in which a set of size a is compared."""
        own = a.bit_length() - 1
        return [own] + ([own + 1] if self.most(a) >> (own + 1) else [])

    def parts(self, band: int) -> int:
        """Into how many parts the hash space is cut in a band (any number is right; this one leaves slack)."""
        top = 2 ** (band + 1)
        k = self.max_difference(top, top)
        return max(4, math.ceil(1.65 * k + 2 * math.sqrt(top))) + 4

    def allowed(self, a: int, band: int) -> int:
        """Most differences between a set of size a and a linked partner inside the band's sizes. The difference of
        two sizes has their sum's parity, so the largest partner can allow one less than the one below it."""
        b = max(a, min(self.most(a), 2 ** (band + 1) - 1))
        return max(0, self.max_difference(a, b), self.max_difference(a, b - 1))


def part_keys(shingles: np.ndarray, band: int, measure: Measure) -> tuple[np.ndarray, int]:
    """(keys, how many of the most frequent of them the document may leave out) in one band."""
    g = measure.parts(band)
    k = measure.allowed(len(shingles), band)
    part = ((mix(shingles, seed=31) >> np.uint64(32)) * np.uint64(g)) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    p = part[order]
    first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    xor = np.bitwise_xor.reduceat(mix(shingles[order], seed=32), first)
    spare = len(first) - k - 1
    if spare < 0:  # too few parts are filled: the empty ones count as well
        empty = np.setdiff1d(np.arange(g, dtype=np.uint64), p[first])
        p, xor = np.concatenate([p[first], empty]), np.concatenate([xor, np.zeros(len(empty), dtype=np.uint64)])
        spare = 0
    else:
        p = p[first]
    return mix(xor + (p + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), seed=33 + band), spare


# --- blocks: sets, keys, kept keys ------------------------------------------------------------------

def _signatures(n: int):
    def signatures(batches):
        for batch in batches:
            for _, part in in_slices(pa.Table.from_batches([batch])):
                sets = list(shingle_sets(Words(part.column("text"), fold=True), n))
                ids = [set_id(s) for s in sets]
                yield pa.record_batch({
                    "doc_id": part.column("doc_id").combine_chunks(), "block": part.column("block").combine_chunks(),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "h1": pa.array([x for x, _ in ids], pa.int64()), "h2": pa.array([x for _, x in ids], pa.int64())})
    return signatures


class _Block:
    """The representatives of one block: their sets and band keys. A class goes by its code from here on: ids may repeat
    or be null."""

    def __init__(self, texts: pa.Table, chosen: dict[int, dict[tuple[int, int], int]], n: int, measure: Measure, bits: int):
        self.docs, self.sets, keys, self.slots = [], [], [], []
        done: set[int] = set()
        for _, part in in_slices(texts):
            ids = ids_of(part.column("doc_id"))
            wanted = [i for i, d in enumerate(ids.tolist()) if d in chosen]
            if not wanted:
                continue
            part = part.take(wanted)
            for doc, shingles in zip(ids[wanted].tolist(), shingle_sets(Words(part.column("text"), fold=True), n)):
                code = chosen[doc].get(set_id(shingles))
                if code is None or code in done:  # another text of the id, or the same once more
                    continue
                done.add(code)
                self.docs.append(code)
                self.sets.append(shingles)
                for band in measure.bands(len(shingles)) if len(shingles) else []:
                    k, spare = part_keys(shingles, band, measure)
                    self.slots.append((len(self.docs) - 1, len(k), spare))
                    keys.append(k)
        self.full = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        short = short_keys(self.full, bits)
        self.keys, self.index, counts = np.unique(short, return_inverse=True, return_counts=True)
        self.counts = counts.astype(np.uint32)
        self.present, self.cuts = bucket_cuts(self.keys, 32)


def _chosen(right: pa.Table) -> dict[int, dict[tuple[int, int], int]]:
    """id -> set identity -> class code of a block's representatives."""
    rows = right.filter(pc.equal(right.column("bucket"), -1))
    out: dict[int, dict[tuple[int, int], int]] = {}
    for doc, text in zip(ids_of(rows.column("doc_id")).tolist(), rows.column("payload").to_pylist()):
        h1, h2, code = (int(x) for x in text.split(b","))
        out.setdefault(doc, {})[h1, h2] = code
    return out


def _ask(n, measure, bits):
    def ask(key, texts: pa.Table, reps: pa.Table) -> pa.Table:
        block = _Block(texts, _chosen(reps), n, measure, bits)
        parts = list(zip(block.cuts[:-1], block.cuts[1:]))
        return pa.table({
            "bucket": pa.array(block.present, pa.int32()), "block": pa.array([key[0].as_py()] * len(parts), pa.int32()),
            "keys": pa.array([pack_short(block.keys[a:b]) for a, b in parts], pa.binary()),
            "counts": pa.array([np.minimum(block.counts[a:b], 2**16 - 1).astype(np.uint16).tobytes() for a, b in parts], pa.binary())})
    return ask


def _count(table: pa.Table) -> pa.Table:
    """One bucket: how many documents hold each key of each row."""
    keys = [unpack_short(x) for x in table.column("keys").to_pylist()]
    counts = [np.frombuffer(x, dtype=np.uint16) for x in table.column("counts").to_pylist()]
    every = np.concatenate(keys) if keys else np.zeros(0, np.uint32)
    _, index = np.unique(every, return_inverse=True)
    total = np.bincount(index, weights=np.concatenate(counts) if counts else None).astype(np.int64)
    total = np.minimum(total, 2**32 - 1).astype(np.uint32)[index] if len(every) else np.zeros(0, np.uint32)
    at = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int64)
    return pa.table({"bucket": table.column("bucket").cast(pa.int32()), "block": table.column("block").cast(pa.int32()),
                     "doc_id": pa.nulls(len(keys), pa.int64()),
                     "payload": pa.array([total[at[i]:at[i + 1]].tobytes() for i in range(len(keys))], pa.binary())})


def _keep(n, measure, bits):
    """Of each representative: the keys it keeps that another document holds too, its sketch and its set."""
    def keep(key, texts: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(texts, _chosen(right), n, measure, bits)
        counts = np.frombuffer(b"".join(join_replies(right.filter(pc.greater_equal(right.column("bucket"), 0)))),
                               dtype=np.uint32)
        held = counts[block.index] if len(block.keys) else np.zeros(0, dtype=np.uint32)
        kept: dict[int, list[np.ndarray]] = {}
        at = 0
        for doc, size, spare in block.slots:
            own, c = block.full[at:at + size], held[at:at + size]
            at += size
            if spare:
                rarest = np.lexsort((block.index[at - size:at], c))[:size - spare]
                own, c = own[rarest], c[rarest]
            if (c >= 2).any():
                kept.setdefault(doc, []).append(own[c >= 2])
        docs = sorted(kept)
        return pa.table({
            "doc_id": pa.array([block.docs[d] for d in docs], pa.int64()),
            "n": pa.array([len(block.sets[d]) for d in docs], pa.int64()),
            "keys": pa.array([np.unique(np.concatenate(kept[d])).view(np.int64) for d in docs], pa.list_(pa.int64())),
            "sketch": pa.array([parity_sketch(block.sets[d]).tobytes() for d in docs], pa.binary()),
            "shingles": pa.array([block.sets[d].tobytes() for d in docs], pa.binary())})
    return keep


# --- verification --------------------------------------------------------------------------------

def _verify(measure: Measure):
    def verify(batches):
        for batch in batches:
            cols = batch.to_pydict()
            good = []
            for i, (a, b) in enumerate(zip(cols["set_u"], cols["set_v"])):
                a, b = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
                if measure.most(min(len(a), len(b))) < max(len(a), len(b)):
                    continue
                apart = int(np.bitwise_count(np.frombuffer(cols["sketch_u"][i], dtype=np.uint64)
                                             ^ np.frombuffer(cols["sketch_v"][i], dtype=np.uint64)).sum())
                if apart <= measure.max_difference(len(a), len(b)) and \
                        measure.linked(len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))):
                    good.append(i)
            yield pa.record_batch({"u": pa.array([cols["u"][i] for i in good], pa.int64()),
                                   "v": pa.array([cols["v"][i] for i in good], pa.int64())})
    return verify


def _links(pairs: DataFrame, kept: DataFrame, measure: Measure) -> DataFrame:
    """The pairs (u, v) that are linked, by their exact sets."""
    def side(x):
        return kept.select(F.col("doc_id").alias(x), F.col("sketch").alias(f"sketch_{x}"), F.col("shingles").alias(f"set_{x}"))
    return pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v").mapInArrow(_verify(measure), "u long, v long")


def _compare(measure: Measure, nearest: int | None):
    """One chunk of a key's queries against one chunk of its members: pairs the sketches allow, in other components.
    With ``nearest``, of each query and component only that many, by sketch distance; ``more`` tells of others."""
    def compare(table: pa.Table) -> pa.Table:
        doc, label, size = (np.asarray(table.column(c), dtype=np.int64) for c in ("doc_id", "label", "n"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint64).reshape(len(doc), -1)
        query = np.asarray(table.column("is_query").to_numpy(zero_copy_only=False), dtype=bool)
        q, t = np.flatnonzero(query), np.flatnonzero(~query)
        us, vs, more = [], [], []
        for i in q.tolist():
            near = t[(label[t] != label[i]) & (size[t] >= measure.least(size[i])) & (size[t] <= measure.most(size[i]))]
            if not len(near):
                continue
            apart = np.bitwise_count(sketch[near] ^ sketch[i]).sum(axis=1)
            allowed = apart <= measure.max_difference(size[near], size[i])
            near, apart = near[allowed], apart[allowed]
            if not len(near):
                continue
            order = np.lexsort((doc[near], apart, label[near]))
            near, of = near[order], label[near[order]]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            count = np.diff(np.concatenate([first, [len(of)]]))
            rank = np.arange(len(of)) - np.repeat(first, count)
            top = rank < (nearest or len(of))
            us.append(np.full(int(top.sum()), doc[i]))
            vs.append(doc[near[top]])
            more.append(np.repeat(count, count)[top] > (nearest or len(of)))
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()),
                         "more": pa.array(np.concatenate(more) if more else np.zeros(0, bool), pa.bool_())})
    return compare


def _star_pairs(kept: DataFrame) -> DataFrame:
    """One pair a representative: itself and the pivot it shares most keys with. A key's pivot is its member
    whose kept keys are the most widely held."""
    held = kept.select("doc_id", F.explode("keys").alias("key"))
    width = held.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c >= 2")
    weight = held.join(width, "key").groupBy("doc_id").agg(F.sum("c").alias("w"))
    weighted = held.join(weight, "doc_id")
    pivot = (weighted.groupBy("key").agg(F.max(F.struct("w", (-F.col("doc_id")).alias("neg"))).alias("p"),
                                         F.count(F.lit(1)).alias("c")).where("c >= 2")
             .select("key", (-F.col("p.neg")).alias("pivot")))
    return (held.join(pivot, "key").where("doc_id != pivot").groupBy("doc_id", "pivot").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("doc_id").agg(F.max(F.struct("c", (-F.col("pivot")).alias("neg"))).alias("p"))
            .select(F.col("doc_id").alias("u"), (-F.col("p.neg")).alias("v")))


def _cross_pairs(kept: DataFrame, labels: DataFrame | None, measure: Measure, nearest: int | None = None,
                 open_: DataFrame | None = None) -> DataFrame:
    """(u, v, more): pairs that share a key, lie in different components (``labels``; None: each document is its own),
    and that size and sketch allow. Of a key the documents outside its largest component ask all others; with ``open_``
    (doc_id, target) those documents ask the members of those components, whichever is the largest."""
    member = kept.select("doc_id", "n", F.explode("keys").alias("key"))
    if labels is None:
        member = member.withColumn("label", F.col("doc_id"))
    else:
        member = member.join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    sizes = member.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    salted = member.withColumn("salt", F.xxhash64("doc_id", F.lit(7)))
    if open_ is None:
        main = (sizes.groupBy("key").agg(F.max(F.struct("c", (-F.col("label")).alias("neg"))).alias("p"),
                                         F.sum("c").alias("members"), F.count(F.lit(1)).alias("labels"))
                .where("labels > 1").select("key", (-F.col("p.neg")).alias("main"), "members",
                                            (F.col("members") - F.col("p.c")).alias("asking")))
        met = salted.join(main, "key").withColumn("target", F.lit(None).cast("long"))
        asking = met.where("label != main")
    else:
        asked = salted.join(open_, "doc_id").join(sizes.select("key", F.col("label").alias("target"), F.col("c").alias("members")),
                                                  ["key", "target"])
        counts = asked.groupBy("key", "target").agg(F.count(F.lit(1)).alias("asking"), F.first("members").alias("members"))
        met = salted.join(counts.withColumn("label", F.col("target")), ["key", "label"])
        asking = asked.drop("members").join(counts, ["key", "target"])
    chunk = lambda c: F.ceil(F.col(c) / CHUNK).cast("long")
    chunks = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), chunk(c) - 1))
    members = met.select("key", "target", "doc_id", "label", "n", F.pmod("salt", chunk("members")).alias("t"), chunks("asking").alias("q"), F.lit(False).alias("is_query"))
    queries = asking.select("key", "target", "doc_id", "label", "n", chunks("members").alias("t"), F.pmod("salt", chunk("asking")).alias("q"), F.lit(True).alias("is_query"))
    rows = members.unionByName(queries).join(kept.select("doc_id", "sketch"), "doc_id")
    return (rows.groupBy("key", "target", "t", "q").applyInArrow(_compare(measure, nearest), "u long, v long, more boolean")
            .groupBy("u", "v").agg(F.max("more").alias("more")))


def _labels(links: DataFrame) -> DataFrame:
    return pin(components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("label")), "labels")


def _all_labels(kept: DataFrame, measure: Measure) -> DataFrame:
    """(doc_id, label) of every representative that a link reaches, with no linked pair left in two components."""
    links = pin(_links(_star_pairs(kept), kept, measure), "links")
    labels, nearest, open_ = _labels(links), 1, None
    while True:
        pairs = pin(_cross_pairs(kept, labels, measure, nearest, open_), "pairs")
        links = links.union(pin(_links(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
                                       kept, measure), "links"))
        labels = _labels(links)
        # a query and a component that are still apart after the nearest were compared, and others were left
        at = lambda x: labels.select(F.col("doc_id").alias(x), F.col("label").alias(f"label_{x}"))
        open_ = pin(pairs.where("more").join(at("u"), "u", "left").join(at("v"), "v", "left")
                    .select(F.col("u").alias("doc_id"), F.coalesce("label_u", "u").alias("own"), F.coalesce("label_v", "v").alias("target"))
                    .where("own != target").select("doc_id", "target").distinct(), "open")
        if open_.isEmpty():
            return labels
        nearest *= 16


def _kept(docs: DataFrame, n: int, measure: Measure, id_col: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets of all documents, classes of equal sets, kept keys of the classes' representatives)."""
    blocks, bits = plan_blocks(docs, text)
    dealt = text_blocks(docs, id_col, text, blocks)
    signed = pin(dealt.mapInArrow(_signatures(n), "doc_id long, block int, n_shingles long, h1 long, h2 long"), "sets")
    # null ids sort last, so a class has a null representative only if all its ids are null
    reps = (signed.where("n_shingles > 0").groupBy("n_shingles", "h1", "h2")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "block")).alias("r")))
    code = F.shiftrightunsigned(F.xxhash64("n_shingles", "h1", "h2"), 1)
    reps = pin(reps.select("n_shingles", "h1", "h2", F.col("r.doc_id").alias("rep"), F.col("r.block").alias("block"), code.alias("code")), "classes")
    # a set with no room for another linked size has no partner but its equals
    identity = F.encode(F.concat_ws(",", *[F.col(c).cast("string") for c in ("h1", "h2", "code")]), "utf-8")
    chosen = (reps.where(F.col("n_shingles") >= measure.num // max(1, measure.den - measure.num))
              .select(F.lit(-1).alias("bucket"), "block", F.col("rep").alias("doc_id"), identity.alias("payload")))
    texts = dealt.groupBy("block")
    asked = texts.cogroup(chosen.groupBy("block")).applyInArrow(_ask(n, measure, bits), "bucket int, block int, keys binary, counts binary")
    counted = asked.groupBy("bucket").applyInArrow(_count, "bucket int, block int, doc_id long, payload binary")
    kept = pin(texts.cogroup(chosen.unionByName(counted).groupBy("block")).applyInArrow(
        _keep(n, measure, bits), "doc_id long, n long, keys array<long>, sketch binary, shingles binary"), "kept")
    return signed, reps, kept


def jaccard_links(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                  text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links, membership): every linked pair of classes, as their representatives' ids u and v (u the smaller; null last) and
    their codes, and (doc_id, n_shingles, rep, code) of every document (null rep and code for an empty set). Documents of one
    class are linked with each other, and the links of their class are theirs."""
    measure = Measure(num, den)
    signed, reps, kept = _kept(docs, n, measure, id_col, text)
    pairs = _cross_pairs(kept, None, measure).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    side = lambda x: reps.select(F.col("code").alias(x), F.struct(F.col("rep").isNull().alias("z"), "rep", F.col("code").alias("c")).alias(f"s{x}"))
    both = _links(pairs, kept, measure).join(side("u"), "u").join(side("v"), "v").select(F.least("su", "sv").alias("a"), F.greatest("su", "sv").alias("b"))
    member = signed.join(reps.drop("block"), ["n_shingles", "h1", "h2"], "left").select("doc_id", "n_shingles", "rep", "code")
    return both.select(F.col("a.rep").alias("u"), F.col("b.rep").alias("v"), F.col("a.c").alias("code_u"), F.col("b.c").alias("code_v")), member


def jaccard_classes(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): the set size and the smallest id reachable by links."""
    measure = Measure(num, den)
    signed, reps, kept = _kept(docs, n, measure, id_col, text)
    labels = _all_labels(kept, measure).select(F.col("doc_id").alias("code"), "label")
    named = reps.join(labels, "code", "left").withColumn("label", F.coalesce("label", "code"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    classes = named.join(least, "label").select("n_shingles", "h1", "h2", "component_id")
    return (signed.where("n_shingles > 0").join(classes, ["n_shingles", "h1", "h2"]).select("doc_id", "n_shingles", "component_id")
            .union(signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those whose component has a smaller id. Rows that share an id stay together, if one of them stays;
    documents without words or without an id stay."""
    found = jaccard_classes(docs, n, num, den, id_col, text)
    gone = (found.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__gone"))
            .agg(F.min(F.col("component_id") != F.col("doc_id")).alias("__all")).where("__all").select("__gone"))
    return docs.join(gone, F.col(f"`{id_col}`").cast("long") == F.col("__gone"), "left_anti")
