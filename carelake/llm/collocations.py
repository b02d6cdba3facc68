"""Phrase collocations by HAT-trie counting (operator 13).

1. Words are counted per language, and those with ``least`` occurrences or more numbered by falling count: no other word can be
   in a frequent phrase. A block of documents asks the dictionary for the ids of its distinct words (``blocks.py``); the
   dictionary is never in one place. Texts become id sequences, broken where a piece ends or a rare word stands.
2. Each task counts all phrases of 2 to ``longest`` ids of its sequences in one HAT-trie (``hattrie.py``): hash containers that
   burst under a shallow trie; whole subtrees are spilled as sorted runs, and a prefix partition merges the runs of
   all tasks. A partition holds the phrases of some first words; those of hot first words (the lowest ids) are
   dealt by all their words, so no partition grows with one word. Phrases below ``least`` end there.
3. All parts of a frequent phrase are frequent, so cuts and longer phrases are joined to their counts as Spark joins.
   The best of a language are found in levels of salted windows, ties kept, before words replace ids.

Everything is counted exactly. Words are told apart by 64-bit hashes of language and word. Ids take 32 bits.

Defined cases: a null text is empty, a null language is ``und`` (and one group with a language of that name); ids are not
read, so null and repeated ids, and repeated rows, all count; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.blocks import bucket_cuts, give_back, in_slices, join_replies, plan_blocks, shuffle_partitions
from carelake.llm.hattrie import HatTrie, merge_runs, pack_run
from carelake.llm.words import Words, mix
from carelake.operators.keys import with_surrogate_key
from carelake.session import pin

PART_PHRASES = 2_000_000   # phrases that one partition should merge
GROUP_ROWS = 1_000_000     # rows of a salted window
FEWEST_SALTS = 64

_BETWEEN = np.zeros(256, dtype=bool)
_CUTS = np.zeros(256, dtype=bool)
_CUTS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_BETWEEN[[0x20, 0x09]] = True
_BETWEEN |= _CUTS
IDS = ("i1", "i2", "i3", "i4")


def _exact(c):
    return F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")


# --- words --------------------------------------------------------------------------------------------------------

class Tokens:
    """The words of (lang, text) rows, hashed with their language, and where a word follows the one before it."""

    def __init__(self, table: pa.Table):
        self.words = Words(table.column("text"), fold=True, between=_BETWEEN)
        langs = table.column("lang").combine_chunks()
        langs = langs.dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        codes = np.asarray(langs.indices)
        of_lang = np.array([xxhash.xxh64_intdigest(x.encode(), 7) for x in self.langs], dtype=np.uint64)
        self.lang = np.repeat(codes, self.words.counts)
        self.keys = mix(self.words.hashes + of_lang[self.lang], seed=96) if len(self.lang) else self.words.hashes

    def starts_piece(self) -> np.ndarray:
        """True at the first word of each piece."""
        w = self.words
        cuts = np.concatenate([[0], np.cumsum(_CUTS[w.data])])
        out = np.ones(len(w.starts), dtype=bool)
        out[1:] = cuts[w.starts[1:]] > cuts[w.ends[:-1]]
        out[w.bounds[:-1][w.counts > 0]] = True
        return out


def _count_words(most: int = 1 << 18):
    """A task's words with their counts, sent on when there are many."""
    def count(batches):
        seen: dict[int, list] = {}

        def rows():
            values = list(seen.values())
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([v[1] for v in values], pa.string()), "word": pa.array([v[2].decode() for v in values], pa.string()),
                "h": pa.array(np.fromiter(seen.keys(), dtype=np.uint64, count=len(seen)).view(np.int64)),
                "n": pa.array([v[0] for v in values], pa.int64())})

        for batch in batches:
            for _, part in in_slices(pa.Table.from_batches([batch])):
                t = Tokens(part)
                keys, at, n = np.unique(t.keys, return_index=True, return_counts=True)
                w = t.words
                for k, i, c in zip(keys.tolist(), at.tolist(), n.tolist()):
                    if k in seen:
                        seen[k][0] += c
                    else:
                        seen[k] = [c, t.langs[t.lang[i]], w.data[w.starts[i]:w.ends[i]].tobytes()]
                if len(seen) > most:
                    yield rows()
                    seen.clear()
        if seen:
            yield rows()
        seen.clear()
        give_back()
    return count


# --- ids ----------------------------------------------------------------------------------------------------------

def _ask(bits):
    def ask(key, table):
        keys = np.unique(Tokens(table).keys)
        present, cuts = bucket_cuts(keys, 64 - bits)
        return pa.table({"bucket": pa.array(present, pa.int32()), "block": pa.array([key[0].as_py()] * len(present), pa.int32()),
                         "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})
    return ask


def _look_up(key, asked, dictionary):
    """The ids of each block's words in one bucket; 0 for rare ones."""
    known = np.asarray(dictionary.column("h")).view(np.uint64) if dictionary.num_rows else np.zeros(0, np.uint64)
    ids = np.asarray(dictionary.column("id")).astype(np.uint32) if dictionary.num_rows else np.zeros(0, np.uint32)
    order = np.argsort(known, kind="stable")
    known, ids = known[order], ids[order]
    out = []
    for k in asked.column("keys").to_pylist():
        k = np.frombuffer(k, np.uint64)
        i = np.minimum(np.searchsorted(known, k), max(len(known) - 1, 0))
        out.append((np.where(known[i] == k, ids[i], 0) if len(known) else np.zeros(len(k))).astype(np.uint32).tobytes())
    return pa.table({"bucket": asked.column("bucket").cast(pa.int32()), "block": asked.column("block").cast(pa.int32()),
                     "payload": pa.array(out, pa.binary())})


def _sequences(key, table, replies):
    """Id sequences of a block, in rows of some documents: byte planes of 32-bit ids, 0 between sequences."""
    keys = np.unique(Tokens(table).keys)
    ids = np.frombuffer(b"".join(join_replies(replies)), np.uint32)
    out = []
    for _, part in in_slices(table):
        t = Tokens(part)
        if len(t.keys):
            found = ids[np.searchsorted(keys, t.keys)]
            at = np.flatnonzero(t.starts_piece())
            seq = np.insert(found, at, 0)
            rare = seq == 0
            seq = seq[~(rare & np.concatenate([[False], rare[:-1]]))]  # one break is enough
            out.append(seq.view(np.uint8).reshape(-1, 4).T.tobytes())
    return pa.table({"ids": pa.array(out, pa.binary())})


# --- phrases ------------------------------------------------------------------------------------------------------

def phrases_of(seq: np.ndarray, longest: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(hi, lo) of all runs of 2 to ``longest`` (at most 4) ids of a sequence with breaks (0)."""
    wide = seq.astype(np.uint64)
    ok = wide > 0
    start = np.flatnonzero(ok)
    his, los = [], []
    for n in range(2, longest + 1):
        start = start[start + n <= len(wide)]
        start = start[ok[start + n - 1]]
        hi = wide[start] << np.uint64(32) | wide[start + 1]
        lo = np.zeros(len(start), dtype=np.uint64)
        if n > 2:
            lo = wide[start + 2] << np.uint64(32)
        if n > 3:
            lo = lo | wide[start + 3]
        his.append(hi)
        los.append(lo)
    return np.concatenate(his), np.concatenate(los)


def _count_phrases(parts: int, hot: int, longest: int, batch_ids: int = 1 << 16):
    def count(batches):
        trie = HatTrie(parts, hot)

        def rows(runs):
            for part, *run in runs:
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), **{k: pa.array([v], pa.binary()) for k, v in pack_run(*run).items()}})

        held, size = [], 0
        for batch in batches:
            for blob in batch.column("ids"):
                seq = np.frombuffer(blob.as_py(), np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
                held += [seq, np.zeros(1, np.uint32)]
                size += len(seq)
                if size >= batch_ids:
                    yield from rows(trie.add(*phrases_of(np.concatenate(held), longest)))
                    held, size = [], 0
        if held:
            yield from rows(trie.add(*phrases_of(np.concatenate(held), longest)))
        held = []
        yield from rows(trie.close())
        give_back()
    return count


def _merge(least: int):
    def merge(table):
        hi, lo, n = merge_runs(table.select(["hi", "lo", "n"]).to_pylist())
        often = n >= least
        hi, lo, n = hi[often], lo[often], n[often]
        low = np.uint64(0xFFFFFFFF)
        ids = [hi >> np.uint64(32), hi & low, lo >> np.uint64(32), lo & low]
        return pa.table({**{c: pa.array(x.astype(np.int64)) for c, x in zip(IDS, ids)}, "a": pa.array(n)})
    return merge


class Phrases:
    """Frequent words and phrases of (lang, text): ``words`` (id, lang, word, f), ``totals`` (lang, n), ``found`` (i1 .. i4, a)."""

    def __init__(self, docs: DataFrame, least: int = 30, longest: int = 4, lang: str = "lang", text: str = "text"):
        spark = docs.sparkSession
        plain = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
        counted = plain.mapInArrow(_count_words(), "lang string, word string, h long, n long")
        every = pin(counted.groupBy("lang", "word", "h").agg(F.sum("n").alias("f")), "words")
        self.totals = pin(every.groupBy("lang").agg(F.sum("f").alias("n")), "word-totals")
        self.words = pin(with_surrogate_key(every.where(F.col("f") >= least), "id", ["f", "lang", "word"], descending=["f"]), "word-ids")
        total = every.agg(F.sum("f")).first()[0] or 0
        if (self.words.agg(F.max("id")).first()[0] or 0) >= 1 << 32:
            raise ValueError("more than 2**32 frequent words: raise `least`")

        blocks, bits = plan_blocks(docs, text)
        dealt = plain.withColumn("block", F.pmod(F.xxhash64("lang", "text", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
        grouped = pin(dealt, "phrase-texts").groupBy("block")
        asked = grouped.applyInArrow(_ask(bits), "bucket int, block int, keys binary")
        numbered = self.words.select(F.shiftrightunsigned("h", 64 - bits).cast("int").alias("bucket"), "h", "id")
        answered = (asked.groupBy("bucket").cogroup(numbered.groupBy("bucket"))
                    .applyInArrow(_look_up, "bucket int, block int, payload binary"))
        sequences = pin(grouped.cogroup(answered.groupBy("block")).applyInArrow(_sequences, "ids binary"), "id-sequences")

        parts = max(shuffle_partitions(spark), math.ceil(total * (longest - 1) / PART_PHRASES))
        # words so frequent that they would fill a good part of a partition alone; they have the lowest ids
        hot = self.words.where(F.col("f") > total / (4 * parts)).count()
        runs = sequences.mapInArrow(_count_phrases(parts, hot, longest), "part int, hi binary, lo binary, n binary")
        self.found = pin(runs.groupBy("part").applyInArrow(_merge(least), ", ".join(f"{c} long" for c in IDS) + ", a long"), "phrases")


# --- scores -------------------------------------------------------------------------------------------------------

def _pieces(longest: int):
    """(k, l1.., r1..) of every cut of a phrase, as an array of structs; null where the phrase is shorter."""
    zero = F.lit(0).cast("long")
    out = []
    for n in range(2, longest + 1):
        is_n = (F.col(IDS[n - 1]) > 0) & ((F.col(IDS[n]) == 0) if n < 4 else F.lit(True))
        for k in range(1, n):
            left = [F.col(IDS[j]) if j < k else zero for j in range(3)]
            right = [F.col(IDS[k + j]) if k + j < n else zero for j in range(3)]
            cols = [F.lit(k).alias("k"), *[c.alias(f"l{j}") for j, c in enumerate(left)], *[c.alias(f"r{j}") for j, c in enumerate(right)]]
            out.append(F.when(is_n, F.struct(*cols)))
    return F.array_compact(F.array(*out))


def scored(p: Phrases, longest: int = 4) -> DataFrame:
    """(i1 .. i4, a, l, r, score) of all frequent phrases: the lowest-scoring cut counts, ties to the first."""
    counts = (p.found.where("i4 = 0").select("i1", "i2", "i3", F.col("a").alias("f"))
              .unionByName(p.words.select(F.col("id").alias("i1"), F.lit(0).cast("long").alias("i2"), F.lit(0).cast("long").alias("i3"), "f")))
    side = lambda s, name: counts.select(F.col("i1").alias(f"{s}0"), F.col("i2").alias(f"{s}1"), F.col("i3").alias(f"{s}2"), F.col("f").alias(name))
    cuts = p.found.select(*IDS, "a", F.explode(_pieces(longest)).alias("c")).select(*IDS, "a", "c.*")
    cuts = cuts.join(side("l", "l"), ["l0", "l1", "l2"]).join(side("r", "r"), ["r0", "r1", "r2"])
    # 38 digits hold any product; the quotient is at most 1,000,000
    cuts = cuts.withColumn("score", F.expr("cast(2000000 * cast(a as decimal(30,0)) div (cast(l as decimal(30,0)) + cast(r as decimal(30,0))) as long)"))
    return cuts.groupBy(*IDS, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")).select(*IDS, "a", "best.l", "best.r", "best.score")


def maximal(p: Phrases, rows: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """``rows`` without phrases inside a longer one that has ``num`` / ``den`` of their occurrences or more. A phrase one word
    longer occurs at least as often as any longer one around it, so those decide."""
    zero = F.lit(0).cast("long")
    child = lambda a, b, c: F.struct(a.alias("i1"), b.alias("i2"), c.alias("i3"))
    i1, i2, i3, i4 = (F.col(c) for c in IDS)
    inside = F.when(i4 > 0, F.array(child(i1, i2, i3), child(i2, i3, i4))).otherwise(F.array(child(i1, i2, zero), child(i2, i3, zero)))
    longer = (p.found.where("i3 > 0").select(F.explode(inside).alias("c"), "a").select("c.*", "a")
              .groupBy("i1", "i2", "i3").agg(F.max("a").alias("longer")).withColumn("i4", zero))
    kept = F.col("longer").isNull() | (_exact("longer") * F.lit(den) < _exact("a") * F.lit(num))
    return rows.join(longer, list(IDS), "left").where(kept).drop("longer")


def best(p: Phrases, rows: DataFrame, most: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``most`` of each language."""
    named = lambda c, *more: p.words.select(F.col("id").alias(c), *more)
    rows = pin(rows.join(named("i1", "lang", F.col("word").alias("w1")), "i1"), "scored-phrases")
    order = [F.desc("score"), F.desc("a")]
    salts = max(FEWEST_SALTS, math.ceil(rows.count() / GROUP_ROWS))
    salt = lambda s: F.pmod(F.xxhash64(*IDS), F.lit(s))
    for s in sorted({salts, FEWEST_SALTS}, reverse=True):
        # rank keeps ties: which of them come first is known when they have words
        w = Window.partitionBy("lang", salt(s)).orderBy(*order)
        rows = rows.withColumn("rank", F.rank().over(w)).where(F.col("rank") <= most).drop("rank")
    for i in (2, 3, 4):
        rows = rows.join(named(f"i{i}", F.col("word").alias(f"w{i}")), f"i{i}", "left")
    rows = rows.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3", "w4"))
    order.append(F.asc("phrase"))
    inner = Window.partitionBy("lang", salt(FEWEST_SALTS)).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(inner)).where(F.col("rank") <= most)  # ties in the open again
    # at most FEWEST_SALTS * most rows a language
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return rows.join(p.totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, most: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the collocations of each language, best first."""
    p = Phrases(docs, least, longest, lang, text)
    return best(p, maximal(p, scored(p, longest)), most)
