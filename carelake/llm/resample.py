"""Target-distribution importance resampling: documents drawn by how much they resemble a target text (operator 11).

Every run of 1 to 3 consecutive words is a feature, hashed to one of ``BUCKETS`` buckets. A bucket's gain is the log ratio
of its smoothed frequency in the target and in all documents; a document's weight is the sum of its features' gains.
Adding Gumbel noise, fixed by the document's id, to the weights and taking the highest sums draws without replacement.

* Weights are scored in arrays: the CRC-32 of a run is combined from its words' CRCs by table look-ups, so each word's
  bytes are read once; gains are gathered from one array. Only the bucket counts (a fixed size) come to the driver.
* The cutoff is found by bracketing: a quantile sketch names two scores that should enclose it; exact counts outside
  the bracket validate that, or the bracket is widened; the rows inside, and no others, are sorted to place the
  cutoff. The drawn rows are then ranked in sorted ranges, tied or not; no task or driver sees all rows.

Defined cases: a null text has no words; a null id counts as the text "" in the noise and sorts after other ids; rows
with one id are drawn each on its own; empty tables give no rows, an empty target gives gains from its smoothed zero
counts. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.blocks import as_nullable, in_slices, rest_type
from carelake.llm.words import Words
from carelake.operators.keys import with_surrogate_key
from carelake.session import pin

BUCKETS = 10_000
LONGEST = 3  # words of a feature
SKETCH = 10_000  # accuracy of the quantile sketch: its rank error is rows / SKETCH

_BETWEEN = np.ones(256, dtype=bool)  # digits, letters (after folding) and bytes beyond ASCII make words
_BETWEEN[0x30:0x3A] = _BETWEEN[0x61:0x7B] = _BETWEEN[0x80:] = False


# --- CRC-32 of joined words ------------------------------------------------------------------------------

def _byte_table() -> np.ndarray:
    """The CRC register after one more byte, for each low byte of the register."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_NEXT = _byte_table()


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of the register, given by its values on each of the four bytes."""
    return tables[0][crc & 0xFF] ^ tables[1][(crc >> 8) & 0xFF] ^ tables[2][(crc >> 16) & 0xFF] ^ tables[3][crc >> 24]


def _zeros(n: int) -> np.ndarray:
    """(n, 4, 256): the register's change over 0 .. n - 1 zero bytes."""
    unit = np.arange(256, dtype=np.uint32)
    out = [np.stack([unit << np.uint32(8 * i) for i in range(4)])]
    for _ in range(n - 1):
        out.append(_NEXT[out[-1] & 0xFF] ^ (out[-1] >> 8))
    return np.stack(out)


_FEW = _zeros(32)


def _doubled() -> list[np.ndarray]:
    """The register's change over 32, 64, 128, ... zero bytes."""
    step = _apply(_FEW[31], _FEW[1])
    out = [step]
    while len(out) < 34:
        out.append(_apply(out[-1], out[-1]))
    return out


_MANY = _doubled()


def crc_after(crc: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of texts of CRC ``crc`` followed by texts of CRC ``tail`` and ``length`` bytes."""
    few = length & 31
    out = np.zeros(len(crc), dtype=np.uint32)
    for i in range(4):
        out ^= _FEW[few, i, (crc >> np.uint32(8 * i)) & np.uint32(0xFF)]
    rest = length >> 5
    for j, tables in enumerate(_MANY):
        long = np.flatnonzero((rest >> j) & 1)
        if len(long):
            out[long] = _apply(tables, out[long])
        elif not (rest >> j).any():
            break
    return out ^ tail


def _with_space(crc: np.ndarray) -> np.ndarray:
    state = ~crc
    return ~(_NEXT[(state ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (state >> np.uint32(8)))


def feature_crcs(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(first word, CRC-32) of all runs of 1, 2, .. ``LONGEST`` words of a row."""
    raw = words.data.tobytes()
    crc = zlib.crc32
    one = np.array([crc(raw[a:b]) for a, b in zip(words.starts.tolist(), words.ends.tolist())], dtype=np.uint32)
    length = words.ends - words.starts
    left = np.repeat(words.bounds[1:], words.counts) - np.arange(len(one))  # words from here to the row's end
    first, run, out = np.arange(len(one)), one, []
    for n in range(1, LONGEST + 1):
        if n > 1:
            go_on = left[first] >= n
            first, run = first[go_on], run[go_on]
            last = first + (n - 1)
            run = crc_after(_with_space(run), one[last], length[last])
        out.append((first, run))
    return out


# --- counts, weights --------------------------------------------------------------------------------------

def _tally(batches):
    """A task's features by bucket: one row, whatever the task reads."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, part in in_slices(pa.Table.from_batches([batch])):
            for _, crc in feature_crcs(Words(part.column("text"), fold=True, between=_BETWEEN)):
                total += np.bincount(crc % np.uint32(BUCKETS), minlength=BUCKETS)
    if total.any():
        yield pa.RecordBatch.from_pydict({"counts": pa.array([total], pa.list_(pa.int64()))})


def bucket_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket. The tasks' counts are added by bucket; ``BUCKETS`` sums reach the driver."""
    rows = (texts.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(_tally, "counts array<bigint>")
            .select(F.posexplode("counts").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target frequency / source frequency)) of every bucket, both smoothed by one."""
    s, t = int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (s + BUCKETS) / ((float(a) + 1) * (t + BUCKETS))))
                     for a, b in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(seed: int, doc_id) -> int:
    """Gumbel noise in thousandths, fixed by the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh(gain: np.ndarray, seed: int):
    def weigh(batches):
        for batch in batches:
            for _, part in in_slices(pa.Table.from_batches([batch])):
                words = Words(part.column("text"), fold=True, between=_BETWEEN)
                n, weight = np.zeros(words.n_rows, dtype=np.int64), np.zeros(words.n_rows, dtype=np.int64)
                for first, crc in feature_crcs(words):
                    sums = np.zeros(len(first) + 1, dtype=np.int64)
                    np.cumsum(gain[crc % np.uint32(BUCKETS)], out=sums[1:])
                    cut = np.searchsorted(first, words.bounds)
                    n += np.diff(cut)
                    weight += np.diff(sums[cut])
                ids = part.column("doc_id")
                extra = np.array([noise(seed, i) for i in ids.to_pylist()], dtype=np.int64)
                out = {"doc_id": ids.combine_chunks(), "n_words": pa.array(words.counts.astype(np.int64)),
                       "n_features": pa.array(n), "weight": pa.array(weight), "score": pa.array(weight + extra)}
                if "rest" in part.column_names:
                    out["rest"] = as_nullable(part.column("rest").combine_chunks())
                yield pa.RecordBatch.from_pydict(out)
    return weigh


def weighted(docs: DataFrame, target: DataFrame, seed: int = 42, id_col: str = "doc_id", text: str = "text",
             whole: bool = False) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document against the texts of ``target``, which has a text
    column of the same name; ``whole`` adds the documents' own rows as ``rest``."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, text))
    cols = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")]
    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    if whole:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"))
        schema += f", rest {rest_type(docs)}"
    return docs.select(*cols).mapInArrow(_weigh(gain, seed), schema)


# --- the draw ----------------------------------------------------------------------------------------------

def bracket(rows: DataFrame, k: int, n: int, score: str = "score", accuracy: int = SKETCH, width: float | None = None):
    """(low, high, rows above high): scores that enclose the ``k``-th highest of ``n``. A sketch proposes them ``width`` (a
    share of the rows) to either side; the exact counts outside decide, and a bracket that misses is widened."""
    width = 2.0 / accuracy if width is None else width
    while True:
        at = 1 - k / n
        if width < 1:
            ends = F.percentile_approx(score, [max(0.0, at - width), min(1.0, at + width)], accuracy)
        else:
            ends = F.array(F.min(score), F.max(score))
        low, high = rows.agg(ends.alias("e")).first()["e"]
        seen = rows.agg(F.count_if(F.col(score) > high).alias("above"), F.count_if(F.col(score) >= low).alias("not_below")).first()
        if seen["above"] < k <= seen["not_below"]:
            return low, high, seen["above"]
        width = 8 * width


def draw(scored: DataFrame, percent: int = 5, min_words: int = 20, accuracy: int = SKETCH, width: float | None = None) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, .. for the floor(percent * N / 100) highest scores of the N documents of ``min_words``
    words or more, ties to the smaller id; null for the others. ``scored`` is stored by the caller."""
    fit = F.col("n_words") >= min_words
    n = scored.where(fit).count()
    k = percent * n // 100
    no_rank = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select("*", no_rank)
    low, high, above = bracket(scored.where(fit), k, n, accuracy=accuracy, width=width)
    order = dict(order_cols=["score", "doc_id"], descending=["score"])
    sure = with_surrogate_key(scored.where(fit & (F.col("score") > high)), "rank", **order)
    inside = with_surrogate_key(scored.where(fit & F.col("score").between(low, high)), "rank", start=above + 1, **order)
    inside = inside.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    others = scored.where(~fit | (F.col("score") < low)).select("*", no_rank)
    return others.unionByName(sure).unionByName(inside)


def resample_weights(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42,
                     id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document."""
    return draw(pin(weighted(docs, target, seed, id_col, text), "weights"), percent, min_words)


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42,
              id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The drawn documents themselves, all columns as they came."""
    rows = draw(pin(weighted(docs, target, seed, id_col, text, whole=True), "weights"), percent, min_words)
    return rows.where(F.col("rank").isNotNull()).select("rest.*")
