"""Exact top-k inner products on a bit-sliced index (operator 3).

Every component is quantised to the integer floor(scale * x). The index holds, for a block of rows sorted by id, one
bitmap per attribute and bit: *slices* of the offset values u = v + 2**(w - 1), which are unsigned w-bit numbers.

A query's score is a sum of its coefficients times the attributes. Each coefficient is written in signed
powers of two (non-adjacent form), so a term is an attribute's slices moved up by some places, or
their complements for a negative power; constants that offsets and complements add are the same for every
row. All slices of one weight are added with carry-save adders, bitmap by bitmap, and the last two of
each weight with a ripple of carries: the result is a bit-sliced sum, one bitmap per bit of the score.

The top rows are selected from the most significant slice downwards: rows that are certainly in, and rows that are
tied so far. What is tied at the last slice has equal scores; of those the smallest ids are taken, so the boundary is
exact. Each block gives its k best rows of every query, and the k best of these are the answer.

The query rows (a stated set) are dealt to slots; a block of the index meets each slot once. Defined cases: a row
with a null id or vector, or a null or non-finite component, takes no part; rows with one id and one
vector stand once, rows with one id and other vectors stand each; no row with a query's id is its candidate, and the
query rows of one id share its k places; a component beyond 64 bits stands at
the nearer end of their range; rows are ranked by exact scores of any size, and a score beyond 64 bits is reported as the nearer
end of their range; missing components of shorter vectors count as 0; fewer than k candidates give all of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.blocks import shuffle_partitions
from carelake.session import pin

BLOCK_ROWS = 32768
SLOT_BYTES = 1 << 20  # query vectors that meet a block of the index at once


def quantised(vectors: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v): the distinct integer vectors of the rows that take part."""
    x = F.col(f"`{vector}`").cast("array<double>")
    sound = (F.col(f"`{id_col}`").isNotNull() & x.isNotNull()
             & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))))
    return (vectors.where(sound).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                                        F.transform(x, lambda e: F.floor(e * F.lit(float(scale)))).alias("v"))
            .distinct())


def _matrix(column, dim: int | None = None) -> np.ndarray:
    """Rows of an integer list column as a matrix, padded with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(np.asarray(column.offsets))
    dim = int(size.max(initial=0)) if dim is None else dim
    flat = np.asarray(column.flatten(), dtype=np.int64)
    out = np.zeros((len(column), dim), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    col = np.arange(len(flat)) - np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(flat) else flat
    keep = col < dim
    out[row[keep], col[keep]] = flat[keep]
    return out


def build_slices(values: np.ndarray) -> tuple[np.ndarray, int]:
    """(slices[attribute, bit, word], width) of an integer matrix (rows, attributes)."""
    n, dim = values.shape
    width = max(int(values.max(initial=0)).bit_length(), int(~values.min(initial=0)).bit_length()) + 1
    u = values.astype(np.uint64) + np.uint64(1 << (width - 1))  # modulo 2**64
    words = -(-n // 64) or 1
    out = np.zeros((dim, width, words * 8), dtype=np.uint8)
    for b in range(width):
        bits = ((u >> np.uint64(b)) & np.uint64(1)).astype(bool)
        out[:, b, :-(-n // 8)] = np.packbits(bits.T, axis=1, bitorder="little")
    return out.view(np.uint64), width


def signed_powers(c: int) -> list[tuple[int, bool]]:
    """c as a sum of signed powers of two without neighbours: (exponent, negative)."""
    out, e = [], 0
    while c:
        if c & 1:
            d = 2 - (c & 3)
            out.append((e, d < 0))
            c -= d
        c >>= 1
        e += 1
    return out


def sliced_score(slices: np.ndarray, width: int, query: np.ndarray) -> tuple[np.ndarray, int]:
    """(slices of the score plus a constant, least significant first; the constant to subtract)."""
    by_weight: dict[int, tuple[list, list, list]] = {}
    extra = 0
    for i, c in enumerate(query.tolist()):
        extra += c << (width - 1)  # the attributes' offset
        for e, negative in signed_powers(c):
            if negative:  # -u = ~u - (2**w - 1)
                extra += ((1 << width) - 1) << e
            for b in range(width):
                at = by_weight.setdefault(e + b, ([], [], []))
                at[0].append(i)
                at[1].append(b)
                at[2].append(negative)
    words = slices.shape[2]
    out, carried, p = [], np.zeros((0, words), dtype=np.uint64), 0
    top = max(by_weight, default=-1)
    while p <= top or len(carried):
        rows = carried
        if p in by_weight:
            i, b, negative = by_weight[p]
            picked = slices[i, b]
            picked[np.array(negative)] ^= np.uint64(2**64 - 1)
            rows = np.concatenate([rows, picked])
        carries = []
        while len(rows) > 2:  # three slices of one weight become one, and one of the next weight
            m = len(rows) // 3
            x, y, z = rows[:m], rows[m:2 * m], rows[2 * m:3 * m]
            half = x ^ y
            carries.append((x & y) | (z & half))
            rows = np.concatenate([half ^ z, rows[3 * m:]])
        if len(rows) == 2:
            carries.append((rows[0] & rows[1])[None])
            out.append(rows[0] ^ rows[1])
        else:
            out.append(rows[0] if len(rows) else np.zeros(words, dtype=np.uint64))
        carried = np.concatenate(carries) if carries else np.zeros((0, words), dtype=np.uint64)
        p += 1
    return (np.stack(out) if out else np.zeros((1, words), dtype=np.uint64)), extra


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def select_top(score: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest sliced scores among the allowed rows; ties go to smaller positions."""
    certain, tied = np.zeros_like(allowed), allowed
    for s in score[::-1]:
        up = tied & s
        n = int(np.bitwise_count(certain | up).sum())
        if n > k:
            tied = up
        else:
            certain, tied = certain | up, tied & ~s
            if n == k:
                break
    known = _positions(certain)
    return np.concatenate([known, _positions(tied)[:k - len(known)]])


def _score_at(score: np.ndarray, at: np.ndarray, extra: int) -> list[int]:
    bits = (score[:, at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)
    return [sum(int(b) << p for p, b in enumerate(col)) - extra for col in bits.T.tolist()]


def _build(key, table):
    table = table.sort_by("vec_id")
    values = _matrix(table.column("v"))
    slices, width = build_slices(values)
    return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([len(values)], pa.int32()),
                     "dim": pa.array([values.shape[1]], pa.int32()), "width": pa.array([width], pa.int32()),
                     "ids": pa.array([np.asarray(table.column("vec_id"), dtype=np.int64).tobytes()], pa.binary()),
                     "slices": pa.array([slices.tobytes()], pa.binary())})


_INDEX = "block int, n int, dim int, width int, ids binary, slices binary"
_RESULT = "query_id long, vec_id long, score long, exact binary"
EXACT_BYTES = 24  # products of 64-bit numbers, summed over up to 2**63 attributes


def exact_key(score: int) -> bytes:
    """Bytes that sort like the score; empty where the score itself fits a long (``score`` sorts before ``exact``)."""
    return b"" if -2**63 < score < 2**63 - 1 else (score + (1 << (8 * EXACT_BYTES - 1))).to_bytes(EXACT_BYTES, "big")


def build_index(rows: DataFrame) -> DataFrame:
    """The bit-sliced index of (vec_id, v): one row per block of about ``BLOCK_ROWS`` rows."""
    blocks = max(1, math.ceil(rows.count() / BLOCK_ROWS))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(_build, _INDEX)


def slots_for(queries: int, query_bytes: int, blocks: int, partitions: int) -> int:
    """Into how many slots the queries are dealt. The index is shuffled once a slot, so slots are as large as a task's
    memory allows; only where the blocks are too few to fill the cluster are there more, down to one query each."""
    return max(1, math.ceil(query_bytes / SLOT_BYTES), min(queries, math.ceil(partitions / blocks)))


def _search(k: int):
    def search(key, queries: pa.Table, index: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if index.num_rows and queries.num_rows:
            row = index.to_pylist()[0]
            ids = np.frombuffer(row["ids"], dtype=np.int64)
            slices = np.frombuffer(row["slices"], dtype=np.uint64).reshape(row["dim"], row["width"], -1)
            rows = np.zeros(slices.shape[2] * 8, dtype=np.uint8)
            rows[:-(-row["n"] // 8)] = np.packbits(np.ones(row["n"], dtype=bool), bitorder="little")
            rows = rows.view(np.uint64)
            for q, v in zip(queries.column("query_id").to_pylist(), _matrix(queries.column("v"), row["dim"])):
                allowed = rows.copy()
                for own in range(int(np.searchsorted(ids, q)), int(np.searchsorted(ids, q, side="right"))):
                    allowed[own // 64] &= ~np.uint64(1 << (own % 64))
                score, extra = sliced_score(slices, row["width"], v)
                at = select_top(score, allowed, k)
                out[0].extend([q] * len(at))
                out[1].extend(ids[at].tolist())
                scores = _score_at(score, at, extra)
                out[2].extend(min(max(s, -2**63), 2**63 - 1) for s in scores)
                out[3].extend(exact_key(s) for s in scores)
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), out)}
                        | {"exact": pa.array(out[3], pa.binary())})
    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): of each row for which ``is_query`` (over the column ``vec_id``) holds, the k rows
    of other ids with the highest integer inner product; ties to the smaller id."""
    rows = pin(quantised(vectors, id_col, vector, scale), "vectors")
    index = pin(build_index(rows), "index")
    queries = rows.where(is_query)
    asking = queries.agg(F.count(F.lit(1)), F.sum(F.size("v").cast("long"))).first()
    blocks = (index.agg(F.max("block")).first()[0] or 0) + 1
    slots = slots_for(asking[0], 8 * (asking[1] or 0), blocks, shuffle_partitions(vectors.sparkSession))
    # every slot of queries meets every block: both sides are dealt by (block, slot)
    asked = (queries.select(F.col("vec_id").alias("query_id"), "v", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(slots)).cast("int").alias("slot"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    held = index.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    best = (asked.groupBy("block", "slot").cogroup(held.groupBy("block", "slot")).applyInArrow(_search(k), _RESULT))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("exact").desc(), "vec_id")  # k rows from every block
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
