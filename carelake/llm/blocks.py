"""Documents in blocks, hashed keys in buckets: the exchange that the corpus-wide text operators share.

A *block* is a set of whole documents (a few MB of text, chosen by a hash of the document id), so a
block's content does not depend on task order and can be rebuilt after an executor loss. A *bucket*
is a range of key hashes. To learn something about its keys from the whole corpus (how many
documents hold this window? which is the smallest?) each block sends its *distinct* keys, packed,
one row per bucket; the bucket combines what all blocks sent and answers each row in the row's own
key order; the answers meet the block again.

* A key that occurs a billion times reaches its bucket once per block, so no hot key gathers rows.
* Blocks and buckets follow the size of the data (``plan_blocks``), so what one task holds is bounded. A block sends at
  most one row per bucket and never an empty one, so rows are at most keys; with much more data, larger blocks
  (``BLOCK_BYTES``) and buckets (``BUCKET_KEYS``), as the executors' memory allows, keep rows long.
* The text is dealt to blocks by one exchange that every later step of the same plan reuses.
"""

from __future__ import annotations

import ctypes
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
BUCKET_KEYS = 2 << 20
NO_ID = np.int64(2**63 - 1)  # a null id sorts after every other id


def plan_blocks(docs: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """(blocks, bits) for a table's total text, with 2**bits buckets; one aggregate over the text column."""
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")).cast("long"))).first()[0] or 0
    parts = shuffle_partitions(docs.sparkSession)
    blocks = max(parts, math.ceil(total / block_bytes))
    keys = total / 6  # about six bytes a word
    return blocks, max(1, math.floor(math.log2(parts)), math.ceil(math.log2(max(1.0, keys / BUCKET_KEYS))))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_blocks(docs: DataFrame, id_col: str, text: str, blocks: int, rest: bool = False, by_text: bool = False) -> DataFrame:
    """(block, doc_id, text[, rest]): null text is empty; ``rest`` keeps the whole row as a struct. With ``by_text``
    the rows of one id (or of none) are spread by their texts; otherwise they share a block."""
    of = [id_col, text] if by_text else [id_col]
    cols = [F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in of]), F.lit(blocks)).cast("int").alias("block"),
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")]
    if rest:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("rest"))
    return docs.select(*cols)


def rest_type(docs: DataFrame, text: str | None = None) -> str:
    """SQL type of the ``rest`` struct: all columns but ``text``."""
    return "struct<" + ",".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in docs.schema if f.name != text) + ">"


def as_nullable(column):
    """A struct column whose fields may be null (what a schema string declares)."""
    def wide(t):
        if pa.types.is_struct(t):
            return pa.struct([pa.field(t.field(i).name, wide(t.field(i).type)) for i in range(t.num_fields)])
        if pa.types.is_list(t):
            return pa.list_(wide(t.value_type))
        return t
    return column.cast(wide(column.type))


def ids_of(column) -> np.ndarray:
    """int64 ids of an Arrow column; null becomes NO_ID."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False), dtype=np.int64)


def in_slices(table: pa.Table, text: str = "text", size: int = 1 << 20):
    """Row slices of a table with about ``size`` bytes of text each (a long row is a slice of its own)."""
    n = table.num_rows
    if not n:
        return
    lengths = np.asarray(pc.binary_length(table.column(text)).fill_null(0).to_numpy(), dtype=np.int64)
    ends = np.cumsum(lengths)
    i = 0
    while i < n:
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield i, table.slice(i, j - i)
        i = j


def give_back() -> None:
    """Hand memory that this worker has freed back to the system. A Python worker outlives its task and waits for the next one;
    without this its peak stays in the executor's memory beside the workers of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


# --- keys: sorted distinct 64-bit hashes; a bucket is the range of keys with the same leading bits ----

def bucket_cuts(sorted_keys: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(the buckets that sorted keys fall into, where each begins, and the end): bucket = key >> shift.
    A block sends a row to these buckets alone, and gets one answer from each."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
    bucket = sorted_keys >> np.uint64(shift)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return bucket[first].astype(np.int64), np.append(first, len(sorted_keys))


def short_keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The leading 32 + bits bits of each hash: the bucket, then 32 bits to tell its keys apart.
    Enough to find candidates; two keys that share them only add a candidate."""
    return hashes >> np.uint64(32 - bits)


def pack_short(keys: np.ndarray) -> bytes:
    """The low 32 bits of one bucket's sorted short keys, as byte planes of their differences."""
    d = np.diff((keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), prepend=np.uint32(0))
    return d.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_short(blob: bytes) -> np.ndarray:
    d = np.frombuffer(blob, dtype=np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
    return np.cumsum(d, dtype=np.uint32)


def pack_flags(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=n).astype(bool)


def join_replies(replies: pa.Table) -> list[bytes]:
    """One block's answers in bucket order."""
    order = np.argsort(np.asarray(replies.column("bucket")), kind="stable")
    payload = replies.column("payload").to_pylist()
    return [payload[i] for i in order]
