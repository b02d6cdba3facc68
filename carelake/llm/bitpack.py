"""Token ids in a fixed-width bit-packed binary format (operator 7).

Each id takes the least bits that hold the vocabulary (16 for 50,257 ids). One shard file holds a range of the
document order::

    magic "BPK1" | u32 version | u32 bits | u32 ids per block | u64 documents | u64 ids | u64 bytes of the payload
    i64 document ids | u8 null flags of the ids | u64 first id of each document (n + 1) | u64 byte offset of each block (m + 1)
    payload: the blocks, one after another, each padded to a byte

A block's ids are unpacked with one numpy expression (no loop over ids), and any id range is read from its
blocks alone, found by the block offsets.

Shards are written by the tasks of one range partitioning by document id, through the file system of the
given folder, each under a name of its own; the rows that Spark keeps name the files of the attempts
that counted, so a re-run task leaves an orphan file and never a wrong one. The manifest
(shard order, first id of each shard) is a small table: one row per shard.

Defined cases: null or empty text is the end id alone; null ids come first in the order; rows with the same id follow each
other in no particular order; an empty table gives no shards.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.blocks import in_slices, shuffle_partitions
from carelake.llm.tokens import encode_rows
from carelake.session import pin, scratch_path

MAGIC = b"BPK1"
_HEAD = struct.Struct("<4sIIIQQQ")
BLOCK_IDS = 4096


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """ids (below 2**bits) as a little-endian bit string."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(bool).ravel(), bitorder="little").tobytes()


def unpack_bits(blob: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of a bit string."""
    if bits in (8, 16, 32):
        return np.frombuffer(blob, dtype=f"<u{bits // 8}", count=count).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return planes.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class Writer:
    """Collects documents and writes one shard; ids are packed as they come."""

    def __init__(self, bits: int, block_ids: int = BLOCK_IDS):
        self.bits, self.block_ids = bits, block_ids
        self.docs, self.sizes, self.blocks = [], [], []
        self.rest = np.zeros(0, dtype=np.uint32)

    def add(self, doc_ids: list, ids: np.ndarray, bounds: np.ndarray) -> None:
        self.docs += doc_ids
        self.sizes.append(np.diff(bounds))
        ids = np.concatenate([self.rest, ids])
        full = len(ids) // self.block_ids * self.block_ids
        for a in range(0, full, self.block_ids):
            self.blocks.append(pack_bits(ids[a:a + self.block_ids], self.bits))
        self.rest = ids[full:]

    def write(self, out) -> None:
        if len(self.rest):
            self.blocks.append(pack_bits(self.rest, self.bits))
        sizes = np.concatenate(self.sizes) if self.sizes else np.zeros(0, np.int64)
        first = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
        at = np.concatenate([[0], np.cumsum([len(b) for b in self.blocks])]).astype("<u8")
        out.write(_HEAD.pack(MAGIC, 1, self.bits, self.block_ids, len(self.docs), int(first[-1]), int(at[-1])))
        out.write(np.array([0 if d is None else d for d in self.docs], dtype="<i8").tobytes())
        out.write(np.array([d is None for d in self.docs], dtype="u1").tobytes())
        out.write(first.tobytes())
        out.write(at.tobytes())
        for block in self.blocks:
            out.write(block)


class Reader:
    """Random access to one shard (any seekable binary file)."""

    def __init__(self, f):
        self.f = f
        magic, version, self.bits, self.block_ids, n, self.n_ids, _ = _HEAD.unpack(f.read(_HEAD.size))
        if magic != MAGIC or version != 1:
            raise ValueError("not a shard of this format")
        m = -(-self.n_ids // self.block_ids)
        ids = np.frombuffer(f.read(8 * n), dtype="<i8")
        null = np.frombuffer(f.read(n), dtype="u1")
        self.docs = pa.array(ids, pa.int64(), mask=null.astype(bool))
        self.first = np.frombuffer(f.read(8 * n + 8), dtype="<u8").astype(np.int64)
        self.block_at = np.frombuffer(f.read(8 * m + 8), dtype="<u8").astype(np.int64)
        self.payload = f.tell()

    def ids(self, a: int, b: int) -> np.ndarray:
        """Ids a..b-1 of the shard, from the blocks that hold them."""
        if a >= b:
            return np.zeros(0, dtype=np.uint32)
        x, y = a // self.block_ids, (b - 1) // self.block_ids
        self.f.seek(self.payload + int(self.block_at[x]))
        raw = self.f.read(int(self.block_at[y + 1] - self.block_at[x]))
        parts = []
        for k in range(x, y + 1):
            count = min(self.block_ids, self.n_ids - k * self.block_ids)
            at = int(self.block_at[k] - self.block_at[x])
            parts.append(unpack_bits(raw[at:at + int(self.block_at[k + 1] - self.block_at[k])], count, self.bits))
        return np.concatenate(parts)[a - x * self.block_ids:b - x * self.block_ids]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.first[i]), int(self.first[i + 1]))


def _open(folder: str):
    """The file system and path of a folder URI (``file:/x``, ``hdfs://..``, ``s3://..``) or a plain path."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return pa.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _shards(folder: str, tokenizer: str, end_id: int, bits: int):
    def shards(batches):
        from pyspark import TaskContext
        writer = Writer(bits)
        for batch in batches:
            for _, part in in_slices(pa.Table.from_batches([batch]), size=4 << 20):
                ids, bounds = encode_rows(part.column("text"), tokenizer, end_id)
                if len(ids) and int(ids.max()) >> bits:
                    raise ValueError("an id does not fit the vocabulary's bits")
                writer.add(part.column("doc_id").to_pylist(), ids, bounds)
        if not writer.docs:
            return
        fs, path = _open(folder)
        number = TaskContext.get().partitionId()
        name = f"{number:06d}-{uuid.uuid4().hex}.bpk"
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{name}") as out:
            writer.write(out)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([number], pa.int64()), "file": [name],
                                          "n_ids": pa.array([sum(int(s.sum()) for s in writer.sizes)], pa.int64())})
    return shards


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int, end_id: int = 0, id_col: str = "doc_id",
                 text: str = "text", shards: int | None = None) -> DataFrame:
    """Write every document's ids in ascending id order below ``folder``; the manifest (shard, file, n_ids, first_id)."""
    spark = docs.sparkSession
    bits = max(1, (vocabulary - 1).bit_length())
    ordered = (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
               .repartitionByRange(shards or 2 * shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id"))
    made = pin(ordered.mapInArrow(_shards(folder, tokenizer, end_id, bits), "shard long, file string, n_ids long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return made.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def _read(folder: str):
    def read(batches):
        fs, path = _open(folder)
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first_id").to_pylist()):
                with fs.open_input_file(f"{path}/{name}") as f:
                    shard = Reader(f)
                    n, i = len(shard.docs), 0
                    while i < n:  # documents of about a million ids at a time
                        j = max(i + 1, int(np.searchsorted(shard.first, shard.first[i] + (1 << 20), side="right")) - 1)
                        ids, at = shard.ids(int(shard.first[i]), int(shard.first[j])), shard.first[i:j + 1] - shard.first[i]
                        crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": shard.docs[i:j], "start": pa.array(first + shard.first[i:j], pa.int64()),
                            "n_tokens": pa.array(np.diff(at), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})
                        i = j
    return read


def read_digest(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files of a manifest."""
    n = 2 * shuffle_partitions(manifest.sparkSession)
    return (manifest.repartition(n, "shard").mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def round_trip(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int = 0, folder: str | None = None, **kw) -> DataFrame:
    """Write the ids, read them back: what the files hold of each document."""
    folder = folder or scratch_path(docs.sparkSession, f"tokens/{uuid.uuid4().hex}")
    return read_digest(write_tokens(docs, folder, tokenizer, vocabulary, end_id, **kw), folder)


def to_bytes(doc_ids: list, ids: np.ndarray, bounds: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """One shard in memory."""
    out, writer = io.BytesIO(), Writer(bits, block_ids)
    writer.add(doc_ids, ids, bounds)
    writer.write(out)
    return out.getvalue()
