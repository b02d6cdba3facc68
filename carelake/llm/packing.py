"""Packing by power-of-two decomposition (operator 5).

A document of n tokens is cut into floor(n / longest) pieces of ``longest`` tokens (a power of two) and
the binary decomposition of the rest, longest first: 2**k for each bit of n. Every piece is a
sequence of its own, so no sequence crosses documents and none needs padding; sequences of one length
form a bucket (``length``) that trains as a batch. The number of pieces is the number of set
bits, so no piece is wasted on a document longer than the limit.

Documents are numbered by one range partitioning of (doc_id, n_pieces), so sequence ids are dense and
follow the document order without passing through one task.

Defined cases: null or empty text is the end id alone (one piece of length 1); a null id sorts first; rows with the
same id are documents of their own; extra columns are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.blocks import give_back, in_slices
from carelake.llm.numbering import running_sum
from carelake.llm.tokens import encode_rows
from carelake.session import pin


def piece_lengths(n: int, longest: int) -> list[int]:
    """The lengths into which n tokens are cut: ``longest`` as often as it fits, then the rest's powers of two."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(path: str, end_id: int, longest: int, with_ids: bool):
    def pieces(batches):
        for batch in batches:
            for _, part in in_slices(pa.Table.from_batches([batch])):
                ids, bounds = encode_rows(part.column("text"), path, end_id)
                row, start, length, crc, data, last = [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    at = a
                    for n in piece_lengths(b - a, longest):
                        raw = ids[at:at + n].tobytes()
                        row.append(i)
                        start.append(at - a)
                        length.append(n)
                        crc.append(zlib.crc32(raw))
                        if with_ids:
                            data.append(ids[at:at + n])
                        at += n
                    last.append(len(row))
                n_pieces = np.diff([0, *last])
                own = np.array(row, dtype=np.int64)
                cols = {"doc_id": part.column("doc_id").combine_chunks().take(pa.array(own)),
                        "row_key": part.column("row_key").combine_chunks().take(pa.array(own)),
                        "n_pieces": pa.array(n_pieces[own] if len(own) else own, pa.int64()),
                        "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                        "doc_tokens": pa.array(np.diff(bounds)[own], pa.int64()),
                        "piece": pa.array(np.arange(len(own)) - np.concatenate([[0], last[:-1]]).astype(np.int64)[own] if len(own) else own, pa.int64())}
                if with_ids:
                    cols["ids"] = pa.array(data, pa.list_(pa.uint32())).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(cols)
            give_back()
    return pieces


def pack_powers(docs: DataFrame, tokenizer: str, end_id: int = 1, longest: int = 2048, id_col: str = "doc_id",
                text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of every piece."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    dealt = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
                        F.monotonically_increasing_id().alias("row_key"))
    schema = ("doc_id long, row_key long, n_pieces long, start long, length long, ids_crc32 long, doc_tokens long, piece long"
              + (", ids array<long>" if with_ids else ""))
    pieces = pin(dealt.mapInArrow(_pieces(tokenizer, end_id, longest, with_ids), schema), "pieces")
    rows = pieces.where("piece = 0").select("doc_id", "row_key", "n_pieces")
    before = running_sum(rows, ["doc_id", "row_key"], "n_pieces", "first_sequence").select("row_key", "first_sequence")
    return (pieces.join(before, "row_key")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first_sequence") + F.col("piece")).alias("sequence_id"),
                    F.lit(0).cast("long").alias("offset"), *(["ids"] if with_ids else [])))
