"""SimHash near-duplicates by covering locality-sensitive hashing (operator 12).

A document's fingerprint has a bit set if more than half of the XXH64 hashes of its word shingles have. Two documents are
linked when their fingerprints differ in ``RADIUS`` bits or fewer.

Covering masks: every bit position gets a non-zero vector of ``RADIUS + 1`` bits, every non-zero vector v of that length a
table, and table v keeps the positions whose vector has an odd product with v. Any ``RADIUS`` positions have a v at right
angles to all their vectors, so two fingerprints that differ there alone agree in table v: each pair within the radius
meets in some bucket, by construction, not by chance.

* Copies collapse first: one row per distinct fingerprint goes through the tables, in one row per table.
* Buckets are never compared pair by pair. A fingerprint of a bucket with company names its *midpoints*: itself, and itself
  with one of the bits flipped that the table leaves out. Two fingerprints differ in at most two of those bits
  exactly when they name a common midpoint, and all that name one are within two bits of each other, so
  a midpoint's group needs no check, holds 65 fingerprints at most, and links all to its smallest. A bucket with a third
  of all rows is as many rows times 28, spread over all midpoints.
* Links are joined to components in Spark (``components.py``).

Defined cases: null and wordless texts have fingerprint zero and are linked like others; fewer words than a shingle make one
shingle; rows with one id are rows of their own; a null id counts as larger than any other (a component of null ids
alone has a null id). Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.blocks import in_slices
from carelake.llm.components import components
from carelake.llm.words import Words, ragged
from carelake.session import pin

BITS = 64
RADIUS = 2  # the midpoints are made for two differing bits
SHINGLE = 3
SEED = 42  # of XXH64

# a byte's bits, most significant first, each in a byte lane of its own
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()
_LANE_MOST = 255  # a lane counts so far


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """2**(radius + 1) - 1 masks: any two words that differ in ``radius`` bits or fewer agree under one of them."""
    tables = 2 ** (radius + 1) - 1
    vector = [1 + i % tables for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, tables + 1)]


# --- fingerprints -----------------------------------------------------------------------------------------------

def shingle_hashes(words: Words, n: int = SHINGLE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, first shingle of each row): ``n`` words joined by one space."""
    length = words.ends - words.starts
    joined = np.empty(int((length + 1).sum()), dtype=np.uint8)  # every word, and a space
    at = np.concatenate([[0], np.cumsum(length + 1)])
    joined[at[1:] - 1] = 0x20
    body = np.ones(len(joined), dtype=bool)
    body[at[1:] - 1] = False
    joined[body] = words.data[ragged(words.starts, length)]
    raw = joined.tobytes()
    count = np.where(words.counts >= n, words.counts - n + 1, np.minimum(words.counts, 1))
    first = ragged(words.bounds[:-1], count)
    last = first + np.repeat(np.minimum(words.counts, n), count)
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(raw[a:b], seed) for a, b in zip(at[first].tolist(), (at[last] - 1).tolist())], dtype=np.uint64)
    return hashes, np.concatenate([[0], np.cumsum(count)])


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The fingerprint of every row: bits set in over half of its hashes, zero without hashes."""
    n = np.diff(bounds)
    full = np.flatnonzero(n)
    out = np.zeros(len(n), dtype=np.uint64)
    if not len(full):
        return out
    # sums of at most _LANE_MOST hashes fit the byte lanes; they are then added in wide integers
    parts = -(-n[full] // _LANE_MOST)
    step = ragged(np.zeros(len(full), dtype=np.int64), parts)
    cut = np.repeat(bounds[:-1][full], parts) + step * _LANE_MOST
    lanes = _LANES[hashes.astype(">u8").view(np.uint8).reshape(-1, 8)]
    sums = np.ascontiguousarray(np.add.reduceat(lanes, cut, axis=0)).view(np.uint8)
    total = np.add.reduceat(sums.astype(np.int64), np.concatenate([[0], np.cumsum(parts)[:-1]]), axis=0)
    bits = 2 * total > n[full][:, None]
    out[full] = np.packbits(bits, axis=1).view(">u8").ravel()
    return out


def _fingerprint(n: int, seed: int):
    def fingerprint(batches):
        for batch in batches:
            for _, part in in_slices(pa.Table.from_batches([batch])):
                prints = majority(*shingle_hashes(Words(part.column("text"), fold=True), n, seed))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id").combine_chunks(),
                                                  "fp": pa.array(prints.view(np.int64))})
    return fingerprint


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` holds the 64 bits as a long."""
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
            .mapInArrow(_fingerprint(n, seed), "doc_id long, fp long"))


# --- links ------------------------------------------------------------------------------------------------------

def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(nodes: DataFrame, fp: str = "fp") -> DataFrame:
    """Links (u, v) between distinct fingerprints that join all pairs within ``RADIUS`` bits: every midpoint's fingerprints
    to the smallest of them."""
    tables = covering_masks()
    left_out = [[_signed(1 << i) for i in range(BITS) if not mask >> i & 1] for mask in tables]
    flips = {v: F.array(F.lit(0).cast("long"), *[F.lit(b).cast("long") for b in bits]) for v, bits in enumerate(left_out)}
    keyed = nodes.select(F.col(fp).alias("fp"), F.posexplode(F.array(*[F.col(fp).bitwiseAND(F.lit(_signed(m)).cast("long")) for m in tables]))
                         .alias("table", "key"))
    company = keyed.groupBy("table", "key").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("table", "key")
    met = keyed.join(company, ["table", "key"])
    which = F.coalesce(*[F.when(F.col("table") == v, bits) for v, bits in flips.items()])
    middle = met.select("fp", F.explode(which).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    # at most 65 fingerprints lie within one bit of a midpoint
    groups = middle.groupBy("mid").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return (groups.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).where("u <> v").distinct())


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp, component_id) of every row; the component is the smallest id that links reach."""
    prints = pin(fingerprints(docs, id_col, text, n, seed), "prints")
    nodes = pin(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "print-nodes")
    joined = components(links(nodes)).withColumnRenamed("node", "fp")
    named = nodes.join(joined, "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    labels = pin(named.join(least, "component").select("fp", "component_id"), "print-labels")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")
