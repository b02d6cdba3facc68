"""Copy-on-write tables in key buckets: merges that rewrite only what a batch touches.

A bucketed table is a set of Parquet folders and a *manifest* with one row per key bucket, naming the folder that
holds the bucket's rows now. The bucket of a row is a hash of its key (NULL parts included), so a merge finds the rows of its
batch in the batch's own buckets:

* it reads the buckets that the batch touches, and no other folder;
* it writes their new content to a new folder, rows dealt by bucket in one shuffle that AQE splits where a bucket is hot;
* it commits by writing the next manifest (``v=<n>``, readable once its ``_SUCCESS`` marker exists). Buckets that were not
  touched keep their files. A failed merge leaves an unnamed folder behind and the table as it was; a second writer
  of the same version fails, because the folder of that version exists.

The manifest has as many rows as the table has buckets (a parameter, chosen for buckets of a good file's size), whatever the
number of rows; those names are what the driver sees, as for any file listing.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators import history
from carelake.session import remove, store
from carelake.sources.io import _fs_and_path, committed_versions, layer_path, read_current, write_version

BUCKET = "__bucket"


@dataclass
class MergeReport:
    """What a merge did: the version it committed, the buckets it read and those it wrote, of how many."""
    version: str | None
    read: list[int]
    written: list[int]
    buckets: int


class BucketedTable:
    """``<root>/<layer>/<name>``: manifests ``v=<n>``; rows in ``<root>/<layer>/<name>.data/<write>/__bucket=<b>``."""

    def __init__(self, spark: SparkSession, root: str, layer: str, name: str, key: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.layer, self.name = spark, root, layer, name
        self.key, self.buckets = list(key), buckets

    # --- state ---------------------------------------------------------------------------------

    @property
    def data(self) -> str:
        return layer_path(self.root, self.layer, f"{self.name}.data")

    def manifest(self) -> dict[int, str]:
        """Bucket -> folder of the newest committed version; buckets without rows are absent."""
        m = read_current(self.spark, self.root, self.layer, self.name)
        return {} if m is None else {r["bucket"]: r["folder"] for r in m.collect()}

    def versions(self) -> list[int]:
        return committed_versions(self.spark, self.root, self.layer, self.name)

    def bucket_of(self, types: dict | None = None) -> Column:
        """The key's bucket. A NULL part is a value of its own; ``types`` casts the parts of a batch to the table's."""
        cols = []
        for k in self.key:
            c = F.col(f"`{k}`").cast(types[k]) if types else F.col(f"`{k}`")
            cols += [c, c.isNull()]
        return F.pmod(F.xxhash64(*cols), F.lit(self.buckets)).cast("int")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The rows of all buckets, or of the given ones; only their folders are opened. None if there are none."""
        held = self.manifest()
        return self._open([held[b] for b in sorted(held if buckets is None else set(buckets) & set(held))])

    def _open(self, folders: Sequence[str]) -> DataFrame | None:
        return self.spark.read.parquet(*folders) if folders else None

    # --- writes --------------------------------------------------------------------------------

    def _write(self, df: DataFrame, held: dict[int, str], replaced: Sequence[int]) -> tuple[str, list[int]]:
        """Store ``df`` by bucket in a new folder and commit a manifest in which it stands for the ``replaced`` buckets."""
        folder = os.path.join(self.data, uuid.uuid4().hex)
        schema = self._schema(held)
        if schema is not None:  # every folder of a table has the table's columns and types
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
        (df.withColumn(BUCKET, self.bucket_of()).hint("rebalance", BUCKET)
         .write.mode("errorifexists").partitionBy(BUCKET).parquet(folder))
        written = self._written(folder)
        rows = {b: f for b, f in held.items() if b not in set(replaced)}
        rows.update({b: os.path.join(folder, f"{BUCKET}={b}") for b in written})
        manifest = self.spark.createDataFrame(sorted(rows.items()), "bucket int, folder string").coalesce(1)
        return write_version(manifest, self.root, self.layer, self.name), written

    def _written(self, folder: str) -> list[int]:
        """The buckets that a write left rows in, by its folder names."""
        fs, path = _fs_and_path(self.spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))

    def create(self, df: DataFrame) -> MergeReport:
        """The first version, or a full replacement."""
        version, written = self._write(df, {}, list(range(self.buckets)))
        return MergeReport(version, [], written, self.buckets)

    def merge(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> MergeReport:
        """Replace the batch's buckets by ``merge(their rows, batch)``; the batch is computed once."""
        held = self.manifest()
        kept, path = store(batch, "merge-batch")
        try:
            types = self._types(held)
            touched = self._touched(kept, types)
            if not touched:
                return MergeReport(None, [], [], self.buckets)
            read = [b for b in touched if b in held]
            current = self._open([held[b] for b in read])
            if current is None:  # none of these buckets has rows yet
                current = self._empty(held, kept)
            version, written = self._write(merge(current, kept), held, touched)
            return MergeReport(version, read, written, self.buckets)
        finally:
            remove(self.spark, path)

    def _schema(self, held: dict[int, str]) -> T.StructType | None:
        return self._open([held[min(held)]]).schema if held else None

    def _types(self, held: dict[int, str]) -> dict | None:
        schema = self._schema(held)
        return None if schema is None else {k: schema[k].dataType for k in self.key}

    def _touched(self, batch: DataFrame, types) -> list[int]:
        """At most one number per bucket."""
        return sorted(r[0] for r in batch.select(self.bucket_of(types).alias("b")).distinct().collect())

    def _empty(self, held, batch: DataFrame) -> DataFrame:
        return self._open([held[min(held)]]).limit(0) if held else batch.limit(0)

    def upsert(self, batch: DataFrame) -> MergeReport:
        """Type-1 upsert; NULL key parts match each other."""
        return self.merge(batch, lambda current, new: history.upsert_null_safe(current, new, self.key))

    def scd2_merge(self, batch: DataFrame, attrs: Sequence[str], as_of) -> MergeReport:
        """SCD-2 merge. The batch is first held against (key, hash) of the open rows of its buckets, two narrow columns, so a
        full snapshot rewrites only the buckets in which something is new or changed."""
        held = self.manifest()
        types = self._types(held)
        kept, path = store(batch, "snapshot")
        try:
            touched = [b for b in self._touched(kept, types) if b in held]
            current = self._open([held[b] for b in touched])
            if current is None:
                return self.merge(kept, lambda now, new: self._first(now, new, attrs, as_of))
            if history.HASH not in current.columns:
                current = current.withColumn(history.HASH, history.attribute_hash(attrs))
            open_rows = current.where(history.CURRENT).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.key)],
                                                              F.col(history.HASH).alias("__h"))
            same = F.col("__h") == history.attribute_hash(attrs)
            for i, k in enumerate(self.key):
                same = same & F.col(f"__k{i}").eqNullSafe(F.col(k))
            changed = kept.join(open_rows, same, "left_anti")
            return self.merge(changed, lambda now, new: self._first(now, new, attrs, as_of))
        finally:
            remove(self.spark, path)

    def _first(self, now: DataFrame, new: DataFrame, attrs, as_of) -> DataFrame:
        if history.CURRENT not in now.columns:  # a new table: its schema comes from the batch
            return (history.scd2_init(new, as_of).withColumns({history.HASH: history.attribute_hash(attrs),
                                                                history.VERSION: F.lit(1)}))
        return history.scd2_merge(now, new, self.key, attrs, as_of)
