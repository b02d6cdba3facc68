"""Fact tables that append each key once, found through an index of their files.

Beside the table's Parquet files stands a small side table, ``<table>.files``: of each data file the rows, the least and
greatest value of the first key column, and whether that column holds NULL. A batch is dealt to sorted ranges of that
column; only files whose values meet one of those ranges can hold a key of the batch, so only their key columns are read,
in whichever partition of the table they lie: a key whose partition value has changed is found as well.

Files are written sorted by partition and key, so each covers a narrow range, and carry Parquet Bloom filters on the key
columns: where a batch has few keys they are pushed to the scan as an IN list and Bloom filters skip row groups.

The index is derived from the files: ``refresh`` reads the key columns of data files that it does not list yet, so a writer
lost between its data and its index leaves nothing wrong. What reaches the driver is one row per file, as with any file
listing, and one range per shuffle partition. One writer at a time.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass
from typing import Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import remove, store
from carelake.sources.io import _fs_and_path


@dataclass
class AppendReport:
    """Rows appended, and how many of the table's files were read to find keys that are there already."""
    rows: int
    files_read: int
    files: int


def _plain(uri: str) -> str:
    """A file's path without scheme and escapes, to compare listings with."""
    return unquote(urlparse(uri).path)


class IndexedTable:
    """A Parquet table at ``path`` whose rows are told apart by ``key`` (NULL parts equal each other)."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], partition_by: Sequence[str] = ()):
        self.spark, self.path, self.key, self.partition_by = spark, path.rstrip("/"), list(key), list(partition_by)
        self.index_path = f"{self.path}.files"

    def _exists(self, path: str) -> bool:
        fs, p = _fs_and_path(self.spark, path)
        return fs.exists(p)

    def data_files(self) -> dict[str, str]:
        """Plain path -> URI of the table's committed files."""
        if not self._exists(self.path):
            return {}
        return {_plain(f): f for f in self.spark.read.parquet(self.path).inputFiles()}

    def _indexed(self) -> DataFrame | None:
        return self.spark.read.parquet(self.index_path) if self._exists(self.index_path) else None

    def refresh(self) -> list:
        """Index the files that are not listed yet; returns the index rows of the table's files."""
        files, index = self.data_files(), self._indexed()
        if not files:
            return []
        known = {r.path for r in index.select("path").collect()} if index is not None else set()
        new = [uri for p, uri in files.items() if p not in known]
        if new:
            rows = self.spark.read.option("basePath", self.path).parquet(*new)
            first = F.col(f"`{self.key[0]}`")
            found = {_plain(r.uri): r for r in rows.groupBy(F.col("_metadata.file_path").alias("uri")).agg(
                F.count(F.lit(1)).alias("rows"), F.min(first).alias("low"), F.max(first).alias("high"),
                F.bool_or(first.isNull()).alias("nulls")).collect()}
            kind = rows.schema[self.key[0]].dataType.simpleString()
            # a file without rows has no group; it is listed so that it is not read again
            listed = [(p, *((r.rows, r.low, r.high, r.nulls) if (r := found.get(p)) else (0, None, None, False)))
                      for p in map(_plain, new)]
            (self.spark.createDataFrame(listed, f"path string, rows long, low {kind}, high {kind}, nulls boolean")
             .coalesce(1).write.mode("append").parquet(self.index_path))
        return [r for r in self._indexed().collect() if r.path in files]

    def candidates(self, batch: DataFrame) -> tuple[list[str], int]:
        """(URIs of the files that may hold a key of the batch, number of files)."""
        index = self.refresh()
        if not index:
            return [], 0
        first = F.col(f"`{self.key[0]}`")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        ranges = (batch.select(first.alias("k")).repartitionByRange(n, "k").groupBy(F.spark_partition_id().alias("part"))
                  .agg(F.min("k").alias("low"), F.max("k").alias("high"), F.bool_or(F.col("k").isNull()).alias("nulls")).collect())
        spans = sorted((r.low, r.high) for r in ranges if r.low is not None)
        highs, nulls = [h for _, h in spans], any(r.nulls for r in ranges)

        def meets(f) -> bool:
            if f.nulls and nulls:
                return True
            if f.low is None:
                return False
            at = bisect.bisect_left(highs, f.low)
            return at < len(spans) and spans[at][0] <= f.high

        files = self.data_files()
        return [files[f.path] for f in index if meets(f)], len(index)

    def _held(self, batch: DataFrame, uris: list[str]) -> DataFrame:
        """The keys that the candidate files hold."""
        held = self.spark.read.option("basePath", self.path).parquet(*uris).select(*self.key)
        few = int(self.spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold"))
        if len(self.key) == 1:
            keys = [r[0] for r in batch.select(*self.key).limit(few + 1).collect()]  # more than few: the join decides alone
            if len(keys) <= few and None not in keys:
                held = held.where(F.col(f"`{self.key[0]}`").isin(keys))
        return held

    def new_rows(self, batch: DataFrame) -> tuple[DataFrame, int, int]:
        """(the rows of a batch of distinct keys whose key the table does not hold, files read, files)."""
        uris, n = self.candidates(batch)
        if not uris:
            return batch, 0, n
        held = self._held(batch, uris).select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(self.key)])
        same = F.lit(True)
        for i, k in enumerate(self.key):
            same = same & batch[k].eqNullSafe(held[f"__k{i}"])
        return batch.join(held, same, "left_anti"), len(uris), n

    def append_new(self, batch: DataFrame) -> AppendReport:
        """Append the rows whose key is not in the table yet, one a key. The batch is stored once in the shared folder,
        so that ranges, look-up and write see the same rows."""
        rows, path = store(batch.dropDuplicates(self.key), "batch")
        try:
            new, read, files = self.new_rows(rows)
            order = [*self.partition_by, *self.key]
            writer = new.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("append")
            for k in self.key:  # a dictionary would stand in the Bloom filter's place
                writer = (writer.option(f"parquet.bloom.filter.enabled#{k}", "true").option(f"parquet.enable.dictionary#{k}", "false")
                          .option("parquet.bloom.filter.adaptive.enabled", "true"))
            if self.partition_by:
                writer = writer.partitionBy(*self.partition_by)
            before = self.rows()
            writer.parquet(self.path)
            return AppendReport(self.rows() - before, read, files)
        finally:
            remove(self.spark, path)

    def rows(self) -> int:
        """Rows of the table, from the index."""
        return sum(r.rows for r in self.refresh())
