"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Settings that matter for the warehouse workload at any scale.
#  * AQE re-plans joins from runtime sizes (broadcast only what proved small),
#    coalesces small shuffle partitions and splits skewed ones.
#  * ANSI stays on: strict casts must fail loudly, safe casts use try_cast.
#  * UTC session time zone: date keys never shift with the client's zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "carelake", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the warehouse defaults.

    On a cluster the master and sizing come from spark-submit; locally (tests,
    bench) pass ``master="local[8]"``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    The cluster setting always wins. Only when it is unset (unit tests, a laptop)
    a private scratch folder is created so ``DataFrame.checkpoint()`` works.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="carelake-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables, under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "carelake", name)


def _parquet_storable(t: T.DataType) -> bool:
    if isinstance(t, T.NullType):
        return False
    if isinstance(t, T.StructType):
        return all(_parquet_storable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _parquet_storable(t.elementType)
    if isinstance(t, T.MapType):
        return _parquet_storable(t.keyType) and _parquet_storable(t.valueType)
    return True


def store(df: DataFrame, name: str = "pinned") -> tuple[DataFrame, str | None]:
    """``pin`` with the path of the stored table (None for a ``checkpoint()``), for a caller that removes it."""
    spark = df.sparkSession
    if not all(_parquet_storable(f.dataType) for f in df.schema.fields):
        checkpoint_dir(spark)
        return df.checkpoint(eager=True), None
    path = scratch_path(spark, f"pins/{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path), path


def remove(spark: SparkSession, path: str | None) -> None:
    """Delete a stored table that nothing reads any more."""
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def pin(df: DataFrame, name: str = "pinned") -> DataFrame:
    """Compute ``df`` once, store it in the shared checkpoint folder, return a scan of it.

    Like ``checkpoint()`` this cuts the lineage (a lost executor re-reads the
    stored files instead of replaying the plan), but the table is Parquet, so
    every later reader prunes columns, pushes filters into the scan and reads
    vectorised batches, and a row count is answered from file metadata. Inputs
    holding a type Parquet cannot store fall back to ``checkpoint()``.
    """
    return store(df, name)[0]
