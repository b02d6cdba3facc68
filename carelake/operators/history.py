"""Slowly-changing history, upserts and incremental loads.

Plain Parquet has no MERGE: every operation here is expressed as joins and
unions that produce the complete new version of the table, which the caller
writes to a new path (``sources.io.merge_version``: the next ``v=<n>`` folder,
read once committed) or overwrites only the touched partitions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FROM, TO, CURRENT, HASH, VERSION = ("date_debut_validite", "date_fin_validite", "est_actuel",
                                    "hash_attributs", "numero_version")


def scd2_init(df: DataFrame, as_of) -> DataFrame:
    """Initial load — every row current, valid from ``as_of`` (the reference's stub, T20)."""
    return df.withColumns({
        FROM: F.lit(as_of).cast("date"),
        TO: F.lit(None).cast("date"),
        CURRENT: F.lit(True),
    })


def attribute_hash(attrs: Sequence[str]) -> F.Column:
    """SHA-256 over the tracked attributes (NULL-safe via a marker)."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(F.col(a).cast("string"), F.lit("∅"))
                                      for a in attrs]), 256)


def scd2_history(df: DataFrame, key: Sequence[str], attrs: Sequence[str], order: str | Sequence[str],
                 date_col: str | None = None, chunk: int = 100_000) -> DataFrame:
    """Versions from a dated feed of snapshots.

    A new version starts whenever the attribute hash differs from the previous
    snapshot of the key (``lag``); its validity ends the day before the next
    version starts (``lead``); the last version is current. ``order`` gives a
    total order of snapshots within a key, ``date_col`` the validity date.

    The snapshots are numbered once and cut into chunks of ``chunk`` numbers, so a key with a
    huge history is not one task. A chunk numbers its own versions of a key; only a key that goes on over a
    chunk's edge needs to know of other chunks, so one row per such key and chunk (at most two a chunk) carries
    how many versions came before and when the next one starts.
    """
    from carelake.operators.measures import SEQ, in_chunks
    order = [order] if isinstance(order, str) else list(order)
    start = F.struct(F.col(date_col or order[0]).cast("date").alias("d"))  # a struct: a version may start at a NULL date
    _, rows = in_chunks(df.withColumn(HASH, attribute_hash(attrs)), key, order, before=1, chunk=chunk)
    w = Window.partitionBy("__chunk", *key).orderBy(SEQ)
    prev = F.lag(HASH).over(w)
    own = rows.withColumn("__new", prev.isNull() | (prev != F.col(HASH))).where("__own").drop("__own")

    edge = [F.col(k).alias(f"__key_{k}") for k in key]
    groups = own.groupBy(F.col("__chunk").alias("__at"), *edge).agg(
        F.count_if("__new").alias("__n"), F.min_by(F.when(F.col("__new"), start), F.when(F.col("__new"), F.col(SEQ))).alias("__first"),
        F.min(F.pmod(F.col(SEQ) - 1, F.lit(chunk))).alias("__lo"), F.max(F.pmod(F.col(SEQ), F.lit(chunk)) == 0).alias("__ends"))
    over = Window.partitionBy(*[f"__key_{k}" for k in key])
    ahead = over.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    behind = over.orderBy(F.col("__at").desc()).rowsBetween(Window.unboundedPreceding, -1)
    edges = groups.where((F.col("__lo") == 0) | F.col("__ends")).select(
        "__at", *[f"__key_{k}" for k in key], F.sum("__n").over(ahead).alias("__before"),
        F.last("__first", ignorenulls=True).over(behind).alias("__after"))

    versions = own.where("__new").select("*", F.row_number().over(w).alias("__pos"), F.lead(start).over(w).alias("__next"))
    same = F.col("__chunk") == F.col("__at")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    following = F.coalesce("__next", "__after")
    return versions.join(edges, same, "left").select(
        *df.columns, HASH, following.isNull().alias(CURRENT),
        (F.col("__pos") + F.coalesce("__before", F.lit(0))).cast("int").alias(VERSION),
        start["d"].alias(FROM), F.date_sub(following["d"], 1).alias(TO))


def scd2_merge(current: DataFrame, incoming: DataFrame, key: Sequence[str],
               attrs: Sequence[str], as_of) -> DataFrame:
    """Merge a new snapshot into an SCD-2 table.

    * closed history rows pass through untouched;
    * a current row whose attributes changed is closed at ``as_of - 1`` and a new
      current version is added;
    * unseen keys are inserted as version 1; unchanged keys keep their row.
    Both sides meet in one full outer join on the key (current rows only); NULL key parts
    are equal to each other, so a current row never falls out of the result.
    """
    as_of_d = F.lit(as_of).cast("date")
    if HASH not in current.columns:
        current = current.withColumn(HASH, attribute_hash(attrs))
    if VERSION not in current.columns:
        current = current.withColumn(VERSION, F.lit(1))
    cols = [c for c in current.columns]
    closed = current.where(~F.col(CURRENT))
    open_ = current.where(F.col(CURRENT))
    inc = incoming.withColumn(HASH, attribute_hash(attrs))

    o = open_.withColumn("__old", F.lit(True)).alias("o")
    i = inc.withColumn("__new", F.lit(True)).alias("i")
    # NULL key parts match each other; presence is told by the side's own mark, never by a key
    match = F.lit(True)
    for k in key:
        match = match & F.col(f"o.{k}").eqNullSafe(F.col(f"i.{k}"))
    old, new = F.col("o.__old").isNotNull(), F.col("i.__new").isNotNull()
    changed = old & new & (F.col(f"o.{HASH}") != F.col(f"i.{HASH}"))
    types = {f.name: f.dataType for f in current.schema.fields}

    def existing(closing: bool) -> F.Column:
        return F.struct(*[(F.date_sub(as_of_d, 1) if closing and c == TO else F.lit(False) if closing and c == CURRENT
                           else F.col(f"o.{c}")).cast(types[c]).alias(c) for c in cols])

    fixed = {FROM: as_of_d, TO: F.lit(None), CURRENT: F.lit(True), VERSION: F.coalesce(F.col(f"o.{VERSION}"), F.lit(0)) + 1}
    version = F.struct(*[(fixed[c] if c in fixed else F.col(f"i.{c}") if c in inc.columns else F.lit(None))
                         .cast(types[c]).alias(c) for c in cols])
    # one join; each joined row gives the versions that follow from it
    out = (F.when(changed, F.array(existing(True), version))
           .when(old, F.array(existing(False))).otherwise(F.array(version)))
    merged = o.join(i, match, "full_outer").select(F.explode(out).alias("v")).select("v.*")
    return closed.unionByName(merged)


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Type-1 upsert — source rows replace target rows with the same key."""
    return source.unionByName(target.join(source.select(*key).distinct(), list(key), "left_anti"))


def upsert_null_safe(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """D07 with NULL key parts equal to each other."""
    ks = source.select(*[F.col(k).alias(f"__s{i}") for i, k in enumerate(key)]).distinct()
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & target[k].eqNullSafe(ks[f"__s{i}"])
    return source.unionByName(target.join(ks, same, "left_anti"))


def append_new(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The source rows whose key is not yet in the target (incremental fact load).

    The caller appends them (or overwrites only their date partitions).
    """
    return source.join(target.select(*key), list(key), "left_anti")
