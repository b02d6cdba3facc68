"""Residual, pseudonym and containment joins.

J08 is the reference's correlated lookup

    coalesce((select sk from dim where col1 like '%' || x || '%' limit 1),
             (select sk from dim where col2 like ...), (... col3 ...), -1)

which, planned literally, compares every needle with every dimension row.
``containment_lookup`` turns it into equi-joins:

* all haystack columns are stacked into one table of (column priority, sk, text), read
  from the dimension once and stored; its strings are exploded into their substrings of
  length k for the needle lengths that occur, up to K: one positional gram index;
* "the first column that contains it, and there the smallest sk" is then one minimum of
  (priority, sk) per needle: no step waits for the one before it, and nothing is replanned;
* a needle shorter than K is contained exactly when it equals a gram of its length: grams
  of length < K are reduced to the least (priority, sk) per (k, gram) before the join, so
  short needles never fan out and need no verification;
* a longer needle is keyed by its rarest K-gram in the index (counts per gram aggregated
  map-side) and equi-joins only the positions carrying it; ``contains`` verifies the needle;
* needles found nowhere get -1.

Needles of length >= K fan out only to the index positions of their rarest K-gram, and
their minimum is aggregated map-side before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.keys import lookup
from carelake.session import pin

GRAM_MAX = 8


def haystacks(dim: DataFrame, sk: str, hay_cols: Sequence[str]) -> DataFrame:
    """(__prio, __sk, __hay): the dimension's columns stacked in priority order, NULLs left out; one scan."""
    cols = F.array(*[F.col(c).cast("string") for c in hay_cols])
    return (dim.select(F.col(sk).alias("__sk"), F.posexplode(cols).alias("__prio", "__hay"))
            .where(F.col("__hay").isNotNull()).select((F.col("__prio") + 1).alias("__prio"), "__sk", "__hay"))


def _grams(hay: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(__k, __g, __prio, __sk, __hay) for every substring whose length k is in ``ks`` (one row per position; k = 0
    gives the empty gram once per string)."""
    k, n = F.col("__k"), F.length("__hay")
    kk = hay.select("*", F.explode(F.array(*[F.lit(x) for x in ks])).alias("__k")).where(n >= k)
    pos = kk.select("*", F.explode(F.sequence(F.lit(1), F.when(k == 0, F.lit(1)).otherwise(n - k + 1))).alias("__pos"))
    return pos.select("__k", F.when(k == 0, F.lit("")).otherwise(F.substring("__hay", F.col("__pos"), k)).alias("__g"),
                      "__prio", "__sk", "__hay")


def containment_lookup(needles: DataFrame, needle: str, dim: DataFrame,
                       hay_cols: Sequence[str], sk: str, default: int = -1,
                       k_max: int = GRAM_MAX, with_step: bool = False) -> DataFrame:
    """For each distinct needle, the smallest ``sk`` whose ``hay_cols[i]``
    contains it, trying the columns in order; ``default`` when none does.

    Returns ``(needle, sk[, step])`` with one row per distinct needle (NULL
    needles map to ``default``, as ``LIKE NULL`` never matches).
    """
    # the distinct needles and the stacked haystacks are computed once and stored (Parquet in the
    # shared checkpoint folder): both branches read them without running their sources again
    k = F.least(F.length("__n"), F.lit(k_max))
    distinct = pin(needles.select(F.col(needle).cast("string").alias("__n")).distinct()
                   .withColumns({"__k": k, "__g": F.when(k == 0, F.lit("")).otherwise(F.substring("__n", 1, k))}),
                   "needles")
    keyed = distinct.where(F.col("__n").isNotNull())
    hay = pin(haystacks(dim, sk, hay_cols), "haystacks")

    # the key lengths present: at most k_max + 1 small integers (branches without
    # needles are left out of the plan)
    ks = sorted(r[0] for r in keyed.select("__k").distinct().collect())
    short_ks = [x for x in ks if x < k_max]
    first = F.min(F.struct("__prio", "__sk")).alias("__first")
    parts = []
    if short_ks:
        grams = _grams(hay, short_ks).groupBy("__k", "__g").agg(first)
        parts.append(keyed.where(F.col("__k") < k_max).join(grams, ["__k", "__g"]).select("__n", "__first"))
    if k_max in ks:
        pos = _grams(hay, [k_max])
        # how many positions carry each K-gram (partial counts before the shuffle)
        freq = pos.groupBy("__g").agg(F.count(F.lit(1)).alias("__c"))
        # the needle is keyed by its rarest K-gram, so it meets only the positions of that gram. A K-gram
        # found nowhere (count 0) proves that the needle is not contained: it is dropped before any fan-out.
        ng = (keyed.where(F.col("__k") == k_max)
              .select("__n", F.explode(F.sequence(F.lit(1), F.length("__n") - k_max + 1)).alias("__p"))
              .select("__n", F.substring("__n", F.col("__p"), k_max).alias("__g")))
        rarest = (ng.join(freq, "__g", "left").groupBy("__n")
                  .agg(F.min(F.struct(F.coalesce("__c", F.lit(0)).alias("c"), F.col("__g").alias("g"))).alias("__m"))
                  .where(F.col("__m.c") > 0).select("__n", F.col("__m.g").alias("__g")))
        parts.append(rarest.join(pos, "__g").where(F.col("__hay").contains(F.col("__n"))).groupBy("__n").agg(first))

    found = None
    for p in parts:
        found = p if found is None else found.unionByName(p)
    distinct = distinct.select("__n")
    nothing = F.lit(None).cast("struct<__prio: int, __sk: bigint>")
    out = distinct.join(found, "__n", "left") if found is not None else distinct.withColumn("__first", nothing)
    return out.select(
        F.col("__n").alias(needle), F.coalesce(F.col("__first.__sk"), F.lit(default)).cast("bigint").alias(sk),
        *([F.coalesce(F.col("__first.__prio"), F.lit(-1)).alias("step")] if with_step else []))


def attach_containment(df: DataFrame, needle: str, dim: DataFrame, hay_cols: Sequence[str],
                       sk: str, default: int = -1, k_max: int = GRAM_MAX) -> DataFrame:
    """Add ``sk`` to every row of ``df`` via :func:`containment_lookup` on its distinct needles."""
    res = containment_lookup(df, needle, dim, hay_cols, sk, default, k_max)
    res = res.withColumnRenamed(needle, "__needle")
    joined = df.join(res, F.col(needle).cast("string").eqNullSafe(F.col("__needle")), "left")
    return joined.withColumn(sk, F.coalesce(F.col(sk), F.lit(default)).cast("bigint")).drop("__needle")


def match_person(df: DataFrame, dim: DataFrame, keys: Sequence[tuple[str, str]], sk: str,
                 default: int = -1, strict: bool = False) -> DataFrame:
    """Exact match on pseudonymised identity columns (left join, -1 if absent).

    Homonyms born the same day multiply rows in parity mode (T17d); ``strict``
    keeps the smallest key instead. A NULL key part never matches.
    """
    return lookup(df, dim, keys, sk, required=False, default=default, strict=strict)


def residual_lookup(fact: DataFrame, dim: DataFrame, on, sk: str, right_filter: Column,
                    default: int = -1) -> DataFrame:
    """Equi left join where the dimension side is first narrowed by a predicate."""
    return lookup(fact, dim, on, sk, required=False, default=default, right_filter=right_filter)
