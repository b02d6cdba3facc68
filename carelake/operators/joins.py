"""Join shapes of the model graph.

Thin, named compositions of DataFrame joins so models read like the reference's
SQL. Dimension sides are not hinted: AQE broadcasts them when their runtime size
is small, and shuffles otherwise.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pair = tuple[str, str]


def _cond(left: DataFrame, right: DataFrame, on: Sequence[Pair]) -> Column:
    conds = [left[a] == right[b] for a, b in on]
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def enrich(df: DataFrame, right: DataFrame, on: Sequence[Pair], cols: Sequence[str | Column]) -> DataFrame:
    """Optional enrichment — left join, selected right columns (NULL when absent)."""
    keys = [b for _, b in on]
    r = right.select(*[F.col(b).alias(f"__r_{b}") for b in keys], *cols)
    j = df.join(r, _cond(df, r, [(a, f"__r_{b}") for a, b in on]), "left")
    return j.drop(*[f"__r_{b}" for b in keys])


def bridge(df: DataFrame, link: DataFrame, target: DataFrame, k1: Pair, k2: Pair,
           cols: Sequence[str | Column]) -> DataFrame:
    """Chained left joins through a link table (rows multiply when a
    key has several links, as in the reference, T17a/b)."""
    lk = link.select(F.col(k1[1]).alias("__l1"), F.col(k2[0]).alias("__l2"))
    t = target.select(F.col(k2[1]).alias("__t2"), *cols)
    return (df.join(lk, df[k1[0]] == lk["__l1"], "left")
            .join(t, F.col("__l2") == t["__t2"], "left")
            .drop("__l1", "__l2", "__t2"))


def walk(fact: DataFrame, dim1: DataFrame, fk: Pair, dim2: DataFrame, fk2: Pair,
         cols1: Sequence[str], cols2: Sequence[str]) -> DataFrame:
    """Snowflake walk fact -> dimension -> dimension (two left joins)."""
    d1 = dim1.select(F.col(fk[1]).alias("__d1"), F.col(fk2[0]).alias("__fk2"), *cols1)
    d2 = dim2.select(F.col(fk2[1]).alias("__d2"), *cols2)
    return (fact.join(d1, fact[fk[0]] == d1["__d1"], "left")
            .join(d2, F.col("__fk2") == d2["__d2"], "left")
            .drop("__d1", "__fk2", "__d2"))


def denormalize(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, Sequence[str | Column]]]) -> DataFrame:
    """Star join of a fact with several dimensions on their surrogate keys (left joins)."""
    out = fact
    for dim, sk, cols in dims:
        out = out.join(dim.select(sk, *cols), sk, "left")
    return out


def attach_totals(base: DataFrame, grain: DataFrame, keys: Sequence[str], measures: Sequence[str],
                  fill=0) -> DataFrame:
    """Re-attach group totals to detail rows on the group keys (plain equality:
    rows whose key is NULL get ``fill``, T33)."""
    g = grain.select(*[F.col(k).alias(f"__g_{k}") for k in keys], *measures)
    j = base.join(g, _cond(base, g, [(k, f"__g_{k}") for k in keys]), "left").drop(*[f"__g_{k}" for k in keys])
    return j.withColumns({m: F.coalesce(F.col(m), F.lit(fill)) for m in measures}) if fill is not None else j


def full_merge(a: DataFrame, b: DataFrame, on: Sequence[Pair], fill=0) -> DataFrame:
    """Full outer join of two aggregates; keys coalesced, measures filled."""
    ra = a.alias("a")
    rb = b.alias("b")
    j = ra.join(rb, [F.col(f"a.{x}") == F.col(f"b.{y}") for x, y in on], "full_outer")
    key_cols = [F.coalesce(F.col(f"a.{x}"), F.col(f"b.{y}")).alias(x) for x, y in on]
    a_keys, b_keys = {x for x, _ in on}, {y for _, y in on}
    rest = [(F.coalesce(F.col(f"a.{c}"), F.lit(fill)) if fill is not None else F.col(f"a.{c}")).alias(c)
            for c in a.columns if c not in a_keys]
    rest += [(F.coalesce(F.col(f"b.{c}"), F.lit(fill)) if fill is not None else F.col(f"b.{c}")).alias(c)
             for c in b.columns if c not in b_keys and c not in a.columns]
    return j.select(*key_cols, *rest)


def enrich_grouped(df: DataFrame, right: DataFrame, on: Pair, aggs: Sequence[Column]) -> DataFrame:
    """Join-then-group rewritten as group-then-join: the right side is
    aggregated per key first, so the left side is never multiplied."""
    g = right.groupBy(F.col(on[1]).alias("__k")).agg(*aggs)
    return df.join(g, df[on[0]] == g["__k"], "left").drop("__k")
