"""Connected components of a link table, as Spark joins (small and large star steps).

Each round links every node's neighbours to the smallest of them ("star" steps); a component becomes
one star in about log rounds. Every round is stored in the shared checkpoint folder, so a lost executor
re-reads it; only a count of changed links reaches the driver. Hot nodes are met with map-side
minima and a join whose skewed partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.session import pin


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over edges (u, v). Large: larger neighbours go to the smallest neighbour (or the node itself);
    small: the node and its smaller neighbours go to the smallest of them."""
    if small:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    best = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(best, "u")
    if small:
        out = joined.select(F.col("v").alias("u"), "m").union(best.select("u", "m"))
    else:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), "m")
    return out.where(F.col("u") != F.col("m")).select("u", F.col("m").alias("v")).distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.
    Null ends and self links are ignored; link order and repeats do not matter."""
    e = pin(edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
            .where(F.col("u") != F.col("v")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        e = pin(_star(_star(e, small=False), small=True), "stars")
        # unchanged sums of the link table mean that it is a set of stars
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
