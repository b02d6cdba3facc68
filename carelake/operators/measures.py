"""Aggregate, window and ordering helpers.

All helpers return Column expressions or DataFrames built from ``groupBy`` and
``Window``; partial aggregation happens map-side before any shuffle.
Windows without ``partitionBy`` (share of total, national rank) are only
applied to already-aggregated frames whose size is bounded by the number of
groups (sexes x age bands, regions), never to detail rows.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from carelake.operators.keys import with_surrogate_key
from carelake.session import pin

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- A01-A05 -----------------------------------------------------------------------------

def dedup_flag(df: DataFrame, keys: Sequence[str], flag: Column, name: str) -> DataFrame:
    """One row per key tuple with ``max(case when flag then 1 else 0)``."""
    return df.groupBy(*keys).agg(F.max(F.when(flag, 1).otherwise(0)).alias(name))


def any_value_max(cols: Sequence[str]) -> list[Column]:
    """Deterministic 'any value' per group via ``max``."""
    return [F.max(c).alias(c) for c in cols]


def n_distinct(c: ColumnOrName, approx: bool = False, rsd: float = 0.02) -> Column:
    """Exact distinct count, or HyperLogLog++ when ``approx``."""
    return F.approx_count_distinct(_c(c), rsd) if approx else F.count_distinct(_c(c))


def n_rows() -> Column:
    """count(*)."""
    return F.count(F.lit(1))


def join_distinct(c: ColumnOrName, sep: str = ", ") -> Column:
    """Distinct values, sorted, joined (``string_agg(distinct x order by x)``).

    The buffer holds the distinct values of one group only (a handful of labels).
    """
    return F.array_join(F.array_sort(F.collect_set(_c(c))), sep)


# --- A06-A13 -----------------------------------------------------------------------------

def total(df: DataFrame, keys: Sequence[str], c: str, name: str | None = None) -> DataFrame:
    """SUM by composite keys."""
    return df.groupBy(*keys).agg(F.sum(c).alias(name or f"sum_{c}"))


def weighted_mean(x: ColumnOrName, w: ColumnOrName, skip_null: bool = False) -> Column:
    """``sum(x*w) / nullif(sum(w), 0)``.

    Parity (T24): a NULL score still counts its weight in the denominator.
    ``skip_null`` counts weights only where the score is present (A18).
    """
    xx, ww = _c(x), _c(w)
    den = F.sum(F.when(xx.isNotNull(), ww).otherwise(0)) if skip_null else F.sum(ww)
    return F.sum(xx * ww) / F.nullif(den, F.lit(0))


def stats(c: ColumnOrName, prefix: str) -> list[Column]:
    """Min / max / avg."""
    col = _c(c)
    return [F.min(col).alias(f"{prefix}_min"), F.max(col).alias(f"{prefix}_max"),
            F.avg(col).alias(f"{prefix}_avg")]


def sum_if(c: ColumnOrName, cond: Column) -> Column:
    """Conditional sum, 0 otherwise (pivot by category)."""
    return F.sum(F.when(cond, _c(c)).otherwise(F.lit(0)))


def avg_if(c: ColumnOrName, cond: Column) -> Column:
    """A10: conditional average; rows outside the condition are ignored (no ELSE)."""
    return F.avg(F.when(cond, _c(c)))


def ratio(num: Column, den: Column, digits: int | None = 2) -> Column:
    """Guarded ratio of aggregates, optionally rounded half-up."""
    r = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return F.round(r, digits) if digits is not None else r


def per_workday(c: Column, days: float = 220.0) -> Column:
    """Total spread over a constant number of working days."""
    return c.cast("double") / F.lit(days)


def multi_grain(base: DataFrame, grains: Mapping[str, tuple[Sequence[str], Sequence[Column]]],
                where: Mapping[str, Column] | None = None) -> dict[str, DataFrame]:
    """Several ``groupBy``s over one base (the caller persists the base)."""
    where = where or {}
    out = {}
    for name, (keys, aggs) in grains.items():
        b = base.where(where[name]) if name in where else base
        out[name] = b.groupBy(*keys).agg(*aggs)
    return out


def distinct(df: DataFrame) -> DataFrame:
    """SELECT DISTINCT."""
    return df.distinct()


def median(c: ColumnOrName, exact: bool = True, accuracy: int = 10000) -> Column:
    """Median. Exact (``percentile_cont`` semantics) or approximate at scale."""
    col = _c(c)
    return F.median(col) if exact else F.percentile_approx(col, 0.5, accuracy)


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, ps: Mapping[str, float],
                      ranges: int | None = None) -> DataFrame:
    """Exact percentiles (``percentile_cont``: linear between the two middle values) per group, without a buffer of the
    group's values.

    The groups' histograms (group, value, count) are one aggregate; dealt to sorted ranges, they get running counts: each range
    sums its own, and one row per range gives what lies before it. A value's places among all rows then follow, the group's
    first place and size name the wanted places, and the values that cover them are picked. No task holds a group: one with
    half of all rows is as many ranges as its distinct values fill. NULL values do not count; a group of NULLs alone
    has NULL percentiles; NULL keys are a group.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = [f"__g{i}" for i in range(len(keys))]
    named = df.select(*[F.col(k).alias(a) for k, a in zip(keys, g)], F.col(value).cast("double").alias("__v"))
    hist = named.groupBy(*g, "__v").agg(F.count(F.lit(1)).alias("__c"))
    order = [F.col(a).asc_nulls_first() for a in [*g, "__v"]]
    dealt = pin(hist.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "histogram")
    sizes = dealt.groupBy("__range").agg(F.sum("__c").alias("__n"))
    before = sizes.select("__range", F.coalesce(F.sum("__n").over(
        Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # one row per range
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (dealt.withColumn("__in", F.coalesce(F.sum("__c").over(inside), F.lit(0)))
              .join(F.broadcast(before), "__range").withColumn("__from", F.col("__before") + F.col("__in")))
    full = placed.where(F.col("__v").isNotNull())
    groups = placed.groupBy(*g).agg(F.min(F.when(F.col("__v").isNotNull(), F.col("__from"))).alias("__first"),
                                    F.coalesce(F.sum(F.when(F.col("__v").isNotNull(), F.col("__c"))), F.lit(0)).alias("__n"))
    wanted = groups.withColumns({f"__p{i}": (F.col("__n") - 1) * F.lit(float(p)) for i, p in enumerate(ps.values())})
    same = F.lit(True)
    for a in g:
        same = same & F.col(f"h.{a}").eqNullSafe(F.col(f"w.{a}"))
    at = F.col("h.__from") - F.col("w.__first")  # the value's first place in its group

    def covers(place):
        return (at <= place) & (place < at + F.col("h.__c"))

    near = F.lit(False)
    for i in range(len(ps)):
        near = near | covers(F.floor(f"w.__p{i}")) | covers(F.ceil(f"w.__p{i}"))
    picked = full.alias("h").join(wanted.alias("w"), same & near)  # two rows a group and percentile at most
    aggs = []
    for i, name in enumerate(ps):
        p = F.col(f"w.__p{i}")
        low = F.max(F.when(covers(F.floor(p)), F.col("h.__v")))
        high = F.max(F.when(covers(F.ceil(p)), F.col("h.__v")))
        aggs.append((low + (high - low) * F.max(p - F.floor(p))).alias(name))
    found = picked.groupBy(*[F.col(f"w.{a}").alias(a) for a in g]).agg(*aggs)
    back = F.lit(True)
    for a in g:
        back = back & groups[a].eqNullSafe(found[a])
    return groups.join(found, back, "left").select(*[groups[a].alias(k) for a, k in zip(g, keys)], *ps)


def grain_totals(base: DataFrame, grains: Mapping[str, Sequence[str]], aggs: Sequence[Column],
                 distinct: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """The totals of several grains from one aggregate (GROUPING SETS), stored once: one shuffle of the narrow rows (keys
    and measures), distinct counts included, instead of one set of shuffles per grain.

    ``distinct`` = (column, name) counts the column's distinct values: the rows are dealt once by the keys that all grains share
    and the column, where each grain marks the first row of a value in its group. Those marks add up like any sum, so no row
    travels once per grain, as it does for a ``count_distinct`` among ``aggs``."""
    cols = list(dict.fromkeys(k for keys in grains.values() for k in keys))
    marks = [f"__first{i}" for i in range(len(grains))] if distinct else []
    if distinct:
        shared = [k for k in cols if all(k in keys for keys in grains.values())]
        base = base.repartition(*shared, distinct[0])
        base = base.withColumns({m: _first(keys, distinct[0]) for m, keys in zip(marks, grains.values())})
    sets = base.groupingSets([[F.col(k) for k in keys] for keys in grains.values()], *cols).agg(
        F.grouping_id().alias("__gid"), *aggs, *[F.sum(m).alias(m) for m in marks])
    gids = [sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys) for keys in grains.values()]
    if distinct:
        own = F.coalesce(*[F.when(F.col("__gid") == gid, F.col(m)) for gid, m in zip(gids, marks)])
        sets = sets.withColumn(distinct[1], own).drop(*marks)
    stored = pin(sets, "grains")
    out = {}
    for (name, keys), gid in zip(grains.items(), gids):
        out[name] = stored.where(F.col("__gid") == gid).drop("__gid", *[c for c in cols if c not in keys])
    return out


def _first(keys: Sequence[str], who: str) -> Column:
    """1 at one row of each value of ``who`` in its group, else 0; NULL is no value."""
    at = F.row_number().over(Window.partitionBy(*keys, who).orderBy(who))
    return F.when(F.col(who).isNotNull() & (at == 1), 1).otherwise(0)


def totals_beside(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], distinct: tuple[str, str], fill=0) -> DataFrame:
    """A11 / J11 for a grain with nearly as many groups as rows: a window puts the group's totals beside each row, so the
    totals are not another table of that size to shuffle, store and join. Rows already dealt by some of ``keys`` stay where they are.
    ``distinct`` = (column, name) counts the column's distinct values. Rows with a NULL key get ``fill``, as in ``attach_totals``."""
    who, name = distinct
    group = Window.partitionBy(*keys)
    sorted_group = group.orderBy(F.col(who).asc_nulls_first())
    new = F.col(who).isNotNull() & ~F.lag(who).over(sorted_group).eqNullSafe(F.col(who))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    marked = df.withColumn("__new", F.when(new, 1).otherwise(0))
    return marked.withColumns({m: F.coalesce(F.when(known, a.over(group)), F.lit(fill))
                               for m, a in {**aggs, name: F.sum("__new")}.items()}).drop("__new")


def occupancy(days: Column, n: Column, month_days: float = 30.44) -> Column:
    """Days / (stays x 30.44) x 100, 0 when there are no stays."""
    return F.when(n > 0, days.cast("double") / (n * F.lit(month_days)) * 100).otherwise(F.lit(0.0))


def share(num: Column, den: Column) -> Column:
    """Guarded percentage, 0 when the denominator is 0."""
    return F.when(den > 0, num.cast("double") / den * 100).otherwise(F.lit(0.0))


def completeness_pct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percentage of NULLs per column, one pass."""
    n = F.count(F.lit(1))
    return df.agg(*[(F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)) * 100.0 / n)
                  .alias(f"pct_null_{c}") for c in cols])


# --- W03-W09 -----------------------------------------------------------------------------

def share_of_total(c: ColumnOrName) -> Column:
    """``x * 100 / sum(x) over ()`` — for aggregated (bounded) frames only."""
    col = _c(c)
    return col * 100.0 / F.sum(col).over(Window.partitionBy())


def rank_desc(c: ColumnOrName, partition: Sequence[str] = ()) -> Column:
    """``rank() over (order by c desc)`` (ties share a rank)."""
    w = Window.partitionBy(*partition).orderBy(_c(c).desc_nulls_last())
    return F.rank().over(w)


def previous(c: ColumnOrName, key: Sequence[str], ts: Sequence[str]) -> Column:
    """Value of the previous version of the same key."""
    return F.lag(_c(c)).over(Window.partitionBy(*key).orderBy(*ts))


def next_value(c: ColumnOrName, key: Sequence[str], ts: Sequence[str]) -> Column:
    """Value of the next version of the same key."""
    return F.lead(_c(c)).over(Window.partitionBy(*key).orderBy(*ts))


def version_no(key: Sequence[str], ts: Sequence[str]) -> Column:
    """1, 2, ... per key in time order."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(*ts))


def moving_avg(c: ColumnOrName, key: Sequence[str], ts: Sequence[str], n: int = 10) -> Column:
    """Average over the current row and the ``n`` preceding rows of the key."""
    w = Window.partitionBy(*key).orderBy(*ts).rowsBetween(-n, 0)
    return F.avg(_c(c)).over(w)


def order(df: DataFrame, cols: Sequence[ColumnOrName]) -> DataFrame:
    """Multi-key ascending sort, NULLS LAST (the reference engine's default, T14).

    A global sort is a range-partitioned shuffle (sampled bounds, no single task);
    applied to KPI results it only orders the few grouped rows.
    """
    return df.orderBy(*[(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in cols])


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top-N with a total order (ties broken by the caller's extra keys).

    Planned as ``TakeOrderedAndProject``: each partition keeps its own top n,
    only n rows per partition reach the final merge.
    """
    return df.orderBy(*order).limit(n)


# --- W06-W09 without hot keys: bounded frames over chunks of a global sequence ----------

SEQ = "__seq"


def in_chunks(df: DataFrame, key: Sequence[str], order: Sequence[str], before: int = 0, after: int = 0,
              chunk: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """The rows numbered (``SEQ``) over (key, order, other columns), and the same rows in chunks of ``chunk`` numbers
    (``__chunk``) with ``before`` rows of the chunk before and ``after`` rows of the chunk after as context (not ``__own``)."""
    if max(before, after) > chunk:
        raise ValueError("a frame must not reach beyond the next chunk")
    seq = with_surrogate_key(df, SEQ, [*key, *order])
    pos = F.pmod(F.col(SEQ) - 1, F.lit(chunk))
    ch = F.floor((F.col(SEQ) - 1) / F.lit(chunk)).cast("long")
    rows = seq.withColumns({"__chunk": ch, "__own": F.lit(True)})
    if before:
        rows = rows.unionByName(seq.where(pos >= chunk - before).withColumns({"__chunk": ch + 1, "__own": F.lit(False)}))
    if after:
        rows = rows.unionByName(seq.where(pos < after).withColumns({"__chunk": ch - 1, "__own": F.lit(False)}))
    return seq, rows


def framed(df: DataFrame, key: Sequence[str], order: Sequence[str],
           exprs: Mapping[str, Callable[[WindowSpec], Column]], before: int = 0, after: int = 0,
           chunk: int = 100_000, keep_seq: bool = False, position: str | None = None) -> DataFrame:
    """Evaluate window expressions whose frame spans at most ``before`` rows back and
    ``after`` rows ahead within each key, without sending a key's rows to one task.

    Rows are numbered densely over (key, order, other columns) with the balanced
    surrogate-key operator (D01), so each key's rows are consecutive numbers. The
    numbers are cut into chunks of ``chunk``; every chunk also receives, as context,
    the last ``before`` rows of the previous chunk and the first ``after`` rows of
    the next. The window then runs per (chunk, key), so a key holding a third of
    the data is spread over many tasks, each with at most chunk + before + after
    rows; results are exact (the frame never needs rows beyond the context).

    ``exprs`` maps output names to functions of the window spec (ordered by the
    sequence), e.g. ``{"prev": lambda w: F.lag("x").over(w)}``; ``order`` must be a
    total order within a key. ``position`` names an optional 1-based position of
    the row within its key: the first number of a key is found by a per-key ``min``
    over the stored numbering and attached per (chunk, key), at most keys + chunks rows,
    so that a hot key's rows meet it in as many groups as they have chunks.
    """
    seq, rows = in_chunks(df, key, order, before, after, chunk)
    w = Window.partitionBy("__chunk", *key).orderBy(SEQ)
    out = rows.select("*", *[fn(w).alias(name) for name, fn in exprs.items()]).where(F.col("__own")).drop("__own")
    if position:
        spans = (seq.groupBy(*key).agg(F.min(SEQ).alias("__first"), F.max(SEQ).alias("__last"))
                 .select(*[F.col(k).alias(f"__key_{k}") for k in key], "__first",
                         F.explode(F.sequence(F.floor((F.col("__first") - 1) / chunk).cast("long"),
                                              F.floor((F.col("__last") - 1) / chunk).cast("long"))).alias("__at")))
        same = F.col("__chunk") == F.col("__at")
        for k in key:
            same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
        out = (out.join(spans, same, "inner")
               .withColumn(position, (F.col(SEQ) - F.col("__first") + 1).cast("int"))
               .drop(*spans.columns))
    out = out.drop("__chunk")
    return out if keep_seq else out.drop(SEQ)


def moving_avg_frame(df: DataFrame, c: str, key: Sequence[str], order: Sequence[str], n: int = 10,
                     name: str = "moyenne_mobile", **kw) -> DataFrame:
    """W09 at scale: mean of the current and ``n`` preceding rows of the same key."""
    return framed(df, key, order, {name: lambda w: F.avg(c).over(w.rowsBetween(-n, 0))}, before=n, **kw)
