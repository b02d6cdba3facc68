"""Surrogate keys, pseudonyms and dimension lookups.

D01 ``with_surrogate_key`` replaces the reference's global
``row_number() over (order by key)``: planned naively that sorts every row in
one task (``Exchange SinglePartition``). Here Spark's range partitioner deals
the rows to sorted ranges, each task numbers its own range while storing it, and
a table of range sizes (one row per range) turns local numbers into the global
dense 1..N sequence. There is one code path for every input size.

* The order is made total with tie-breaker columns, so numbers are reproducible.
* Rows equal in every ordering column (a hot key, many identical copies) are told
  apart by a salt, the last ordering column, so they spread over ranges like any
  others; which of them gets which number does not matter.
* The salt is stored with the input before the rows are dealt, and the dealt ranges
  are stored before they are counted: a task that runs again after a lost executor
  reads the same salts, and counting and numbering see the same ranges.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.session import remove, store

_SALT = "__sk_salt"
_RANGE = "__sk_range"
_LOCAL = "__sk_local"
_OFF = "__sk_offset"
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in these bits


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def _sort_columns(df: DataFrame, order_cols: Sequence[str], tie_breakers: Sequence[str] | None,
                  descending: Sequence[str]) -> list[Column]:
    """Ordering columns, then tie-breakers, NULLs last in either direction (the reference's
    default, T14). Types without an ordering of their own break ties by a hash."""
    if tie_breakers is None:
        tie_breakers = [n for n in df.columns if n not in order_cols]
    out = []
    for name in [*order_cols, *tie_breakers]:
        c = F.col(f"`{name}`")
        if not _orderable(df.schema[name].dataType):
            c = F.xxhash64(F.to_json(F.struct(c)))
        out.append(c.desc_nulls_last() if name in descending else c.asc_nulls_last())
    return out


def with_surrogate_key(df: DataFrame, name: str, order_cols: Sequence[str],
                       tie_breakers: Sequence[str] | None = None,
                       descending: Sequence[str] = (), ranges: int | None = None, start: int = 1) -> DataFrame:
    """Dense ``bigint`` key ``start..start+N-1`` following ``order_cols``.

    Equivalent to ``row_number() over (order by order_cols, tie_breakers)`` with NULLS LAST
    ordering; arrays and structs order by their values. ``tie_breakers`` defaults to every other
    column, which makes the numbering reproducible. ``ranges`` defaults to the session's shuffle
    partitions, so rows per task follow that setting as for any other shuffle.

    The input is computed once. Jobs: store it with a salt, deal it to sorted ranges and store
    those with the row's number in its range, count each range. The salted copy is deleted once the
    ranges are stored; only the range sizes (one row per range) are ordered in one task and broadcast.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted, path = store(df.withColumn(_SALT, F.monotonically_increasing_id()), "sk-input")
    keys = [*_sort_columns(df, order_cols, tie_breakers, descending), F.col(_SALT).asc()]
    local = F.monotonically_increasing_id()
    dealt = (salted.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop(_SALT)
             .withColumn(_LOCAL, local))
    dealt = store(dealt, "sk-ranges")[0].withColumns({
        _RANGE: F.shiftright(_LOCAL, _ROW_BITS), _LOCAL: F.col(_LOCAL).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))})
    remove(spark, path)

    sizes = dealt.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_RANGE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_OFF))
    return (dealt.join(F.broadcast(offsets), _RANGE, "inner")
            .withColumn(name, (F.col(_OFF) + F.col(_LOCAL) + F.lit(start)).cast("bigint"))
            .drop(_RANGE, _LOCAL, _OFF))


# --- D02 / D03: pseudonyms --------------------------------------------------------------

def hash_id(c: Column | str) -> Column:
    """Full lower-case SHA-256 hex of the text; NULL stays NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sha2(col.cast("string"), 256)


def pseudonymize(c: Column | str, n: int = 8) -> Column:
    """First ``n`` hex characters of SHA-256 (8 in the reference)."""
    return F.substring(hash_id(c), 1, n)


# --- D04 / J01 / J03 / J06: dimension lookup -------------------------------------------------

def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str],
           sk: str | Sequence[str], required: bool = True, default=-1,
           right_filter: Column | None = None, as_name: str | None = None,
           strict: bool | str = False, broadcast: bool = False) -> DataFrame:
    """Look up dimension column(s) ``sk`` for every fact row.

    * ``required``: inner join, unmatched facts are dropped (J01); otherwise a
      left join with ``default`` for misses (J03).
    * ``right_filter``: predicate applied to the dimension before the join (J06,
      the reference's ``LIKE`` residual on the right side).
    * ``strict``: keep one dimension row per key (smallest ``sk``) so duplicate
      keys cannot multiply facts; the default reproduces the reference's fan-out (T17).
      ``"fail"``: a fact that meets a duplicate key fails the job, naming the key (duplicates that
      no fact asks for do no harm).
    * ``broadcast``: only for dimensions with a size bound by construction;
      otherwise AQE picks broadcast from the runtime size.
    """
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    sks = [sk] if isinstance(sk, str) else list(sk)
    d = dim
    if right_filter is not None:
        d = d.where(right_filter)
    rkeys = [f"__lk_{i}" for i in range(len(pairs))]
    d = d.select(*[F.col(r).alias(a) for (_, r), a in zip(pairs, rkeys)], *sks)
    if strict:
        d = d.groupBy(*rkeys).agg(F.min(F.struct(*sks)).alias("__v"), F.count(F.lit(1)).alias("__dup"))
        d = d.select(*rkeys, "__v.*", *(["__dup"] if strict == "fail" else []))
    if broadcast:
        d = F.broadcast(d)
    cond = [fact[l] == d[r] for (l, _), r in zip(pairs, rkeys)]
    joined = fact.join(d, cond, "inner" if required else "left").drop(*rkeys)
    if strict == "fail":
        key = F.concat_ws(", ", *[fact[l].cast("string") for l, _ in pairs])
        broken = F.raise_error(F.concat(F.lit("duplicate dimension key: "), key))
        joined = joined.withColumn(sks[0], F.when(F.col("__dup") > 1, broken).otherwise(F.col(sks[0]))).drop("__dup")
    if not required and default is not None:
        joined = joined.withColumns({s: F.coalesce(F.col(s), F.lit(default)) for s in sks})
    if as_name and len(sks) == 1:
        joined = joined.withColumnRenamed(sks[0], as_name)
    return joined


def lookup_report(name: str, fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str],
                  right_filter: Column | None = None) -> DataFrame:
    """One row on what a lookup does, before it runs: fact rows that find a key (``matched``), that find none
    (``missed``; NULL keys among them, ``null_keys``), that find several (``multiplied``) with the rows they add (``extra_rows``), and
    the duplicate keys of the dimension. Both sides are counted by key first, so a hot key is one row of the join."""
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    keys = [f"__k{i}" for i in range(len(pairs))]
    f = fact.groupBy(*[F.col(l).alias(k) for (l, _), k in zip(pairs, keys)]).agg(F.count(F.lit(1)).alias("__f"))
    d = (dim if right_filter is None else dim.where(right_filter))
    d = d.groupBy(*[F.col(r).alias(k) for (_, r), k in zip(pairs, keys)]).agg(F.count(F.lit(1)).alias("__d"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    d = d.where(~null_key)
    j = f.join(d, keys, "full_outer")
    rows, found = F.coalesce("__f", F.lit(0)), F.coalesce("__d", F.lit(0))

    def total(cond, value=None):
        return F.coalesce(F.sum(F.when(cond, rows if value is None else value)), F.lit(0)).cast("bigint")

    return j.agg(F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("fact_rows"), total(found > 0).alias("matched"),
                 total(found == 0).alias("missed"), total(null_key).alias("null_keys"), total(found > 1).alias("multiplied"),
                 total(found > 1, rows * (found - 1)).alias("extra_rows"),
                 F.count_if(found > 1).alias("duplicate_keys")).select(F.lit(name).alias("lookup"), "*")


def observed_lookup(fact: DataFrame, dim: DataFrame, on, sk: str, name: str, **kw) -> tuple[DataFrame, Observation]:
    """An optional lookup that counts what it does while it runs: after the action on the returned frame,
    ``observation.get`` has ``rows_out``, ``matched`` and ``missed``; no pass is added."""
    obs = Observation(name)
    out = lookup(fact, dim, on, sk, required=False, default=None, **kw)
    col = kw.get("as_name") or sk
    seen = out.observe(obs, F.count(F.lit(1)).alias("rows_out"), F.count(F.col(col)).alias("matched"),
                       F.count_if(F.col(col).isNull()).alias("missed"))
    return seen.withColumn(col, F.coalesce(F.col(col), F.lit(-1))), obs


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a dimension (the T17 fan-out report)."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unknown_member(dim: DataFrame, sk: str, defaults: dict | None = None,
                   sk_value: int = -1) -> DataFrame:
    """One typed row with key -1 (the unknown member), other columns from ``defaults``."""
    defaults = defaults or {}
    spark = dim.sparkSession
    cols = []
    for f in dim.schema.fields:
        v = sk_value if f.name == sk else defaults.get(f.name)
        cols.append(F.lit(v).cast(f.dataType).alias(f.name))
    return spark.range(1).select(*cols)


def with_unknown_member(dim: DataFrame, sk: str, defaults: dict | None = None,
                        sk_value: int = -1) -> DataFrame:
    """Add the unknown member unless a row with that key exists already."""
    unk = unknown_member(dim, sk, defaults, sk_value)
    missing = unk.join(dim.select(sk), sk, "left_anti")
    return dim.unionByName(missing)


def keys_are_dense(df: DataFrame, sk: str) -> DataFrame:
    """Property check: one row with n, distinct keys, min and max of ``sk``."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(sk).alias("n_distinct"),
                  F.min(sk).alias("min_sk"), F.max(sk).alias("max_sk"))


def order_columns(cols: Iterable[str]) -> list[Column]:
    """Ascending NULLS LAST sort columns (the reference engine's default, T14)."""
    return [F.col(c).asc_nulls_last() for c in cols]
