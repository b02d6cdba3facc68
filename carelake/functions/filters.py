"""Filter predicates (F01-F12) as Column expressions / DataFrame helpers.

All of them are plain ``where`` conditions, so Catalyst pushes the ones on
scanned columns down to the Parquet reader (and year filters on partition
columns prune whole directories).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def require_keys(df: DataFrame, *cols: str) -> DataFrame:
    """drop rows with a NULL business key (any of 1-4 columns)."""
    return df.dropna(subset=list(cols))


def drop_null(df: DataFrame, col: str) -> DataFrame:
    """drop rows whose parsed value is NULL."""
    return df.where(F.col(col).isNotNull())


def current_only(df: DataFrame, flag: str = "est_actuel") -> DataFrame:
    """current versions only (turns a following left join into an inner one, T17e)."""
    return df.where(F.col(flag))


def in_years(df: DataFrame, col: str, lo: int, hi: int | None = None) -> DataFrame:
    """year equality or range."""
    c = F.col(col)
    return df.where(c == lo if hi is None else c.between(lo, hi))


def known_only(df: DataFrame, col: str, sentinel: str = "Non renseigne") -> DataFrame:
    """exclude NULL and the sentinel category."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != sentinel))


def differs(c: ColumnOrName, value) -> Column:
    """inequality that also drops NULLs (three-valued ``!=``, not null-safe)."""
    return _c(c) != F.lit(value)


def contains_ci(c: ColumnOrName, needle: str) -> Column:
    """case-folded containment (``lower(x) LIKE '%needle%'``)."""
    return F.lower(_c(c)).contains(needle.lower())


def isin(c: ColumnOrName, values: Iterable) -> Column:
    """IN list."""
    return _c(c).isin(*list(values))


def between_str(c: ColumnOrName, lo: str, hi: str) -> Column:
    """string range with binary collation (same order in both engines)."""
    return _c(c).between(lo, hi)


def between(c: ColumnOrName, lo, hi) -> Column:
    """numeric BETWEEN (inclusive)."""
    return _c(c).between(lo, hi)


def matches(c: ColumnOrName, regex: str) -> Column:
    """code-shape check by regular expression."""
    return _c(c).rlike(regex)


def plausible(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """keep rows inside a plausibility window (e.g. duration > 0, age 0-120)."""
    conds = []
    if lo is not None:
        conds.append(F.col(col) >= lo)
    if hi is not None:
        conds.append(F.col(col) <= hi)
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df
