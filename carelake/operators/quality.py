"""Declarative data-quality checks (Q01-Q13).

Every check returns a one-row DataFrame ``(check_name, table_name, column_name,
failures, passed)`` computed by an aggregate on the executors; ``run_checks``
unions them into one result table. Nothing is collected unless the caller asks.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _result(failures: DataFrame, check: str, table: str, column: str | None) -> DataFrame:
    """``failures`` is a one-row frame with column ``failures``."""
    return failures.select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"),
        F.col("failures").cast("bigint").alias("failures"),
        (F.col("failures") == 0).alias("passed"))


def unique(df: DataFrame, cols: str | Sequence[str], table: str = "") -> DataFrame:
    """Q01 / Q06: number of key values that occur more than once (NULL keys ignored)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    dup = (df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
           .groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
           .agg(F.count(F.lit(1)).alias("failures")))
    return _result(dup, "unique" if len(cols) == 1 else "unique_combination", table, ",".join(cols))


def not_null(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """Q02: NULL counts of several columns in one pass, one result row per column."""
    agg = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(c) for c in cols])
    stacked = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c), F.lit(0)).alias("failures"))
        for c in cols])).alias("r")).select("r.*")
    return stacked.select(F.lit("not_null").alias("check_name"), F.lit(table).alias("table_name"),
                          "column_name", F.col("failures").cast("bigint").alias("failures"),
                          (F.col("failures") == 0).alias("passed"))


def accepted_values(df: DataFrame, col: str, values: Iterable, table: str = "") -> DataFrame:
    """Q03: rows whose non-NULL value is outside the accepted list."""
    bad = df.agg(F.sum(F.when(F.col(col).isNotNull() & ~F.col(col).isin(*list(values)), 1)
                       .otherwise(0)).alias("failures"))
    return _result(bad.fillna(0), "accepted_values", table, col)


def relationship(df: DataFrame, fk: str, ref: DataFrame, pk: str, table: str = "") -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (left anti join)."""
    orphans = (df.where(F.col(fk).isNotNull()).select(F.col(fk).alias("__k"))
               .join(ref.select(F.col(pk).alias("__k")).distinct(), "__k", "left_anti")
               .agg(F.count(F.lit(1)).alias("failures")))
    return _result(orphans, "relationship", table, fk)


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """The orphan rows themselves."""
    return fact.join(dim.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def in_range(df: DataFrame, col: str, lo=None, hi=None, table: str = "") -> DataFrame:
    """Non-NULL values outside ``[lo, hi]``."""
    c = F.col(col)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < lo)
    if hi is not None:
        cond = cond | (c > hi)
    bad = df.agg(F.sum(F.when(c.isNotNull() & cond, 1).otherwise(0)).alias("failures"))
    return _result(bad.fillna(0), "accepted_range", table, col)


def min_rows(df: DataFrame, n: int, table: str = "") -> DataFrame:
    """Q07: row-count floor; failures = rows missing below the floor."""
    cnt = df.agg(F.greatest(F.lit(n) - F.count(F.lit(1)), F.lit(0)).alias("failures"))
    return _result(cnt, "min_rows", table, None)


def holds(df: DataFrame, pred: Column, name: str, table: str = "") -> DataFrame:
    """Q08: rows violating a cross-column predicate (NULL result counts as unknown, not failure)."""
    bad = df.agg(F.sum(F.when(~pred, 1).otherwise(0)).alias("failures"))
    return _result(bad.fillna(0), f"holds:{name}", table, None)


def one_current(df: DataFrame, key: Sequence[str], flag: str = "est_actuel",
                table: str = "") -> DataFrame:
    """Q09: keys with more than one current version."""
    bad = (df.where(F.col(flag)).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
           .where("n > 1").agg(F.count(F.lit(1)).alias("failures")))
    return _result(bad, "one_current_version", table, ",".join(key))


def max_length(df: DataFrame, spec: Mapping[str, int], table: str = "",
               exact: Mapping[str, int] | None = None) -> DataFrame:
    """Q10: values longer than the declared VARCHAR length (and, for ``exact``,
    values whose length differs — e.g. 64 for SHA-256 hex).

    One aggregate over the table for every column of the contract (a single scan),
    one result row per column.
    """
    exact = exact or {}
    checks = [("max_length", c, F.length(F.col(c).cast("string")) > n) for c, n in spec.items()]
    checks += [("exact_length", c, F.col(c).isNotNull() & (F.length(F.col(c).cast("string")) != n))
               for c, n in exact.items()]
    agg = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).alias(f"__f{i}") for i, (_, _, cond) in enumerate(checks)])
    stacked = agg.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.lit(c).alias("column_name"),
                 F.coalesce(F.col(f"__f{i}"), F.lit(0)).cast("bigint").alias("failures"))
        for i, (name, c, _) in enumerate(checks)])).alias("r")).select("r.*")
    return stacked.select("check_name", F.lit(table).alias("table_name"), "column_name", "failures",
                          (F.col("failures") == 0).alias("passed"))


def having(df: DataFrame, keys: Sequence[str], agg: Column, pred: Column) -> DataFrame:
    """groups whose aggregate satisfies ``pred`` (``HAVING``)."""
    return df.groupBy(*keys).agg(agg).where(pred)


def load_summary(audit: DataFrame) -> DataFrame:
    """Q13: per load id: tables, rows, successes and failures."""
    return (audit.groupBy("load_id")
            .agg(F.count(F.lit(1)).alias("nb_tables"),
                 F.sum("nb_lignes").alias("nb_lignes_total"),
                 F.sum(F.when(F.col("statut") == "SUCCESS", 1).otherwise(0)).alias("nb_succes"),
                 F.sum(F.when(F.col("statut") != "SUCCESS", 1).otherwise(0)).alias("nb_echecs"),
                 F.min("date_chargement").alias("debut"), F.max("date_chargement").alias("fin")))


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """All check results in one DataFrame."""
    return reduce(DataFrame.unionByName, checks)
