"""Column contracts of published tables (D09) and type widening.

A contract is an ordered list of ``(name, spark type, max length or None)``.
``conform`` casts a DataFrame to it (strict casts: a value that does not fit
fails the job, as the target DDL would); ``contract_violations`` reports, in one
aggregate pass, missing columns and values longer than the declared VARCHAR
length (Q10).
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Spec = Sequence[tuple[str, str, int | None]]


def conform(df: DataFrame, spec: Spec) -> DataFrame:
    """Select and cast the contract's columns in order; extra columns are dropped."""
    missing = [n for n, _, _ in spec if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the contract: {missing}")
    return df.select(*[F.col(n).cast(t).alias(n) for n, t, _ in spec])


def contract_violations(df: DataFrame, spec: Spec, table: str = "") -> DataFrame:
    """Q10: one row per contract column with a length or a missing column:
    -1 when the column is missing, else the count of over-long values.
    The length checks are one aggregate over the table (a single scan); missing
    columns need no scan."""
    spark = df.sparkSession
    checked = [(n, ln) for n, _, ln in spec if n in df.columns and ln is not None]
    missing = [n for n, _, _ in spec if n not in df.columns]
    parts = []
    if checked:
        agg = df.agg(*[F.coalesce(F.sum(F.when(F.length(F.col(n).cast("string")) > ln, 1).otherwise(0)), F.lit(0))
                       .cast("bigint").alias(f"__f{i}") for i, (n, ln) in enumerate(checked)])
        parts.append(agg.select(F.explode(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("column_name"),
                     F.col(f"__f{i}").alias("failures"))
            for i, (n, _) in enumerate(checked)])).alias("r")).select("r.*"))
    if missing:
        parts.append(spark.createDataFrame([(table, n, -1) for n in missing],
                                           "table_name string, column_name string, failures bigint"))
    return reduce(DataFrame.unionByName, parts)


def widen(df: DataFrame, changes: Mapping[str, str]) -> DataFrame:
    """Widen column types (e.g. int -> bigint, varchar(10) -> string)."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in changes.items()})
