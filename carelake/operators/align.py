"""Schema alignment and unions."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align(df: DataFrame, mapping: Mapping[str, Column | str | None],
          types: Mapping[str, str] | None = None) -> DataFrame:
    """Project ``df`` onto a target shape.

    ``mapping`` is ordered ``{target: source}``; ``source`` may be a column name,
    an expression, or None for a typed NULL (type from ``types``).
    """
    types = types or {}
    cols = []
    for target, src in mapping.items():
        if src is None:
            e = F.lit(None)
        elif isinstance(src, str):
            e = F.col(src)
        else:
            e = src
        if target in types:
            e = e.cast(types[target])
        cols.append(e.alias(target))
    return df.select(*cols)


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name (no de-duplication)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_years(frames: Mapping[int, DataFrame], year_col: str = "annee_enquete") -> DataFrame:
    """Yearly extracts of one survey into one table, tagged by year."""
    tagged = [df.withColumn(year_col, F.lit(y)) if year_col not in df.columns else df
              for y, df in frames.items()]
    return union_all(tagged)


def profile(tables: Mapping[str, DataFrame], ids: Mapping[str, str] | None = None) -> DataFrame:
    """One row per table with its row count (and distinct ids).

    Each table is reduced to a single row by its own aggregate, then the rows
    are unioned; nothing is collected to the driver.
    """
    ids = ids or {}
    rows = []
    for name, df in tables.items():
        aggs = [F.count(F.lit(1)).alias("nb_lignes")]
        id_col = ids.get(name)
        aggs.append(F.count_distinct(id_col).alias("nb_ids_distincts") if id_col
                    else F.lit(None).cast("bigint").alias("nb_ids_distincts"))
        rows.append(df.agg(*aggs).select(F.lit(name).alias("table_name"), "*"))
    return union_all(rows)
