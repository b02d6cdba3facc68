"""A table's declared checks in one pass (Q01-Q06, Q08, Q09): one scan per table, one shuffle for all checks.

Every row gives, for each check that has something to say about it, a marker ``(check, key, rows, parents)``:

* not_null, accepted values, ranges and cross-column rules: a marker without key, from failing rows only;
* unique, unique combination and one-current: the key, counted;
* relationships: the child's foreign key, counted, and from the parent table the key itself, as a parent.

Markers of all tables go through one aggregate by (check, key), combined map-side, so a hot key or a column that always
fails is one row per task; what fails is then counted per check. Keys are compared whole (as text parts with their NULLs),
not by hash. Checks without markers pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEYED, _ORPHANS, _ROWS = "keyed", "orphans", "rows"


@dataclass
class Check:
    """One declared check; ``columns`` name the key or the column, the rest depends on the kind."""
    kind: str
    table: str
    columns: tuple[str, ...]
    fails: Callable[[], Column] | None = None   # rows that fail (row checks)
    where: Callable[[], Column] | None = None   # rows that take part (keyed checks)
    parent: tuple[str, tuple[str, ...]] | None = field(default=None)

    @property
    def counts(self) -> str:
        return _ORPHANS if self.parent else _ROWS if self.fails else _KEYED


def unique(table: str, *columns: str) -> Check:
    """Q01 / Q06: keys that occur more than once; keys with a NULL part are ignored."""
    return Check("unique" if len(columns) == 1 else "unique_combination", table, columns)


def one_current(table: str, *columns: str, flag: str = "est_actuel") -> Check:
    """Q09: keys with more than one current version."""
    return Check("one_current_version", table, columns, where=lambda: F.col(flag))


def not_null(table: str, *columns: str) -> list[Check]:
    """Q02: NULLs, one check a column."""
    return [Check("not_null", table, (c,), fails=lambda c=c: F.col(c).isNull()) for c in columns]


def accepted_values(table: str, column: str, values: Sequence) -> Check:
    """Q03: non-NULL values outside the list."""
    return Check("accepted_values", table, (column,), fails=lambda: ~F.col(column).isin(*values))


def in_range(table: str, column: str, lo=None, hi=None) -> Check:
    """Q05: non-NULL values outside [lo, hi]."""
    def fails():
        out = F.lit(False)
        out = out if lo is None else out | (F.col(column) < F.lit(lo))
        return out if hi is None else out | (F.col(column) > F.lit(hi))
    return Check("accepted_range", table, (column,), fails=fails)


def holds(table: str, name: str, rule: Callable[[], Column]) -> Check:
    """Q08: rows that break a cross-column rule (an unknown result is no failure)."""
    return Check(f"holds:{name}", table, (), fails=lambda: ~rule())


def relationship(table: str, columns: str | Sequence[str], parent: str, keys: str | Sequence[str]) -> Check:
    """Child rows whose foreign key (no NULL part) no parent row has."""
    cols = (columns,) if isinstance(columns, str) else tuple(columns)
    return Check("relationship", table, cols, parent=(parent, (keys,) if isinstance(keys, str) else tuple(keys)))


def _key(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns])


def _present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _marker(check: int, key: Column, rows: int, parents: int) -> Column:
    return F.struct(F.lit(check).alias("check"), key.alias("key"), F.lit(rows).cast("bigint").alias("rows"),
                    F.lit(parents).alias("parents"))


def _markers(name: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame | None:
    none = F.array().cast("array<string>")
    out = []
    for i, c in enumerate(checks):
        if c.table == name:
            if c.counts == _ROWS:
                out.append(F.when(c.fails(), _marker(i, none, 1, 0)))
            else:
                part = _present(c.columns) if c.where is None else c.where() & _present(c.columns)
                out.append(F.when(part, _marker(i, _key(c.columns), 1, 0)))
        if c.parent and c.parent[0] == name:
            out.append(F.when(_present(c.parent[1]), _marker(i, _key(c.parent[1]), 0, 1)))
    if not out:
        return None
    return df.select(F.explode(F.array_compact(F.array(*out))).alias("m")).select("m.*")


def run(tables: Mapping[str, DataFrame], checks: Sequence[Check | Sequence[Check]]) -> DataFrame:
    """(check_name, table_name, column_name, failures, passed) of every check, in one job."""
    flat = [c for x in checks for c in (x if isinstance(x, (list, tuple)) else [x])]
    missing = {c.table for c in flat} | {c.parent[0] for c in flat if c.parent}
    missing -= set(tables)
    if missing:
        raise ValueError(f"checks name tables that are not given: {sorted(missing)}")
    marked = [m for m in (_markers(n, df, flat) for n, df in tables.items()) if m is not None]
    spark = next(iter(tables.values())).sparkSession
    declared = spark.createDataFrame([(i, c.kind, c.table, ",".join(c.columns) or None, c.counts) for i, c in enumerate(flat)],
                                     "check int, check_name string, table_name string, column_name string, counts string")
    keys = (reduce(DataFrame.unionByName, marked).groupBy("check", "key")
            .agg(F.sum("rows").alias("rows"), F.max("parents").alias("parents")))
    found = keys.groupBy("check").agg(F.count_if(F.col("rows") > 1).alias("repeated"), F.sum("rows").alias("rows"),
                                      F.coalesce(F.sum(F.when(F.col("parents") == 0, F.col("rows"))), F.lit(0)).alias("orphans"))
    # one row per declared check on either side
    joined = F.broadcast(declared).join(found, "check", "left")
    failures = F.coalesce(F.when(F.col("counts") == _KEYED, F.col("repeated")).when(F.col("counts") == _ORPHANS, F.col("orphans"))
                          .otherwise(F.col("rows")), F.lit(0)).cast("bigint")
    return joined.select("check_name", "table_name", "column_name", failures.alias("failures"), (failures == 0).alias("passed"))
