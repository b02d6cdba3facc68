"""Running sums over a total order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.blocks import shuffle_partitions
from carelake.session import pin


def running_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows before a row in ``order`` (nulls first).

    The rows are dealt to ranges and stored once with the range's number, so that counting and adding see the
    same ranges; the driver-side table has one row per range.
    """
    spark = df.sparkSession
    n = max(2, shuffle_partitions(spark))
    ranged = pin(df.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("__range").agg(F.sum(value).alias("t"))
    # one row per range: n rows at most
    before = totals.select("__range", F.coalesce(F.sum("t").over(
        Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy("__range").orderBy(*order)
                                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (ranged.join(F.broadcast(before), "__range")
            .withColumn(name, (F.col("__before") + inside).cast("long")).drop("__range", "__before"))
