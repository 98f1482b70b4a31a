"""Places of rows in a sorted order, without a window over all rows of a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import stored

#: Bits of a row number that tell the row within its partition.
ROW_BITS = 33


def numbered(rows: DataFrame, group: list[str], order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``idx`` (place within the group, from 0) and ``size`` (rows of the group).

    The rows are range-partitioned by group and order, numbered where they are and stored, as a second evaluation might
    cut the ranges differently. The only window runs over the counts per group and range, and a group has at most as
    many of these as there are ranges, however many rows it holds. Null is a group like any other.
    """
    keys = [F.col(c) for c in group]
    placed = stored(
        rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id()), label,
    ).withColumn("_range", F.shiftright("_at", ROW_BITS))
    counts = placed.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[k.alias(f"_{c}") for k, c in zip(keys, group)], F.col("_range").alias("__range"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size"),
    )
    same = F.col("_range") == F.col("__range")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return placed.join(offsets, same).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("idx"), "size")
