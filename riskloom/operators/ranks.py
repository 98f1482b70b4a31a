"""Average ranks of distinct values without a window over all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.session import stored


def average_ranks(counts: DataFrame, value: str, n: str) -> DataFrame:
    """Average rank of each distinct value, given how often it occurs.

    The values are range-partitioned and numbered within their range; the only window without partitioning runs over
    one row per range. The ranges are stored, because a second evaluation might cut them differently.
    """
    ranged = stored(
        counts.repartitionByRange(value).select(value, n, F.spark_partition_id().alias("part")), "value-ranges"
    )
    totals = ranged.groupBy("part").agg(F.sum(n).alias("part_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("part_n").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(n).over(within), F.lit(0)) + F.col("offset")
    # one row per range: as small as the number of shuffle partitions
    placed = ranged.join(F.broadcast(offsets), "part")
    return placed.select(value, n, (before + (F.col(n) + 1) / 2.0).alias("rank"))
