"""Coverage of the master table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.numeric import percent_of, round_half_even
from riskloom.vocabulary import COVERAGE_COLUMNS, SCORE_COLUMNS


def coverage_report(
    df: DataFrame, columns: Sequence[str] = COVERAGE_COLUMNS, complete: Sequence[str] = SCORE_COLUMNS,
    entity: str = "country", period: str = "year",
) -> DataFrame:
    """Rows, distinct countries and years, and present values per column, one row per metric.

    A column the table lacks counts no values. Everything is computed in one aggregation.
    """
    def present(*names: str):
        if any(n not in df.columns for n in names):
            return F.lit(0).cast("bigint")
        condition = F.lit(True)
        for n in names:
            condition = condition & F.col(n).isNotNull()
        return F.count_if(condition)

    counts = df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(entity).alias("countries"),
        F.count_distinct(period).alias("years"),
        *[present(c).alias(f"present_{c}") for c in columns],
        present(*complete).alias("present_all"),
    )
    share = lambda c: round_half_even(percent_of(F.col(c).cast("double"), F.col("rows").cast("double")), 0)
    none = F.lit(None).cast("double")
    metrics = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("n"), none.alias("pct"))
               for m in ("rows", "countries", "years")]
    metrics += [F.struct(F.lit(c).alias("metric"), F.col(f"present_{c}").alias("n"), share(f"present_{c}").alias("pct"))
                for c in columns]
    metrics += [F.struct(F.lit("all pillars").alias("metric"), F.col("present_all").alias("n"),
                         share("present_all").alias("pct"))]
    return counts.select(F.inline(F.array(*metrics)))


def years_covered(df: DataFrame, period: str = "year") -> DataFrame:
    """Distinct years in order, with their rows."""
    return df.groupBy(period).agg(F.count("*").alias("n")).orderBy(period)
