"""One row per country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.numeric import round_settled
from riskloom.operators.rollups import total


def _present(column: str, period: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.col(period))


def latest_present(column: str, period: str = "year") -> Column:
    """Value of the latest period that has one."""
    return F.max_by(column, _present(column, period))


LATEST = (
    "environmental_score", "social_score", "governance_score", "esg_score", "esg_risk_score", "risk_trend",
    "lending_gap", "priority_score",
)


def country_summary(
    df: DataFrame, country: str = "country", code: str = "iso3", period: str = "year", latest: Sequence[str] = LATEST
) -> DataFrame:
    """Latest present values, total lending and mean success rate per country, highest risk first.

    Rows are first reduced per country and code, where all that is kept is numbers, so they are aggregated in place by
    hash. The code, a text, is chosen among the few rows that are left.
    """
    columns = [c for c in latest if c in df.columns]
    reduced = df.dropna(subset=[country]).groupBy(country, code).agg(
        F.max(period).alias("_period"),
        *[latest_present(c, period).alias(c) for c in columns],
        *[F.max(_present(c, period)).alias(f"_{c}") for c in columns],
        F.sum("lending_amount").alias("_lending"), F.sum("success_rate").alias("_success"),
        F.count("success_rate").alias("_rated"),
    )
    order = {c: F.struct(F.col(f"_{c}"), F.col(code)) for c in columns}
    summary = reduced.groupBy(country).agg(
        F.max_by(code, F.when(F.col(code).isNotNull(), F.struct("_period", code))).alias(code),
        F.max("_period").alias("latest_year"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order[c])).alias(c) for c in columns],
        total("_lending").alias("total_lending_usd"),
        round_settled(F.try_divide(F.sum("_success"), F.sum("_rated")), 1).alias("avg_success_rate"),
    )
    return summary.orderBy(F.desc_nulls_last("esg_risk_score"), country)
