"""Exposure, priority, trend and lending gap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.numeric import flag, percent_of, round_half_even, round_settled
from riskloom.vocabulary import GAP_RISK, MIN_TREND_POINTS


def add_exposure(df: DataFrame, amount: str = "lending_amount") -> DataFrame:
    """Amount as percentage of the greatest amount of all rows, null where that is 0 or there is none."""
    greatest = df.agg(F.max(amount).alias("greatest")).scalar()
    return df.withColumn("exposure_score", round_settled(percent_of(F.col(amount), greatest), 1))


def add_priority(df: DataFrame, risk: str = "esg_risk_score", exposure: str = "exposure_score") -> DataFrame:
    return df.withColumn("priority_score", round_half_even(F.col(risk) / 100.0 * F.col(exposure), 2))


def risk_trends(
    df: DataFrame, entity: str = "country", period: str = "year", risk: str = "esg_risk_score"
) -> DataFrame:
    """Least-squares slope of risk over the periods per entity, null below three points or with one period only."""
    enough = F.regr_count(risk, period) >= MIN_TREND_POINTS
    slope = F.when(enough, F.regr_slope(risk, period))
    return df.dropna(subset=[entity]).groupBy(entity).agg(round_settled(slope, 3).alias("risk_trend"))


def add_risk_trend(
    df: DataFrame, entity: str = "country", period: str = "year", risk: str = "esg_risk_score"
) -> DataFrame:
    return df.join(risk_trends(df, entity, period, risk), entity, "left").select(*df.columns, "risk_trend")


def without_lending(amount: Column) -> Column:
    return amount.isNull() | (amount == 0)


def add_lending_gap(df: DataFrame, risk: str = "esg_risk_score", amount: str = "lending_amount") -> DataFrame:
    """1 for high risk without lending, else 0; an unknown risk is no high risk."""
    return df.withColumn("lending_gap", flag((F.col(risk) >= GAP_RISK) & without_lending(F.col(amount))))
