"""Roll-ups of loans and ratings to entity and period, and their re-aggregation on a join key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.numeric import round_settled


def total(column: str) -> Column:
    """Sum that is 0 where nothing but nulls is summed."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def aggregate_loans(loans: DataFrame, country: str = "country", period: str = "fiscal_year") -> DataFrame:
    """Committed and disbursed amounts and number of loans per country and fiscal year."""
    return (
        loans.dropna(subset=[country, period])
        .groupBy(country, period)
        .agg(
            total("commitment_amount").alias("commitment_amount"),
            total("disbursement_amount").alias("disbursement_amount"),
            F.count("*").alias("n_loans"),
        )
        .withColumn("lending_amount", F.col("commitment_amount"))
    )


def aggregate_ratings(ratings: DataFrame, country: str = "country", period: str = "closing_year") -> DataFrame:
    """Evaluated projects and share of successful ones, in percent, per country and closing year."""
    return (
        ratings.dropna(subset=[country, period])
        .groupBy(country, F.col(period).alias("year"))
        .agg(
            F.count("*").alias("projects_evaluated"),
            round_settled(F.avg("is_successful") * 100.0, 1).alias("success_rate"),
        )
    )


def lending_by_key(lending: DataFrame, key: str = "join_key", period: str = "fiscal_year") -> DataFrame:
    """Sum of the amounts per join key and period, so that two spellings of one country do not multiply rows."""
    return (
        lending.dropna(subset=[key, period])
        .groupBy(key, period)
        .agg(*[total(c).alias(c) for c in ("lending_amount", "commitment_amount", "disbursement_amount")])
    )


def success_by_key(success: DataFrame, key: str = "join_key", period: str = "year") -> DataFrame:
    """Mean of the success rates per join key and period, weighted by the projects behind them."""
    weighted = F.sum(F.col("success_rate") * F.col("projects_evaluated"))
    return (
        success.dropna(subset=[key, period])
        .groupBy(key, period)
        .agg(
            F.sum("projects_evaluated").alias("projects_evaluated"),
            round_settled(F.try_divide(weighted, F.sum("projects_evaluated")), 1).alias("success_rate"),
        )
    )
