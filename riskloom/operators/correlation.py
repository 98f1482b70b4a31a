"""Correlation of risk and success, and statistics per risk bin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.numeric import risk_bin, round_settled
from riskloom.functions.significance import p_value
from riskloom.operators.ranks import average_ranks
from riskloom.session import stored, together
from riskloom.vocabulary import MIN_PAIRED_ROWS, RISK_BINS, SCORE_COLUMNS, SIGNIFICANCE


def paired(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()


def _clipped(r: Column) -> Column:
    return F.when(r > 1.0, 1.0).when(r < -1.0, -1.0).otherwise(r)


def pearson(df: DataFrame, x: str = "esg_risk_score", y: str = "success_rate") -> DataFrame:
    """Rows with both values, and their correlation; null below five rows and for a constant column."""
    r = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    return paired(df, x, y).agg(
        F.count("*").alias("n"),
        F.when(F.count("*") >= MIN_PAIRED_ROWS, _clipped(r)).alias("r"),
    )


def _weighted(x: Column, y: Column, weight: Column) -> Column:
    """Correlation of deviations from the mean that occur ``weight`` times; null where one is always 0."""
    product, of_x, of_y = F.sum(weight * x * y), F.sum(weight * x * x), F.sum(weight * y * y)
    return _clipped(F.try_divide(product, F.sqrt(of_x) * F.sqrt(of_y)))


def _ranked_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Distinct pairs with their ``weight`` and the average rank of both values.

    Equal pairs are counted and stored first, so that only distinct pairs and distinct values move, however often one
    occurs, and the rows are read once.
    """
    pairs = stored(paired(df, x, y).groupBy("x", "y").agg(F.count("*").alias("weight")), "pairs")

    def ranks(column: str) -> DataFrame:
        counts = pairs.groupBy(F.col(column).alias("v")).agg(F.sum("weight").alias("n"))
        return average_ranks(counts, "v", "n").select(F.col("v").alias(column), F.col("rank").alias(f"rank_{column}"))

    of_x, of_y = together(lambda: ranks("x"), lambda: ranks("y"))
    means = pairs.agg(
        F.coalesce(F.sum("weight"), F.lit(0).cast("bigint")).alias("n"),
        # the mean of equal values is that value, without a rounding error that would count as spread
        *[F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.sum(F.col(c) * F.col("weight")) / F.sum("weight")).alias(f"mean_{c}")
          for c in ("x", "y")],
    )
    # the means are one row, which is a value and needs no join
    ranked = pairs.join(of_x, "x").join(of_y, "y").withColumn("means", means.select(F.struct("*")).scalar())
    return ranked.select("*", "means.*").drop("means")


def _correlations(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: ``n``, ``r`` and ``rho``, all from the distinct pairs.

    Both rank columns have the mean ``(n+1)/2``, so both correlations are weighted sums over distinct pairs.
    """
    weight, middle = F.col("weight"), (F.col("n") + 1) / 2.0
    enough = F.coalesce(F.max("n"), F.lit(0)) >= MIN_PAIRED_ROWS
    r = _weighted(F.col("x") - F.col("mean_x"), F.col("y") - F.col("mean_y"), weight)
    rho = _weighted(F.col("rank_x") - middle, F.col("rank_y") - middle, weight)
    return _ranked_pairs(df, x, y).agg(
        F.coalesce(F.max("n"), F.lit(0).cast("bigint")).alias("n"),
        F.when(enough, r).alias("r"),
        F.when(enough, rho).alias("rho"),
    )


def spearman(df: DataFrame, x: str = "esg_risk_score", y: str = "success_rate") -> DataFrame:
    """Rank correlation with average ranks for ties."""
    return _correlations(df, x, y).select("n", "rho")


def risk_success_correlation(df: DataFrame, x: str = "esg_risk_score", y: str = "success_rate") -> DataFrame:
    """Both correlations with their p-values and whether either is significant; one row, empty below five pairs."""
    both = _correlations(df, x, y)
    tested = both.withColumn("p", p_value(F.col("r"), F.col("n"))).withColumn("p_rho", p_value(F.col("rho"), F.col("n")))
    significant = F.coalesce(F.col("p") < SIGNIFICANCE, F.lit(False)) | F.coalesce(
        F.col("p_rho") < SIGNIFICANCE, F.lit(False)
    )
    return tested.filter(F.col("n") >= MIN_PAIRED_ROWS).select("n", "r", "rho", "p", "p_rho", significant.alias("significant"))


def linear_fit(df: DataFrame, x: str = "esg_risk_score", y: str = "success_rate") -> DataFrame:
    """Least-squares line of ``y`` over ``x`` with its correlation, p-value and end points; empty below five pairs."""
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    fit = paired(df, x, y).agg(
        F.count("*").alias("n"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        _clipped(F.try_divide(F.covar_pop("x", "y"), spread)).alias("r"),
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
    )
    at = lambda c: F.col("intercept") + F.col("slope") * F.col(c)
    return (
        fit.filter(F.col("n") >= MIN_PAIRED_ROWS)
        .withColumn("p", p_value(F.col("r"), F.col("n")))
        .withColumn("y_at_min", at("x_min"))
        .withColumn("y_at_max", at("x_max"))
    )


def bin_rows(aggregated: DataFrame, outputs: Sequence[str], bins=RISK_BINS) -> DataFrame:
    """Turn one row with columns ``<output>_<bin number>`` into one row per bin."""
    rows = [
        F.struct(
            F.lit(i).alias("bin_id"),
            F.lit(name).alias("risk_group"),
            *[F.col(f"{o}_{i}").alias(o) for o in outputs],
        )
        for i, (name, _, _) in enumerate(bins)
    ]
    return aggregated.select(F.inline(F.array(*rows)))


def success_by_risk_bin(df: DataFrame, risk: str = "esg_risk_score", rate: str = "success_rate") -> DataFrame:
    """Mean success rate and row count per risk bin over rows with both values; empty bins are listed too."""
    binned = df.dropna(subset=[risk, rate]).withColumn("risk_group", risk_bin(F.col(risk)))
    measures = []
    for i, (name, _, _) in enumerate(RISK_BINS):
        inside = F.when(F.col("risk_group") == name, F.col(rate))
        measures += [
            round_settled(F.avg(inside), 1).alias(f"avg_success_rate_{i}"),
            F.count(inside).alias(f"n_{i}"),
        ]
    return bin_rows(binned.agg(*measures), ("avg_success_rate", "n"))


def pillars_by_risk_bin(
    df: DataFrame, risk: str = "esg_risk_score", period: str = "year", columns: Sequence[str] = SCORE_COLUMNS
) -> DataFrame:
    """Mean pillar scores of the latest year per risk bin and over all rows (bin ``ALL``)."""
    latest = df.agg(F.max(period).alias("latest")).scalar()
    binned = df.filter(F.col(period) == latest).withColumn("risk_group", risk_bin(F.col(risk)))
    groups = (*RISK_BINS, ("ALL", 0.0, 0.0))
    measures = [
        round_settled(
            F.avg(F.col(c) if name == "ALL" else F.when(F.col("risk_group") == name, F.col(c))), 1
        ).alias(f"{c}_{i}")
        for i, (name, _, _) in enumerate(groups)
        for c in columns
    ]
    return bin_rows(binned.agg(*measures), columns, groups)
