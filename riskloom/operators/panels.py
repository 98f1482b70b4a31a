"""Ranked tables and chart data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.numeric import flag, risk_band, round_half_even
from riskloom.operators.correlation import linear_fit
from riskloom.operators.exposure import without_lending
from riskloom.operators.rollups import total
from riskloom.vocabulary import GAP_PANEL_RISK, GAP_RISK, QUADRANT_SPLIT, SCORE_COLUMNS, TREND_CUTOFF

TIES = ("country", "iso3", "year")


def _top(df: DataFrame, column: str, k: int, ties=TIES) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column), *[t for t in ties if t in df.columns]).limit(k)


def latest_period(df: DataFrame, period: str = "year") -> Column:
    return df.agg(F.max(period).alias("latest")).scalar()


def busiest_period(df: DataFrame, period: str = "year", measure: str = "lending_amount") -> DataFrame:
    """Period with the most present values, the earliest of equal ones."""
    counts = df.groupBy(period).agg(F.count(measure).alias("n"))
    return counts.agg(F.max_by(period, F.struct("n", -F.col(period))).alias(period), F.max("n").alias("n"))


def snapshot(df: DataFrame, year: int | Column | None = None) -> DataFrame:
    """Rows of one year, all rows without one."""
    return df if year is None else df.filter(F.col("year") == year)


def top_priority(df: DataFrame, year: int | None = None, k: int = 15) -> DataFrame:
    """Countries of the highest priority in one year, or in all."""
    ranked = _top(snapshot(df, year).dropna(subset=["priority_score"]), "priority_score", k)
    digits = {"esg_risk_score": 1, "exposure_score": 1, "priority_score": 2, "success_rate": 1}
    return ranked.select("country", "year", *[round_half_even(F.col(c), d).alias(c) for c, d in digits.items()])


def top_gap(df: DataFrame, k: int = 10) -> DataFrame:
    """Countries of the highest risk without lending in the latest year."""
    rows = snapshot(df, latest_period(df)).filter(
        (F.col("esg_risk_score") >= GAP_RISK) & without_lending(F.col("lending_amount"))
    )
    return _top(rows, "esg_risk_score", k).select(
        "country", *[round_half_even(F.col(c), 1).alias(c) for c in
                     ("esg_risk_score", "social_score", "environmental_score")]
    )


# --- the six panels --------------------------------------------------------------------------------------------------


def top_risk_panel(rows: DataFrame, k: int = 20) -> DataFrame:
    """Highest risks with their presentation band, in ascending order."""
    top = _top(rows.dropna(subset=["country", "esg_risk_score"]), "esg_risk_score", k)
    return top.select("country", "esg_risk_score", risk_band(F.col("esg_risk_score")).alias("band")).orderBy(
        "esg_risk_score", F.desc("country")
    )


def _labelled(rows: DataFrame, by: str, k: int) -> DataFrame:
    """Mark the ``k`` rows of the greatest ``by``, ties by ``TIES``; rows equal in all of these are marked alike.

    Each row is compared with the last marked one, a single value, so rows are neither joined nor multiplied.
    """
    present = F.col(by).isNotNull() & ~F.isnan(by)
    place = F.struct((-F.col(by)).alias("by"), *TIES)
    last = _top(rows.filter(present), by, k).agg(F.max(place).alias("last")).scalar()
    return rows.withColumn("label", F.coalesce((present & (place <= last)).cast("int"), F.lit(0)))


def pillar_scatter_panel(rows: DataFrame, k: int = 4) -> DataFrame:
    """Social over environmental score; the highest risks carry a label."""
    kept = rows.dropna(subset=["social_score", "environmental_score", "esg_risk_score"])
    return _labelled(kept, "esg_risk_score", k).select(
        "country", "environmental_score", "social_score", "esg_risk_score", "label"
    )


def gap_panel(rows: DataFrame, k: int = 25) -> DataFrame:
    """Highest risks above the panel's limit and whether they have lending, in ascending order."""
    risky = rows.filter(F.col("esg_risk_score") >= GAP_PANEL_RISK)
    top = _top(risky, "esg_risk_score", k)
    lending = flag(F.col("lending_amount") > 0)
    return top.select("country", "esg_risk_score", lending.alias("has_lending")).orderBy(
        "esg_risk_score", F.desc("country")
    )


def trend_panel(df: DataFrame, k: int = 10) -> DataFrame:
    """Countries that improve and that worsen most; the trend is the same in all rows of a country."""
    trends = df.groupBy("country").agg(F.max("risk_trend").alias("risk_trend")).dropna()
    improving = trends.filter(F.col("risk_trend") < -TREND_CUTOFF).orderBy("risk_trend", "country").limit(k)
    worsening = trends.filter(F.col("risk_trend") > TREND_CUTOFF).orderBy(F.desc("risk_trend"), "country").limit(k)
    return improving.withColumn("direction", F.lit("improving")).unionByName(
        worsening.withColumn("direction", F.lit("worsening"))
    )


def success_scatter_panel(df: DataFrame) -> DataFrame:
    return df.select("country", "year", "esg_risk_score", "success_rate").dropna(
        subset=["esg_risk_score", "success_rate"]
    )


def priority_matrix_panel(rows: DataFrame, k: int = 5) -> DataFrame:
    """Risk over exposure with quadrant; the highest priorities carry a label."""
    kept = rows.dropna(subset=["esg_risk_score", "exposure_score"])
    high_risk, high_exposure = (F.col(c) > QUADRANT_SPLIT for c in ("esg_risk_score", "exposure_score"))
    quadrant = F.concat(
        F.when(high_risk, "High Risk / ").otherwise("Low Risk / "),
        F.when(high_exposure, "High Exposure").otherwise("Low Exposure"),
    )
    return _labelled(kept, "priority_score", k).select(
        "country", "exposure_score", "esg_risk_score", "priority_score", quadrant.alias("quadrant"), "label"
    )


def dashboard_panels(df: DataFrame, year: int | None = None) -> dict[str, DataFrame]:
    """Data of the six panels; without a year the snapshot is the year with the most lending values."""
    chosen = busiest_period(df).select("year").scalar() if year is None else year
    rows = snapshot(df, chosen)
    return {
        "top_risk": top_risk_panel(rows),
        "pillar_scatter": pillar_scatter_panel(rows),
        "lending_gap": gap_panel(rows),
        "risk_trend": trend_panel(df),
        "success_scatter": success_scatter_panel(df),
        "success_fit": linear_fit(df),
        "priority_matrix": priority_matrix_panel(rows),
    }


# --- the four notebook charts ----------------------------------------------------------------------------------------


def pillar_chart(df: DataFrame, k: int = 15) -> DataFrame:
    """Mean pillar scores of the countries with the highest mean score, one row per country and pillar."""
    means = df.groupBy("country").agg(
        F.avg("esg_score").alias("avg_esg_score"), *[F.avg(c).alias(c) for c in SCORE_COLUMNS]
    )
    top = _top(means, "avg_esg_score", k)
    return top.unpivot(["country"], list(SCORE_COLUMNS), "pillar", "score")


def lending_chart(df: DataFrame, k: int = 15) -> DataFrame:
    """Countries with the most lending, in ascending order."""
    totals = df.groupBy("country").agg(total("lending_amount").alias("lending_amount"))
    return _top(totals, "lending_amount", k).orderBy("lending_amount", F.desc("country"))


def success_chart(df: DataFrame) -> DataFrame:
    """Mean scores and success rate per country that has one, with the mean of the countries' rates."""
    means = df.groupBy("country").agg(
        F.avg("esg_score").alias("avg_esg_score"),
        F.avg("esg_risk_score").alias("avg_esg_risk_score"),
        F.avg("success_rate").alias("avg_success_rate"),
    ).dropna(subset=["avg_success_rate"])
    portfolio = means.agg(F.avg("avg_success_rate").alias("m")).scalar()
    return means.withColumn("portfolio_success_rate", portfolio)
