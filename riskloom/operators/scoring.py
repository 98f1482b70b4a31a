"""Min-max scores per indicator and period, averaged into pillar scores per entity and period."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.numeric import mean_of_present, round_settled
from riskloom.session import stored
from riskloom.vocabulary import INDICATORS, PILLARS

INVERTED = tuple(code for code, (_, _, direction) in INDICATORS.items() if direction < 0)


def group_bounds(
    facts: DataFrame, by: Sequence[str] = ("indicator", "year"), value: str = "value"
) -> DataFrame:
    """Least and greatest value per group; partial aggregation leaves one row per group and task to shuffle."""
    return facts.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def normalise(
    facts: DataFrame,
    by: Sequence[str] = ("indicator", "year"),
    value: str = "value",
    code: str = "indicator",
    inverted: Collection[str] = INVERTED,
    output: str = "norm",
) -> DataFrame:
    """Add the value's position between the least (0) and the greatest (100) value of its group.

    A group with one distinct value scores 50. For ``inverted`` codes 0 and 100 are swapped; other codes, also unknown
    ones, are not inverted. A group may be of any size (there are few groups and many facts), so the bounds are
    aggregated and joined back, not computed in a window. They are stored first: the planner then knows their size
    and broadcasts them only if they are small; otherwise the join shuffles and splits hot groups at run time.
    """
    bounds = stored(group_bounds(facts, by, value), "bounds")
    position = (F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * 100.0
    directed = F.when(F.col(code).isin(*inverted), 100.0 - position).otherwise(position)
    scored = F.when(F.col("hi") == F.col("lo"), F.lit(50.0)).otherwise(directed)
    return (
        facts.join(bounds, list(by), "left")
        .withColumn(output, F.when(F.col(value).isNotNull(), scored))
        .drop("lo", "hi")
        .select(*facts.columns, output)
    )


def pillar_scores(
    normalised: DataFrame,
    entity: Sequence[str] = ("iso3", "country", "year"),
    pillar: str = "pillar",
    norm: str = "norm",
    pillars: Sequence[str] = PILLARS,
) -> DataFrame:
    """Mean score per pillar as columns, their mean as ``esg_score`` and its complement as ``esg_risk_score``.

    Pillars are averaged unrounded; all scores are rounded to one digit at the end.
    """
    keyed = normalised.dropna(subset=[*entity, pillar])
    means = keyed.groupBy(*entity).agg(
        *[F.avg(F.when(F.col(pillar) == p, F.col(norm))).alias(f"{p}_score") for p in pillars]
    )
    names = [f"{p}_score" for p in pillars]
    overall = mean_of_present(*[F.col(n) for n in names])
    scored = means.withColumn("esg_score", overall).withColumn("esg_risk_score", 100.0 - F.col("esg_score"))
    return scored.select(
        *entity,
        *[round_settled(F.col(n), 1).alias(n) for n in (*sorted(names), "esg_score", "esg_risk_score")],
    )


def aggregate_esg(facts: DataFrame, inverted: Collection[str] = INVERTED) -> DataFrame:
    """Scores per country and year from indicator values."""
    return pillar_scores(normalise(facts, inverted=inverted))
