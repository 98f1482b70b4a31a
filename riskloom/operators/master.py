"""The master table: scores, lending and success per country and year."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.text import alias_key, clean_key
from riskloom.operators.matching import canonical_names, distinct_spellings, spelling_keys, with_key
from riskloom.operators.rollups import lending_by_key, success_by_key
from riskloom.vocabulary import AGGREGATE_LOANS, AGGREGATE_RATINGS, COUNTRY_ALIASES, MASTER, MATCH_THRESHOLD


def _keyed(
    esg: DataFrame, lending: DataFrame, success: DataFrame, match: str, threshold: float, aliases: Mapping[str, str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    if match == "alias":
        key = lambda df: df.withColumn("join_key", alias_key(F.col("country"), aliases))
        return key(esg), key(lending), key(success)
    keyed = lambda df: df.withColumn("join_key", clean_key(F.col("country")))
    if match == "equal":
        return keyed(esg), keyed(lending), keyed(success)
    if match != "scored":
        raise ValueError(f"unknown match: {match}")
    spellings = distinct_spellings((lending, "country"), (success, "country"))
    keys = spelling_keys(spellings, canonical_names(esg), threshold)
    return keyed(esg), with_key(lending, "country", keys), with_key(success, "country", keys)


def build_master(
    esg: DataFrame,
    lending: DataFrame | None = None,
    success: DataFrame | None = None,
    *,
    match: str = "scored",
    threshold: float = MATCH_THRESHOLD,
    aliases: Mapping[str, str] = COUNTRY_ALIASES,
    reaggregate: bool = True,
) -> DataFrame:
    """Left-join the lending and success roll-ups to the scores on country and year.

    ``match`` says how a country name becomes a key: ``scored`` by best match, ``alias`` by the alias list, ``equal``
    by its cleaned form only. Roll-ups whose names share a key are added up first, unless ``reaggregate`` is off, in
    which case a country with two spellings yields two rows. A missing roll-up leaves its columns null.

    Both joins use the key and year, and the re-aggregated sides are partitioned by them already, so the scores are
    shuffled once for both.
    """
    spark = esg.sparkSession
    lending = spark.createDataFrame([], AGGREGATE_LOANS) if lending is None else lending
    success = spark.createDataFrame([], AGGREGATE_RATINGS) if success is None else success
    esg, lending, success = _keyed(esg, lending, success, match, threshold, aliases)
    if reaggregate:
        lending, success = lending_by_key(lending), success_by_key(success)
    lending = lending.dropna(subset=["join_key", "fiscal_year"]).select(
        "join_key",
        F.col("fiscal_year").alias("year"),
        "lending_amount",
        "commitment_amount",
        "disbursement_amount",
    )
    success = success.dropna(subset=["join_key", "year"]).select(
        "join_key", "year", "projects_evaluated", "success_rate"
    )
    joined = esg.join(lending, ["join_key", "year"], "left").join(success, ["join_key", "year"], "left")
    return joined.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MASTER.fields])


def top_borrowers(master: DataFrame, k: int = 10) -> DataFrame:
    """Largest borrowers of the latest year in which a country has both a score and lending."""
    both = master.dropna(subset=["esg_score", "lending_amount"])
    latest = both.agg(F.max("year").alias("year")).scalar()
    return (
        both.filter(F.col("year") == latest)
        .orderBy(F.desc("lending_amount"), "country", "iso3")
        .limit(k)
        .select(
            "country", "year", "environmental_score", "social_score", "governance_score", "esg_risk_score",
            "lending_amount",
        )
    )
