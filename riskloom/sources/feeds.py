"""From raw feed rows to the three bronze tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.dates import fiscal_year, puts_day_first, to_date
from riskloom.functions.numeric import to_double
from riskloom.functions.text import is_success, strip_text, year_in_text
from riskloom.sources.resolve import resolve, resolved
from riskloom.vocabulary import ESG, INDICATORS, LOAN_FIELDS, LOANS, RATING_FIELDS, RATINGS


def _within(df: DataFrame, column: str, start: int | None, end: int | None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(column) >= start)
    if end is not None:
        df = df.filter(F.col(column) <= end)
    return df


def pillar_of(indicator: Column, indicators: Mapping[str, tuple[str, str, int]] = INDICATORS) -> Column:
    """Pillar of an indicator code, null for a code that is not listed.

    The list is reference data of fixed size, so it becomes an expression and needs no join.
    """
    pillar = F.lit(None).cast("string")
    for name in dict.fromkeys(entry[0] for entry in indicators.values()):
        codes = [code for code, entry in indicators.items() if entry[0] == name]
        pillar = F.when(indicator.isin(codes), name).otherwise(pillar)
    return pillar


def real_entities(df: DataFrame, countries: DataFrame, key: str = "iso3") -> DataFrame:
    """Rows whose key is in the country dimension."""
    return df.join(countries.select(key), key, "left_semi")


def esg_bronze(
    observations: DataFrame,
    countries: DataFrame,
    start: int | None = None,
    end: int | None = None,
    indicators: Mapping[str, tuple[str, str, int]] = INDICATORS,
) -> DataFrame:
    """Observations of the listed indicators and real countries within the years, tagged with their pillar."""
    wanted = _within(observations, "year", start, end).filter(F.col("indicator").isin(list(indicators)))
    tagged = real_entities(wanted, countries).withColumn("pillar", pillar_of(F.col("indicator"), indicators))
    return tagged.select(*ESG.names)


def normalise_loans(raw: DataFrame, source: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Loans of one feed in the common layout, one row per loan.

    A feed without country, approval date or principal yields no rows. Loans without a fiscal year are dropped. Whether
    the feed writes the day or the month first is found in the whole column before its dates are read.
    """
    if any(resolve(raw, LOAN_FIELDS[f]) is None for f in ("country", "approval", "principal")):
        return raw.sparkSession.createDataFrame([], LOANS)
    if resolve(raw, LOAN_FIELDS["disbursed"]) is None:
        disbursed = F.lit(0.0)
    else:
        disbursed = to_double(resolved(raw, LOAN_FIELDS["disbursed"]))
    approval = resolved(raw, LOAN_FIELDS["approval"])
    loans = raw.select(
        strip_text(resolved(raw, LOAN_FIELDS["loan_id"])).alias("loan_id"),
        strip_text(resolved(raw, LOAN_FIELDS["country"])).alias("country"),
        fiscal_year(to_date(approval, day_first=puts_day_first(raw, approval))).alias("fiscal_year"),
        to_double(resolved(raw, LOAN_FIELDS["principal"])).alias("commitment_amount"),
        disbursed.alias("disbursement_amount"),
        F.lit(source).alias("source"),
    )
    return _within(loans.filter(F.col("fiscal_year").isNotNull()), "fiscal_year", start, end)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Bag union by column name."""
    result = feeds[0]
    for feed in feeds[1:]:
        result = result.unionByName(feed, allowMissingColumns=True)
    return result


def loans_bronze(feeds: Mapping[str, DataFrame], start: int | None = None, end: int | None = None) -> DataFrame:
    """Loans of all feeds, each tagged with the name it is listed under."""
    return union_feeds(*[normalise_loans(raw, source, start, end) for source, raw in feeds.items()])


def normalise_ratings(raw: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Project ratings in the common layout, one row per project; a field the feed lacks is null."""
    outcome = strip_text(resolved(raw, RATING_FIELDS["outcome"]))
    ratings = raw.select(
        resolved(raw, RATING_FIELDS["project_id"]).cast("string").alias("project_id"),
        strip_text(resolved(raw, RATING_FIELDS["country"])).alias("country"),
        outcome.alias("outcome_rating"),
        resolved(raw, RATING_FIELDS["sector"]).cast("string").alias("sector"),
        year_in_text(resolved(raw, RATING_FIELDS["closing"])).alias("closing_year"),
        is_success(outcome).alias("is_successful"),
    )
    assert ratings.columns == RATINGS.names
    return _within(ratings, "closing_year", start, end)
