"""Bronze job: landed feeds to the three fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.operators.rollups import total
from riskloom.session import releasing
from riskloom.sinks.tables import Written, overwrite, upsert, write_csv
from riskloom.sources.envelopes import batch_completeness, pair_page_completeness, parse_countries, parse_observations, read_pages
from riskloom.sources.feeds import esg_bronze, loans_bronze, normalise_ratings
from riskloom.sources.resolve import first_non_empty
from riskloom.vocabulary import BRONZE_KEYS, LOANS, RATINGS

_NOTHING = T.StructType([])
#: Buckets of new loan and rating tables: an upsert of a few keys rewrites as many of them at most.
KEY_BUCKETS = 32


@dataclass(frozen=True)
class Landed:
    """Where the feeds were landed. ``indicators`` holds one folder ``indicator=<code>`` per indicator."""

    countries: str
    indicators: str
    loans: Mapping[str, Sequence[str]] = field(default_factory=dict)
    ratings: Sequence[str] = ()


def require_pages(pages: DataFrame) -> DataFrame:
    """``pages`` if as many pages as announced have landed for each ``indicator``; raises otherwise."""
    gaps = pair_page_completeness(pages).filter(~F.col("complete"))
    if gap := gaps.orderBy("indicator").first():
        raise ValueError(
            f"{gap.pages_landed} of {gap.pages_announced} pages of {gap.indicator} have landed, at least this one is incomplete"
        )
    return pages


def landed_feed(spark: SparkSession, paths: Sequence[str], feed: str) -> DataFrame:
    """Rows of the first folder that holds any; raises where fewer rows than announced have landed there."""
    for path in paths:
        rows = first_non_empty([path], spark, _NOTHING)
        if not rows.columns:
            continue
        state = batch_completeness(read_pages(spark, path).withColumn("feed", F.lit(feed))).first()
        if not state.complete:
            raise ValueError(f"{state.rows_landed} of {state.rows_announced} rows of {feed} have landed")
        return rows
    return spark.createDataFrame([], _NOTHING)


def bronze_tables(
    spark: SparkSession, landed: Landed, start: int | None = None, end: int | None = None, skip_ratings: bool = False
) -> dict[str, DataFrame]:
    """The bronze tables as frames; the ratings are left out when skipped or empty. Missing indicator or country pages and missing loan or rating rows raise."""
    countries = parse_countries(
        require_pages(read_pages(spark, landed.countries).withColumn("indicator", F.lit("countries")))
    )
    pages = require_pages(spark.read.text(landed.indicators, wholetext=True).withColumnRenamed("value", "page"))
    tables = {"esg": esg_bronze(parse_observations(pages), countries, start, end)}
    feeds = {source: landed_feed(spark, paths, source) for source, paths in landed.loans.items()}
    if feeds:
        tables["loans"] = loans_bronze(feeds)
    if not skip_ratings:
        raw = landed_feed(spark, landed.ratings, "ratings")
        if raw.columns:
            tables["ratings"] = normalise_ratings(raw)
    return tables


def loans_have_ids(loans: DataFrame) -> bool:
    return "loan_id" in loans.columns and not loans.filter(F.col("loan_id").isNotNull()).isEmpty()


def loans_per_source(loans: DataFrame) -> DataFrame:
    """Loans without ids, rolled up to the grain at which they can be matched again, which gives them an id.

    The id is null where a part of it is missing, so that these rows are set aside.
    """
    keys = BRONZE_KEYS["loans_without_id"]
    parts = [p for k in keys for p in (F.lit("|"), F.col(k).cast("string"))]
    return loans.groupBy(*keys).agg(
        total("commitment_amount").alias("commitment_amount"), total("disbursement_amount").alias("disbursement_amount")
    ).withColumn("loan_id", F.concat(F.lit("all"), *parts)).select(*LOANS.names)


def write_bronze(
    tables: Mapping[str, DataFrame], database: str, fmt: str = "parquet", loan_keys: Sequence[str] | None = None,
    buckets: int = KEY_BUCKETS,
) -> dict[str, Written]:
    """Upsert the bronze tables into ``database`` on their keys; loans without any id as sums per country, year and source.

    Rows set aside for a missing key are kept in ``<table>_quarantine``, which holds those of the latest run.
    """
    written = {"esg": upsert(tables["esg"], f"{database}.esg", BRONZE_KEYS["esg"], fmt=fmt, partition_by=["year"])}
    if "loans" in tables:
        loans = tables["loans"].select(*LOANS.names)
        if loan_keys is None and not loans_have_ids(loans):
            loans = loans_per_source(loans)
        written["loans"] = upsert(loans, f"{database}.loans", loan_keys or BRONZE_KEYS["loans"], fmt=fmt, buckets=buckets)
    ratings = tables.get("ratings")
    if ratings is not None and not ratings.isEmpty():
        written["ratings"] = upsert(
            ratings.filter("project_id IS NOT NULL").select(*RATINGS.names),
            f"{database}.ratings",
            BRONZE_KEYS["ratings"],
            fmt=fmt,
            buckets=buckets,
        )
    for name, result in written.items():
        aside = f"{database}.{name}_quarantine"
        if not result.quarantine.isEmpty() or result.quarantine.sparkSession.catalog.tableExists(aside):
            overwrite(result.quarantine, aside, fmt)
    return written


def write_bronze_files(tables: Mapping[str, DataFrame], out: str) -> dict[str, int]:
    """The bronze tables as CSV folders; a table without columns, from feeds that had no data, is left out."""
    return {name: write_csv(df, f"{out}/{name}.csv") for name, df in tables.items() if df.columns}


def run_bronze(
    spark: SparkSession, landed: Landed, database: str, *, start: int | None = None, end: int | None = None,
    skip_ratings: bool = False, fmt: str = "parquet",
) -> dict[str, Written]:
    with releasing(spark):
        return write_bronze(bronze_tables(spark, landed, start, end, skip_ratings), database, fmt)
