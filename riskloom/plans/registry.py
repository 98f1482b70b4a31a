"""Registered queries: every operator on the star-schema tables, as ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.functions.dates import fiscal_year
from riskloom.functions.numeric import flag, percent_of, risk_band, risk_bin, round_half_even, to_double
from riskloom.functions.text import alias_key, clean_key, strip_text, year_in_text
from riskloom.operators import panels
from riskloom.operators.correlation import (
    linear_fit,
    pearson,
    pillars_by_risk_bin,
    risk_success_correlation,
    spearman,
    success_by_risk_bin,
)
from riskloom.operators.coverage import coverage_report, years_covered
from riskloom.operators.dedup import one_per_key, split_null_keys
from riskloom.operators.exposure import add_exposure, add_lending_gap, add_priority, add_risk_trend, risk_trends
from riskloom.operators.master import build_master, top_borrowers
from riskloom.operators.matching import (
    canonical_names,
    distinct_names,
    distinct_spellings,
    match_audit,
    match_to_canonical,
)
from riskloom.operators.ranks import average_ranks
from riskloom.operators.rollups import aggregate_loans, aggregate_ratings, lending_by_key, success_by_key
from riskloom.operators.scoring import normalise, pillar_scores
from riskloom.operators.summary import country_summary
from riskloom.plans.analysis import analysis_columns, enrich
from riskloom.plans.job_queries import JOB_QUERIES
from riskloom.session import shared_folder, stored, together
from riskloom.sinks.tables import merged, write_csv
from riskloom.sources import star
from riskloom.sources.envelopes import (
    batch_completeness,
    pair_page_completeness,
    parse_batches,
    parse_countries,
    parse_observations,
)
from riskloom.sources.feeds import loans_bronze, normalise_loans, normalise_ratings, real_entities, union_feeds
from riskloom.sources.files import CSV_OPTIONS, read_table_file
from riskloom.sources.resolve import first_non_empty
from riskloom.vocabulary import LOANS

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

NATION_ALIASES = {"nation_0": "nation_5", "nation_1": "nation_5", "nation_2": "nation_7"}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: round_half_even(F.col(c), digits) for c in columns})


# --- shared inputs ---------------------------------------------------------------------------------------------------


def _scores(spark: SparkSession, folder: str, grain: str) -> DataFrame:
    facts = stored(star.esg(spark, folder, grain), "esg")
    return pillar_scores(normalise(facts, inverted=star.INVERTED))


def _lending(spark: SparkSession, folder: str, grain: str, source: str | None = None) -> DataFrame:
    return aggregate_loans(star.loans(spark, folder, grain, source))


def _success(spark: SparkSession, folder: str, grain: str) -> DataFrame:
    return aggregate_ratings(star.ratings(spark, folder, grain))


def _master(spark: SparkSession, folder: str, grain: str = "customer", match: str = "equal") -> DataFrame:
    """Master table of customers (many entities, gaps in lending and success) or of nations.

    The roll-ups are stored as in the gold job; a match by score reads them twice, for their names and for their rows.
    """
    rollups = (
        lambda: _scores(spark, folder, grain),
        lambda: _lending(spark, folder, grain),
        lambda: _success(spark, folder, grain),
    )
    scores, lending, success = together(*[lambda f=f: stored(f(), "rollup") for f in rollups])
    return build_master(scores, lending, success, match=match)


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(stored(_master(spark, folder), "master"))


def _exposed(spark: SparkSession, folder: str) -> DataFrame:
    return add_priority(add_exposure(stored(_master(spark, folder), "master")))


def _busiest_snapshot(df: DataFrame) -> DataFrame:
    return panels.snapshot(df, panels.busiest_period(df).select("year").scalar())


# --- sources ---------------------------------------------------------------------------------------------------------


@query
def country_envelope(spark, folder):
    region = F.when(F.col("region") == "AFRICA", "Aggregates").otherwise(F.col("region"))
    payload = F.struct(
        F.col("iso3").alias("id"),
        F.col("iso2").alias("iso2Code"),
        F.col("country").alias("name"),
        F.struct(region.alias("value")).alias("region"),
        F.struct(F.col("income_level").alias("value")).alias("incomeLevel"),
    )
    return parse_countries(star.pair_pages(star.countries(spark, folder), "region", "n_nationkey", payload))


def _observation_pages(spark, folder):
    customer = F.col("o_custkey").cast("string")
    payload = F.struct(
        F.concat(F.lit("C"), customer).alias("countryiso3code"),
        F.struct(F.concat(F.lit("Customer "), customer).alias("value")).alias("country"),
        F.year("o_orderdate").cast("string").alias("date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value"),
    )
    return star.pair_pages(star.table(spark, folder, "orders"), "o_orderpriority", "o_orderkey", payload)


@query
def indicator_envelope(spark, folder):
    return parse_observations(_observation_pages(spark, folder))


@query
def page_completeness(spark, folder):
    return pair_page_completeness(_observation_pages(spark, folder))


def _batch_pages(spark, folder):
    payload = F.struct(
        F.col("o_orderkey").cast("string").alias("loan_number"),
        F.col("o_totalprice").cast("string").alias("original_principal_amount"),
    )
    return star.batch_pages(star.table(spark, folder, "orders"), "o_orderstatus", "o_orderkey", payload)


@query
def batch_envelope(spark, folder):
    layout = T.StructType([T.StructField(c, T.StringType()) for c in ("loan_number", "original_principal_amount")])
    rows = parse_batches(_batch_pages(spark, folder), layout)
    return rows.select("loan_number", to_double(F.col("original_principal_amount")).alias("principal"))


@query
def feed_completeness(spark, folder):
    return batch_completeness(_batch_pages(spark, folder))


@query
def first_non_empty_feed(spark, folder):
    orders = star.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    candidates = [orders.filter("o_totalprice < 0"), orders.filter("o_orderstatus = 'F'"), orders]
    return first_non_empty(candidates, spark, orders.schema)


@query
def csv_round_trip(spark, folder):
    path = f"{shared_folder(spark)}/loans-{uuid.uuid4().hex}.csv"
    write_csv(star.loans(spark, folder), path)
    return read_table_file(spark, path, LOANS)


@query
def csv_mixed_headers(spark, folder):
    """Loans in one folder of files whose columns differ in order and number."""
    path = f"{shared_folder(spark)}/loans-{uuid.uuid4().hex}.csv"
    loans = stored(star.loans(spark, folder), "loans")
    finished = F.col("source") == "IBRD"
    recent = F.coalesce(F.col("fiscal_year") >= 1996, F.lit(False))
    for rows, columns in (
        (finished, LOANS.names), (~finished & recent, LOANS.names[::-1]), (~finished & ~recent, ["note", *LOANS.names[2:], *LOANS.names[:2]])
    ):
        part = loans.filter(rows).withColumn("note", F.lit("a, \"b\"")).select(*columns)
        part.write.mode("append").options(**CSV_OPTIONS).csv(path)
    return read_table_file(spark, path, LOANS)


# --- normalisers -----------------------------------------------------------------------------------------------------


@query
def loan_normaliser(spark, folder):
    return normalise_loans(star.raw_loans(spark, folder), "IBRD")


@query
def rating_normaliser(spark, folder):
    return normalise_ratings(star.raw_ratings(spark, folder))


@query
def lending_feeds(spark, folder):
    raw = star.raw_loans(spark, folder)
    feeds = {"IBRD": raw.filter("status = 'F'"), "IDA": raw.filter("status <> 'F'")}
    return loans_bronze(feeds, start=1994, end=1997)


@query
def closing_years(spark, folder):
    text = F.concat(
        F.element_at(F.split("o_orderpriority", "-"), 2), F.lit(" "), F.col("o_orderkey").cast("string")
    )
    return star.table(spark, folder, "orders").select("o_orderkey", year_in_text(text).alias("closing_year"))


@query
def success_flags(spark, folder):
    return star.ratings(spark, folder).groupBy("outcome_rating", "is_successful").agg(F.count("*").alias("n"))


@query
def clean_keys(spark, folder):
    accented = F.translate(F.initcap("p_name"), "aeionc", "áèîõñç")
    name = F.concat(F.lit(" \t"), F.upper("p_type"), F.lit(" d’"), accented, F.lit(" "))
    return (
        star.table(spark, folder, "part").select(clean_key(name).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    )


@query
def alias_keys(spark, folder):
    lending = aggregate_loans(star.loans(spark, folder))
    keyed = lending.withColumn("join_key", alias_key(F.col("country"), NATION_ALIASES))
    return _rounded(lending_by_key(keyed), 2, "lending_amount", "commitment_amount", "disbursement_amount")


@query
def real_entity_values(spark, folder):
    real = star.countries(spark, folder).filter("region <> 'AFRICA'")
    return real_entities(star.esg(spark, folder), real)


@query
def tagged_union(spark, folder):
    raw = star.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    finished = raw.filter("o_orderstatus = 'F'").withColumn("source", F.lit("IBRD"))
    others = raw.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", F.lit("IDA").alias("source"))
    return union_feeds(finished, others)


@query
def half_even_rounding(spark, folder):
    price = F.col("l_extendedprice") * F.col("l_discount")
    return star.table(spark, folder, "lineitem").select(
        round_half_even(price, 1).alias("one_digit"),
        round_half_even(price, 2).alias("two_digits"),
        round_half_even(F.col("l_quantity") / 8.0, 1).alias("tie"),
    ).groupBy("one_digit", "two_digits", "tie").agg(F.count("*").alias("n"))


@query
def event_property(spark, folder):
    props = F.try_parse_json("props")
    number = F.try_variant_get(props, "$.k", "double")
    return star.table(spark, folder, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.count(number).alias("n_k"), F.sum(number).alias("sum_k")
    )


# --- scores and roll-ups ---------------------------------------------------------------------------------------------


@query
def fiscal_year_lending(spark, folder):
    return _rounded(
        _lending(spark, folder, "nation"), 2, "commitment_amount", "disbursement_amount", "lending_amount"
    )


@query
def indicator_values(spark, folder):
    return star.esg(spark, folder)


@query
def minmax_normalise(spark, folder):
    facts = stored(star.esg(spark, folder), "esg")
    scored = normalise(facts, inverted=star.INVERTED)
    return _rounded(scored, 6, "norm").drop("value")


@query
def minmax_normalise_orders(spark, folder):
    facts = star.table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("indicator"),
        fiscal_year(F.col("o_orderdate")).alias("year"),
        F.col("o_totalprice").alias("value"),
    )
    return _rounded(normalise(facts, inverted=star.INVERTED), 6, "norm")


@query
def country_scores(spark, folder):
    return _scores(spark, folder, "nation")


@query
def customer_scores(spark, folder):
    return _scores(spark, folder, "customer")


@query
def customer_lending(spark, folder):
    return _rounded(
        _lending(spark, folder, "customer"), 2, "commitment_amount", "disbursement_amount", "lending_amount"
    )


@query
def success_rates(spark, folder):
    return _success(spark, folder, "nation")


@query
def lending_on_key(spark, folder):
    lending = _lending(spark, folder, "nation").withColumn("join_key", alias_key(F.col("country"), NATION_ALIASES))
    return _rounded(lending_by_key(lending), 2, "lending_amount", "commitment_amount", "disbursement_amount")


@query
def success_on_key(spark, folder):
    success = _success(spark, folder, "nation").withColumn("join_key", alias_key(F.col("country"), NATION_ALIASES))
    return success_by_key(success)


# --- matching --------------------------------------------------------------------------------------------------------


def _spellings(spark, folder):
    """Part names in four spellings each, beside the name they come from."""
    parts = star.table(spark, folder, "part").select("p_name", "p_brand")
    words = F.split("p_name", " ")
    return parts.select(
        "p_name",
        F.explode(
            F.array(
                F.concat(F.lit("  "), F.upper("p_name")),
                F.concat(words[1], F.lit(", "), words[0]),
                F.concat(F.lit("Republic of "), F.translate("p_name", "aeo", "áéö")),
                F.concat(F.col("p_name"), F.lit("s")),
            )
        ).alias("spelling"),
    )


@query
def fuzzy_match(spark, folder):
    spellings = _spellings(spark, folder)
    parts = star.table(spark, folder, "part").select("p_name")
    matched = match_to_canonical(spellings, "spelling", parts, "p_name", ["p_name"])
    return matched.groupBy("spelling", "join_key").agg(F.count("*").alias("n"))


@query
def fuzzy_match_audit(spark, folder):
    parts = star.table(spark, folder, "part").select("p_name")
    audit = match_audit(
        distinct_names(distinct_spellings((_spellings(spark, folder), "spelling"))),
        canonical_names(parts, "p_name", ["p_name"]),
    )
    return _rounded(audit, 4, "score").select("name", "canonical", "score", "method")


@query
def customer_match(spark, folder):
    customer = star.table(spark, folder, "customer")
    orders = star.table(spark, folder, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    bought = orders.select(F.replace(F.upper("c_name"), F.lit("#"), F.lit("-")).alias("buyer"), "o_orderkey")
    counts = bought.groupBy("buyer").agg(F.count("*").alias("orders"))
    return match_to_canonical(counts, "buyer", customer, "c_name", ["c_custkey"])


# --- master table ----------------------------------------------------------------------------------------------------


@query
def country_master(spark, folder):
    return _rounded(
        _master(spark, folder, "nation", "scored"), 2, "lending_amount", "commitment_amount", "disbursement_amount"
    )


@query
def customer_master(spark, folder):
    return _rounded(
        _master(spark, folder, "customer", "scored"), 2, "lending_amount", "commitment_amount", "disbursement_amount"
    )


@query
def alias_master(spark, folder):
    master = build_master(
        _scores(spark, folder, "nation"),
        _lending(spark, folder, "nation"),
        _success(spark, folder, "nation"),
        match="alias",
        aliases=NATION_ALIASES,
        reaggregate=False,
    )
    return _rounded(master, 2, "lending_amount", "commitment_amount", "disbursement_amount")


@query
def top_borrower_table(spark, folder):
    return _rounded(top_borrowers(_master(spark, folder)), 2, "lending_amount")


# --- analysis --------------------------------------------------------------------------------------------------------


@query
def exposure(spark, folder):
    exposed = add_exposure(stored(_master(spark, folder), "master"))
    return exposed.select("iso3", "country", "year", "exposure_score")


@query
def priority(spark, folder):
    return _exposed(spark, folder).select("iso3", "country", "year", "priority_score")


@query
def risk_trend(spark, folder):
    scores = stored(_scores(spark, folder, "customer"), "scores")
    return add_risk_trend(scores).select("country", "year", "risk_trend")


@query
def lending_gap(spark, folder):
    return add_lending_gap(_master(spark, folder)).select("iso3", "country", "year", "lending_gap")


@query
def coverage(spark, folder):
    return coverage_report(_master(spark, folder))


@query
def master_years(spark, folder):
    return years_covered(_master(spark, folder))


@query
def pearson_correlation(spark, folder):
    return _rounded(pearson(_master(spark, folder)), 6, "r")


@query
def spearman_correlation(spark, folder):
    return _rounded(spearman(_master(spark, folder)), 6, "rho")


@query
def correlation_test(spark, folder):
    test = risk_success_correlation(_master(spark, folder))
    return _rounded(test, 6, "r", "rho", "p", "p_rho")


@query
def price_ranks(spark, folder):
    counts = star.table(spark, folder, "orders").groupBy("o_totalprice").agg(F.count("*").alias("n"))
    return average_ranks(counts, "o_totalprice", "n")


@query
def price_quantity_rank_correlation(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    return _rounded(spearman(lines, "l_extendedprice", "l_quantity"), 6, "rho")


@query
def linear_regression(spark, folder):
    fit = linear_fit(_master(spark, folder))
    return _rounded(fit, 6, "slope", "intercept", "r", "p", "x_min", "x_max", "y_at_min", "y_at_max")


@query
def success_by_bin(spark, folder):
    return success_by_risk_bin(_master(spark, folder))


@query
def pillars_by_bin(spark, folder):
    return pillars_by_risk_bin(stored(_master(spark, folder), "master"))


@query
def risk_bins(spark, folder):
    score = F.col("esg_risk_score")
    return (
        _scores(spark, folder, "customer")
        .groupBy(risk_bin(score).alias("risk_group"), risk_band(score).alias("band"))
        .agg(F.count("*").alias("n"))
    )


@query
def summary_by_country(spark, folder):
    return _rounded(country_summary(_enriched(spark, folder)), 2, "total_lending_usd")


@query
def analysis_export(spark, folder):
    export = analysis_columns(_exposed(spark, folder))
    return _rounded(export, 2, "lending_amount", "commitment_amount", "disbursement_amount")


# --- ranked tables, panels, charts -----------------------------------------------------------------------------------


@query
def top_priority_table(spark, folder):
    return panels.top_priority(_exposed(spark, folder))


@query
def top_priority_of_year(spark, folder):
    return panels.top_priority(_exposed(spark, folder), 1997)


@query
def top_gap_table(spark, folder):
    return panels.top_gap(stored(_master(spark, folder), "master"))


@query
def busiest_year(spark, folder):
    return panels.busiest_period(_master(spark, folder))


@query
def panel_top_risk(spark, folder):
    return panels.top_risk_panel(_busiest_snapshot(stored(_master(spark, folder), "master")))


@query
def panel_pillar_scatter(spark, folder):
    return panels.pillar_scatter_panel(_busiest_snapshot(stored(_master(spark, folder), "master")))


@query
def panel_lending_gap(spark, folder):
    return panels.gap_panel(_busiest_snapshot(stored(_master(spark, folder), "master")))


@query
def panel_risk_trend(spark, folder):
    scores = stored(_scores(spark, folder, "customer"), "scores")
    return panels.trend_panel(add_risk_trend(scores))


@query
def panel_success_scatter(spark, folder):
    return panels.success_scatter_panel(_master(spark, folder))


@query
def panel_priority_matrix(spark, folder):
    return panels.priority_matrix_panel(_busiest_snapshot(stored(_exposed(spark, folder), "exposed")))


@query
def chart_pillars(spark, folder):
    return _rounded(panels.pillar_chart(_master(spark, folder)), 6, "score")


@query
def chart_lending(spark, folder):
    return _rounded(panels.lending_chart(_master(spark, folder)), 2, "lending_amount")


@query
def chart_success(spark, folder):
    chart = panels.success_chart(stored(_master(spark, folder), "master"))
    return _rounded(chart, 6, "avg_esg_score", "avg_esg_risk_score", "avg_success_rate", "portfolio_success_rate")


# --- panels over the event stream ------------------------------------------------------------------------------------


def _user_days(spark, folder):
    events = star.table(spark, folder, "events")
    return events.groupBy(F.col("user_id").cast("string").alias("country"), F.dayofyear("ts").alias("year")).agg(
        round_half_even(F.sum(star.cents(F.col("value"))).cast("double") / 100.0 / F.count("*"), 1).alias(
            "esg_risk_score"
        )
    )


@query
def user_trends(spark, folder):
    return risk_trends(_user_days(spark, folder))


@query
def busiest_day(spark, folder):
    return panels.busiest_period(_user_days(spark, folder), "year", "esg_risk_score")


# --- keys and upserts ------------------------------------------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query
def one_line_per_key(spark, folder):
    return one_per_key(star.table(spark, folder, "lineitem"), LINE_KEYS, ["l_shipdate"])


@query
def upserted_lines(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    recent = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    existing = one_per_key(lines.filter(~recent), LINE_KEYS, ["l_shipdate"])
    return merged(existing, one_per_key(lines.filter(recent), LINE_KEYS, ["l_shipdate"]), LINE_KEYS)


@query
def quarantined_keys(spark, folder):
    ratings = normalise_ratings(star.raw_ratings(spark, folder))
    valid, quarantine = split_null_keys(ratings, ["project_id", "closing_year"])
    aside = quarantine.agg(F.count("*").alias("n")).scalar()
    return valid.agg(F.count("*").alias("valid")).withColumn("quarantined", aside)


@query
def share_of_sector(spark, folder):
    ratings = star.ratings(spark, folder)
    return ratings.groupBy("sector").agg(
        F.count("*").alias("n"),
        round_half_even(percent_of(F.sum("is_successful").cast("double"), F.count("*").cast("double")), 1).alias(
            "success_rate"
        ),
        flag(F.max("closing_year") >= 1998).alias("recent"),
        F.count(strip_text(F.col("outcome_rating"))).alias("rated"),
    )


REGISTRY.update(JOB_QUERIES)
