"""The domain's tables built from the star-schema test tables.

Orders stand for loans and, averaged by priority, for indicator values; line items stand for rated projects. The
entity is the customer's or supplier's nation, or the single customer. Amounts are added up in whole cents, so the
values do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions.dates import fiscal_year
from riskloom.functions.text import is_success
from riskloom.sources.feeds import pillar_of
from riskloom.vocabulary import ESG

# priority -> (pillar, metric name, direction), in the layout of the indicator list
PRIORITIES: dict[str, tuple[str, str, int]] = {
    "1-URGENT": ("governance", "urgent orders", 1),
    "2-HIGH": ("governance", "high orders", 1),
    "3-MEDIUM": ("social", "medium orders", -1),
    "4-NOT SPECIFIED": ("environmental", "unspecified orders", 1),
    "5-LOW": ("environmental", "low orders", -1),
}
INVERTED = tuple(code for code, (_, _, direction) in PRIORITIES.items() if direction < 0)

OUTCOMES: dict[str, str] = {"A": "Satisfactory", "N": "Moderately Satisfactory", "R": "Unsatisfactory"}


SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def cents(amount: Column) -> Column:
    return F.rint(amount * 100.0).cast("bigint")


def countries(spark: SparkSession, folder: str) -> DataFrame:
    """Country dimension: nations with their region."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    number = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey",
        F.concat(F.lit("N"), number).alias("iso3"),
        number.alias("iso2"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.lit("not classified").alias("income_level"),
    )


def _customers(spark: SparkSession, folder: str, grain: str) -> DataFrame:
    """``c_custkey`` with the ``iso3`` and ``country`` of the chosen grain."""
    customer = table(spark, folder, "customer")
    if grain == "customer":
        return customer.select(
            "c_custkey", F.col("c_custkey").cast("string").alias("iso3"), F.col("c_name").alias("country")
        )
    nations = countries(spark, folder).select("n_nationkey", "iso3", "country")
    return customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "iso3", "country")


def esg(spark: SparkSession, folder: str, grain: str = "nation") -> DataFrame:
    """Indicator values per entity, fiscal year and priority: mean order amount by order year for nations, mean line
    amount by shipping year for customers, who thus have scores in years in which they ordered nothing.

    Line items are added up per order and year before they are joined to their orders. Orders get their customer first, so
    that line items move by order only.
    """
    indicator = F.col("o_orderpriority").alias("indicator")
    if grain == "nation":
        facts = table(spark, folder, "orders").select(
            "o_custkey", fiscal_year(F.col("o_orderdate")).alias("year"), indicator, cents(F.col("o_totalprice")).alias("amount"),
            F.lit(1).alias("n"),
        )
    else:
        lines = table(spark, folder, "lineitem").select(
            "l_orderkey", fiscal_year(F.col("l_shipdate")).alias("year"), cents(F.col("l_extendedprice")).alias("amount")
        ).groupBy("l_orderkey", "year").agg(F.sum("amount").alias("amount"), F.count("amount").alias("n"))
        facts = table(spark, folder, "orders").select("o_orderkey", "o_custkey", indicator)
    owned = facts.join(_customers(spark, folder, grain), F.col("o_custkey") == F.col("c_custkey"))
    if grain != "nation":
        owned = lines.join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
    mean = F.sum("amount").cast("double") / 100.0 / F.sum("n")
    values = owned.groupBy("iso3", "country", "year", "indicator").agg(mean.alias("value"))
    return values.withColumn("pillar", pillar_of(F.col("indicator"), PRIORITIES)).select(*ESG.names)


def line_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Net amount per order, one row per order before it is joined to anything."""
    net = F.col("l_extendedprice") * (1.0 - F.col("l_discount"))
    return (
        table(spark, folder, "lineitem")
        .select("l_orderkey", cents(net).alias("net"))
        .groupBy("l_orderkey")
        .agg((F.sum("net").cast("double") / 100.0).alias("disbursed"))
    )


def loans(spark: SparkSession, folder: str, grain: str = "nation", source: str | None = None) -> DataFrame:
    """Loans: one row per order; finished orders are one source, the others the second one."""
    finished = F.col("o_orderstatus") == "F"
    orders = table(spark, folder, "orders")
    if source is not None:
        orders = orders.filter(finished if source == "IBRD" else ~finished)
    orders = orders.select(
        "o_orderkey",
        "o_custkey",
        fiscal_year(F.col("o_orderdate")).alias("fiscal_year"),
        F.col("o_totalprice").alias("commitment_amount"),
        F.when(finished, "IBRD").otherwise("IDA").alias("source"),
    )
    lines = line_totals(spark, folder)
    funded = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return funded.join(_customers(spark, folder, grain), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("loan_id"),
        "country",
        "fiscal_year",
        "commitment_amount",
        F.col("disbursed").alias("disbursement_amount"),
        "source",
    )


def outcome_of(returnflag: Column) -> Column:
    label = F.lit(None).cast("string")
    for code, name in OUTCOMES.items():
        label = F.when(returnflag == code, name).otherwise(label)
    return label


def ratings(spark: SparkSession, folder: str, grain: str = "nation") -> DataFrame:
    """Rated projects: one row per line item, of the supplier's nation or of the customer."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("project_id"),
        outcome_of(F.col("l_returnflag")).alias("outcome_rating"),
        F.col("l_linestatus").alias("sector"),
        F.year("l_shipdate").alias("closing_year"),
        is_success(outcome_of(F.col("l_returnflag"))).alias("is_successful"),
    )
    if grain == "customer":
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
        owners = orders.join(_customers(spark, folder, grain), F.col("o_custkey") == F.col("c_custkey"))
        named = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
    else:
        nations = countries(spark, folder).select("n_nationkey", "country")
        suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
        owners = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "country")
        named = lines.join(owners, F.col("l_suppkey") == F.col("s_suppkey"))
    return named.select(
        "project_id", "country", "outcome_rating", "sector", "closing_year", "is_successful"
    )


# --- raw feeds: the same facts as untidy text ------------------------------------------------------------------------


def raw_loans(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a raw loan feed: dates in three formats, padded names, amounts that are no numbers."""
    day = F.col("o_orderdate").cast("date")
    status = F.col("o_orderstatus")
    date_text = (
        F.when(status == "F", F.date_format(day, "yyyy-MM-dd"))
        .when(status == "O", F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "dd-MMM-yyyy"))
    )
    no_date = F.col("o_orderpriority") == "5-LOW"
    amount = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "n/a").otherwise(
        F.col("o_totalprice").cast("string")
    )
    orders = table(spark, folder, "orders")
    return orders.join(_customers(spark, folder, "nation"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("Loan_Number"),
        F.concat(F.lit("\t"), F.col("country"), F.lit("  ")).alias("Country_Economy"),
        F.when(no_date, "not-a-date").otherwise(date_text).alias("BOARD_APPROVAL_DATE"),
        amount.alias("original_principal_amount_us_"),
        status.alias("status"),
    )


def raw_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a raw rating feed: padded upper-case outcomes, years inside text."""
    flag_ = F.col("l_returnflag")
    closing = (
        F.when(flag_ == "A", F.concat(F.lit("FY"), F.year("l_shipdate")))
        .when(flag_ == "N", F.date_format(F.col("l_shipdate"), "MM/dd/yyyy"))
        .otherwise(F.date_format(F.col("l_shipdate"), "'Q'M/yy"))
    )
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("proj_id"),
        F.concat(F.lit(" Supplier "), F.col("l_suppkey").cast("string"), F.lit("\n")).alias("country"),
        F.concat(F.lit("  "), F.upper(outcome_of(flag_))).alias("outcome"),
        closing.alias("closing_fy"),
    )


# --- landed pages of the remote feeds --------------------------------------------------------------------------------

ROWS_PER_PAGE = 1000


def pair_pages(rows: DataFrame, group: str, key: str, payload: Column, rows_per_page: int = ROWS_PER_PAGE) -> DataFrame:
    """Rows as pair pages: at most ``rows_per_page`` values of the unique integer ``key`` in a page."""
    number = F.floor(F.col(key) / rows_per_page)
    pages = rows.groupBy(F.col(group).alias("group"), number.alias("number")).agg(F.collect_list(payload).alias("rows"))
    first = pages.groupBy("group").agg(F.min("number").alias("first"), F.count("*").alias("pages"))
    meta = F.to_json(F.struct((F.col("number") - F.col("first") + 1).alias("page"), "pages"))
    body = F.to_json("rows", {"ignoreNullFields": "false"})
    return pages.join(first, "group").select(
        F.col("group").alias("indicator"), F.concat(F.lit("["), meta, F.lit(","), body, F.lit("]")).alias("page")
    )


def batch_pages(rows: DataFrame, group: str, key: str, payload: Column, rows_per_page: int = ROWS_PER_PAGE) -> DataFrame:
    """Rows as batch pages ``{"count": all rows of the feed, "data": [...]}``."""
    number = F.floor(F.col(key) / rows_per_page)
    pages = rows.groupBy(F.col(group).alias("feed"), number.alias("number")).agg(F.collect_list(payload).alias("data"))
    counts = rows.groupBy(F.col(group).alias("feed")).agg(F.count("*").alias("count"))
    return pages.join(counts, "feed").select(
        "feed", F.to_json(F.struct("count", "data"), {"ignoreNullFields": "false"}).alias("page")
    )
