"""Registered queries that run a job over the given tables and read what it wrote.

Feeds are landed as pages in the shared folder, tables are written to a database of their own there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.operators.master import build_master
from riskloom.operators.rollups import aggregate_loans, aggregate_ratings
from riskloom.operators.scoring import normalise, pillar_scores
from riskloom.plans.analysis import run_analysis_files
from riskloom.plans.bronze import Landed, run_bronze, write_bronze
from riskloom.plans.gold import run_gold
from riskloom.session import shared_folder, stored, together
from riskloom.sinks.tables import overwrite, write_csv
from riskloom.sources import star
from riskloom.sources.envelopes import batch_completeness, parse_batches
from riskloom.sources.feeds import normalise_loans
from riskloom.sources.files import read_managed, read_table_file
from riskloom.streaming.refresh import refresh, waiting_pages
from riskloom.vocabulary import ANALYSIS_COLUMNS, LOANS, MASTER, RATINGS

#: Indicator code that stands for a priority; those of star.INVERTED are codes of which less is better.
CODES = {
    "1-URGENT": "EG.ELC.ACCS.ZS", "2-HIGH": "SP.DYN.LE00.IN", "3-MEDIUM": "SI.POV.DDAY",
    "4-NOT SPECIFIED": "EG.FEC.RNEW.ZS", "5-LOW": "EN.ATM.CO2E.PC",
}


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _database(spark: SparkSession) -> str:
    name = f"job_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}.db'")
    return name


#: Pages in a bundle; a page of a thousand orders has about 130 KB.
BUNDLE = 500


def _land(pages: DataFrame, folder: str, by: str | None = None, per_file: int = 1) -> str:
    """One page per line and up to ``per_file`` of them in a file, in a folder per value of ``by``."""
    writer = pages.write.mode("append").option("maxRecordsPerFile", per_file)
    (writer.partitionBy(by) if by else writer).text(folder)
    return folder


def _coded(esg: DataFrame) -> DataFrame:
    code = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    return esg.withColumn("indicator", code[F.col("indicator")])


def _landed_indicators(spark: SparkSession, folder: str) -> Landed:
    countries = star.countries(spark, folder).withColumn("feed", F.lit("countries"))
    region = F.when(F.col("region") == "AFRICA", "Aggregates").otherwise(F.col("region"))
    country = F.struct(
        F.col("iso3").alias("id"), F.col("iso2").alias("iso2Code"), F.col("country").alias("name"),
        F.struct(region.alias("value")).alias("region"), F.struct(F.col("income_level").alias("value")).alias("incomeLevel"),
    )
    values = _coded(star.esg(spark, folder)).withColumn(
        "key", F.substring("iso3", 2, 2).cast("int") * 100 + F.col("year") - 1990
    )
    value = F.struct(
        F.col("iso3").alias("countryiso3code"), F.struct(F.col("country").alias("value")).alias("country"),
        F.col("year").cast("string").alias("date"), "value",
    )
    return Landed(
        _land(star.pair_pages(countries, "feed", "n_nationkey", country).select("page"), _folder(spark, "countries")),
        _land(star.pair_pages(values, "indicator", "key", value), _folder(spark, "indicators"), "indicator"),
    )


def job_bronze_esg(spark: SparkSession, folder: str) -> DataFrame:
    """Indicator values from landed pages to the table, within a range of years and without regional totals."""
    database = _database(spark)
    run_bronze(spark, _landed_indicators(spark, folder), database, start=1993, end=1997)
    return spark.table(f"{database}.esg")


def _money(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.rint(F.col(c) * 100) / 100 for c in ("commitment_amount", "disbursement_amount")})


def job_bronze_loans(spark: SparkSession, folder: str) -> DataFrame:
    """Loans upserted three times: with ids, without any, and again some with ids and other amounts."""
    database, esg = _database(spark), star.esg(spark, folder)
    loans = stored(star.loans(spark, folder), "loans")
    ids, others = loans.filter("source = 'IBRD'"), loans.filter("source = 'IDA'").withColumn("loan_id", F.lit(None).cast("string"))
    again = ids.filter("cast(loan_id as bigint) % 2 = 0").withColumn("commitment_amount", F.col("commitment_amount") * 2)
    for batch in (ids, others, again):
        write_bronze({"esg": esg, "loans": batch.select(*LOANS.names)}, database)
    return _money(read_managed(spark, f"{database}.loans", LOANS))


def job_bronze_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings without a project id are left out, of equal ids one row stays."""
    database = _database(spark)
    ratings = star.ratings(spark, folder)
    some = ratings.withColumn("project_id", F.when(F.col("closing_year") != 1995, F.col("project_id")))
    write_bronze({"esg": star.esg(spark, folder), "ratings": some}, database)
    return read_managed(spark, f"{database}.ratings", RATINGS)


def _gold(spark: SparkSession, folder: str) -> tuple[str, dict[str, int]]:
    database = _database(spark)
    overwrite(_coded(star.esg(spark, folder)), f"{database}.esg")
    overwrite(star.loans(spark, folder), f"{database}.loans")
    overwrite(star.ratings(spark, folder), f"{database}.ratings", partition_by=["closing_year"])
    run_gold(spark, database, match="equal")  # the second run replaces what the first one wrote
    return database, run_gold(spark, database, match="equal")


def job_gold_scores(spark: SparkSession, folder: str) -> DataFrame:
    return spark.table(f"{_gold(spark, folder)[0]}.aggregate_esg")


def job_gold_master(spark: SparkSession, folder: str) -> DataFrame:
    database, _ = _gold(spark, folder)
    rows = _money(spark.table(f"{database}.esg_lending_master"))
    return rows.withColumn("lending_amount", F.rint(F.col("lending_amount") * 100) / 100)


def job_written_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that the job says it has written, and rows in the tables."""
    database, written = _gold(spark, folder)
    out = None
    for name, n in written.items():
        row = spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"), F.lit(n).cast("bigint").alias("written"), F.count("*").alias("n"))
        out = row if out is None else out.unionAll(row)
    return out


def job_analysis_files(spark: SparkSession, folder: str) -> DataFrame:
    """The analysis table read back from the files that the job made of the master table's files."""
    rollups = together(
        lambda: stored(pillar_scores(normalise(stored(star.esg(spark, folder, "customer"), "esg"), inverted=star.INVERTED)), "rollup"),
        lambda: stored(aggregate_loans(star.loans(spark, folder, "customer")), "rollup"),
        lambda: stored(aggregate_ratings(star.ratings(spark, folder, "customer")), "rollup"),
    )
    out = _folder(spark, "analysis")
    write_csv(build_master(*rollups, match="equal"), f"{out}/master.csv")
    run_analysis_files(spark, f"{out}/master.csv", out)
    kinds = {f.name: f.dataType for f in MASTER.fields}
    layout = T.StructType([T.StructField(c, kinds.get(c, T.DoubleType())) for c in ANALYSIS_COLUMNS])
    rows = _money(read_table_file(spark, f"{out}/analysis.csv", layout))
    return rows.withColumn("lending_amount", F.rint(F.col("lending_amount") * 100) / 100)


_PAGE_FIELDS = ("loan_number", "country", "board_approval_date", "original_principal_amount", "disbursed_amount")


def _loan_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Batch pages of orders, one feed per status, with ``last`` on the last page of a feed."""
    orders = star.table(spark, folder, "orders")
    price = F.col("o_totalprice").cast("string")
    payload = F.struct(*[c.alias(n) for n, c in zip(_PAGE_FIELDS, (
        F.col("o_orderkey").cast("string"), F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")),
        F.date_format("o_orderdate", "yyyy-MM-dd"), price, price))])
    pages = stored(star.batch_pages(orders, "o_orderstatus", "o_orderkey", payload), "pages")
    number = F.get_json_object("page", "$.data[0].loan_number").cast("bigint")
    last = pages.groupBy("feed").agg(F.max(number).alias("greatest"))
    return pages.join(last, "feed").withColumn("last", number == F.col("greatest"))


def _refresh(spark: SparkSession, landed: str, progress: str, table: str) -> int:
    layout = T.StructType([T.StructField(c, T.StringType()) for c in _PAGE_FIELDS])
    return refresh(
        spark, landed, progress, table, ["loan_id"], lambda pages: normalise_loans(parse_batches(pages, layout), "IBRD"),
        feed=F.regexp_extract("path", "feed=([^/]+)", 1), completeness=batch_completeness, page_per_line=True)


def job_refresh_loans(spark: SparkSession, folder: str) -> DataFrame:
    """Pages land in two steps; a feed is merged after its last page."""
    pages, landed, progress, table = _loan_pages(spark, folder), _folder(spark, "landed"), _folder(spark, "progress"), f"{_database(spark)}.loans"
    for step in (F.col("feed").isin("F") | ~F.col("last"), ~F.col("feed").isin("F") & F.col("last")):
        _land(pages.filter(step).select("feed", "page"), landed, "feed", BUNDLE)
        _refresh(spark, landed, progress, table)
    return spark.table(table)


def job_waiting_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Feeds that still miss a page after a refresh; only the complete one is in the table."""
    pages, landed, progress, table = _loan_pages(spark, folder), _folder(spark, "landed"), _folder(spark, "progress"), f"{_database(spark)}.loans"
    _land(pages.filter(F.col("feed").isin("F") | ~F.col("last")).select("feed", "page"), landed, "feed", BUNDLE)
    batches = _refresh(spark, landed, progress, table)
    merged = spark.table(table).agg(F.count("*")).scalar()
    return batch_completeness(waiting_pages(spark, progress, batches)).withColumn("rows_merged", merged)


JOB_QUERIES = {f.__name__: f for f in (
    job_bronze_esg, job_bronze_loans, job_bronze_ratings, job_gold_scores, job_gold_master, job_written_rows, job_analysis_files,
    job_refresh_loans, job_waiting_feeds)}
