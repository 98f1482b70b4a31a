"""Silver and gold job: roll-ups and the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.master import build_master
from riskloom.operators.rollups import aggregate_loans, aggregate_ratings
from riskloom.operators.scoring import aggregate_esg
from riskloom.session import releasing, stored, together
from riskloom.sinks.tables import overwrite, write_csv, write_csv_unless_empty
from riskloom.sources.files import read_managed, read_table_file
from riskloom.vocabulary import ESG, LOANS, RATINGS


def gold_tables(
    esg: DataFrame, loans: DataFrame, ratings: DataFrame, *, match: str = "scored"
) -> dict[str, DataFrame]:
    """The three roll-ups, stored because the master table reads them again, and the master table."""
    scores, lending, success = together(
        lambda: stored(aggregate_esg(esg), "aggregate_esg"),
        lambda: stored(aggregate_loans(loans), "aggregate_loans"),
        lambda: stored(aggregate_ratings(ratings), "aggregate_ratings"),
    )
    return {
        "aggregate_esg": scores,
        "aggregate_loans": lending,
        "aggregate_ratings": success,
        "esg_lending_master": build_master(scores, lending, success, match=match),
    }


def run_gold(spark: SparkSession, database: str, *, fmt: str = "parquet", match: str = "scored") -> dict[str, int]:
    """Read the bronze tables of ``database`` and replace the four derived ones; empty roll-ups are not written."""
    with releasing(spark):
        tables = gold_tables(
            read_managed(spark, f"{database}.esg", ESG),
            read_managed(spark, f"{database}.loans", LOANS, optional=True),
            read_managed(spark, f"{database}.ratings", RATINGS, optional=True),
            match=match,
        )
        written = {}
        for name, df in tables.items():
            if name in ("aggregate_loans", "aggregate_ratings") and df.isEmpty():
                continue
            written[name] = overwrite(df, f"{database}.{name}", fmt)
    return written


def run_gold_files(spark: SparkSession, bronze: str, out: str, *, match: str = "scored") -> dict[str, int]:
    """The same job from CSV folders to CSV folders; loans and ratings may be missing."""
    required = {"aggregate_esg", "esg_lending_master"}
    with releasing(spark):
        tables = gold_tables(
            read_table_file(spark, f"{bronze}/esg.csv", ESG),
            read_table_file(spark, f"{bronze}/loans.csv", LOANS, optional=True),
            read_table_file(spark, f"{bronze}/ratings.csv", RATINGS, optional=True),
            match=match,
        )
        return {
            name: (write_csv if name in required else write_csv_unless_empty)(df, f"{out}/{name}.csv")
            for name, df in tables.items()
        }
