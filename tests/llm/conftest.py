import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    return dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{FOLDER}/documents.parquet'").fetchall())


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns whose names clash with internal ones."""
    long = "word number %d again and mail a.b@example.org or 10.0.0.1; " * 400
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two three"), (5, "one two three"), (5, "one two three"),
            (None, "one two three"), (6, long), (7, long + "end"), (8, "İ ΣΑΣ café \U0001f600 " * 30)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.length("text").cast("long").alias("n_chars"), F.lit(7).alias("fp"), F.lit("x").alias("block"),
        F.lit("y").alias("score"), F.lit(0).alias("rid"), F.lit(1).alias("h"), F.lit(2).alias("spans"),
    )
