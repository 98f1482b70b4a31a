"""Landed pages of the remote feeds.

Two page layouts exist. A *pair page* is a JSON array ``[meta, rows]``; a *batch page* is a JSON object
``{"count": n, "data": [rows]}``. Each page is one JSON document of bounded size, so a page is the unit of
parallelism. The parsing functions take a frame with one page per row, whatever it was read from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.functions.numeric import to_double, to_int
from riskloom.vocabulary import AGGREGATE_REGION


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: ``page`` text and the ``path`` it came from."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("page"), F.col("_metadata.file_path").alias("path")
    )


def _field(node: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col(node), path, kind)


def _rows_of_pair_pages(pages: DataFrame, page: str, *keep: str) -> DataFrame:
    """One variant ``row`` per element of the second array entry; pages without rows give none, a page that is no JSON raises."""
    parsed = pages.select(*keep, F.parse_json(page).alias("parsed"))
    return parsed.select(*keep, F.explode(F.expr("try_variant_get(parsed, '$[1]', 'array<variant>')")).alias("row"))


def parse_countries(pages: DataFrame, page: str = "page") -> DataFrame:
    """Country dimension from pair pages, without regional and income-group totals."""
    rows = _rows_of_pair_pages(pages, page)
    countries = rows.select(
        _field("row", "$.id").alias("iso3"),
        _field("row", "$.iso2Code").alias("iso2"),
        _field("row", "$.name").alias("country"),
        _field("row", "$.region.value").alias("region"),
        _field("row", "$.incomeLevel.value").alias("income_level"),
    )
    return countries.filter(F.col("region").isNull() | (F.col("region") != AGGREGATE_REGION))


def parse_observations(pages: DataFrame, page: str = "page", indicator: str = "indicator") -> DataFrame:
    """Indicator observations from pair pages; ``indicator`` names the column with the code the page was asked for.

    Observations without a value are dropped.
    """
    rows = _rows_of_pair_pages(pages, page, indicator)
    return rows.select(
        _field("row", "$.countryiso3code").alias("iso3"),
        _field("row", "$.country.value").alias("country"),
        to_int(_field("row", "$.date")).alias("year"),
        F.col(indicator).alias("indicator"),
        to_double(_field("row", "$.value")).alias("value"),
    ).filter(F.col("value").isNotNull())


def pair_page_completeness(pages: DataFrame, page: str = "page", indicator: str = "indicator") -> DataFrame:
    """Landed against announced pages per indicator."""
    meta = pages.select(indicator, F.try_parse_json(page).alias("parsed")).select(
        F.col(indicator).alias("indicator"),
        F.coalesce(_field("parsed", "$[0].page", "int"), F.lit(1)).alias("page"),
        F.coalesce(_field("parsed", "$[0].pages", "int"), F.lit(1)).alias("pages"),
    )
    return meta.groupBy("indicator").agg(
        F.count_distinct("page").alias("pages_landed"), F.max("pages").cast("bigint").alias("pages_announced")
    ).withColumn("complete", F.col("pages_landed") >= F.col("pages_announced"))


def parse_batches(pages: DataFrame, row_schema: T.StructType, page: str = "page") -> DataFrame:
    """Rows of batch pages with the columns of ``row_schema``; a page that is no JSON raises."""
    batch = F.from_json(F.col(page), _batch_schema(row_schema), {"mode": "FAILFAST"})
    return pages.select(F.inline(batch["data"]))


def _batch_schema(row_schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("count", T.LongType()), T.StructField("data", T.ArrayType(row_schema))]
    )


def batch_completeness(pages: DataFrame, page: str = "page", feed: str = "feed") -> DataFrame:
    """Landed against announced rows per feed; a feed that announces no total counts as complete."""
    envelope = F.from_json(F.col(page), "count bigint, data array<string>")
    return (
        pages.select(F.col(feed).alias("feed"), envelope.alias("e"))
        .groupBy("feed")
        .agg(
            F.coalesce(F.sum(F.size("e.data").cast("bigint")), F.lit(0).cast("bigint")).alias("rows_landed"),
            F.max("e.count").alias("rows_announced"),
        )
        .withColumn("complete", F.col("rows_landed") >= F.coalesce("rows_announced", F.lit(0)))
    )


def read_batches(spark: SparkSession, path: str, row_schema: T.StructType | None = None) -> DataFrame:
    """Rows of the batch pages landed under ``path``. Without ``row_schema`` the columns are found in the pages."""
    reader = spark.read.option("multiLine", True)
    if row_schema is not None:
        reader = reader.schema(_batch_schema(row_schema))
    pages = reader.json(path)
    if "data" not in pages.columns:
        return spark.createDataFrame([], T.StructType([]))
    return pages.select(F.inline("data"))
