"""File and table scans with declared schemas."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

# the usual dialect: header line, quotes doubled inside quotes, blanks kept
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_table_file(
    spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "csv", optional: bool = False
) -> DataFrame:
    """Scan of a CSV (with header), Parquet, ORC or JSON table.

    CSV columns are matched by their header name, so a file may hold them in any order or hold more of them, and the
    files of a folder may differ. A header is one line. An optional table that does not exist reads as an empty frame with
    the same columns.
    """
    try:
        if fmt != "csv":
            return without_nan(spark.read.schema(schema).format(fmt).load(path))
        reader = spark.read.options(**CSV_OPTIONS)
        headers = _files_by_header(spark, path) if len(reader.csv(path).inputFiles()) > 1 else {}
        if len(headers) < 2:
            return without_nan(_typed(_as_text(reader, path, reader.csv(path).columns), schema))
        # a filter on the path is decided before the files are opened, so each scan reads its own files alone
        scans = [
            _typed(_as_text(reader, path, next(csv.reader([header]))).filter(F.col("_metadata.file_path").isin(files)), schema)
            for header, files in sorted(headers.items())
        ]
        return without_nan(reduce(DataFrame.unionAll, scans))
    except AnalysisException as error:
        if optional and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files under ``path`` by their first line that is not blank; what is collected is one line per file."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        "value", F.monotonically_increasing_id().alias("place"),
    )
    firsts = lines.filter("start = 0 AND trim(value) != ''").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return {
        row.header: row.files for row in firsts.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    }


def _as_text(reader: DataFrameReader, path: str, header: Sequence[str]) -> DataFrame:
    """All columns as text. The header is checked file by file: one in another order raises instead of mixing columns up."""
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return reader.option("enforceSchema", False).schema(as_text).csv(path)


def _typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return raw.select(
        *[raw[f"`{f.name}`"].try_cast(_via(f.dataType)).try_cast(f.dataType).alias(f.name)
          if f.name in raw.columns else _null(f) for f in schema.fields]
    )


def without_nan(df: DataFrame) -> DataFrame:
    """Null instead of NaN: aggregates skip nulls but not NaN, which other writers use for a missing number."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in numbers}) if numbers else df


def _via(kind: T.DataType) -> T.DataType:
    # whole numbers may be stored as "2022.0" when the column once held a missing value
    return T.DoubleType() if isinstance(kind, (T.IntegerType, T.LongType)) else kind


def _null(field: T.StructField):
    return F.lit(None).cast(field.dataType).alias(field.name)


def read_managed(spark: SparkSession, table: str, schema: T.StructType, *, optional: bool = False) -> DataFrame:
    """Scan of the columns of ``schema`` in a catalog table; an optional one that does not exist reads as empty."""
    if optional and not spark.catalog.tableExists(table):
        return spark.createDataFrame([], schema)
    rows = spark.table(table)
    return without_nan(rows.select(*[c for c in schema.names if c in rows.columns]))
