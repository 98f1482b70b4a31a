"""Column and dataset resolution for feeds whose layout varies."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def resolve(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """Name of the first candidate that ``df`` has, whatever its case."""
    present = {name.lower(): name for name in df.columns}
    return next((present[c] for c in candidates if c in present), None)


def resolved(df: DataFrame, candidates: Sequence[str], missing_type: str = "string") -> Column:
    """Column of the first candidate that ``df`` has, a null column where it has none."""
    name = resolve(df, candidates)
    return F.lit(None).cast(missing_type) if name is None else df[f"`{name}`"]


def first_non_empty(
    candidates: Iterable[DataFrame | str], spark: SparkSession, schema: T.StructType
) -> DataFrame:
    """First candidate that can be read and holds a row; an empty frame of ``schema`` where none does.

    A candidate is a frame, or the path of a landed row-batch feed.
    """
    from riskloom.sources.envelopes import read_batches

    for candidate in candidates:
        try:
            df = read_batches(spark, candidate) if isinstance(candidate, str) else candidate
            if not df.isEmpty():
                return df
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)
