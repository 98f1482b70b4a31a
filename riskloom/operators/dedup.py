"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose keys are all present, and the others, which can neither be matched nor replaced."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.filter(~missing), df.filter(missing)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Of the rows with equal keys the one that is greatest by ``order``, then by the other columns.

    It is an aggregate, not a numbered window, so the copies of a hot key are reduced before they are shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    leading = [c for c in order if c in rest]
    row = F.struct(*[F.col(c) for c in [*leading, *[c for c in rest if c not in leading]]])
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.max(row).alias("row")).select(
        *[F.col(c) if c in keys else F.col("row")[c].alias(c) for c in df.columns]
    )
