"""Scheduled refresh of the bronze tables: each run takes the pages that were landed since the last one.

A file stream keeps track of the pages that are done, so a run reads new pages only. The upsert replaces rows by key,
and rows set aside belong to their batch, so a batch that is repeated after a failure changes nothing.

Pages of a feed that is not complete wait: after every batch the waiting pages are written to a folder of that batch in
the shared folder, and the next batch takes them up again. A repeated batch starts from the same folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskloom.session import releasing, stored
from riskloom.sinks.tables import set_aside, upsert

PAGE = T.StructType([T.StructField("value", T.StringType())])


def refresh(
    spark: SparkSession,
    landed: str,
    checkpoint: str,
    table: str,
    keys: Sequence[str],
    parse: Callable[[DataFrame], DataFrame],
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    order: Sequence[str] = (),
    pages_per_batch: int = 10_000,
    feed: Column | None = None,
    completeness: Callable[[DataFrame], DataFrame] | None = None,
    page_per_line: bool = False,
) -> int:
    """Upsert the rows that ``parse`` finds in the new pages under ``landed``; returns the number of batches.

    ``parse`` gets a frame with one ``page`` and its ``path`` per row. With ``order`` the latest of several rows of
    one key in a batch is the greatest by these columns. Rows that lack a key are kept in ``<table>_quarantine``, by batch.

    With ``feed``, an expression of ``path`` and ``page`` that names the feed of a page, and ``completeness``, which gets
    frames with ``feed`` and ``page`` and returns ``feed`` and ``complete``, the pages of a feed are parsed together once
    all of them have landed. A batch that completes no feed leaves a table that exists as it is.

    A landed file is one page, or with ``page_per_line`` a bundle of pages with one in each line; a batch then takes up
    to ``pages_per_batch`` bundles. Bundles keep the number of files, which are listed and opened one by one, far below
    that of pages.
    """
    pages = (
        spark.readStream.format("text")
        .schema(PAGE)
        .options(**({"lineSep": "\n"} if page_per_line else {"wholetext": True}))
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", pages_per_batch)
        .load(landed)
        .select(F.col("value").alias("page"), F.col("_metadata.file_path").alias("path"))
    )
    batches = []

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with releasing(session):
            ready = True
            if feed is not None:
                batch, ready = _complete_feeds(batch.withColumn("feed", feed), checkpoint, batch_id, completeness)
            parsed = parse(batch)
            if ready or not session.catalog.tableExists(table):
                # stored, since the rows are read for the table and for those set aside
                rows = stored(parsed, "rows")
                aside = upsert(rows, table, keys, fmt=fmt, partition_by=partition_by, order=order).quarantine
                set_aside(aside, f"{table}_quarantine", batch_id, fmt)
        batches.append(batch_id)

    run = (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    if batches:
        # batches are written in a session of the stream's own; this one may still know the old files
        spark.catalog.refreshTable(table)
    return len(batches)


WAITING = "page string, path string, feed string"


def _waiting_folder(checkpoint: str, batch_id: int) -> str:
    return f"{checkpoint.rstrip('/')}-waiting/after={batch_id}"


def _waiting(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(WAITING).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], WAITING)


def _complete_feeds(
    batch: DataFrame, checkpoint: str, batch_id: int, completeness: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, bool]:
    """Pages of the feeds that this batch completes, and whether it completes any; the others are written to wait for the
    next batch."""
    spark = batch.sparkSession
    held = _waiting(spark, _waiting_folder(checkpoint, batch_id - 1)).unionByName(batch.select("page", "path", "feed"))
    held = stored(held, "pages")
    done = stored(completeness(held).filter("complete").select("feed"), "feeds")
    held.join(done, "feed", "left_anti").select("page", "path", "feed").write.mode("overwrite").parquet(
        _waiting_folder(checkpoint, batch_id)
    )
    return held.join(done, "feed", "left_semi"), not done.isEmpty()


def waiting_pages(spark: SparkSession, checkpoint: str, batches: int) -> DataFrame:
    """Pages (page, path, feed) that wait for the rest of their feed after so many batches in all."""
    return _waiting(spark, _waiting_folder(checkpoint, batches - 1))
