"""Writing tables: create, overwrite, upsert, CSV export."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from riskloom.operators.dedup import one_per_key, split_null_keys
from riskloom.session import delete_folder, stored
from riskloom.sources.files import CSV_OPTIONS

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class Written:
    """Outcome of an upsert: incoming rows after deduplication, and rows set aside for a missing key."""

    rows: int
    quarantine: DataFrame


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is taken while it is written, so that no second pass is needed."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def ensure_table(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Create an empty table with the columns of ``df`` unless it exists."""
    if not df.sparkSession.catalog.tableExists(table):
        df.limit(0).write.format(fmt).partitionBy(*partition_by).saveAsTable(table)


def overwrite(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> int:
    """Replace a table, its columns included, and return the number of rows written.

    Plain file formats are written to a folder of their own first. Only when all rows are there does the table point
    to it, so a job that dies on the way leaves the old rows as they were.
    """
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df, seen = counted(df)
    if fmt not in _PLAIN_FORMATS:
        df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").partitionBy(*partition_by).saveAsTable(table)
        return seen.get["rows"]
    folder = _table_folder(spark, table)
    version = f"{folder}-{uuid.uuid4().hex}"
    df.write.format(fmt).partitionBy(*partition_by).save(version)
    rows = seen.get["rows"]
    if (found := spark.read.schema(df.schema).format(fmt).load(version).count()) != rows:
        raise RuntimeError(f"{rows} rows were written for {table}, {found} are in {version}; the table is unchanged")
    _point_to(df, table, fmt, version, partition_by)
    return rows


_PLAIN_FORMATS = ("parquet", "orc", "json", "csv")


def _table_folder(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    return f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{name}"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type")
    return rows.first()[0]


def _point_to(df: DataFrame, table: str, fmt: str, folder: str, partition_by: Sequence[str]) -> None:
    """Let ``table`` read ``folder``; a change of columns needs a new catalog entry, which holds no rows itself."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c not in partition_by] + list(partition_by)
    old = None
    if spark.catalog.tableExists(table):
        old = _location(spark, table)
        alike = spark.table(table).dtypes == df.select(*columns).dtypes and _partition_columns(spark, table) == list(partition_by)
        if alike:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        else:
            spark.sql(f"DROP TABLE {table}")
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema.fields)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {table} ({fields}) USING {fmt}{parts} LOCATION '{folder}'")
    if partition_by:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    if old:
        delete_folder(spark, old)


def merged(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows without a replacement, and all incoming rows."""
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.select(*incoming.columns).unionByName(incoming)


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _touched_partitions(existing: DataFrame, incoming: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of the partitions that ``incoming`` has rows for.

    The range of the partition values prunes the scan, the semi-join keeps the partitions that are really touched.
    """
    for part in parts:
        least, greatest = (incoming.agg(f(part).alias("bound")).scalar() for f in (F.min, F.max))
        existing = existing.filter(F.col(part).between(least, greatest))
    return existing.join(incoming.select(*parts).distinct(), list(parts), "left_semi")


def _replace_rows(incoming: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert into a table format without row-level operations.

    The merged rows are stored in the shared folder before the table is overwritten, so that the table is never read
    and written at once. Should the overwrite fail, the error says where they are. If the table is partitioned by
    key columns, only the partitions that receive rows are read and rewritten.
    """
    spark = incoming.sparkSession
    existing = spark.table(table)
    parts = _partition_columns(spark, table)
    columns = existing.columns
    scoped = bool(parts) and (set(parts) <= set(keys) or parts == [BUCKET])
    if parts == [BUCKET]:
        # at most as many numbers as there are buckets; as a list they prune the scan
        touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]
        existing = existing.filter(F.col(BUCKET).isin(touched))
    elif scoped:
        existing = _touched_partitions(existing, incoming, parts)
    rows = stored(merged(existing, incoming, keys), "upsert").select(*columns)
    if parts:
        # brings a partition's rows together and splits a partition that is too large for one task
        rows = rows.hint("rebalance", *parts)
    try:
        with _overwrite_mode(spark, "dynamic" if scoped else "static"):
            rows.write.insertInto(table, overwrite=True)
    except Exception as error:
        error.add_note(f"the merged rows of {table} are kept in {rows.inputFiles()[:1]}")
        raise


#: Partition column of tables whose rows are dealt to buckets by a hash of their key, and the property with their number.
BUCKET = "key_bucket"
_BUCKETS = "riskloom.key_buckets"


def _bucket_count(spark: SparkSession, table: str, wanted: int) -> int:
    """Buckets of an existing table, which keep their number, or as many as wanted."""
    if not spark.catalog.tableExists(table):
        return wanted
    if BUCKET not in _partition_columns(spark, table):
        return 0
    return int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{_BUCKETS}')").select("value").first()[0])


def upsert(
    df: DataFrame, table: str, keys: Sequence[str], *, fmt: str = "parquet", partition_by: Sequence[str] = (),
    order: Sequence[str] = (), buckets: int = 0,
) -> Written:
    """Replace the rows of ``table`` whose keys are in ``df`` and add the others.

    ``df`` is reduced to one row per key first. Rows with a missing key cannot be matched and are returned apart.
    Table formats with row-level operations get a MERGE. For the others, ``buckets`` lays a new table out by a hash of
    its keys (column ``key_bucket``), so that only the buckets that receive rows are read and rewritten.
    """
    spark = df.sparkSession
    valid, quarantine = split_null_keys(df, keys)
    if n := _bucket_count(spark, table, buckets):
        partition_by = [BUCKET]
        valid = valid.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))
        if not spark.catalog.tableExists(table):
            ensure_table(valid, table, fmt, partition_by)
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_BUCKETS}' = '{n}')")
    ensure_table(valid, table, fmt, partition_by)
    single, seen = counted(one_per_key(valid, keys, order))
    incoming = stored(single, "incoming")
    try:
        target = incoming.alias("s").mergeInto(table, _on(table, keys))
        target.whenMatched().updateAll().whenNotMatched().insertAll().merge()
    except PySparkException as error:
        if not (error.getCondition() or "").startswith("UNSUPPORTED_FEATURE"):
            raise
        _replace_rows(incoming, table, keys)
    return Written(seen.get["rows"], quarantine)


def set_aside(rows: DataFrame, table: str, batch_id: int, fmt: str = "parquet") -> None:
    """Keep ``rows`` as those of a batch; a batch that runs again replaces its own rows."""
    spark, part = rows.sparkSession, "batch_id"
    rows = rows.withColumn(part, F.lit(batch_id).cast("bigint"))
    if rows.isEmpty():
        return
    ensure_table(rows, table, fmt, [part])
    with _overwrite_mode(spark, "dynamic"):
        rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def _on(table: str, keys: Sequence[str]):
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{table}.{key}") == F.col(f"s.{key}"))
    return condition


def write_csv(df: DataFrame, path: str) -> int:
    """CSV files with a header in the folder ``path``; the number of rows is counted on the way."""
    df, seen = counted(df)
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return seen.get["rows"]


def write_csv_unless_empty(df: DataFrame, path: str) -> int:
    return 0 if df.isEmpty() else write_csv(df, path)
