"""Run registered queries and their SQL counterparts side by side: ``python -m tests.compare <folder> [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(record[i]) for i in order) for record in records]
    return sorted(names), sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def _kind(value):
    return "null" if value is None else type(value).__name__


def differences(df, connection, sql: str) -> str | None:
    """What differs between the Spark result and the SQL result, None where nothing does."""
    ours_names, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    theirs_names, theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if ours_names != theirs_names:
        return f"columns {ours_names} != {theirs_names}"
    spark_types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                   "timestamp_ntz": "TIMESTAMP"}
    for name, kind in df.dtypes:
        if spark_types.get(kind, kind) != types[name].replace("TIMESTAMP_NS", "TIMESTAMP"):
            return f"type of {name}: {kind} != {types[name]}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    if ours != theirs:
        left, right = Counter(ours) - Counter(theirs), Counter(theirs) - Counter(ours)
        return f"{sum(left.values())} of {len(ours)} rows differ, {list(left)[:2]} != {list(right)[:2]}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles = connect(folder), entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            found = differences(df, connection, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None and not found.startswith("no SQL")
        print(f"{name:34s} {time.time() - start:6.1f}s  {found or 'same'}", flush=True)
    print("failed:", failed)
    spark.stop()
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
