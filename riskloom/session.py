"""Session settings and the shared folder in which intermediate tables are stored."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split hot join keys at run time, even where that costs one more shuffle behind the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # what a compressed file may take in memory, for the size check before a broadcast
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.session.timeZone": "UTC",
}

_LOCAL_FOLDER: dict[str, str] = {}
#: Folders of the tables stored by the job that runs, None outside of :func:`releasing`.
_OF_JOB: ContextVar[list[str] | None] = ContextVar("stored tables of the job", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session may go without the setting; there a scratch folder is made once per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_FOLDER:
        _LOCAL_FOLDER[app] = tempfile.mkdtemp(prefix="riskloom-")
    return _LOCAL_FOLDER[app]


def _stored_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/riskloom-{spark.conf.get('spark.app.id')}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result has no lineage behind it, so it survives lost executors without recomputation, and its size is known
    to the planner from the files: a join against it is broadcast only when the files are below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{_stored_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if (of_job := _OF_JOB.get()) is not None:
        of_job.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*jobs: Callable[[], DataFrame]) -> list[DataFrame]:
    """Results of independent jobs that are submitted at once, so that one fills the cores another leaves idle."""
    bound = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(jobs)) as pool:
        # a thread starts without the context of the job it belongs to
        return [f.result() for f in [pool.submit(copy_context().run, bound(job)) for job in jobs]]


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Delete what a job has stored when it is done.

    For jobs whose results are written and counted by then: frames that read the stored tables cannot be used any more.
    Jobs that run at the same time only delete their own tables. A job that fails leaves them, since an error may name
    one that holds the only copy of merged rows.
    """
    stored_here: list[str] = []
    token = _OF_JOB.set(stored_here)
    try:
        yield
    finally:
        _OF_JOB.reset(token)
    for folder in stored_here:
        delete_folder(spark, folder)


def release_stored(spark: SparkSession) -> None:
    """Delete the tables this application has stored. Frames that read them cannot be used any more."""
    delete_folder(spark, _stored_folder(spark))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in the Python workers of a local session, once per application.

    On a cluster the package is installed on the executors or passed with ``--py-files``.
    """
    app = spark.sparkContext.applicationId
    if spark.sparkContext.master.startswith("local") and app not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)
