"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_OWN_DIRS: dict[str, str] = {}
_SCOPE: ContextVar[str] = ContextVar("scope", default="tables")


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the results depend on: all timestamps are naive UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves, but only in local mode: on a cluster the
    executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and the executors")
    application = spark.sparkContext.applicationId
    if application not in _OWN_DIRS:
        _OWN_DIRS[application] = tempfile.mkdtemp(prefix="usertide-")
    return _OWN_DIRS[application]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, grouped by application; nothing is created yet."""
    return f"{shared_dir(spark)}/usertide/{spark.sparkContext.applicationId}/{_SCOPE.get()}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, spread_by: str | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back, which cuts its lineage.

    Used where one frame feeds several fits or passes.  A lost executor then costs a re-read of some
    files, not a recomputation of everything upstream, and later passes read only their columns.

    ``spread_by`` names a unique column and gives every core a file of its own: iterative fits go
    over the table many times, and a small table would otherwise end up in one file and one task.
    """
    if spread_by:
        session = df.sparkSession
        tasks = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
        df = df.repartition(tasks, spread_by)
    path = new_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored within the block go with its end; results must have been written or collected by then."""
    scope = f"run-{uuid.uuid4().hex}"
    token = _SCOPE.set(scope)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _delete(spark, f"/{scope}")


def drop_materialized(spark: SparkSession) -> None:
    """Delete the tables this application has stored; frames that read them no longer work."""
    _delete(spark, "")


def _delete(spark: SparkSession, below: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/usertide/{spark.sparkContext.applicationId}{below}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
