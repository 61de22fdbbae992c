"""Shared scratch space: where intermediate tables are written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Temporary folders of local sessions, by application.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder of its
    own and keeps its settings; a cluster session is refused, because a
    machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or sc.getConf().get("spark.checkpoint.dir", None)
        or sc.getCheckpointDir()
    )
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _LOCAL:
        _LOCAL[sc.applicationId] = "file:" + tempfile.mkdtemp(prefix="scrubline-")
    return _LOCAL[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, grouped by application for clean-up."""
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/scrubline/{application}{_INNER.get(application, '')}"


def clear(spark: SparkSession) -> None:
    """Delete the stored tables of this application, once their results are written."""
    _delete(spark, _application_folder(spark))


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was stored within; write the results before that."""
    outer = _INNER.get(spark.sparkContext.applicationId, "")
    inner = f"{outer}/{uuid.uuid4().hex}"
    _INNER[spark.sparkContext.applicationId] = inner
    try:
        yield
    finally:
        folder = _application_folder(spark)
        _INNER[spark.sparkContext.applicationId] = outer
        _delete(spark, folder)


# The folder that ``scratch_tables`` has opened, by application.
_INNER: dict[str, str] = {}


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(folder, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared storage and return the stored table.

    Cuts lineage in a way that survives the loss of any executor, and gives
    the planner real sizes for the steps that follow.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
