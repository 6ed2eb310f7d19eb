"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}
#: Paths that the innermost block of :func:`own_scratch` of this thread has to remove.
_kept: ContextVar[list[str] | None] = ContextVar("kept", default=None)


def build_session(
    app: str = "gridmart", master: str | None = None, settings: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with adaptive execution on; ``settings`` come on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for results that later jobs share: ``spark.checkpoint.dir``, which all executors reach.

    Where it is unset a session whose tasks run in its own process takes a folder under
    ``spark.sql.warehouse.dir``. On a cluster nothing says that executors share that one, so there
    the setting is needed.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors reach")
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/gridmart-{spark.sparkContext.applicationId}"


def new_scratch(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nobody else uses."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    if (kept := _kept.get()) is not None:
        kept.append(path)
    return path


def spill(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Later jobs read single columns of it, and a lost executor costs a file read, not a recompute.
    """
    path = new_scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder by whatever file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end, after errors as well, what the block has put into the shared folder.

    For jobs whose results are stored elsewhere. Blocks do not reach into other threads.
    """
    token = _kept.set([])
    try:
        yield
    finally:
        paths = _kept.get()
        _kept.reset(token)
        for path in paths:
            remove(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application has put into the shared folder; frames that read it end with it."""
    remove(spark, scratch_root(spark))
