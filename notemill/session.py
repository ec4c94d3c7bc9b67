"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "notemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` entries win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def runs_locally(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session. Only a session on one
    machine may leave it unset: a temporary folder takes its place there.
    Elsewhere executors would each write to their own disk, so it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not runs_locally(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="notemill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch path, once nothing reads it any more."""
    _scratch.remove(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch paths of this process, once nothing reads them any more."""
    while _scratch:
        drop_scratch(spark, _scratch[-1])


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    For results that several branches of a plan read: each branch then scans
    only its columns of the written copy instead of repeating the work, and a
    lost executor costs its own tasks, not the lineage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_alone(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> tuple[DataFrame, str]:
    """(rows, path): what ``build`` returns, written once; the copies made on the way to it are deleted."""
    first = len(_scratch)
    out = saved(build(), label)
    path = _scratch[-1]
    for other in _scratch[first:-1]:
        drop_scratch(spark, other)
    return out, path
