"""Session set-up and the shared folder that staged data goes to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def build_session(app: str = "retinue", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC timestamps."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only when Spark itself runs locally."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    already_set = spark.sparkContext.getCheckpointDir()
    if already_set:
        return os.path.dirname(already_set)
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return os.path.join(tempfile.gettempdir(), "retinue-shared")


_scope: ContextVar[str] = ContextVar("scope", default="")


def run_folder(spark: SparkSession) -> str:
    """Everything this application stages lies under one folder, a scope's below that."""
    return f"{shared_dir(spark).rstrip('/')}/retinue-{spark.sparkContext.applicationId}{_scope.get()}"


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside, at the end and after a failure too."""
    token = _scope.set(f"{_scope.get()}/run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        clear_staged(spark)
        _scope.reset(token)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the run's folder that nothing else uses."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application, or the present scope, staged; frames that read it are unusable then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
