"""Where intermediate tables go.

Multi-pass jobs write the table they share between passes, so a lost executor costs a re-read and
not a recomputation that might come out differently. The folder is the shared one the cluster
names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_dir(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="larder-")


def scratch_dir(spark: SparkSession) -> str:
    """Shared scratch folder of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    # One JVM on one machine: a local folder is shared by definition.
    return _local_dir(context.applicationId)


def session_database(spark: SparkSession) -> str:
    """The database, in the scratch folder, that holds what this session leaves until its end."""
    name = "larder_" + re.sub(r"\W", "_", spark.sparkContext.applicationId).lower()
    if name not in _sessions:
        folder = f"{scratch_dir(spark)}/larder/{name}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}'")
        _sessions[name] = folder
        atexit.register(clear_scratch, spark)
    return name


_sessions: dict[str, str] = {}


def clear_scratch(spark: SparkSession) -> None:
    """Drop all that the session has left: tables staged outside of any scope, and results that
    read them. Runs at the end of the process too, if the session still does."""
    if SparkSession.getActiveSession() is None:
        return
    name = session_database(spark)
    del _sessions[name]
    spark.sql(f"DROP DATABASE {name} CASCADE")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the session's scratch folder that no other use has."""
    return f"{_sessions[session_database(spark)]}/{label}-{uuid.uuid4().hex}"


_scope: ContextVar[str | None] = ContextVar("scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what ``stage`` writes inside the block once the block is left.

    The folder belongs to an otherwise empty database, and dropping that removes the folder on
    any file system that Spark can write to.
    """
    name = f"larder_{uuid.uuid4().hex}"
    folder = f"{scratch_dir(spark)}/larder/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to scratch as Parquet and return the written table; ``options`` are the writer's."""
    folder = _scope.get()
    path = (
        f"{folder}/{label}-{uuid.uuid4().hex}" if folder else scratch_path(df.sparkSession, label)
    )
    return write_table(df, path, **options)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Like ``stage``, but the table outlives the scope: for a result computed inside one."""
    return write_table(df, scratch_path(df.sparkSession, label))


def write_table(df: DataFrame, path: str, **options: str) -> DataFrame:
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
