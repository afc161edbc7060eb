"""Intermediate tables.

A table which several later steps read is written once to the folder the cluster shares for
checkpoints. That keeps the scan of the raw feeds down to one, survives the loss of any executor,
and gives Spark the true size of the table, so that it broadcasts the small ones by itself and
joins the large ones by shuffle, without any hint.

A run opens a ``scope``: what is staged in it goes to a folder of its own, which is dropped when the
run is done. Outside a scope the tables stay, like Spark's own checkpoints, until the folder's
retention removes them; a query whose result is still to be computed needs them.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[str | None] = ContextVar("scope", default=None)


def staging_root(spark: SparkSession) -> str:
    """The session's checkpoint folder. It has to be set: only a local session, whose driver and
    executors are one process, is given one of its own."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder which all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stockweave-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is staged inside, dropped at the end."""
    folder = f"{staging_root(spark)}/stockweave/run-{uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the staging root."""
    folder = _scope.get() or f"{staging_root(spark)}/stockweave"
    return f"{folder}/{label}-{uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
