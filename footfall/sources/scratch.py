"""A place for intermediate files that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_open: list[list[tuple[SparkSession, str]]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, the shared folder of the cluster.

    Where that is unset, the checkpoint folder of the context is taken. Only a
    session in local mode may do without both and gets a temporary folder: on a
    cluster each executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="footfall-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for paths in _open:
        paths.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results that several later steps read: they are computed once, survive
    the loss of executors, and are scanned with only the columns needed.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def cleared() -> Iterator[None]:
    """Remove at the end all scratch files made inside.

    For callers that have written their result by then; a result that is still
    to be computed needs the files.
    """
    paths: list[tuple[SparkSession, str]] = []
    _open.append(paths)
    try:
        yield
    finally:
        _open.remove(paths)
        for spark, path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
