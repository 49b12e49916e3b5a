"""Intermediate tables in the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# The folder of local sessions without the setting, which a running session does not take.
_local: list[str] = []
# Paths made by this process in the shared folder, and those of the scope a thread is in.
_made: list[str] = []
_scope: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session, as in tests, may go without the setting and gets a folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="tidemark-"))
        folder = _local[0]
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    own = _scope.get()
    (_made if own is None else own).append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return that table.

    The result has no lineage behind it, survives lost executors, is columnar (so columns
    not needed later are not read), and has a size known to the optimizer. The table stays
    until :func:`release`, as results not computed yet may read it.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder of the shared folder, so that its files appear in another at once; false when there is none."""
    jvm = spark.sparkContext._jvm
    one, two = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    system = one.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(one):
        return False
    system.mkdirs(two.getParent())
    if not system.rename(one, two):
        raise OSError(f"cannot move {source} to {target}")
    return True


def release(spark: SparkSession) -> None:
    """Delete all tables staged by this process, when the results built on them are written.

    Where other jobs of the process may still read theirs, use :func:`scope`.
    """
    _delete(spark, _made)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the tables staged inside by this thread, and no others."""
    own: list[str] = []
    token = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(token)
        _delete(spark, own)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)
