"""Tables written between two steps of a job.

A step that is read several times (the per-user table, a scored table) is
written once as Parquet to the shared folder the cluster names in
``spark.checkpoint.dir``.  That cuts the lineage, keeps column pruning, and a
lost executor costs no recomputation of the event scan.

A ``run`` owns a folder of its own there and deletes it at its end; tables staged
outside any run stay, because a lazy result may still read them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_folder: ContextVar[str | None] = ContextVar("staging folder", default=None)
_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    """The shared folder of this cluster; in local mode a folder of our own if unset."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_roots.get(context.applicationId) or tempfile.mkdtemp(prefix="stayline-")
        _local_roots[context.applicationId] = root
    return root.rstrip("/")


def new_path(spark: SparkSession) -> str:
    """A path of its own in the folder of the current run."""
    folder = _folder.get() or f"{staging_root(spark)}/stayline"
    return f"{folder}/{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the folder of the current run and return it as a table scan."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def run(spark: SparkSession) -> Iterator[str]:
    """What is staged inside belongs to this run and is deleted with it; write results before."""
    folder = f"{staging_root(spark)}/stayline/run-{uuid.uuid4().hex}"
    token = _folder.set(folder)
    try:
        yield folder
    finally:
        _folder.reset(token)
        delete(spark, folder)
