"""The shared folder for data that must outlive an executor."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local session without either gets a temporary folder of its own; on a cluster
    a machine-local folder would be lost with its machine, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


_own: ContextVar[str | None] = ContextVar("own", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables of the block go into one folder, which is deleted when it ends.

    For work that leaves nothing lazy behind: a frame over such a table cannot be read later.
    """
    folder = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _own.set(folder)
    try:
        yield folder
    finally:
        _own.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder, or the `scratch` folder at work, that nothing else uses."""
    return f"{_own.get() or shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = (), **options: str) -> DataFrame:
    """Write the frame as parquet in the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, fixes the result of
    order-dependent expressions, lets later scans prune columns, and shows the planner
    the real size (so a small result is broadcast by Spark's own size check).
    """
    path = new_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
