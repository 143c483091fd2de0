"""Folders for files that one query writes and reads back."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``, which must be set.

    Whoever asks for it removes it with ``remove_dir`` when nothing reads it any more.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/logvigil-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, folder: str) -> None:
    """Removes a folder of ``scratch_dir`` from its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A shared folder that is removed at the end."""
    folder = scratch_dir(spark)
    try:
        yield folder
    finally:
        remove_dir(spark, folder)
