"""Results stored as versions in folders of their own, one of which a pointer names.

A version is written as a whole before the pointer moves to it, so readers see the earlier result until the new one is complete,
and a job that dies on the way leaves the earlier one in place.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name."""
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder, if it is there."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def write_version(result: DataFrame, path: str) -> str:
    """Writes a result to a new version, which nobody reads yet; returns its name."""
    version = f"version-{uuid.uuid4().hex}"
    result.write.parquet(f"{path}/{version}")
    return version


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version in use, or None where nothing was published."""
    files, place = _file_system(spark, f"{path}/{POINTER}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Moves the pointer to a version. The one before stays for readers at work; older ones are removed."""
    before = current_version(spark, path)
    jvm = spark._jvm
    files, place = _file_system(spark, f"{path}/{POINTER}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}-{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(draft), files.makeQualified(place), options)
    for status in files.listStatus(files.makeQualified(place).getParent()):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in (version, before):
            files.delete(status.getPath(), True)
