"""Helpers shared by the corpus operators: stored intermediates, skew-safe joins, byte texts."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.sources import scratch_dir

#: A key is hot if it holds more than this share of the rows: so there are fewer than HOT_KEYS of them.
HOT_KEYS = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes a table below a shared folder and reads it back, which cuts the lineage."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def work_folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return scratch_dir(spark)


def az_lower(text: Column) -> Column:
    """Lower case for A to Z only; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, how: str) -> DataFrame:
    """Joins rows with one row per key of ``groups``, whatever share of the rows a key has.

    ``size`` is the column of ``groups`` with the rows per key. Keys above the
    share 1 / HOT_KEYS are fewer than HOT_KEYS by arithmetic and are broadcast, so
    their rows don't move. All others are joined by a shuffle. ``how`` is "inner" or
    "left". Keys are never NULL.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).collect()[0]["n"]
    is_hot = F.col(size) * HOT_KEYS > F.lit(total)
    hot = groups.filter(is_hot).withColumn("_hot", F.lit(True))
    marked = rows.join(F.broadcast(hot), key, "left")
    columns = [*rows.columns, *[c for c in groups.columns if c != key]]
    done = marked.filter(F.col("_hot")).select(*columns)
    rest = marked.filter(F.col("_hot").isNull()).select(*rows.columns)
    return done.unionByName(rest.join(groups.filter(~is_hot), key, how).select(*columns))


def byte_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; NULL is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text, so that memory stays bounded."""
    for arrow in batches:
        sizes = [x or 0 for x in pa.compute.binary_length(arrow.column(text)).to_pylist()]
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield arrow.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield arrow.slice(start)
