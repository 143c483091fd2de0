"""CSV records of files with newlines inside quotes, read by many tasks.

Whether a line starts inside quotes depends on all quotes before it in its file. Each task counts from the start of its block
under both assumptions; the blocks of a file, one row each, then tell which one holds.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LINES = "file string, start long, nth long, value string, before int, after int, up long, down long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number in the block, whether quotes are open before and after each, if none were at the start of the
    block, and how often they have been opened and closed by then."""
    block, nth, parity, up, down = None, 0, 0, 0, 0
    for arrow in batches:
        files, starts = arrow.column("file").to_pylist(), arrow.column("start").to_pylist()
        odd = (np.asarray(pc.count_substring(arrow.column("value"), '"')) % 2).astype(np.int64)
        first = 0
        while first < len(files):
            last = first
            while last < len(files) and (files[last], starts[last]) == (files[first], starts[first]):
                last += 1
            if (files[first], starts[first]) != block:
                block, nth, parity, up, down = (files[first], starts[first]), 0, 0, 0, 0
            after = (parity + np.cumsum(odd[first:last])) % 2
            before = np.concatenate([[parity], after[:-1]])
            ups = up + np.cumsum((before == 0) & (after == 1))
            downs = down + np.cumsum((before == 1) & (after == 0))
            part = arrow.slice(first, last - first)
            columns = [nth + np.arange(last - first), before.astype(np.int32), after.astype(np.int32), ups, downs]
            numbers, *marks = [pa.array(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [part.column("file"), part.column("start"), numbers, part.column("value"), *marks],
                names=["file", "start", "nth", "value", "before", "after", "up", "down"],
            )
            nth, parity, up, down = nth + last - first, int(after[-1]), int(ups[-1]), int(downs[-1])
            first = last


def read_records(spark: SparkSession, paths, schema: StructType, options: dict, line_end: str | None = None) -> DataFrame:
    """The CSV records of files with one header line each, whatever block a record starts or ends in.

    Lines that are records of their own stay in their task; only those of records with newlines are brought together, one record
    at a time. Newlines inside quotes are ``line_end`` if given, otherwise one line feed.
    """
    reader = spark.read if line_end is None else spark.read.option("lineSep", line_end)
    text = reader.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    lines = text.mapInArrow(_numbered, _LINES)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        lines.groupBy("file", "start")
        .agg(F.max("up").alias("ups"), F.max("down").alias("downs"))
        .withColumn("open", F.coalesce(F.sum(F.col("ups") - F.col("downs")).over(earlier), F.lit(0)) % 2 != 0)
        .withColumn("records", F.coalesce(F.sum(F.when(F.col("open"), F.col("downs")).otherwise(F.col("ups"))).over(earlier), F.lit(0)))
        .select("file", "start", "open", "records")
    )
    placed = lines.join(blocks, ["file", "start"]).select(
        "file",
        "start",
        "nth",
        "value",
        (F.col("before") + F.col("open").cast("int")).alias("_before"),
        (F.col("after") + F.col("open").cast("int")).alias("_after"),
        (F.col("records") + F.when(F.col("open"), F.col("down")).otherwise(F.col("up"))).alias("record"),
    )
    body = placed.filter("start > 0 OR nth > 0")
    alone = (F.col("_before") % 2 == 0) & (F.col("_after") % 2 == 0)
    single = body.filter(alone & (F.trim("value") != "")).select("value")
    parts = F.sort_array(F.collect_list(F.struct("start", "nth", "value")))
    joined = body.filter(~alone).groupBy("file", "record").agg(parts.alias("parts"))
    several = joined.select(F.array_join(F.col("parts.value"), "\n" if line_end is None else line_end).alias("value"))
    names = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in schema.names)
    parsing = {name: str(value) for name, value in options.items() if name != "header"}
    return single.unionByName(several).select(F.from_csv("value", names, parsing).alias("row")).select("row.*")
