"""Log and result readers.

CSV quotes are doubled inside quoted fields, as in RFC 4180.
"""

import csv
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from logvigil.schema import DAY_SCHEMA, LOG_SCHEMA, REJECTED
from logvigil.sources.records import read_records
from logvigil.sources.versions import current_version

CSV_OPTIONS = {"header": True, "escape": '"'}


def read_stored(
    spark: SparkSession, root: str, fmt: str = "parquet", quoted_newlines: bool = False
) -> DataFrame:
    """All that an ingest has stored: log lines of all days, and rejected lines."""
    schema = StructType([*LOG_SCHEMA.fields, *DAY_SCHEMA.fields])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS, multiLine=quoted_newlines)
    return reader.format(fmt).load(root)


def read_logs(
    spark: SparkSession, root: str, fmt: str = "parquet", quoted_newlines: bool = False
) -> DataFrame:
    """Log lines of all days below the root, with year, month and day as text.

    Filters on year, month and day skip the folders of other days. Large files are split. CSV
    files whose fields hold newlines, which an ingest tells, need ``quoted_newlines``: then
    one task reads one file.
    """
    return read_stored(spark, root, fmt, quoted_newlines).filter(F.col("year") != REJECTED)


def read_rejects(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    quoted_newlines: bool = False,
    ingest_id: str | None = None,
) -> DataFrame:
    """The lines that an ingest below this root could not date, with its id; those of all ingests if none is given.

    The lines of an ingest are replaced only by a rerun of that ingest, also by one without such lines.
    """
    stored = read_stored(spark, root, fmt, quoted_newlines).filter(F.col("year") == REJECTED)
    rejects = stored.select(*LOG_SCHEMA.names, F.col("day").alias("ingest_id"))
    return rejects if ingest_id is None else rejects.filter(F.col("ingest_id") == ingest_id)


def raw_files(spark: SparkSession, path: str) -> list[tuple[str, bool, list[str]]]:
    """(header, whether a quoted field holds a newline, files) for each kind of raw file, in one pass.

    If every line has an even number of quotes, each one ends outside quotes. The result
    is as long as the file listing, which the driver holds anyway.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.text(path).select(
        "value",
        (quotes % 2 == 1).alias("odd"),
        F.col("_metadata.file_path").alias("file"),
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("nth"),
    )
    files = lines.groupBy("file").agg(F.bool_or("odd").alias("found"), F.min_by("value", "nth").alias("header"))
    kinds = files.groupBy("header", "found").agg(F.sort_array(F.collect_list("file")).alias("files"))
    rows = kinds.orderBy("header", "found").collect()
    return [(r["header"], r["found"], [_path_of(file) for file in r["files"]]) for r in rows]


def _path_of(uri: str) -> str:
    """A file's name as readers take it: not percent-coded, and no character read as a pattern."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", unquote(uri))


def header_schema(header: str) -> StructType:
    """The columns of a header line, all text."""
    names = next(csv.reader([header.lstrip("﻿")]), [])
    return StructType([StructField(name, StringType()) for name in names])


def read_raw_csv(
    spark: SparkSession,
    path: str,
    quoted_newlines: bool | None = None,
    line_end: str | None = None,
    kinds: list[tuple[str, bool, list[str]]] | None = None,
) -> DataFrame:
    """Raw CSV files, each with a header of its own; all columns are text and joined by name.

    One pass over the text (``raw_files``, unless its result is given) finds the header of each file and whether quoted fields
    hold newlines; such files are read by many tasks too (``read_records``). Files of one kind share a reader with the
    schema of their header. A caller who says ``quoted_newlines`` also says that all headers are
    alike: that pass is left out, another header is an error, and one task reads one file. Giving the ``line_end`` of files
    with quoted newlines keeps the same characters inside quotes as they are; otherwise they are read as one newline.
    """

    def reader(whole: bool):
        options = {"multiLine": True} | ({"lineSep": line_end} if line_end is not None else {}) if whole else {}
        return spark.read.options(**CSV_OPTIONS, enforceSchema=False, **options)

    if quoted_newlines is not None:
        first = reader(quoted_newlines).csv(path)
        return reader(quoted_newlines).schema(first.schema).csv(path)
    kinds = raw_files(spark, path) if kinds is None else kinds
    tables = []
    for header, found, files in kinds:
        paths, schema = path if len(kinds) == 1 else files, header_schema(header)
        if found:
            tables.append(read_records(spark, paths, schema, CSV_OPTIONS, line_end))
        else:
            tables.append(reader(False).schema(schema).csv(paths))
    if not tables:
        return spark.createDataFrame([], "timestamp string")
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """A stored result, as last published."""
    version = current_version(spark, path)
    return spark.read.parquet(path if version is None else f"{path}/{version}")
