"""Log and result writers."""

from pyspark.sql import DataFrame, SparkSession

from logvigil.operators.ingest import typed
from logvigil.schema import DAY_COLUMNS
from logvigil.sources.read import CSV_OPTIONS, read_result
from logvigil.sources.versions import publish, write_version

ROWS_PER_FILE = 1_000_000


def write_result(result: DataFrame, path: str) -> None:
    """Stores a result as Parquet in place of an earlier one, which stays readable until the new one is whole."""
    publish(result.sparkSession, path, write_version(result, path))


def write_days(
    lines: DataFrame,
    root: str,
    fmt: str = "parquet",
    rows_per_file: int = ROWS_PER_FILE,
    in_time_order: bool = False,
) -> None:
    """Writes lines to year=/month=/day= folders and replaces only the days among them.

    Rebalancing puts the lines of a day together, so a day does not become one
    small file per task, and splits a day that is too large for one task. Input
    in time order has few days per task as it is, and can do without that shuffle. Other
    formats than CSV store the columns in their types.
    """
    if fmt != "csv":
        lines = typed(lines)
    if not in_time_order:
        lines = lines.hint("rebalance", *DAY_COLUMNS)
    writer = (
        lines.write.partitionBy(*DAY_COLUMNS)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
    )
    if fmt == "csv":
        # Texts keep their outer blanks, which the CSV writer trims by default.
        writer = writer.options(
            **CSV_OPTIONS, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.format(fmt).save(root)


def saved_rows(spark: SparkSession, path: str) -> int:
    """Rows of a stored result, from the file footers."""
    return read_result(spark, path).count()
