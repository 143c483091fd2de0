"""Raw lines split by the date they carry."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logvigil.functions import date_key, with_value
from logvigil.schema import DAY_COLUMNS, LOG_SCHEMA, REJECTED


def _with_date(raw: DataFrame) -> DataFrame:
    return with_value(raw, "_date", F.coalesce(date_key(F.col("timestamp")), F.lit("")))


def dated(raw: DataFrame) -> DataFrame:
    """Lines with a date, and its year, month and day as written."""
    parts = [
        F.split_part("_date", F.lit("-"), F.lit(position)).alias(name)
        for position, name in enumerate(DAY_COLUMNS, start=1)
    ]
    return _with_date(raw).filter(F.col("_date") != "").select(*raw.columns, *parts)


def rejected(raw: DataFrame) -> DataFrame:
    """Lines without a date."""
    return _with_date(raw).filter(F.col("_date") == "").select(*raw.columns)


def by_day(raw: DataFrame, ingest_id: str) -> DataFrame:
    """All lines with the day they belong to; lines without a date in a day named after their ingest."""
    parts = [
        F.when(F.col("_date") == "", F.lit(ingest_id if name == "day" else REJECTED))
        .otherwise(F.split_part("_date", F.lit("-"), F.lit(position)))
        .alias(name)
        for position, name in enumerate(DAY_COLUMNS, start=1)
    ]
    return _with_date(raw).select(*raw.columns, *parts)


def aligned(lines: DataFrame) -> DataFrame:
    """The columns of the log schema first and in its order, missing ones as NULL.

    CSV logs are read by position, so raw files with another order are put in line.
    """
    known = [
        F.col(field.name) if field.name in lines.columns else F.lit(None).cast("string")
        for field in LOG_SCHEMA
    ]
    more = [name for name in lines.columns if name not in LOG_SCHEMA.names]
    return lines.select(
        *[column.alias(name) for column, name in zip(known, LOG_SCHEMA.names, strict=True)],
        *more,
    )


def typed(lines: DataFrame) -> DataFrame:
    """Text columns of the log schema in their types, as a columnar format stores them.

    A text that is no value of its type becomes NULL, as it does when read from CSV.
    """
    kinds = {field.name: field.dataType for field in LOG_SCHEMA}
    return lines.withColumns(
        {name: F.col(name).try_cast(kinds[name]) for name in lines.columns if name in kinds}
    )


def day_inventory(dated_lines: DataFrame) -> DataFrame:
    """Lines per day."""
    return dated_lines.groupBy(*DAY_COLUMNS).agg(F.count("*").alias("row_count"))


def day_text() -> Column:
    """Year, month and day as one text."""
    return F.concat_ws("-", *DAY_COLUMNS)


def merged_days(before: DataFrame, written: DataFrame) -> DataFrame:
    """The inventory of a store: days written again have their new counts, all others those they had."""
    return before.join(written, list(DAY_COLUMNS), "left_anti").unionByName(written)


def reject_inventory(raw: DataFrame) -> DataFrame:
    """Rejected lines per time text."""
    return rejected(raw).groupBy("timestamp").agg(F.count("*").alias("row_count"))


def ingest_summary(raw: DataFrame) -> DataFrame:
    """One row: lines read, loaded and rejected, and the number of days."""
    per_date = _with_date(raw).groupBy("_date").agg(F.count("*").alias("lines"))
    has_date = F.col("_date") != ""
    return per_date.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(has_date, F.col("lines"))), F.lit(0)).alias("loaded_rows"),
        F.coalesce(F.sum(F.when(~has_date, F.col("lines"))), F.lit(0)).alias("rejected_rows"),
        F.count_if(has_date).alias("day_count"),
    )
