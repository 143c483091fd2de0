"""Columns that are computed once per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_value(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column on which later steps filter.

    A filter on a plain ``withColumn`` column is pushed below it together with a
    copy of the whole expression, so each row pays for it twice, and once per
    signature for ``lower`` in the classifier. A filter is not pushed below an
    ``explode`` it depends on; exploding a one-element array stays in generated
    code and keeps one evaluation per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
