"""Threats per hour."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.functions import hour_bucket
from logvigil.operators.scans import timed
from logvigil.schema import BENIGN, MALICIOUS, SUSPICIOUS


def hourly_timeline(logs: DataFrame) -> DataFrame:
    """Lines per hour and threat label; the total also counts other and missing labels."""
    return timeline_of(timed(logs))


def timeline_of(lines: DataFrame) -> DataFrame:
    """The same from lines with a valid ``ts``.

    Hours are grouped as times and turned into text afterwards, once per hour.
    """
    label = F.col("threat_label")
    return (
        lines.select("threat_label", F.window("ts", "1 hour")["start"].alias("hour"))
        .groupBy("hour")
        .agg(
            *[F.count_if(label == name).alias(name) for name in (MALICIOUS, SUSPICIOUS, BENIGN)],
            F.count("*").alias("total"),
        )
        .select(
            hour_bucket(F.col("hour")).alias("hour_bucket"),
            MALICIOUS,
            SUSPICIOUS,
            BENIGN,
            "total",
        )
    )
