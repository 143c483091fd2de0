"""Threat score per source IP."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logvigil.functions import parse_timestamp
from logvigil.schema import MALICIOUS, SUSPICIOUS, THREAT_LABELS

# Fixed values.
MALICIOUS_WEIGHT = 2
TOP_SOURCES = 10


def threats(logs: DataFrame) -> DataFrame:
    """Lines labelled suspicious or malicious."""
    return logs.filter(F.col("threat_label").isin(*THREAT_LABELS))


def _most_frequent(value: str, rows: str) -> Column:
    """Value with the most rows, NULL left out; the smallest one on a tie."""
    ranked = F.when(F.col(value).isNotNull(), F.struct(-F.col(rows), F.col(value).alias("value")))
    return F.min(ranked)["value"]


def source_scores(logs: DataFrame, malicious_weight: int = MALICIOUS_WEIGHT) -> DataFrame:
    """One row per source IP with threats: counts, last time, usual protocol and log, score.

    The lines are first counted per (IP, protocol, log type), which combines
    before the shuffle, so a source that owns a third of the lines arrives as a
    handful of rows. Only these counts are then brought together per IP; both
    windows and the final aggregate use that one partitioning.
    """
    counts = (
        threats(logs)
        .groupBy("source_ip", "protocol", "log_type")
        .agg(
            F.count("*").alias("events"),
            F.count_if(F.col("threat_label") == MALICIOUS).alias("malicious"),
            F.count_if(F.col("threat_label") == SUSPICIOUS).alias("suspicious"),
            F.max(parse_timestamp(F.col("timestamp"))).alias("last_ts"),
        )
    )
    per_protocol = Window.partitionBy("source_ip", "protocol")
    per_log_type = Window.partitionBy("source_ip", "log_type")
    return (
        counts.repartition("source_ip")
        .withColumn("protocol_events", F.sum("events").over(per_protocol))
        .withColumn("log_type_events", F.sum("events").over(per_log_type))
        .groupBy("source_ip")
        .agg(
            F.sum("events").alias("total_events"),
            F.sum("malicious").alias("malicious_count"),
            F.sum("suspicious").alias("suspicious_count"),
            F.max("last_ts").cast("string").alias("last_seen"),
            _most_frequent("protocol", "protocol_events").alias("main_protocol"),
            _most_frequent("log_type", "log_type_events").alias("log_source"),
        )
        .withColumn(
            "threat_score",
            F.col("malicious_count") * malicious_weight + F.col("suspicious_count"),
        )
    )


def top_sources(scores: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    """The n sources with the highest score."""
    return scores.orderBy(
        F.col("threat_score").desc(), F.col("source_ip").asc_nulls_last()
    ).limit(n)


def score_range(scores: DataFrame) -> DataFrame:
    """Highest and lowest score of the given sources."""
    return scores.agg(
        F.max("threat_score").alias("max_score"), F.min("threat_score").alias("min_score")
    )
