"""Attack signatures in request paths."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logvigil.functions import (
    ATTACK_SIGNATURES,
    first_match,
    parse_timestamp,
    path_sample,
    with_value,
)
from logvigil.functions.attack import SAMPLE_CHARS

# Fixed value.
TOP_PER_TYPE = 50



def with_path(logs: DataFrame) -> DataFrame:
    """Lines with a request path."""
    return logs.filter(F.col("request_path").isNotNull())


def tag_attacks(
    logs: DataFrame, signatures: Mapping[str, Iterable[str]] = ATTACK_SIGNATURES
) -> DataFrame:
    """Lines whose path holds a signature, with the attack type."""
    lowered = with_path(logs).withColumn("_path", F.lower("request_path"))
    return (
        with_value(lowered, "attack_type", first_match(F.col("_path"), signatures))
        .filter(F.col("attack_type").isNotNull())
        .drop("_path")
    )


def attack_totals(tagged: DataFrame) -> DataFrame:
    """Hits per attack type."""
    return tagged.groupBy("attack_type").agg(F.count("*").alias("hit_count"))


def attack_hits(tagged: DataFrame) -> DataFrame:
    """Hits and last time per attack type and source IP."""
    return (
        tagged.groupBy("attack_type", "source_ip")
        .agg(
            F.count("*").alias("hit_count"),
            F.max(parse_timestamp(F.col("timestamp"))).alias("last_ts"),
        )
        .select("attack_type", "source_ip", "hit_count", _last_seen())
    )


def top_per_type(hits: DataFrame, n: int = TOP_PER_TYPE) -> DataFrame:
    """The n sources with the most hits, per attack type."""
    ranking = Window.partitionBy("attack_type").orderBy(
        F.col("hit_count").desc(), F.col("source_ip").asc_nulls_last()
    )
    return (
        hits.withColumn("rank", F.row_number().over(ranking))
        .filter(F.col("rank") <= n)
        .select("attack_type", "source_ip", "hit_count", "last_seen")
    )


def attack_patterns(tagged: DataFrame) -> DataFrame:
    """One row per attack type and source IP: hits and last time."""
    return attack_hits(tagged)


def sample_counts(tagged: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Hits and last time per attack type, source IP and sample path, from which all attack results derive.

    Copies are combined before the shuffle, and a busy source is spread over its samples.
    """
    return tagged.groupBy(
        "attack_type", "source_ip", path_sample(F.col("request_path"), chars).alias("sample_path")
    ).agg(
        F.count("*").alias("hits"),
        F.max(parse_timestamp(F.col("timestamp"))).alias("last_ts"),
    )


def attack_samples(tagged: DataFrame, chars: int = SAMPLE_CHARS) -> DataFrame:
    """One row per attack type, source IP and sample path: its hits and last time.

    Every sample is kept, each once, with as many hits as it had; the hits of a source add up to
    those of its pattern. ``chars`` is the length of a sample.
    """
    return samples_of(sample_counts(tagged, chars))


def samples_of(counts: DataFrame) -> DataFrame:
    """The samples from the counts per sample."""
    return counts.select("attack_type", "source_ip", "sample_path", "hits", _last_seen())


def patterns_of(counts: DataFrame) -> DataFrame:
    """The patterns from the counts per sample."""
    return (
        counts.groupBy("attack_type", "source_ip")
        .agg(F.sum("hits").alias("hit_count"), F.max("last_ts").alias("last_ts"))
        .select("attack_type", "source_ip", "hit_count", _last_seen())
    )


def totals_of(counts: DataFrame) -> DataFrame:
    """Hits per attack type from the counts per sample."""
    return counts.groupBy("attack_type").agg(F.sum("hits").alias("hit_count"))


def _last_seen() -> Column:
    return F.col("last_ts").cast("string").alias("last_seen")
