"""Counters that tell whether the input suits the analyses."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logvigil.functions import attack_type, parse_timestamp
from logvigil.operators.scans import connection_windows, port_scans
from logvigil.schema import TCP, THREAT_LABELS


def distinct_labels(logs: DataFrame) -> DataFrame:
    """The threat labels in use, NULL among them."""
    return logs.select("threat_label").distinct()


def counters(*names: str) -> list[Column]:
    """Counters of lines that a job can observe in the pass that makes its result; two of them need the column ``ts``."""
    label = F.col("threat_label")
    known = {
        "total_rows": lambda: F.count("*"),
        "threat_rows": lambda: F.count_if(label.isin(*THREAT_LABELS)),
        "sized_rows": lambda: F.count_if(label.isNotNull() & F.col("bytes_transferred").isNotNull()),
        "path_rows": lambda: F.count_if(F.col("request_path").isNotNull()),
        "timed_rows": lambda: F.count_if(F.col("ts").isNotNull()),
        "tcp_rows": lambda: F.count_if(F.col("ts").isNotNull() & (F.col("protocol") == TCP)),
    }
    return [known[name]().alias(name) for name in names]


def line_counts(logs: DataFrame) -> DataFrame:
    """One row of line counters, in one pass."""
    lines = logs.select(
        "threat_label",
        "bytes_transferred",
        "protocol",
        "request_path",
        attack_type(F.col("request_path")).isNotNull().alias("is_attack"),
        parse_timestamp(F.col("timestamp")).alias("ts"),
    )
    return lines.agg(
        *counters("total_rows", "threat_rows", "sized_rows", "path_rows"),
        F.count_if("is_attack").alias("attack_rows"),
        *counters("timed_rows", "tcp_rows"),
    )


def quality_profile(logs: DataFrame) -> DataFrame:
    """The line counters and the number of scan windows, as one row.

    The log is scanned twice: the windows need a shuffle by source, which the counters can do without.
    """
    lines = line_counts(logs)
    scans = port_scans(connection_windows(logs)).agg(F.count("*").alias("scan_rows"))
    names = [*lines.columns, *scans.columns]
    both = lines.unionByName(scans, allowMissingColumns=True)
    return both.agg(*[F.max(name).alias(name) for name in names])


# Counter that must not be zero, and what to look at if it is.
CHECKS = {
    "total_rows": "no log line was read: check the path and that the ingest ran",
    "threat_rows": "no threat label among the lines: look at the labels in use",
    "sized_rows": "no line has both a threat label and a byte count: look at the labels in use",
    "path_rows": "no line has a request path: check the input",
    "attack_rows": "no signature in any request path: look at some paths",
    "timed_rows": "no line has a valid time: check the time format",
    "tcp_rows": "no TCP line with a valid time: look at the protocols in use",
    "scan_rows": "no window reaches the scan threshold: look at the most targets in any window",
}


def findings(profile: DataFrame) -> DataFrame:
    """One row per check: its counter, whether it passed, and what to do if not."""
    checks = profile.unpivot([], list(CHECKS), "check", "row_count")
    advice = F.create_map(*[F.lit(text) for pair in CHECKS.items() for text in pair])
    passed = F.col("row_count") > 0
    return checks.select(
        "check",
        "row_count",
        passed.alias("passed"),
        F.when(~passed, advice[F.col("check")]).alias("advice"),
    )
