"""Every registered query, over the log view of the ``events`` table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.functions import attack_type, hour_bucket
from logvigil.operators.attacks import (
    attack_hits,
    attack_patterns,
    attack_samples,
    attack_totals,
    patterns_of,
    sample_counts,
    tag_attacks,
    top_per_type,
    with_path,
)
from logvigil.operators.ingest import (
    dated,
    day_inventory,
    ingest_summary,
    reject_inventory,
)
from logvigil.operators.quality import distinct_labels, findings, quality_profile
from logvigil.operators.reports import preview, report
from logvigil.operators.reputation import score_range, source_scores, top_sources
from logvigil.operators.scans import (
    connection_windows,
    most_targets,
    port_scans,
    protocol_distribution,
    scanner_summary,
    timed,
)
from logvigil.operators.serving import merge_cells, peek, to_cells, unkeyed_rows
from logvigil.operators.timeline import hourly_timeline
from logvigil.operators.volume import volume_by_label, volume_by_protocol
from logvigil.plans.jobs import ingest
from logvigil.sources import (
    read_logs,
    read_rejects,
    read_result,
    saved_rows,
    scratch,
    scratch_dir,
    write_result,
)
from logvigil.sources.event_logs import event_logs, event_logs_by_day
from logvigil.sources.read import CSV_OPTIONS

Query = Callable[[SparkSession, str], DataFrame]


def _over_logs(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(event_logs(spark, sf_dir))


def _over_days(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(event_logs_by_day(spark, sf_dir))


def _top_sources(logs: DataFrame) -> DataFrame:
    return top_sources(source_scores(logs))


def _scans(logs: DataFrame) -> DataFrame:
    return port_scans(connection_windows(logs))


def _top_attackers(logs: DataFrame) -> DataFrame:
    return top_per_type(attack_hits(tag_attacks(logs)))


def _parsed_timestamps(logs: DataFrame) -> DataFrame:
    return timed(logs).select("timestamp", "ts", hour_bucket(F.col("ts")).alias("hour_bucket"))


def _over_texts(table: str, column: str) -> Query:
    """Rows per attack type, or none, of all texts of a table, each read in full."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(column)
        found = texts.select(attack_type(F.col(column)).alias("attack_type"))
        return found.groupBy("attack_type").agg(F.count("*").alias("row_count"))

    return query


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timeline of a first load, and over it that of a later one; an hour in both is that of the later one."""
    loads = [
        to_cells(hourly_timeline(event_logs(spark, sf_dir, where)), "threat_timeline")
        for where in ("event_id % 3 < 2", "event_id % 3 > 0")
    ]
    return merge_cells(*loads)


def _unkeyed(logs: DataFrame) -> DataFrame:
    tables = {
        "ip_reputation": _top_sources(logs),
        "attack_patterns": _top_attackers(logs),
        "threat_timeline": hourly_timeline(logs),
    }
    counts = [
        unkeyed_rows(rows, table).select(F.lit(table).alias("table_name"), "rows")
        for table, rows in tables.items()
    ]
    return counts[0].union(counts[1]).union(counts[2])


_TEXTS = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as raw CSV, ingested by day and read back."""
    folder = scratch_dir(spark)
    event_logs_by_day(spark, sf_dir).write.options(**_TEXTS).csv(f"{folder}/raw")
    ingest(spark, f"{folder}/raw", f"{folder}/logs")
    return read_logs(spark, f"{folder}/logs")


def _ingest_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files of two column orders, of which one kind holds newlines inside quotes."""
    folder = scratch_dir(spark)
    lines = event_logs_by_day(spark, sf_dir)
    plain, other = lines.filter("source_ip LIKE '10.0%'"), lines.filter("NOT coalesce(source_ip LIKE '10.0%', false)")
    broken = other.withColumn("user_agent", F.concat_ws("\n", "user_agent", F.lit("second line")))
    plain.write.options(**_TEXTS).csv(f"{folder}/raw/plain")
    broken.select(*reversed(lines.columns)).write.options(**_TEXTS).csv(f"{folder}/raw/broken")
    ingest(spark, f"{folder}/raw/*", f"{folder}/logs")
    return read_logs(spark, f"{folder}/logs")


def _written(spark: SparkSession, sf_dir: str, path: str, where: str) -> str:
    event_logs_by_day(spark, sf_dir, where).write.options(**_TEXTS).csv(path)
    return path


_DATED = "event_id % 101 > 0 AND event_id % 97 > 0"


def _rejects_per_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines of three ingests and a rerun: all lines, lines with a date, odd lines, and every second of these again."""
    folder = scratch_dir(spark)
    runs = [("all", "true"), ("dated", _DATED), ("odd", "event_id % 2 = 1"), ("odd", "event_id % 4 = 1")]
    for n, (ingest_id, where) in enumerate(runs):
        ingest(spark, _written(spark, sf_dir, f"{folder}/raw-{n}", where), f"{folder}/logs", ingest_id=ingest_id)
    return read_rejects(spark, f"{folder}/logs").groupBy("ingest_id", "timestamp").agg(F.count("*").alias("row_count"))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inventory of days after an ingest of all lines and one of the even lines of the first ten days of each month."""
    folder = scratch_dir(spark)
    for n, where in enumerate(("true", "event_id % 2 = 0 AND day(ts) <= 10")):
        ingest(spark, _written(spark, sf_dir, f"{folder}/raw-{n}", where), f"{folder}/logs", reports_root=f"{folder}/reports")
    return read_result(spark, f"{folder}/reports/days")


def _result_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan windows written as a result and read back."""
    folder = scratch_dir(spark)
    write_result(_scans(event_logs(spark, sf_dir)), f"{folder}/port_scans")
    return read_result(spark, f"{folder}/port_scans")


def _saved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of a stored result, as checked after a write."""
    with scratch(spark) as folder:
        write_result(_scans(event_logs(spark, sf_dir)), f"{folder}/port_scans")
        saved = saved_rows(spark, f"{folder}/port_scans")
    return spark.range(1).select(F.lit(saved).cast("long").alias("saved_rows"))


QUERIES: dict[str, Query] = {
    # Reputation
    "top_malicious_ips": _over_logs(_top_sources),
    "source_scores": _over_logs(source_scores),
    "threat_score_range": _over_logs(lambda logs: score_range(_top_sources(logs))),
    # Volume
    "threat_volume": _over_logs(lambda logs: report(volume_by_label(logs), "threat_volume")),
    "threat_volume_by_protocol": _over_logs(
        lambda logs: report(volume_by_protocol(logs), "threat_volume_by_protocol")
    ),
    "threat_volume_preview": _over_logs(
        lambda logs: preview(volume_by_protocol(logs), "threat_volume_by_protocol")
    ),
    "distinct_threat_labels": _over_logs(distinct_labels),
    # Attacks
    "attack_tagged": _over_logs(
        lambda logs: tag_attacks(logs).select("source_ip", "request_path", "attack_type")
    ),
    "attack_totals": _over_logs(
        lambda logs: report(attack_totals(tag_attacks(logs)), "attack_totals")
    ),
    "attack_patterns": _over_logs(
        lambda logs: report(attack_patterns(tag_attacks(logs)), "attack_patterns")
    ),
    "attack_patterns_of_samples": _over_logs(lambda logs: patterns_of(sample_counts(tag_attacks(logs)))),
    "attack_samples": _over_logs(lambda logs: attack_samples(tag_attacks(logs))),
    "attack_signatures_in_urls": _over_texts("pages", "url"),
    "attack_signatures_in_texts": _over_texts("documents", "text"),
    "attack_preview": _over_logs(
        lambda logs: preview(attack_hits(tag_attacks(logs)), "attack_patterns")
    ),
    "attack_top50_per_type": _over_logs(_top_attackers),
    "request_path_preview": _over_logs(
        lambda logs: preview(with_path(logs).select("request_path"), "request_paths")
    ),
    # Scans
    "parsed_timestamps": _over_logs(_parsed_timestamps),
    "port_scans": _over_logs(lambda logs: report(_scans(logs), "port_scans")),
    "port_scans_preview": _over_logs(lambda logs: preview(_scans(logs), "port_scans")),
    "port_scan_threshold_probe": _over_logs(lambda logs: most_targets(connection_windows(logs))),
    "port_scan_summary": _over_logs(
        lambda logs: report(scanner_summary(_scans(logs)), "port_scan_summary")
    ),
    "port_scan_summary_preview": _over_logs(
        lambda logs: preview(scanner_summary(_scans(logs)), "port_scan_summary")
    ),
    "protocol_distribution": _over_logs(
        lambda logs: report(protocol_distribution(timed(logs)), "protocol_distribution")
    ),
    # Timeline
    "threat_timeline": _over_logs(lambda logs: report(hourly_timeline(logs), "threat_timeline")),
    # Serving tables
    "serving_ip_reputation": _over_logs(
        lambda logs: to_cells(_top_sources(logs), "ip_reputation")
    ),
    "serving_attack_patterns": _over_logs(
        lambda logs: to_cells(_top_attackers(logs), "attack_patterns")
    ),
    "serving_threat_timeline": _over_logs(
        lambda logs: to_cells(hourly_timeline(logs), "threat_timeline")
    ),
    "serving_upsert": _upserted,
    "serving_peek": _over_logs(
        lambda logs: peek(to_cells(hourly_timeline(logs), "threat_timeline"))
    ),
    "serving_unkeyed": _over_logs(_unkeyed),
    # Ingest
    "ingest_date_partitions": _over_days(lambda logs: day_inventory(dated(logs))),
    "ingest_rejects": _over_days(reject_inventory),
    "ingest_summary": _over_days(ingest_summary),
    "ingest_roundtrip": _ingest_roundtrip,
    "ingest_mixed_files": _ingest_mixed_files,
    "ingest_rejects_per_run": _rejects_per_run,
    "ingest_manifest": _manifest,
    "result_roundtrip": _result_roundtrip,
    "result_saved_rows": _saved_rows,
    # Quality
    "quality_profile": _over_logs(quality_profile),
    "quality_findings": _over_logs(lambda logs: findings(quality_profile(logs))),
}
