"""The jobs: ingest, the analyses, and the load of the serving tables.

A job reads logs or stored results and writes results. It never ends the
process: a result without rows comes back with an advice and a table to look at.
"""

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logvigil.operators.attacks import (
    patterns_of,
    sample_counts,
    samples_of,
    tag_attacks,
    top_per_type,
    with_path,
)
from logvigil.operators.ingest import aligned, by_day, day_inventory, day_text, merged_days
from logvigil.operators.quality import CHECKS, counters, distinct_labels
from logvigil.operators.reports import preview, report
from logvigil.operators.reputation import score_range, source_scores, top_sources
from logvigil.operators.scans import (
    connection_windows,
    most_targets,
    port_scans,
    protocol_distribution,
    scanner_summary,
    timed,
    windows_of,
    with_time,
)
from logvigil.operators.serving import SERVING_TABLES, merge_cells, peek, to_cells, unkeyed_rows
from logvigil.operators.timeline import timeline_of
from logvigil.operators.volume import label_volume_of, protocol_volume_of, size_counts
from logvigil.schema import DAY_COLUMNS, REJECTED, TCP
from logvigil.sources import (
    exists,
    publish,
    raw_files,
    read_logs,
    read_raw_csv,
    read_rejects,
    read_result,
    remove,
    saved_rows,
    scratch,
    write_days,
    write_result,
    write_version,
)

# The folders of the stored results.
RESULTS = (
    "top_malicious_ips",
    "threat_volume",
    "threat_volume_by_protocol",
    "attack_patterns",
    "attack_samples",
    "port_scans",
    "threat_timeline",
)


@dataclass(frozen=True)
class JobResult:
    """Stored rows per result, line counters, tables for a report, and advice if there are no rows.

    Results with an advice weren't published: those of an earlier run stay as they are. ``ingest_id`` names an ingest.
    """

    rows: dict[str, int]
    tables: dict[str, DataFrame]
    advice: str | None = None
    counters: dict[str, int] = field(default_factory=dict)
    ingest_id: str | None = None


class _Draft:
    """Results of a job, written but not yet published."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.versions = spark, root, {}

    def write(self, name: str, result: DataFrame) -> int:
        """Writes a result and counts what was saved."""
        self.versions[name] = write_version(result, f"{self.root}/{name}")
        return self.read(name).count()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/{self.versions[name]}")

    def publish(self) -> None:
        for name, version in self.versions.items():
            publish(self.spark, f"{self.root}/{name}", version)

    def discard(self) -> None:
        for name, version in self.versions.items():
            remove(self.spark, f"{self.root}/{name}/{version}")


@contextmanager
def _draft(spark: SparkSession, root: str) -> Iterator[_Draft]:
    """A draft that is removed if the job fails."""
    draft = _Draft(spark, root)
    try:
        yield draft
    except BaseException:
        draft.discard()
        raise


def _stored(spark: SparkSession, name: str, results_root: str) -> DataFrame:
    return read_result(spark, f"{results_root}/{name}")


def _first_gap(found: dict[str, int], *checks: str) -> str | None:
    """The first of the checks whose counter is zero: nothing read, nothing usable or nothing found."""
    return next((name for name in checks if not found[name]), None)


def _observed(lines: DataFrame, *names: str) -> tuple[DataFrame, Callable[[dict[str, int]], dict[str, int]]]:
    """The same lines, and what they counted in the pass that made results of so many rows.

    A plan that turns out to have no rows may be cut short, observation included; only then the lines are counted on their own.
    """
    seen = Observation(uuid.uuid4().hex)

    def counted(rows: dict[str, int]) -> dict[str, int]:
        if any(rows.values()):
            return {name: seen.get[name] for name in names}
        return lines.agg(*counters(*names)).first().asDict()

    return lines.observe(seen, *counters(*names)), counted


def _finished(draft: _Draft, rows: dict[str, int], found: dict[str, int], *checks: str) -> str | None:
    """Publishes the results if no check failed; otherwise they go, and the name of that check comes back."""
    gap = _first_gap(found, *checks)
    if gap is None:
        draft.publish()
    else:
        draft.discard()
        rows.clear()
    return gap


def ingest(
    spark: SparkSession,
    raw_path: str,
    logs_root: str,
    fmt: str = "parquet",
    in_time_order: bool = False,
    quoted_newlines: bool | None = None,
    reports_root: str | None = None,
    ingest_id: str | None = None,
) -> JobResult:
    """Splits raw CSV by date into day folders, replacing the days it covers.

    The raw text is read twice, once for headers and quoted newlines and once to write all lines. Lines
    without a date are stored beside the days under ``ingest_id`` (``read_rejects``), a new id by default: they stay until that ingest is
    run again. Counters and the days written are observed on the way. The inventory of all days is kept below ``reports_root``, by default
    the logs' folder with "-reports" added; only the days written are counted again. The summary tells what this run
    read and what the store holds apart.
    """
    ingest_id = ingest_id or uuid.uuid4().hex
    kinds = None if quoted_newlines is not None else raw_files(spark, raw_path)
    newlines = quoted_newlines if kinds is None else any(found for _, found, _ in kinds)
    lines = aligned(by_day(read_raw_csv(spark, raw_path, quoted_newlines, kinds=kinds), ingest_id))
    if lines.isEmpty():  # stops at the first line
        return JobResult({}, {}, CHECKS["total_rows"], {"total_rows": 0}, ingest_id)
    seen = Observation(f"ingest {ingest_id}")
    is_reject = F.col("year") == REJECTED
    observed = lines.observe(
        seen,
        F.count("*").alias("total_rows"),
        F.count_if(~is_reject).alias("loaded_rows"),
        F.count_if(is_reject).alias("rejected_rows"),
        # As many as the folders written, which the driver lists anyway.
        F.collect_set(F.when(~is_reject, day_text())).alias("days"),
    )
    write_days(observed, logs_root, fmt, in_time_order=in_time_order)
    found = {name: seen.get[name] for name in ("total_rows", "loaded_rows", "rejected_rows")}
    if not found["rejected_rows"]:
        remove(spark, f"{logs_root}/year={REJECTED}/month={REJECTED}/day={ingest_id}")
    reports_root = reports_root or f"{logs_root.rstrip('/')}-reports"
    as_stored = {"fmt": fmt, "quoted_newlines": bool(newlines) and fmt == "csv"}
    written = list(seen.get["days"])
    of_run = day_inventory(read_logs(spark, logs_root, **as_stored).filter(day_text().isin(written)))
    store = f"{reports_root}/days"
    days = merged_days(read_result(spark, store), of_run) if exists(spark, store) else of_run
    write_result(days, store)
    days = read_result(spark, store)
    totals = days.agg(F.count("*").alias("days"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")).first()
    facts = found | {"day_count": len(written), "stored_days": totals["days"], "stored_rows": totals["rows"]}
    summary = spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in facts.items()])
    write_result(summary, f"{reports_root}/summary")
    tables = {
        "rejects": read_rejects(spark, logs_root, **as_stored, ingest_id=ingest_id),
        "summary": read_result(spark, f"{reports_root}/summary"),
        "days": days.orderBy(*DAY_COLUMNS),
    }
    no_date = "no line has a date: check the timestamp column"
    hint = "fields hold newlines: read these logs with quoted_newlines" if as_stored["quoted_newlines"] else None
    return JobResult({}, tables, hint if found["loaded_rows"] else no_date, found, ingest_id)


def run_reputation(spark: SparkSession, logs: DataFrame, results_root: str) -> JobResult:
    """Stores the sources with the highest threat score."""
    lines, counted = _observed(logs, "total_rows", "threat_rows")
    with _draft(spark, results_root) as draft:
        rows = {"top_malicious_ips": draft.write("top_malicious_ips", top_sources(source_scores(lines)))}
        found = counted(rows)
        gap = _finished(draft, rows, found, "total_rows", "threat_rows")
    if gap:
        return JobResult(rows, {"labels": distinct_labels(logs)}, CHECKS[gap], found)
    stored = _stored(spark, "top_malicious_ips", results_root)
    tables = {"top sources": top_sources(stored), "score range": score_range(stored)}
    return JobResult(rows, tables, None, found)


def run_volume(spark: SparkSession, logs: DataFrame, results_root: str) -> JobResult:
    """Stores the byte volume per label, and per label and protocol.

    Both come from the counts per size, which are kept in the shared folder in between.
    """
    lines, counted = _observed(logs, "total_rows", "sized_rows")
    with scratch(spark) as folder, _draft(spark, results_root) as draft:
        write_result(size_counts(lines, "protocol"), f"{folder}/counts")
        counts = read_result(spark, f"{folder}/counts")
        rows = {
            "threat_volume": draft.write("threat_volume", label_volume_of(counts)),
            "threat_volume_by_protocol": draft.write("threat_volume_by_protocol", protocol_volume_of(counts)),
        }
        found = counted(rows)
        gap = _finished(draft, rows, found, "total_rows", "sized_rows")
    tables = {"labels": distinct_labels(logs)}
    if gap:
        return JobResult(rows, tables, CHECKS[gap], found)
    by_protocol = _stored(spark, "threat_volume_by_protocol", results_root)
    tables["by label"] = report(_stored(spark, "threat_volume", results_root), "threat_volume")
    tables["by protocol"] = preview(by_protocol, "threat_volume_by_protocol")
    return JobResult(rows, tables, None, found)


def run_attacks(spark: SparkSession, logs: DataFrame, results_root: str) -> JobResult:
    """Stores hits per attack type and source, and per sample path.

    Lines are read and classified once: all results come from the counts per sample, which are kept in the shared folder in between.
    """
    lines, counted = _observed(logs, "total_rows", "path_rows")
    with scratch(spark) as folder, _draft(spark, results_root) as draft:
        write_result(sample_counts(tag_attacks(lines)), f"{folder}/counts")
        counts = read_result(spark, f"{folder}/counts")
        rows = {
            "attack_patterns": draft.write("attack_patterns", patterns_of(counts)),
            "attack_samples": draft.write("attack_samples", samples_of(counts)),
        }
        hits = draft.read("attack_patterns").agg(F.coalesce(F.sum("hit_count"), F.lit(0)).alias("n")).first()["n"]
        found = counted(rows) | {"attack_rows": hits}
        gap = _finished(draft, rows, found, "total_rows", "path_rows", "attack_rows")
    if gap:
        paths = preview(with_path(logs).select("request_path"), "request_paths")
        return JobResult(rows, {"paths": paths}, CHECKS[gap], found)
    patterns = _stored(spark, "attack_patterns", results_root)
    totals = patterns.groupBy("attack_type").agg(F.sum("hit_count").alias("hit_count"))
    tables = {
        "totals": report(totals, "attack_totals"),
        "top sources": preview(patterns, "attack_patterns"),
    }
    return JobResult(rows, tables, None, found)


def run_scans(spark: SparkSession, logs: DataFrame, results_root: str) -> JobResult:
    """Stores the windows in which a source reaches many targets."""
    parsed = with_time(logs.select("timestamp", "source_ip", "dest_ip", "protocol"))
    lines, counted = _observed(parsed, "total_rows", "timed_rows", "tcp_rows")
    tcp = lines.filter(F.col("ts").isNotNull() & (F.col("protocol") == TCP))
    with _draft(spark, results_root) as draft:
        rows = {"port_scans": draft.write("port_scans", port_scans(windows_of(tcp)))}
        found = counted(rows) | {"scan_rows": rows["port_scans"]}
        gap = _finished(draft, rows, found, "total_rows", "timed_rows", "tcp_rows", "scan_rows")
    if gap:
        tables = {"protocols": report(protocol_distribution(timed(logs)), "protocol_distribution")}
        if gap == "scan_rows":
            tables["most targets"] = most_targets(connection_windows(logs))
        return JobResult(rows, tables, CHECKS[gap], found)
    stored = _stored(spark, "port_scans", results_root)
    tables = {
        "scans": preview(stored, "port_scans"),
        "sources": preview(scanner_summary(stored), "port_scan_summary"),
    }
    return JobResult(rows, tables, None, found)


def run_timeline(spark: SparkSession, logs: DataFrame, results_root: str) -> JobResult:
    """Stores the lines per hour and label."""
    lines, counted = _observed(with_time(logs.select("timestamp", "threat_label")), "total_rows", "timed_rows")
    with _draft(spark, results_root) as draft:
        timeline = timeline_of(lines.filter(F.col("ts").isNotNull()))
        rows = {"threat_timeline": draft.write("threat_timeline", timeline)}
        found = counted(rows)
        gap = _finished(draft, rows, found, "total_rows", "timed_rows")
    if gap:
        return JobResult(rows, {}, CHECKS[gap], found)
    stored = _stored(spark, "threat_timeline", results_root)
    return JobResult(rows, {"hours": report(stored, "threat_timeline")}, None, found)


def load_serving(
    spark: SparkSession, results_root: str, serving_root: str, previous_root: str | None = None
) -> JobResult:
    """Turns stored results into serving tables, over those of an earlier load if given.

    The new tables go to a folder of their own: the earlier ones stay readable
    during the load, and a load that fails can be run again. Results that no analysis has
    stored yet are named in the advice; their tables are those of the earlier load, if it has them.
    """
    if previous_root is not None and previous_root.rstrip("/") == serving_root.rstrip("/"):
        raise ValueError("serving_root must differ from previous_root")
    names = {"ip_reputation": "top_malicious_ips", "attack_patterns": "attack_patterns", "threat_timeline": "threat_timeline"}
    rows, tables, missing = {}, {}, []
    for table in SERVING_TABLES:
        new = None
        if exists(spark, f"{results_root}/{names[table]}"):
            new = _stored(spark, names[table], results_root)
            new = top_per_type(new) if table == "attack_patterns" else new
        else:
            missing.append(names[table])
        earlier = f"{previous_root}/{table}"
        old = read_result(spark, earlier) if previous_root is not None and exists(spark, earlier) else None
        if new is None and old is None:
            continue
        cells = old if new is None else to_cells(new, table)
        write_result(cells if new is None or old is None else merge_cells(old, cells), f"{serving_root}/{table}")
        rows[table] = saved_rows(spark, f"{serving_root}/{table}")
        tables[table] = peek(read_result(spark, f"{serving_root}/{table}"))
        if new is not None:
            tables[f"{table}, rows without a key"] = unkeyed_rows(new, table)
    return JobResult(rows, tables, f"no stored result of {', '.join(missing)}" if missing else None)


ANALYSES = {
    "reputation": run_reputation,
    "volume": run_volume,
    "attacks": run_attacks,
    "scans": run_scans,
    "timeline": run_timeline,
}


def run_all(spark: SparkSession, logs: DataFrame, results_root: str) -> dict[str, JobResult]:
    """All analyses over the given logs."""
    return {name: run(spark, logs, results_root) for name, run in ANALYSES.items()}
