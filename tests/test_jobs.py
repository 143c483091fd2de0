"""The jobs end to end: raw CSV to serving tables."""

import pytest
from pyspark.sql import functions as F

from logvigil.operators.quality import CHECKS, quality_profile
from logvigil.plans.jobs import (
    ANALYSES,
    RESULTS,
    ingest,
    load_serving,
    run_attacks,
    run_all,
    run_reputation,
    run_scans,
    run_volume,
)
from logvigil.plans.queries import QUERIES
from logvigil.sources import read_logs, read_rejects, read_result
from logvigil.sources.event_logs import event_logs
from tests.lines import log_lines, rows_of


@pytest.fixture(scope="module")
def done(spark, data_root, tmp_path_factory):
    """All jobs over the fixture logs, and their folders."""
    root = tmp_path_factory.mktemp("jobs")
    raw, logs, results, serving = (str(root / name) for name in ("raw", "logs", "results", "serving"))
    event_logs(spark, f"{data_root}/sf0.001").write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(raw)
    ingested = ingest(spark, raw, logs)
    analysed = run_all(spark, read_logs(spark, logs), results)
    loaded = load_serving(spark, results, serving)
    return {"root": root, "ingested": ingested, "analysed": analysed, "loaded": loaded}


def test_ingest_report(done):
    tables = done["ingested"].tables
    assert rows_of(tables["summary"]) == [(1000, 980, 20, 1, 1, 980)]
    assert rows_of(tables["days"]) == [("2024", "05", "01", 980)]
    assert tables["rejects"].count() == 20


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_raw_columns_in_another_order(spark, tmp_path, fmt):
    text = "more,request_path,bytes_transferred,timestamp\n1,/nmap,7,2024-05-01 00:00:00\n"
    (tmp_path / "raw.csv").write_text(text)
    ingest(spark, str(tmp_path / "raw.csv"), str(tmp_path / "logs"), fmt)
    logs = read_logs(spark, str(tmp_path / "logs"), fmt)
    assert rows_of(logs.select("timestamp", "source_ip", "bytes_transferred", "request_path")) == [
        ("2024-05-01 00:00:00", None, 7, "/nmap")
    ]


def test_ingest_without_dates_gives_advice(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("timestamp,source_ip\nbad,1.1.1.1\n")
    result = ingest(spark, str(tmp_path / "raw.csv"), str(tmp_path / "logs"))
    assert "no line has a date" in result.advice
    assert rows_of(result.tables["summary"]) == [(1, 0, 1, 0, 0, 0)]
    assert [row["source_ip"] for row in result.tables["rejects"].collect()] == ["1.1.1.1"]
    assert read_logs(spark, str(tmp_path / "logs")).count() == 0
    (tmp_path / "none.csv").write_text("timestamp,source_ip\n")
    assert "no log line" in ingest(spark, str(tmp_path / "none.csv"), str(tmp_path / "empty")).advice


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_raw_files_of_two_headers_lose_no_line(spark, tmp_path, fmt):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("timestamp,source_ip,threat_label\n2024-05-01 00:00:00,1.1.1.1,benign\n")
    (raw / "b.csv").write_text('source_ip,timestamp,threat_label\n2.2.2.2,2024-05-01 00:00:01,"ben\nign"\n')
    result = ingest(spark, str(raw), str(tmp_path / "logs"), fmt)
    assert rows_of(result.tables["summary"]) == [(2, 2, 0, 1, 1, 2)] and result.tables["rejects"].count() == 0
    logs = read_logs(spark, str(tmp_path / "logs"), fmt, quoted_newlines=fmt == "csv")
    assert rows_of(logs.select("timestamp", "source_ip", "threat_label")) == [
        ("2024-05-01 00:00:00", "1.1.1.1", "benign"),
        ("2024-05-01 00:00:01", "2.2.2.2", "ben\nign"),
    ]


def test_ingest_reads_the_raw_text_twice(spark, tmp_path):
    """Once for headers and newlines, once to write; a filter that counts scans sees no more jobs on the raw files."""
    (tmp_path / "raw.csv").write_text("timestamp,source_ip\n2024-05-01 00:00:00,1.1.1.1\nbad,2.2.2.2\n")
    result = ingest(spark, str(tmp_path / "raw.csv"), str(tmp_path / "logs"))
    for table in result.tables.values():
        assert str(tmp_path / "raw.csv") not in table._jdf.queryExecution().toString()
        assert table.count() == 1


def test_results_match_the_queries(spark, done, data_root):
    logs = read_logs(spark, str(done["root"] / "logs")).drop("year", "month", "day")
    dated_view = event_logs(spark, f"{data_root}/sf0.001").filter(
        F.col("timestamp").isNotNull() & (F.col("timestamp") != "not-a-time")
    )
    assert rows_of(logs) == rows_of(dated_view)
    for name in ("port_scans", "threat_timeline"):
        stored = read_result(spark, str(done["root"] / "results" / name))
        assert rows_of(stored) == rows_of(QUERIES[name](spark, f"{data_root}/sf0.001"))


def test_logs_as_csv(spark, done, tmp_path):
    ingest(spark, str(done["root"] / "raw"), str(tmp_path / "logs"), "csv")
    logs = read_logs(spark, str(tmp_path / "logs"), "csv")
    assert dict(logs.dtypes)["bytes_transferred"] == "bigint"
    assert rows_of(logs) == rows_of(read_logs(spark, str(done["root"] / "logs")))
    run_all(spark, logs, str(tmp_path / "results"))
    for name in RESULTS:
        stored = read_result(spark, str(tmp_path / "results" / name))
        assert rows_of(stored) == rows_of(read_result(spark, str(done["root"] / "results" / name)))


def test_every_result_is_stored_and_counted(spark, done):
    counted = {}
    for result in done["analysed"].values():
        assert result.advice is None
        counted |= result.rows
    assert set(counted) == set(RESULTS)
    for name, rows in counted.items():
        stored = read_result(spark, str(done["root"] / "results" / name))
        assert stored.count() == rows > 0
        assert not any("struct" in kind or "array" in kind for _, kind in stored.dtypes)
    assert counted["top_malicious_ips"] == 10


def test_reports_can_be_shown(done):
    results = [*done["analysed"].values(), done["loaded"]]
    titles = [title for result in results for title in result.tables]
    assert len(titles) == 16
    for result in results:
        for table in result.tables.values():
            assert table.count() > 0


def test_serving_tables(spark, done):
    assert done["loaded"].rows["threat_timeline"] == 2 * 4
    cells = read_result(spark, str(done["root"] / "serving" / "ip_reputation"))
    keys = cells.groupBy("row_key").count()
    missing = done["loaded"].tables["ip_reputation, rows without a key"].first()["rows"]
    assert keys.count() == 10 - missing
    assert rows_of(keys.select("count").distinct()) == [(7,)]


def test_a_later_load_is_put_over_the_earlier_one(spark, done, tmp_path):
    earlier = done["root"] / "serving"
    old = read_result(spark, str(earlier / "threat_timeline"))
    previous = tmp_path / "previous"
    stale = old.withColumn("value", F.lit("stale"))
    gone = stale.limit(4).withColumn("row_key", F.lit("2023-01-01-00"))
    stale.unionByName(gone).write.parquet(str(previous / "threat_timeline"))
    for table in ("ip_reputation", "attack_patterns"):
        read_result(spark, str(earlier / table)).write.parquet(str(previous / table))
    load_serving(
        spark, str(done["root"] / "results"), str(tmp_path / "serving"), str(previous)
    )
    merged = read_result(spark, str(tmp_path / "serving" / "threat_timeline"))
    assert rows_of(merged.filter("row_key > '2024'")) == rows_of(old)
    assert merged.filter("row_key < '2024'").count() == 4
    with pytest.raises(ValueError, match="differ"):
        load_serving(spark, str(done["root"] / "results"), str(previous), f"{previous}/")


def test_jobs_tell_nothing_read_nothing_usable_and_nothing_found_apart(spark, tmp_path):
    out = str(tmp_path)
    usual = log_lines(spark, [{}])
    for run, changes, check, table in [
        (run_reputation, {"protocol": "UDP"}, "threat_rows", "labels"),
        (run_volume, {"bytes_transferred": None}, "sized_rows", "labels"),
        (run_attacks, {"request_path": None}, "path_rows", "paths"),
        (run_attacks, {}, "attack_rows", "paths"),
        (run_scans, {"timestamp": "bad"}, "timed_rows", "protocols"),
        (run_scans, {"protocol": "UDP"}, "tcp_rows", "protocols"),
        (run_scans, {}, "scan_rows", "most targets"),
    ]:
        result = run(spark, log_lines(spark, [changes]), out)
        assert result.rows == {}
        assert result.advice == CHECKS[check] and result.counters["total_rows"] == 1
        assert table in result.tables
    for run in ANALYSES.values():
        assert run(spark, usual.limit(0), out).advice == CHECKS["total_rows"]


def test_the_counters_of_the_jobs_are_those_of_the_profile(spark, done, data_root):
    logs = read_logs(spark, str(done["root"] / "logs")).drop("year", "month", "day")
    profile = quality_profile(logs).first().asDict()
    for result in done["analysed"].values():
        assert result.counters.items() <= profile.items()


def test_a_run_without_a_result_leaves_the_earlier_ones_in_place(spark, done, tmp_path):
    """Whatever the check that fails, the results of the earlier run stay, and nothing of the new one."""
    logs, out = read_logs(spark, str(done["root"] / "logs")), str(tmp_path)
    run_all(spark, logs, out)
    before = {name: rows_of(read_result(spark, f"{out}/{name}")) for name in RESULTS}
    files = sorted(str(p) for p in tmp_path.rglob("*.parquet"))
    nothing = log_lines(spark, [{"timestamp": "bad", "bytes_transferred": None, "request_path": None, "threat_label": None}])
    for run in ANALYSES.values():
        for lines in (logs.limit(0), nothing):
            assert run(spark, lines, out).advice
    assert {name: rows_of(read_result(spark, f"{out}/{name}")) for name in RESULTS} == before
    assert sorted(str(p) for p in tmp_path.rglob("*.parquet")) == files


def test_a_job_that_dies_leaves_the_earlier_results_in_place(spark, done, tmp_path):
    logs, out = read_logs(spark, str(done["root"] / "logs")), str(tmp_path)
    run_all(spark, logs, out)
    before = {name: rows_of(read_result(spark, f"{out}/{name}")) for name in RESULTS}
    broken = logs.withColumn("timestamp", F.when(F.rand() >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("timestamp")))
    for name in ("reputation", "attacks", "scans", "timeline"):
        with pytest.raises(Exception, match="lost"):
            ANALYSES[name](spark, broken, out)
    assert {name: rows_of(read_result(spark, f"{out}/{name}")) for name in RESULTS} == before


def test_rejects_belong_to_the_run_that_found_them(spark, tmp_path):
    logs = str(tmp_path / "logs")

    def run(name, *times):
        (tmp_path / "raw.csv").write_text("timestamp,source_ip\n" + "".join(f"{t},1.1.1.1\n" for t in times))
        return ingest(spark, str(tmp_path / "raw.csv"), logs, ingest_id=name)

    def stored():
        return rows_of(read_rejects(spark, logs).select("ingest_id", "timestamp"))

    run("one", "bad-time", "2024-05-01 00:00:00")
    assert run("two", "2024-05-02 00:00:00").tables["rejects"].count() == 0
    assert rows_of(run("three", "other-bad").tables["rejects"].select("timestamp")) == [("other-bad",)]
    assert stored() == [("one", "bad-time"), ("three", "other-bad")]
    summary = run("one", "2024-05-01 00:00:00", "2024-05-01 00:00:01").tables["summary"]
    assert rows_of(summary) == [(2, 2, 0, 1, 2, 3)]
    assert stored() == [("three", "other-bad")]


def test_an_ingest_reads_only_the_days_it_wrote(spark, tmp_path):
    """Another day is made unreadable, and the inventory still has it."""
    for fmt in ("csv", "parquet"):
        logs = tmp_path / fmt
        for day in ("01", "02"):
            (tmp_path / "raw.csv").write_text(f"timestamp,source_ip\n2024-05-{day} 00:00:00,1.1.1.1\n")
            result = ingest(spark, str(tmp_path / "raw.csv"), str(logs), fmt)
            for file in (logs / "year=2024" / "month=05" / f"day={day}").glob("part-*"):
                file.unlink()
        assert rows_of(result.tables["days"]) == [("2024", "05", "01", 1), ("2024", "05", "02", 1)]


def _plan_of_writes(spark, run, *arguments):
    """The plans of all results that a job wrote."""
    plans = []
    writer = type(spark.range(0).write)
    write = writer.parquet

    def noted(self, *a, **b):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, *a, **b)

    writer.parquet = noted
    try:
        run(spark, *arguments)
    finally:
        writer.parquet = write
    return plans


def test_attack_lines_are_classified_once_and_other_jobs_never(spark, done, tmp_path):
    logs = read_logs(spark, str(done["root"] / "logs"))
    for name, run in ANALYSES.items():
        plans = _plan_of_writes(spark, run, logs, str(tmp_path / name))
        assert sum("nikto" in plan for plan in plans) == (name == "attacks")
        assert sum("CollectMetrics" in plan for plan in plans) == 1


def test_results_that_were_never_stored_are_named(spark, done, tmp_path):
    logs = read_logs(spark, str(done["root"] / "logs"))
    run_reputation(spark, logs, str(tmp_path / "results"))
    loaded = load_serving(spark, str(tmp_path / "results"), str(tmp_path / "serving"))
    assert set(loaded.rows) == {"ip_reputation"} and "attack_patterns, threat_timeline" in loaded.advice
