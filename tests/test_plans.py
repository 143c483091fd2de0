"""What the plans have to look like for large inputs."""

import re

import pytest
from pyspark.sql import functions as F

from logvigil.operators.attacks import (
    attack_hits,
    attack_patterns,
    attack_samples,
    tag_attacks,
    top_per_type,
)
from logvigil.operators.ingest import dated
from logvigil.operators.reputation import source_scores, top_sources
from logvigil.operators.scans import connection_windows
from logvigil.operators.serving import merge_cells
from logvigil.operators.timeline import hourly_timeline
from logvigil.operators.volume import volume_by_label, volume_by_protocol
from logvigil.plans.queries import QUERIES
from logvigil.sources import read_logs, write_days
from logvigil.sources.event_logs import event_logs
from tests.lines import log_lines


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    """A stored log table, as columnar files."""
    path = str(tmp_path_factory.mktemp("plans") / "logs")
    changes = [{"dest_ip": f"t{n}", "request_path": f"/nmap{n % 3}"} for n in range(40)]
    changes += [{"threat_label": "malicious", "bytes_transferred": n} for n in range(40)]
    log_lines(spark, changes).write.parquet(path)
    return spark.read.parquet(path)


def _plan(df):
    """The plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    """The plan as it ran."""
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def _read_columns(plan):
    return set(re.search(r"ReadSchema: struct<(.*)>", plan).group(1).split(","))


def _untruncated(spark, df):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return _plan(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_leaves_the_jvm_or_pairs_everything(spark, data_root, name):
    plan = _plan(QUERIES[name](spark, f"{data_root}/sf0.001"))
    for unwanted in ("Cartesian", "NestedLoop", "Python", "Pandas", "ExistingRDD"):
        assert unwanted not in plan


@pytest.mark.parametrize(
    ("build", "columns"),
    [
        (
            source_scores,
            {
                "timestamp:string",
                "source_ip:string",
                "protocol:string",
                "threat_label:string",
                "log_type:string",
            },
        ),
        (volume_by_label, {"threat_label:string", "bytes_transferred:bigint"}),
        (
            volume_by_protocol,
            {"protocol:string", "threat_label:string", "bytes_transferred:bigint"},
        ),
        (
            lambda logs: attack_hits(tag_attacks(logs)),
            {"timestamp:string", "source_ip:string", "request_path:string"},
        ),
        (
            connection_windows,
            {"timestamp:string", "source_ip:string", "dest_ip:string", "protocol:string"},
        ),
        (hourly_timeline, {"timestamp:string", "threat_label:string"}),
    ],
)
def test_only_the_needed_columns_are_read(spark, logs, build, columns):
    assert _read_columns(_untruncated(spark, build(logs))) == columns


def test_filters_reach_the_scan(spark, logs):
    assert "In(threat_label" in _untruncated(spark, source_scores(logs))
    assert "EqualTo(protocol,TCP)" in _untruncated(spark, connection_windows(logs))
    assert "IsNotNull(request_path)" in _untruncated(spark, tag_attacks(logs))
    volume = _untruncated(spark, volume_by_protocol(logs))
    assert "IsNotNull(threat_label), IsNotNull(bytes_transferred)" in volume


def test_costly_columns_are_computed_once(logs):
    attacks = _plan(tag_attacks(logs))
    assert attacks.count("lower(") == 1
    assert attacks.count("nikto") == 1
    assert _plan(connection_windows(logs)).count("regexp_extract") == 1
    assert _plan(hourly_timeline(logs)).count("regexp_extract") == 1


def test_scores_are_combined_before_each_shuffle(logs):
    plan = _plan(source_scores(logs))
    assert plan.count("Exchange") == 2
    assert "partial_count(1)" in plan.split("Exchange")[-1]
    assert "mode(" not in plan


def test_top_sources_are_not_fully_sorted(logs):
    plan = _plan(top_sources(source_scores(logs)))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_top_per_type_is_cut_before_the_shuffle(logs):
    before_shuffle = _plan(top_per_type(attack_hits(tag_attacks(logs)))).split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_distinct_targets_are_counted_in_two_steps(logs):
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(connection_windows(logs)))
    assert len(exchanges) == 2
    assert "dest_ip" in exchanges[1] and "dest_ip" not in exchanges[0]


@pytest.mark.parametrize(
    "build",
    [
        volume_by_label,
        lambda logs: attack_patterns(tag_attacks(logs)),
        lambda logs: attack_samples(tag_attacks(logs)),
    ],
)
def test_both_uses_of_the_counts_share_one_scan(logs, build):
    assert _final_plan(build(logs)).count("FileScan") == 1


def test_csv_logs_are_parsed_for_the_needed_columns_only(spark, tmp_path):
    write_days(dated(log_lines(spark, [{}])), str(tmp_path), "csv")
    plan = _untruncated(spark, hourly_timeline(read_logs(spark, str(tmp_path), "csv")))
    assert _read_columns(plan) == {"timestamp:string", "threat_label:string"}


def test_the_quantile_needs_no_sketch_of_a_whole_label(logs):
    plan = _plan(volume_by_label(logs))
    assert "ObjectHashAggregate" not in plan and "percentile" not in plan


def test_upsert_combines_before_its_one_shuffle(spark, logs):
    cells = spark.createDataFrame(
        [("a", "cf", "x", "1")], "row_key string, family string, qualifier string, value string"
    )
    plan = _plan(merge_cells(cells, cells.withColumn("value", F.lit("2"))))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_large_csv_files_are_split(spark, tmp_path):
    lines = "x" * 200 + "\n"
    (tmp_path / "logs.csv").write_text("timestamp\n" + lines * 5000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert read_logs(spark, str(tmp_path), "csv").rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sizes_move_once_however_small_the_broadcast_limit(spark, data_root):
    """Sizes of large labels are counted where they lie: only their parts and those of small labels are shuffled again."""
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "20480"}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        result = volume_by_label(event_logs(spark, f"{data_root}/sf0.1"))
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for key in limits:
            spark.conf.unset(key)
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert sum("bytes_transferred" in line for line in moves) == 1
