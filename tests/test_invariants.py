"""Results do not depend on partitions, join strategy or adaptive execution."""

import pytest
from pyspark.sql import functions as F

from logvigil.operators.attacks import (
    attack_hits,
    attack_patterns,
    attack_samples,
    tag_attacks,
    top_per_type,
)
from logvigil.operators.quality import quality_profile
from logvigil.operators.reputation import source_scores, top_sources
from logvigil.operators.scans import connection_windows, port_scans, scanner_summary
from logvigil.operators.serving import to_cells
from logvigil.operators.timeline import hourly_timeline
from logvigil.operators.volume import volume_by_label, volume_by_protocol
from logvigil.sources.event_logs import event_logs
from tests.lines import rows_of

OPERATORS = {
    "top sources": lambda logs: top_sources(source_scores(logs)),
    "volume": volume_by_label,
    "volume by protocol": volume_by_protocol,
    "patterns": lambda logs: attack_patterns(tag_attacks(logs)),
    "samples": lambda logs: attack_samples(tag_attacks(logs)),
    "top attackers": lambda logs: top_per_type(attack_hits(tag_attacks(logs))),
    "scans": lambda logs: port_scans(connection_windows(logs)),
    "scanners": lambda logs: scanner_summary(port_scans(connection_windows(logs))),
    "timeline": hourly_timeline,
    "cells": lambda logs: to_cells(hourly_timeline(logs), "threat_timeline"),
    "profile": quality_profile,
}


@pytest.fixture(scope="module")
def logs(spark, data_root):
    return event_logs(spark, f"{data_root}/sf0.001")


@pytest.fixture(scope="module")
def answers(logs):
    return {name: rows_of(operator(logs)) for name, operator in OPERATORS.items()}


@pytest.mark.parametrize("name", OPERATORS)
def test_partitions_do_not_matter(logs, answers, name):
    shuffled = logs.repartition(7).sortWithinPartitions(F.hash("request_path"))
    assert rows_of(OPERATORS[name](shuffled)) == answers[name]
    assert rows_of(OPERATORS[name](logs.coalesce(1))) == answers[name]


@pytest.mark.parametrize("name", OPERATORS)
def test_execution_settings_do_not_matter(spark, logs, answers, name):
    changes = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "3",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.session.timeZone": "America/New_York",
    }
    before = {key: spark.conf.get(key) for key in changes}
    for key, value in changes.items():
        spark.conf.set(key, value)
    try:
        assert rows_of(OPERATORS[name](logs)) == answers[name]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_large_volume_is_joined_without_broadcast(spark, logs, answers):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = volume_by_label(logs)
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
        assert rows_of(result) == answers["volume"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
