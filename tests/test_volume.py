import math
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logvigil.operators.volume import (
    label_volume_of,
    protocol_volume_of,
    label_totals,
    quantiles,
    size_counts,
    size_parts,
    volume_by_label,
    volume_by_protocol,
)
from logvigil.schema import LOG_SCHEMA
from tests.lines import log_lines, rows_of


def _sizes(spark, sizes):
    return log_lines(spark, [{"bytes_transferred": size} for size in sizes])


@pytest.mark.parametrize(("n", "p95"), [(1, 1), (20, 19), (21, 20), (10_000, 9_500), (60_000, 57_000)])
def test_p95_of_one_to_n(spark, n, p95):
    columns = [
        (F.col("id") + 1 if field.name == "bytes_transferred" else F.lit("x"))
        .cast(field.dataType)
        .alias(field.name)
        for field in LOG_SCHEMA
    ]
    row = volume_by_label(spark.range(n).select(*columns)).first()
    assert (row["event_count"], row["max_bytes"], row["min_bytes"]) == (n, n, 1)
    assert row["p95_bytes"] == p95


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.integers(-5, 50),
            st.integers(-(2**40), 2**40),
            st.sampled_from([0, 3_000_000_000, 2**53 + 1, -(2**55)]),
        ),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([Decimal("0.95"), Decimal("0.5"), Decimal("0.1"), Decimal("1")]),
)
def test_quantile_is_exact(spark, sizes, quantile):
    row = volume_by_label(_sizes(spark, sizes), quantile).first()
    rank = math.ceil(quantile * len(sizes))
    assert row["p95_bytes"] == sorted(sizes)[rank - 1]
    assert row["total_bytes"] == sum(sizes)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_sum_beyond_a_long_is_an_error_in_both_modes(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for build in (volume_by_label, volume_by_protocol):
            with pytest.raises(Exception, match="more than a long"):
                build(_sizes(spark, [2**62] * 3)).collect()
            (row,) = build(_sizes(spark, [2**62, 2**62, -(2**62)])).collect()
            assert row["total_bytes"] == 2**62 and row["avg_bytes"] == round(2**62 / 3, 2)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_quantile_of_any_range(spark):
    sizes = [2**k for k in range(63)] + [-(2**63), 2**63 - 1, -1, 0] + [2**61 + k for k in range(40)]
    for quantile in (Decimal("0.95"), Decimal("0.5"), Decimal("0.01"), Decimal("1")):
        counts = size_counts(_sizes(spark, sizes))
        found = quantiles(counts, size_parts(counts), label_totals(size_parts(counts)), quantile)
        assert found.first()["low"] == sorted(sizes)[math.ceil(quantile * len(sizes)) - 1]


def test_switched_off_broadcasts_are_obeyed_and_a_label_is_dealt(spark):
    x = spark.range(1, 5001).select(F.lit("x").alias("threat_label"), F.col("id").alias("bytes_transferred"))
    few = spark.createDataFrame([("rare", 7), ("rare", 7)], x.schema)
    counts = x.unionByName(few).groupBy("threat_label", "bytes_transferred").agg(F.count("*").alias("lines"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = label_volume_of(counts)
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
        assert "hashpartitioning(threat_label" in plan and "dealt" in plan
        assert rows_of(result.select("threat_label", "event_count", "p95_bytes")) == [("rare", 2, 7), ("x", 5000, 4750)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_size_for_a_third_of_the_lines(spark):
    sizes = [7] * 100 + list(range(1000, 1200))
    assert volume_by_label(_sizes(spark, sizes)).first()["p95_bytes"] == sorted(sizes)[284]


def test_clean_filter_and_missing_protocol(spark):
    lines = log_lines(
        spark,
        [
            {"protocol": None, "bytes_transferred": 3_000_000_000},
            {"protocol": None, "bytes_transferred": 1},
            {"protocol": "UDP", "bytes_transferred": None},
            {"threat_label": None},
            {"threat_label": "other", "bytes_transferred": 1},
            {"threat_label": "other", "bytes_transferred": 0},
            {"threat_label": "other", "bytes_transferred": 0},
        ],
    )
    assert rows_of(volume_by_protocol(lines)) == [
        ("benign", None, 2, 3_000_000_001, 1_500_000_000.5),
        ("other", "TCP", 3, 1, 0.33),
    ]
    assert rows_of(volume_by_label(lines)) == [
        ("benign", 2, 3_000_000_001, 1_500_000_000.5, 3_000_000_000, 1, 3_000_000_000),
        ("other", 3, 1, 0.33, 1, 0, 1),
    ]


def test_results_from_kept_counts(spark, data_root):
    from logvigil.sources.event_logs import event_logs

    logs = event_logs(spark, f"{data_root}/sf0.001")
    counts = size_counts(logs, "protocol")
    assert rows_of(label_volume_of(counts)) == rows_of(volume_by_label(logs))
    assert rows_of(protocol_volume_of(counts)) == rows_of(volume_by_protocol(logs))


def test_protocols_add_up_to_labels(spark, data_root):
    from logvigil.sources.event_logs import event_logs

    logs = event_logs(spark, f"{data_root}/sf0.01")
    summed = (
        volume_by_protocol(logs)
        .groupBy("threat_label")
        .agg(F.sum("event_count").alias("event_count"), F.sum("total_bytes").alias("total_bytes"))
    )
    assert rows_of(summed) == rows_of(
        volume_by_label(logs).select("threat_label", "event_count", "total_bytes")
    )
