from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logvigil.operators.attacks import (
    attack_hits,
    attack_patterns,
    attack_samples,
    attack_totals,
    tag_attacks,
    top_per_type,
)
from logvigil.operators.quality import line_counts
from tests.lines import log_lines, rows_of


def test_tagging(spark):
    lines = log_lines(
        spark,
        [
            {"request_path": "/?A=' OR 1=1"},
            {"request_path": "/<IFRAME"},
            {"request_path": "/nmap"},
            {"request_path": "/plain"},
            {"request_path": None},
        ],
    )
    tagged = tag_attacks(lines)
    assert tagged.columns == [*lines.columns, "attack_type"]
    assert rows_of(tagged.select("request_path", "attack_type")) == [
        ("/<IFRAME", "XSS"),
        ("/?A=' OR 1=1", "SQLi"),
        ("/nmap", "Other"),
    ]
    assert rows_of(attack_totals(tagged)) == [("Other", 1), ("SQLi", 1), ("XSS", 1)]


def _busy_lines(spark):
    """One source with many hits and copies, some with few, one without an address."""
    changes = []
    for number in range(90):
        path = f"/nmap{number % 17:02d}" if number % 3 else "/nmap-copy" + "x" * 90
        changes.append({"request_path": path, "timestamp": f"2024-05-01 00:{number % 60:02d}:00"})
    changes += [{"source_ip": "10.0.0.2", "request_path": f"/nikto{n}"} for n in range(4)]
    changes += [{"source_ip": None, "request_path": "/nmap", "timestamp": "bad"}] * 7
    return log_lines(spark, changes), changes


def _expected_samples(changes):
    samples = defaultdict(Counter)
    for change in changes:
        samples[change.get("source_ip", "10.0.0.1")][change["request_path"][:80]] += 1
    return samples


def test_samples_hold_every_path_once_with_its_hits(spark):
    lines, changes = _busy_lines(spark)
    tagged = tag_attacks(lines)
    got = defaultdict(Counter)
    for row in attack_samples(tagged).collect():
        assert row["sample_path"] not in got[row["source_ip"]]
        got[row["source_ip"]][row["sample_path"]] = row["hits"]
    assert got == _expected_samples(changes)
    hits = {row["source_ip"]: row["hit_count"] for row in attack_patterns(tagged).collect()}
    assert {source: sum(samples.values()) for source, samples in got.items()} == hits
    assert all(len(row["sample_path"]) <= 9 for row in attack_samples(tagged, 9).collect())


def test_a_busy_source_has_the_layout_of_any_other(spark):
    """One source owns a third of the lines: one pattern row, one row per sample, no list."""
    changes = [{"source_ip": "busy", "request_path": f"/nmap{n % 700}"} for n in range(2000)]
    changes += [{"source_ip": f"10.1.{n % 40}.1", "request_path": f"/nmap{n % 9}"} for n in range(4000)]
    tagged = tag_attacks(log_lines(spark, changes))
    patterns, samples = attack_patterns(tagged), attack_samples(tagged)
    assert patterns.count() == patterns.select("attack_type", "source_ip").distinct().count() == 41
    assert samples.columns == ["attack_type", "source_ip", "sample_path", "hits", "last_seen"]
    assert samples.groupBy("source_ip").agg(F.sum("hits").alias("h")).filter("source_ip = 'busy'").first()["h"] == 2000
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (patterns, samples)]
    assert not any("Broadcast" in plan or "collect_list" in plan for plan in plans)


def test_ties_at_rank_fifty(spark):
    sources = [f"10.0.0.{n:03d}" for n in range(60)]
    changes = [{"source_ip": ip, "request_path": "/nmap"} for ip in [*sources, None]]
    changes += [{"source_ip": "z", "request_path": "/nmap"}] * 2
    top = top_per_type(attack_hits(tag_attacks(log_lines(spark, changes))))
    assert sorted(row["source_ip"] for row in top.collect()) == [*sources[:49], "z"]
    assert top.columns == ["attack_type", "source_ip", "hit_count", "last_seen"]


def test_totals_match_the_profile(spark, data_root):
    from logvigil.sources.event_logs import event_logs

    logs = event_logs(spark, f"{data_root}/sf0.01")
    totals = attack_totals(tag_attacks(logs)).agg(F.sum("hit_count")).first()[0]
    assert totals == line_counts(logs).first()["attack_rows"]
