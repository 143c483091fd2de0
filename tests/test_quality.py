from logvigil.operators.quality import CHECKS, distinct_labels, findings, quality_profile
from tests.lines import log_lines, rows_of

NAMES = [
    "total_rows",
    "threat_rows",
    "sized_rows",
    "path_rows",
    "attack_rows",
    "timed_rows",
    "tcp_rows",
    "scan_rows",
]


def test_profile(spark):
    changes = [{"dest_ip": f"t{n}"} for n in range(5)]
    changes += [
        {"threat_label": "malicious", "request_path": "/nmap", "protocol": "UDP"},
        {"threat_label": "suspicious", "request_path": None, "timestamp": "bad"},
        {"threat_label": None, "bytes_transferred": None},
        {"bytes_transferred": None, "protocol": None},
    ]
    profile = quality_profile(log_lines(spark, changes))
    assert profile.columns == NAMES
    assert rows_of(profile) == [(9, 2, 7, 8, 1, 8, 6, 1)]
    assert all(row["passed"] and row["advice"] is None for row in findings(profile).collect())


def test_findings_on_empty_input(spark):
    profile = quality_profile(log_lines(spark, [{}]).limit(0))
    assert rows_of(profile) == [(0,) * 8]
    got = {row["check"]: (row["passed"], row["advice"]) for row in findings(profile).collect()}
    assert got == {name: (False, advice) for name, advice in CHECKS.items()}


def test_labels(spark):
    lines = log_lines(spark, [{}, {}, {"threat_label": None}, {"threat_label": "x"}])
    assert rows_of(distinct_labels(lines)) == [("benign",), ("x",), (None,)]
