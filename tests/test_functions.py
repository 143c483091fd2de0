"""Time parsing, date keys and the classifier on edge cases."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logvigil.functions import (
    ATTACK_SIGNATURES,
    attack_type,
    date_key,
    hour_bucket,
    parse_timestamp,
    path_sample,
)

MAY_1 = dt.datetime(2024, 5, 1)
TIMES = [
    ("2024-05-01T00:00:00", MAY_1),
    ("2024-05-01 00:00:00", MAY_1),
    ("2024-05-01T00:00:00.123", MAY_1),
    ("2024-05-01T00:00:00Z", MAY_1),
    ("2024-5-1 0:0:0", MAY_1),
    (" 2024-05-01 00:00:00", MAY_1),
    ("2024-02-30T00:00:00", None),
    ("2024-13-01 00:00:00", None),
    ("2024-05-01 25:00:00", None),
    ("2024-05-01", None),
    ("bad", None),
    ("", None),
    (None, None),
]
DATES = [
    ("2024-05-01T00:00:00", "2024-05-01"),
    ("2024-05-01", "2024-05-01"),
    ("2024-05-01 ", "2024-05-01"),
    (" 2024-05-01 1:2:3", "2024-05-01"),
    ("2024-13-45 x", "2024-13-45"),
    ("2024-5-1T0", "2024-5-1"),
    ("bad", ""),
    ("", ""),
    ("2024-05-01garbage", ""),
    ("2024-05", ""),
    ("2024-05-01-07 00", ""),
    ("--", ""),
    (None, None),
]


def _texts(spark, texts):
    numbered = list(enumerate(texts))
    return spark.createDataFrame(numbered, "id int, text string").coalesce(1)


def _values(df, column):
    return [row["value"] for row in df.select("id", column.alias("value")).orderBy("id").collect()]


@pytest.fixture
def settings_of(spark):
    changed = {}

    def change(name, value):
        changed.setdefault(name, spark.conf.get(name))
        spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/New_York"])
@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("policy", ["LEGACY", "CORRECTED", "EXCEPTION"])
def test_timestamps_do_not_depend_on_the_session(spark, settings_of, zone, ansi, policy):
    settings_of("spark.sql.session.timeZone", zone)
    settings_of("spark.sql.ansi.enabled", ansi)
    settings_of("spark.sql.legacy.timeParserPolicy", policy)
    df = _texts(spark, [text for text, _ in TIMES])
    assert _values(df, parse_timestamp(F.col("text"))) == [time for _, time in TIMES]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_hour_bucket_keeps_hours_a_zone_skips(spark, settings_of, zone):
    settings_of("spark.sql.session.timeZone", zone)
    df = _texts(spark, ["2024-03-31T02:30:00", "2024-05-01 23:59:59", "bad"])
    buckets = _values(df, hour_bucket(parse_timestamp(F.col("text"))))
    assert buckets == ["2024-03-31-02", "2024-05-01-23", None]


def test_date_keys(spark):
    df = _texts(spark, [text for text, _ in DATES])
    assert _values(df, date_key(F.col("text"))) == [key for _, key in DATES]


def _expected_time(text):
    found = re.match(r"\s*(\d{4})-(\d{1,2})-(\d{1,2})[T ](\d{1,2}):(\d{1,2}):(\d{1,2})", text, re.A)
    try:
        return dt.datetime(*map(int, found.groups())) if found else None
    except ValueError:
        return None


def _expected_date(text):
    first = text.strip(" ").replace("T", " ").split(" ")[0].split("-")
    usable = len(first) == 3 and all(part.isdigit() for part in first)
    return "-".join(first) if usable else ""


USUAL_TIME = r"[12][0-9]{3}-[01]?[0-9]-[0-3]?[0-9][T ][0-2]?[0-9]:[0-9]{1,2}:[0-9]{1,2}[ -~]{0,3}"


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text("0129-T :.Z+", max_size=24),
            st.from_regex(USUAL_TIME, fullmatch=True),
        ),
        min_size=50,
        max_size=50,
    )
)
def test_random_texts(spark, texts):
    df = _texts(spark, texts)
    assert _values(df, parse_timestamp(F.col("text"))) == list(map(_expected_time, texts))
    assert _values(df, date_key(F.col("text"))) == list(map(_expected_date, texts))


def test_each_signature_alone(spark):
    cases = [(needle, name) for name, needles in ATTACK_SIGNATURES.items() for needle in needles]
    assert len(cases) == 36
    df = _texts(spark, [f"/a{needle}z" for needle, _ in cases])
    assert _values(df, attack_type(F.col("text"))) == [name for _, name in cases]
    upper = _texts(spark, [f"/A{needle.upper()}Z" for needle, _ in cases])
    assert _values(upper, attack_type(F.col("text"))) == [name for _, name in cases]


def test_classifier_priority_and_misses(spark):
    cases = [
        ("/q?<script>1=1", "SQLi"),
        ("/../<script>", "XSS"),
        ("/..%2f", None),
        ("%27%20or%20", None),
        ("/wget/x", None),
        ("/x' or", None),
        ("", None),
        (None, None),
    ]
    df = _texts(spark, [text for text, _ in cases])
    assert _values(df, attack_type(F.col("text"))) == [name for _, name in cases]


def test_own_signatures(spark):
    df = _texts(spark, ["/x?A", "/y", "/xb"])
    found = attack_type(F.col("text"), {"first": ["?A"], "second": ["xb", "b"], "none": []})
    assert _values(df, found) == ["first", None, "second"]


def test_path_sample(spark):
    df = _texts(spark, ["x" * 81, "é" * 90, "short", None])
    assert _values(df, path_sample(F.col("text"))) == ["x" * 80, "é" * 80, "short", None]
