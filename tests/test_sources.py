import csv
import io
import random

import pytest

from logvigil.operators.ingest import dated, day_inventory, ingest_summary, rejected
from logvigil.schema import LOG_SCHEMA
from logvigil.sources import (
    raw_files,
    read_logs,
    read_raw_csv,
    read_result,
    saved_rows,
    scratch_dir,
    write_days,
    write_result,
)
from logvigil.sources.event_logs import event_logs
from tests.lines import NAMES, USUAL, log_lines, rows_of

PATHS = [
    '/"><script>',
    'a,"b",c',
    "two\nlines",
    "two\r\nlines",
    "  outer blanks ' or ",
    '"',
    '""',
    'ends with "',
    "back\\slash\\",
    'back\\"slash quote',
    "#no comment",
    "tab\there",
    "é漢字🙂",
    "' --",
    ",",
    None,
]


def _csv_text(rows, names=NAMES):
    text = io.StringIO(newline="")
    writer = csv.DictWriter(text, names)
    writer.writeheader()
    writer.writerows(rows)
    return text.getvalue()


def _raw_file(folder, name, rows, names=NAMES):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(_csv_text(rows, names), encoding="utf-8", newline="")
    return str(folder)


def test_raw_lines_reach_the_logs_unchanged(spark, tmp_path):
    rows = [
        USUAL | {"request_path": path, "bytes_transferred": 3_000_000_000 + n}
        for n, path in enumerate(PATHS)
    ]
    folder = _raw_file(tmp_path / "raw", "a.csv", rows)
    raw = read_raw_csv(spark, folder, line_end="\r\n")
    write_days(dated(raw), str(tmp_path / "logs"))
    logs = read_logs(spark, str(tmp_path / "logs"))
    got = {row["bytes_transferred"] - 3_000_000_000: row["request_path"] for row in logs.collect()}
    assert got == dict(enumerate(PATHS))
    assert rows_of(logs.select("year", "month", "day").distinct()) == [("2024", "05", "01")]


def test_kinds_of_files_are_told_apart(spark, tmp_path):
    plain = [USUAL | {"request_path": path} for path in ('a "quoted" path', "b,c")]
    folder = _raw_file(tmp_path / "raw", "plain 50%.csv", plain)
    assert [found for _, found, _ in raw_files(spark, folder)] == [False]
    assert read_raw_csv(spark, folder).count() == 2
    _raw_file(tmp_path / "raw", "broken 1.csv", [USUAL | {"request_path": "x\ny"}])
    found = [file for _, found, files in raw_files(spark, folder) for file in files if found]
    assert len(found) == 1 and "broken" in found[0]
    mixed = read_raw_csv(spark, folder)
    paths = [row["request_path"] for row in mixed.collect()]
    assert sorted(paths) == ['a "quoted" path', "b,c", "x\ny"]
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "broken" not in plan.split("FileScan csv")[1].split("\n")[0]
    whole = read_raw_csv(spark, str(tmp_path / "raw" / "broken*"))
    assert [row["request_path"] for row in whole.collect()] == ["x\ny"]


@pytest.mark.parametrize("block", [64, 700, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_with_newlines_are_read_by_many_tasks(spark, tmp_path, block, end):
    """Whatever the block borders cut: equal to reading each file whole by one task."""
    rng = random.Random(block)
    pieces = ["a", '"', "\n", ",", "é", " ", "x" * 30, '""', "\n\n"]
    rows = [
        {"timestamp": f"2024-05-01 {n}", "note": "".join(rng.choices(pieces, k=rng.randrange(9))), "more": str(n)}
        for n in range(300)
    ]
    folder = tmp_path / "raw"
    folder.mkdir()
    for part in range(3):
        text = _csv_text(rows[part::3], ["timestamp", "note", "more"]).replace("\r\n", end)
        (folder / f"{part}.csv").write_text(text, encoding="utf-8", newline="")
    keys = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "16"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        raw = read_raw_csv(spark, str(folder), line_end=end)
        got = rows_of(raw)
        tasks = spark.read.text(str(folder)).rdd.getNumPartitions()
    finally:
        for key in keys:
            spark.conf.unset(key)
    whole = spark.read.options(header=True, escape='"', multiLine=True, lineSep=end).schema(raw.schema).csv(str(folder))
    assert got == rows_of(whole) and len(got) == 300
    assert {row[1] or "" for row in got} == {row["note"] for row in rows}
    assert block > 700 or tasks > 10


def test_a_mismatch_is_an_error_where_headers_are_said_to_be_alike(spark, tmp_path):
    folder = _raw_file(tmp_path / "raw", "a.csv", [USUAL])
    _raw_file(tmp_path / "raw", "b.csv", [USUAL], list(reversed(NAMES)))
    with pytest.raises(Exception, match="header|CSV"):
        read_raw_csv(spark, folder, quoted_newlines=False).collect()
    assert rows_of(read_raw_csv(spark, folder)) == rows_of(read_raw_csv(spark, folder).limit(1).union(read_raw_csv(spark, folder).limit(1)))


def test_raw_columns_keep_the_order_of_the_header(spark, tmp_path):
    names = ["request_path", "timestamp", "extra"]
    rows = [{"request_path": "/", "timestamp": "2024-05-01", "extra": "1"}]
    raw = read_raw_csv(spark, _raw_file(tmp_path / "raw", "a.csv", rows, names))
    assert raw.columns == names
    assert dated(raw).columns == [*names, "year", "month", "day"]


def test_short_rows_and_empty_fields(spark, tmp_path):
    text = ",".join(NAMES) + "\n2024-05-01,1.1.1.1\n2024-05-01,,,,,,,,,\n"
    (tmp_path / "a.csv").write_text(text)
    raw = read_raw_csv(spark, str(tmp_path / "a.csv"))
    rows = [tuple(row) for row in dated(raw).collect()]
    day = ("2024", "05", "01")
    assert sorted(rows, key=lambda row: row[1] is None) == [
        ("2024-05-01", "1.1.1.1", *[None] * 8, *day),
        ("2024-05-01", *[None] * 9, *day),
    ]


def test_rejects_and_summary(spark):
    times = ["2024-05-01", "2024-05-01T1", "2024-05-02 0", "2024-5-2", "bad", "bad", "", None]
    raw = log_lines(spark, [{"timestamp": time} for time in times])
    assert rows_of(day_inventory(dated(raw))) == [
        ("2024", "05", "01", 2),
        ("2024", "05", "02", 1),
        ("2024", "5", "2", 1),
    ]
    assert rows_of(rejected(raw).select("timestamp")) == [("",), ("bad",), ("bad",), (None,)]
    assert rejected(raw).columns == raw.columns
    assert rows_of(ingest_summary(raw)) == [(8, 4, 4, 3)]
    assert rows_of(ingest_summary(raw.limit(0))) == [(0, 0, 0, 0)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_only_days_in_the_input_are_replaced(spark, tmp_path, fmt):
    root = str(tmp_path / "logs")

    def write(changes):
        write_days(dated(log_lines(spark, changes)), root, fmt)

    def stored():
        return rows_of(read_logs(spark, root, fmt).select("timestamp", "source_ip", "day"))

    write([{"timestamp": "2024-05-01"}] * 3 + [{"timestamp": "2024-05-02"}])
    write([{"timestamp": "2024-05-02", "source_ip": "new"}, {"timestamp": "2024-05-03"}])
    assert stored() == [
        *[("2024-05-01", "10.0.0.1", "01")] * 3,
        ("2024-05-02", "new", "02"),
        ("2024-05-03", "10.0.0.1", "03"),
    ]
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert mode.lower() == "static"


def test_day_files_stay_small(spark, tmp_path):
    lines = log_lines(spark, [{"timestamp": "2024-05-01"}] * 100, partitions=8)
    write_days(dated(lines), str(tmp_path / "logs"), rows_per_file=30)
    files = list((tmp_path / "logs" / "year=2024" / "month=05" / "day=01").glob("*.parquet"))
    assert len(files) == 4
    assert read_logs(spark, str(tmp_path / "logs")).count() == 100


def test_a_large_day_is_written_by_several_tasks(spark, data_root, tmp_path):
    lines = dated(event_logs(spark, f"{data_root}/sf0.01").repartition(8))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "20000")
    try:
        write_days(lines, str(tmp_path / "logs"))
    finally:
        spark.conf.unset(key)
    files = list((tmp_path / "logs").glob("*/*/*/*.parquet"))
    assert len(files) > 2
    assert rows_of(read_logs(spark, str(tmp_path / "logs"))) == rows_of(lines)


def test_input_in_time_order_is_written_without_a_shuffle(spark, tmp_path):
    lines = log_lines(spark, [{"timestamp": f"2024-05-{1 + n // 20:02d}"} for n in range(60)], 1)
    for in_time_order in (False, True):
        root = str(tmp_path / f"logs-{in_time_order}")
        write_days(dated(lines), root, in_time_order=in_time_order)
        assert rows_of(day_inventory(read_logs(spark, root))) == [
            ("2024", "05", f"{day:02d}", 20) for day in (1, 2, 3)
        ]


def test_other_days_are_not_read(spark, tmp_path):
    lines = log_lines(spark, [{"timestamp": f"2024-05-{day:02d}"} for day in range(1, 10)])
    write_days(dated(lines), str(tmp_path / "logs"))
    one_day = read_logs(spark, str(tmp_path / "logs")).filter("month = '05' AND day = '03'")
    assert one_day.count() == 1
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "(month#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len({row[0] for row in one_day.select("_metadata.file_path").collect()}) == 1


def test_log_schema(spark, tmp_path):
    write_days(dated(log_lines(spark, [{}])), str(tmp_path / "logs"))
    logs = read_logs(spark, str(tmp_path / "logs"))
    assert logs.columns == [*NAMES, "year", "month", "day"]
    assert logs.schema.fields[:10] == LOG_SCHEMA.fields
    assert dict(logs.dtypes)["bytes_transferred"] == "bigint"


def test_results_are_replaced(spark, tmp_path):
    path = str(tmp_path / "result")
    write_result(spark.range(5), path)
    write_result(spark.range(3), path)
    assert saved_rows(spark, path) == 3
    assert rows_of(read_result(spark, path)) == [(0,), (1,), (2,)]


def test_scratch_folders(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first != second
    assert first.startswith(shared + "/") and second.startswith(shared + "/")


def test_a_cluster_needs_a_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster)
