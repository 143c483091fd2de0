"""Row order of the reports, which the comparison with SQL leaves out."""

import duckdb
import pytest

from logvigil.operators.reports import PREVIEW_ROWS, preview, report
from logvigil.plans.oracle import ORACLE_SQL
from logvigil.plans.queries import QUERIES

IN_ORDER = [
    "attack_patterns",
    "attack_preview",
    "port_scan_summary",
    "port_scans",
    "port_scans_preview",
    "request_path_preview",
    "serving_peek",
    "threat_timeline",
    "threat_volume",
    "threat_volume_by_protocol",
]


@pytest.mark.parametrize("name", IN_ORDER)
def test_rows_come_in_the_order_of_the_sql(spark, data_root, name):
    connection = duckdb.connect()
    folder = f"{data_root}/sf0.01"
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    answer = connection.execute(ORACLE_SQL[name])
    columns = [column[0] for column in answer.description]
    got = [tuple(row[column] for column in columns) for row in QUERIES[name](spark, folder).collect()]
    assert got == answer.fetchall()


def test_orders_with_missing_values(spark):
    rows = [("b", None, 1), ("a", 5, 1), ("a", None, 1), ("a", 7, 1), (None, 9, 1)]
    result = spark.createDataFrame(rows, "attack_type string, hit_count long, source_ip long")
    assert [tuple(row)[:2] for row in report(result, "attack_patterns").collect()] == [
        ("a", 7),
        ("a", 5),
        ("a", None),
        ("b", None),
        (None, 9),
    ]


def test_preview_lengths(spark):
    paths = spark.range(100).selectExpr("lpad(id, 3, '0') AS request_path")
    got = [row[0] for row in preview(paths, "request_paths").collect()]
    assert got == [f"{number:03d}" for number in range(10)]
    assert preview(paths, "request_paths", 3).count() == 3
    assert sorted(PREVIEW_ROWS.values()) == [10, 10, 20, 30, 40]
