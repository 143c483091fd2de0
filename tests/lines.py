"""Small log tables for tests."""

from logvigil.schema import LOG_SCHEMA

NAMES = LOG_SCHEMA.fieldNames()
USUAL = {
    "timestamp": "2024-05-01 00:00:00",
    "source_ip": "10.0.0.1",
    "dest_ip": "192.168.1.1",
    "protocol": "TCP",
    "action": "allowed",
    "threat_label": "benign",
    "log_type": "ids",
    "bytes_transferred": 10,
    "user_agent": "agent",
    "request_path": "/",
}


def log_lines(spark, changes, partitions=3):
    """One usual line per entry, with the given columns changed."""
    rows = [tuple((USUAL | change)[name] for name in NAMES) for change in changes]
    return spark.createDataFrame(rows, LOG_SCHEMA).repartition(partitions)


def rows_of(df):
    """Rows as tuples, sorted, None last."""
    rows = [tuple(row) for row in df.collect()]
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])
