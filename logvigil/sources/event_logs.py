"""The log table as a view over the ``events`` test table (see FIXTURES.md)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.functions import ATTACK_SIGNATURES

_EVENT_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
_TIME_OF_LINE = """
  CASE WHEN event_id % 101 = 0 THEN 'not-a-time'
       WHEN event_id % 97 = 0 THEN NULL
       WHEN event_id % 2 = 0 THEN date_format({clock}, "yyyy-MM-dd'T'HH:mm:ss")
       ELSE date_format({clock}, 'yyyy-MM-dd HH:mm:ss') END"""
_PACKED_CLOCK = (
    "CAST('2024-05-01 00:00:00' AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, 0, event_id * 7)"
)

_LOG_COLUMNS = {
    "source_ip": """
  CASE WHEN event_id % 89 = 0 THEN NULL
       WHEN event_type IN ('click', 'view', 'error') AND event_id % 5 < 4
       THEN concat('10.0.0.', CAST(user_id % 5 AS STRING))
       ELSE concat('10.1.', CAST(CAST((user_id - user_id % 256) / 256 AS BIGINT) AS STRING),
                   '.', CAST(user_id % 256 AS STRING)) END""",
    "dest_ip": "concat('192.168.1.', CAST(event_id % 37 AS STRING))",
    "protocol": """
  CASE WHEN event_type IN ('click', 'view', 'error') THEN 'TCP'
       WHEN event_type = 'signup' THEN 'UDP' ELSE 'ICMP' END""",
    "action": "CASE WHEN event_id % 3 = 0 THEN 'blocked' ELSE 'allowed' END",
    "threat_label": """
  CASE WHEN event_id % 83 = 0 THEN NULL
       WHEN event_type = 'error' THEN 'malicious'
       WHEN event_type = 'signup' THEN 'suspicious' ELSE 'benign' END""",
    "log_type": "CASE event_id % 3 WHEN 0 THEN 'firewall' WHEN 1 THEN 'ids' ELSE 'application' END",
    "bytes_transferred": """
  CASE WHEN event_id % 79 = 0 THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END""",
    "user_agent": "concat('agent/', CAST(event_id % 10 AS STRING))",
    "request_path": """
  CASE event_id % 23
    WHEN 0 THEN '/index.html'
    WHEN 1 THEN concat('/login?user=admin', chr(39), ' OR 1=1')
    WHEN 2 THEN '/search?q=<SCRIPT>alert(1)</script>'
    WHEN 3 THEN '/../../etc/passwd'
    WHEN 4 THEN '/products/7'
    WHEN 5 THEN '/item.php?id=3'
    WHEN 6 THEN '/api/v1/health'
    WHEN 7 THEN '/q?x=<img src=x onerror=eval(1)>'
    WHEN 8 THEN '/a?b=union select x'
    WHEN 9 THEN concat('/q?a=', chr(34), '>, ', chr(34), '<iframe src=x>')
    WHEN 10 THEN '/nmap'
    WHEN 11 THEN NULL
    WHEN 12 THEN concat('/probe/', element_at(split(
      "{signatures}", ';'), CAST((event_id - 12) / 23 % 36 AS INT) + 1))
    ELSE concat('/static/', CAST(event_id AS STRING)) END""",
}


def _logs(spark: SparkSession, sf_dir: str, clock: str, where: str = "true") -> DataFrame:
    events = spark.read.schema(_EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet").filter(where)
    signatures = ";".join(needle for needles in ATTACK_SIGNATURES.values() for needle in needles)
    columns = {"timestamp": _TIME_OF_LINE.format(clock=clock)} | _LOG_COLUMNS
    columns["request_path"] = columns["request_path"].replace("{signatures}", signatures)
    return events.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def event_logs(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Log lines seven seconds apart, dense enough for scan windows; ``where`` is SQL over the events."""
    return _logs(spark, sf_dir, _PACKED_CLOCK, where)


def event_logs_by_day(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """The same lines at the times of the events, which cover many days."""
    return _logs(spark, sf_dir, "ts", where)
