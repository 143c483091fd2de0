"""The log table: column names, types and the values the operators compare with."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

# Column names, their order and types, and the label texts.
LOG_SCHEMA = StructType(
    [
        StructField("timestamp", StringType()),
        StructField("source_ip", StringType()),
        StructField("dest_ip", StringType()),
        StructField("protocol", StringType()),
        StructField("action", StringType()),
        StructField("threat_label", StringType()),
        StructField("log_type", StringType()),
        StructField("bytes_transferred", LongType()),
        StructField("user_agent", StringType()),
        StructField("request_path", StringType()),
    ]
)
BENIGN = "benign"
SUSPICIOUS = "suspicious"
MALICIOUS = "malicious"
THREAT_LABELS = (SUSPICIOUS, MALICIOUS)
TCP = "TCP"
DAY_COLUMNS = ("year", "month", "day")

# Year and month of lines that have none; their day is the id of their ingest.
REJECTED = "rejected"

# Kept as text, so that a folder named month=05 reads back as "05".
DAY_SCHEMA = StructType([StructField(name, StringType()) for name in DAY_COLUMNS])
