"""Sort orders and preview lengths of the results.

Results are computed and stored unsorted. A report sorts one, and a preview
keeps its first rows, which Spark takes without a full sort.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The leading sort columns and the preview lengths. The trailing
# columns settle ties, so that a preview has one answer.
REPORT_ORDER: dict[str, tuple[str, ...]] = {
    "threat_volume": ("threat_label asc",),
    "threat_volume_by_protocol": ("threat_label asc", "total_bytes desc", "protocol asc"),
    "attack_totals": ("hit_count desc", "attack_type asc"),
    "attack_patterns": ("attack_type asc", "hit_count desc", "source_ip asc"),
    "port_scans": ("distinct_targets desc", "source_ip asc", "window_start asc"),
    "port_scan_summary": ("scan_windows desc", "source_ip asc"),
    "protocol_distribution": ("event_count desc", "protocol asc"),
    "threat_timeline": ("hour_bucket asc",),
    "request_paths": ("request_path asc",),
}
PREVIEW_ROWS: dict[str, int] = {
    "threat_volume_by_protocol": 40,
    "attack_patterns": 30,
    "port_scans": 20,
    "port_scan_summary": 10,
    "request_paths": 10,
}


def report(result: DataFrame, name: str) -> DataFrame:
    """The whole result in its report order."""
    columns = (text.split() for text in REPORT_ORDER[name])
    return result.orderBy(
        *[
            F.col(column).desc_nulls_last() if way == "desc" else F.col(column).asc_nulls_last()
            for column, way in columns
        ]
    )


def preview(result: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """The first rows of the report."""
    return report(result, name).limit(PREVIEW_ROWS[name] if rows is None else rows)
