"""Key-value serving tables, as rows of (row_key, family, qualifier, value)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The column family, the key separator, and the key and cell
# columns of each table.
FAMILY = "cf"
KEY_SEPARATOR = "#"
SERVING_TABLES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "ip_reputation": (
        ("source_ip",),
        (
            "threat_score",
            "malicious_count",
            "suspicious_count",
            "total_events",
            "last_seen",
            "main_protocol",
            "log_source",
        ),
    ),
    "attack_patterns": (
        ("attack_type", "source_ip"),
        ("attack_type", "source_ip", "hit_count", "last_seen"),
    ),
    "threat_timeline": (
        ("hour_bucket",),
        ("malicious", "suspicious", "benign", "total"),
    ),
}
PEEK_ROWS = 3


def keyed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that have a value in each key column."""
    return rows.dropna(subset=list(keys))


def to_cells(rows: DataFrame, table: str) -> DataFrame:
    """One row per cell, values as text and NULL as ''. Rows without a key are left out."""
    keys, qualifiers = SERVING_TABLES[table]
    texts = keyed(rows, keys).select(
        F.concat_ws(KEY_SEPARATOR, *keys).alias("row_key"),
        F.lit(FAMILY).alias("family"),
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in qualifiers],
    )
    return texts.unpivot(["row_key", "family"], list(qualifiers), "qualifier", "value")


def unkeyed_rows(rows: DataFrame, table: str) -> DataFrame:
    """How many rows a serving table leaves out for want of a key."""
    keys, _ = SERVING_TABLES[table]
    missing = [F.col(name).isNull() for name in keys]
    return rows.agg(F.count_if(F.coalesce(*[F.when(gap, True) for gap in missing])).alias("rows"))


def merge_cells(old: DataFrame, new: DataFrame) -> DataFrame:
    """Puts the new cells over the old ones: same cell replaced, others kept.

    Each cell ends with one value. If it occurs several times on one side, the largest value counts.
    """
    cell = ["row_key", "family", "qualifier"]
    both = old.withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)))
    last = both.groupBy(*cell).agg(F.max(F.struct("is_new", "value"))["value"].alias("value"))
    return last


def peek(cells: DataFrame, n: int = PEEK_ROWS) -> DataFrame:
    """The first n row keys with their number of cells."""
    return (
        cells.groupBy("row_key")
        .agg(F.count("*").alias("cell_count"))
        .orderBy("row_key")
        .limit(n)
    )
