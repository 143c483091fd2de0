"""Removal of repeated passages by overlapping windows of three lines."""

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.llm.common import byte_texts, join_groups, slices, stored, work_folder

WINDOW = 3
_BLANK = b" \t\r\x0b\x0c"


def lines_of(text: bytes) -> list[tuple[int, bytes]]:
    """Position and stripped text of each line that isn't blank."""
    return [(i, x) for i, line in enumerate(text.split(b"\n")) if (x := line.strip(_BLANK))]


def windows_of(text: bytes, window: int) -> list[tuple[int, int, bytes]]:
    """First line, last line and 16-byte hash of each window of consecutive lines."""
    lines = lines_of(text)
    return [
        (
            lines[i][0],
            lines[i + window - 1][0],
            hashlib.blake2b(b"\n".join(x for _, x in lines[i : i + window]), digest_size=16).digest(),
        )
        for i in range(len(lines) - window + 1)
    ]


def removed_lines(n_lines: int, spans: list[tuple[int, int]]) -> list[int]:
    """The lines of spans (first, last), merged."""
    lines, end = [], -1
    for a, b in sorted(spans):
        lines += range(max(a, end + 1), min(b, n_lines - 1) + 1)
        end = max(end, b)
    return lines


def _emit_windows(window: int):
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("hash", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrow in slices(batches, "text"):
            found = [
                (row, doc_id, *w)
                for row, doc_id, text in zip(
                    arrow.column("row").to_pylist(), arrow.column("doc_id").to_pylist(), byte_texts(arrow.column("text"))
                )
                for w in windows_of(text, window)
            ]
            if found:
                columns = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    return run


def _cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """Cuts lines out of the texts that have windows; the others come in and go out as NULL."""
    left, removed = [], []
    for text, found in zip(texts, spans):
        if text is None:
            left.append(None)
            removed.append(None)
            continue
        lines = text.split("\n")
        gone = removed_lines(len(lines), [(s["first"], s["last"]) for s in found])
        drop = set(gone)
        left.append("\n".join(x for i, x in enumerate(lines) if i not in drop))
        removed.append(gone)
    return pd.DataFrame({"text": left, "removed": removed})


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per document: doc (all its columns), text (what is left), n_lines, removed (line numbers).

    Every window of three consecutive lines that aren't blank is hashed, stripped of
    outer blanks. A window that occurs again, in another text or further down, counts as first where it
    occurs first, by document id and then line; the lines that later occurrences cover are
    merged and removed, with blank lines between them. Every line removed so has an earlier copy, in an earlier text or further up.
    Where a later occurrence overlaps the first one of the same window in one text, as in a run of equal lines, the lines of the first stay.

    NULL text counts as empty and comes back empty. Texts of fewer lines than a window
    have no window and stay whole. A NULL id is the smallest; ties between rows of the same id
    go to one row. Other columns are carried inside ``doc``, so no name clashes.
    """
    spark = docs.sparkSession
    folder = work_folder(spark)
    kept = stored(
        docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")),
        folder,
        "docs",
    )
    texts = kept.select(
        "row",
        F.col(f"doc.{id_col}").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"doc.{text_col}").cast("string"), F.lit("")).alias("text"),
    )
    windows = stored(
        texts.mapInArrow(
            _emit_windows(window), "row long, doc_id long, first int, last int, hash binary"
        ),
        folder,
        "windows",
    )
    groups = (
        windows.groupBy("hash")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row", "first", "last")).alias("top"))
        .filter("n > 1")
    )
    same_text = F.col("row") == F.col("top.row")
    from_line = F.when(same_text, F.greatest("first", F.col("top.last") + 1)).otherwise(F.col("first"))
    later = join_groups(windows, stored(groups, folder, "groups"), "hash", "n", "inner").filter(
        ~(same_text & (F.col("first") == F.col("top.first")))
    )
    spans = later.groupBy("row").agg(F.collect_list(F.struct(from_line.alias("first"), "last")).alias("_spans"))
    text = F.coalesce(F.col(f"doc.{text_col}").cast("string"), F.lit(""))
    # The spans grow with the input, so they are never broadcast: the plan is the same at every size.
    joined = kept.join(stored(spans, folder, "spans").hint("merge"), "row", "left").withColumn(
        "_cut", F.pandas_udf(_cut, "text string, removed array<int>")(F.when(F.col("_spans").isNotNull(), text), F.col("_spans"))
    )
    return joined.select(
        "doc",
        F.coalesce("_cut.text", text).alias("text"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.coalesce("_cut.removed", F.array().cast("array<int>")).alias("removed"),
    )
