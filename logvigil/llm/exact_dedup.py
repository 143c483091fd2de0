"""Exact deduplication of texts behind a two-pass Bloom filter, in DataFrame operations only."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.llm.common import az_lower, join_groups, stored, work_folder

BITS_PER_ROW = 16
#: Upper bound of the filter: 2^27 bits, which are at most 2^21 words of 16 bytes to broadcast.
MAX_BITS = 1 << 27
_WORD = 64


def _hashed(text: str, words: int) -> list:
    """Filter word of a text, and the mask of its three bits there.

    The hash is of the text in lower case. That joins more texts than the
    equality asked for, never fewer, so no equal texts are missed.
    """
    h = F.xxhash64(F.lower(F.coalesce(F.col(text), F.lit(""))))
    return [h.alias("h"), F.pmod(h, F.lit(words)).alias("word")]


def _bits() -> list:
    g = F.xxhash64(F.col("h"))
    return [F.shiftrightunsigned(g, s).bitwiseAND(F.lit(63)).cast("int") for s in (0, 6, 12)]


def repeated_bits(rows: DataFrame, words: int) -> DataFrame:
    """First pass: (word, mask) of all filter bits that two or more rows set.

    What is shuffled is a count per bit, combined in each task before; no text and no row.
    """
    cells = rows.select("word", F.explode(F.array_distinct(F.array(*_bits()))).alias("bit"))
    twice = cells.groupBy("word", "bit").agg(F.count("*").alias("n")).filter("n > 1")
    return twice.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A to Z. The row with the
    largest id stays. Pass one finds the bits of a Bloom filter that several rows
    set. In pass two a row whose three bits aren't all among them is
    unique for certain and passes straight through; only the others shuffle, as id
    and digest, and are grouped exactly. A filter that is too small for the input sends
    more rows to the shuffle and changes no result.

    NULL text counts as empty. A NULL id is the smallest. Of rows that repeat id and
    text, one stays. Other columns are ignored, whatever their names. No rows give no rows.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    folder = work_folder(docs.sparkSession)
    bits = min(max_bits, max(_WORD, BITS_PER_ROW * source.count()))
    words = 1 << max(0, math.ceil(math.log2(bits / _WORD)))
    bloom = stored(repeated_bits(source.select(*_hashed("text", words)), words), folder, "bloom")
    b = _bits()
    own = F.lit(0).cast("long")
    for bit in b:
        own = own.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    probed = (
        source.select(
            "doc_id",
            F.unhex(F.sha2(az_lower(F.col("text")).cast("binary"), 256)).alias("sha"),
            *_hashed("text", words),
        )
        .join(F.broadcast(bloom), "word", "left")
        .select(
            "doc_id",
            "sha",
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.col("mask").bitwiseAND(own) == own, F.lit(False)).alias("possible"),
        )
    )
    rows = stored(probed, folder, "rows")
    alone = rows.filter("NOT possible").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "sha",
    )
    maybe = rows.filter("possible").select("doc_id", "row", "sha")
    groups = maybe.groupBy("sha").agg(
        F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row")).alias("top")
    )
    checked = join_groups(maybe, groups, "sha", "group_size", "inner").select(
        "doc_id",
        F.col("top.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"),
        "sha",
    )
    return alone.unionByName(checked).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )
