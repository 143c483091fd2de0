"""Bytes transferred per threat label and protocol."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the reported quantile.
QUANTILE = Decimal("0.95")

# Labels with more than one in LARGE of all distinct sizes are searched by histograms.
LARGE = 4096
# Parts that the sizes of a label are dealt over where broadcasts are switched off.
DEALT = 256
# Bits of a size that each step of the quantile search settles, and those below them: at most four million parts.
STEPS = ((22, 42), (21, 21), (21, 0))
_LOW = (1 << 32) - 1


def sized(logs: DataFrame) -> DataFrame:
    """Lines with a threat label and a byte count."""
    return logs.filter(F.col("threat_label").isNotNull() & F.col("bytes_transferred").isNotNull())


def _sums(size: Column, lines: Column) -> list[Column]:
    """Two sums that give the exact total of ``lines`` times ``size``: of the upper and lower 32 bits.

    They are decimals of 38 digits, so neither wraps, whatever the sizes and with ANSI mode on or off.
    """
    size, lines = size.cast("long"), lines.cast("decimal(19,0)")
    low = size.bitwiseAND(F.lit(_LOW).cast("long"))
    return [
        F.sum(F.shiftright(size, 32).cast("decimal(10,0)") * lines).alias("_high"),
        F.sum(low.cast("decimal(10,0)") * lines).alias("_low"),
    ]


def _total_and_average(rows: DataFrame) -> DataFrame:
    """Adds total_bytes and avg_bytes from the two sums. A total beyond a long is an error in any mode."""
    high = F.col("_high").cast("decimal(27,0)")
    total = (high * F.lit(1 << 32).cast("decimal(10,0)") + F.col("_low").cast("decimal(36,0)")).cast("decimal(38,0)")
    fits = total.between(F.lit(-(1 << 63)).cast("decimal(20,0)"), F.lit((1 << 63) - 1).cast("decimal(20,0)"))
    failed = F.raise_error(F.lit("the bytes of a label add up to more than a long")).cast("long")
    return rows.withColumn("_total", total).select(
        *[c for c in rows.columns if c not in ("_high", "_low")],
        F.when(fits, F.col("_total").cast("long")).otherwise(failed).alias("total_bytes"),
        F.round(F.col("_total").cast("double") / F.col("event_count"), 2).alias("avg_bytes"),
    )


def size_counts(logs: DataFrame, *by: str) -> DataFrame:
    """Lines per threat label and distinct size, and per further column if wanted.

    Both volume results can be had from the counts by protocol, so a job that
    needs both reads the logs once and keeps the counts instead of the lines.
    """
    return (
        sized(logs)
        .groupBy("threat_label", *by, "bytes_transferred")
        .agg(F.count("*").alias("lines"))
    )


def volume_by_label(logs: DataFrame, quantile: Decimal = QUANTILE) -> DataFrame:
    """Count, sum, mean, extremes and exact quantile of the bytes, per threat label."""
    return label_volume(size_counts(logs), quantile)


def label_volume_of(counts: DataFrame, quantile: Decimal = QUANTILE) -> DataFrame:
    """The same from counts that are split by further columns."""
    per_size = counts.groupBy("threat_label", "bytes_transferred")
    return label_volume(per_size.agg(F.sum("lines").alias("lines")), quantile)


def _place() -> Column:
    """A size without sign, as the distance from the smallest long."""
    return F.col("bytes_transferred").cast("long").bitwiseXOR(_smallest())


def _smallest() -> Column:
    return F.lit(-(1 << 63)).cast("long")


def _part(bits: int, shift: int) -> Column:
    return F.shiftrightunsigned(_place(), shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def size_parts(sizes: DataFrame) -> DataFrame:
    """Lines, sizes and their totals per label and part of the first step, in one pass over the sizes."""
    return sizes.groupBy("threat_label", _part(*STEPS[0]).alias("part")).agg(
        F.sum("lines").alias("lines"),
        F.count("*").alias("sizes"),
        F.max("bytes_transferred").alias("max_bytes"),
        F.min("bytes_transferred").alias("min_bytes"),
        *_sums(F.col("bytes_transferred"), F.col("lines")),
    )


def label_totals(parts: DataFrame) -> DataFrame:
    """Totals per label from those of its parts."""
    return _total_and_average(
        parts.groupBy("threat_label").agg(
            F.sum("lines").alias("event_count"),
            F.sum("sizes").alias("sizes"),
            F.max("max_bytes").alias("max_bytes"),
            F.min("min_bytes").alias("min_bytes"),
            *[F.sum(name).cast("decimal(38,0)").alias(name) for name in ("_high", "_low")],
        )
    )


def label_volume(sizes: DataFrame, quantile: Decimal) -> DataFrame:
    """Volume per label from its lines per distinct size.

    The quantile is the smallest size that at least that share of the lines does not exceed.
    """
    parts = size_parts(sizes)
    totals = label_totals(parts)
    found = quantiles(sizes, parts, totals, quantile).select("threat_label", F.col("low").alias("p95_bytes"))
    return totals.join(found, "threat_label").select(
        "threat_label", "event_count", "total_bytes", "avg_bytes", "max_bytes", "min_bytes", "p95_bytes"
    )


def quantiles(sizes: DataFrame, parts: DataFrame, totals: DataFrame, quantile: Decimal) -> DataFrame:
    """(threat_label, low): the exact quantile of each label from its lines per distinct size.

    Labels with more than one in LARGE of all sizes are fewer than LARGE by arithmetic, so what is known of them is broadcast (unless
    the session switches broadcasts off) and their sizes are counted where they lie. Those of all other labels move once, to be ranked label by label; none has more
    than that share.
    """
    ranked = totals.select(
        "threat_label", "sizes", F.ceil(F.lit(quantile) * F.col("event_count")).cast("long").alias("rank")
    )
    marked = ranked.withColumn("large", F.col("sizes") * LARGE > totals.agg(F.sum("sizes")).scalar())
    large = marked.filter("large").select("threat_label", "rank")
    placed = _join_few(sizes, large.withColumn("large", F.lit(True)), "bytes_transferred", "left")
    ranks = marked.filter("NOT large").select("threat_label", "rank")
    small = _ranked(placed.filter("large IS NULL").drop("large", "rank"), ranks)
    return small.unionByName(_histograms(sizes, parts.select("threat_label", "part", "lines"), large))


def _join_few(rows: DataFrame, few: DataFrame, deal_by: str, how: str = "inner") -> DataFrame:
    """Joins rows with what is known of the large labels, which is broadcast, so that the rows don't move.

    A session that switches broadcasts off, the adaptive ones too, gets a sort-merge join. In it the rows of a label are
    dealt over DEALT parts by ``deal_by``, so that they don't all go to one task.
    """
    conf, limit = rows.sparkSession.conf, "autoBroadcastJoinThreshold"
    limits = conf.get(f"spark.sql.{limit}"), conf.get(f"spark.sql.adaptive.{limit}", "-1")
    if not all(value.startswith("-") for value in limits):
        return rows.join(F.broadcast(few), "threat_label", how)
    copies = few.withColumn("dealt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEALT - 1).cast("long"))))
    dealt = rows.withColumn("dealt", F.pmod(F.xxhash64(deal_by), F.lit(DEALT).cast("long")))
    return dealt.join(copies, ["threat_label", "dealt"], how).drop("dealt")


def _up_to(order: str) -> Column:
    window = Window.partitionBy("threat_label").orderBy(order)
    return F.sum("lines").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _holds_rank() -> Column:
    return (F.col("up_to") >= F.col("rank")) & (F.col("up_to") - F.col("lines") < F.col("rank"))


def _ranked(sizes: DataFrame, ranks: DataFrame) -> DataFrame:
    """The quantile by the running number of lines."""
    running = sizes.withColumn("up_to", _up_to("bytes_transferred")).join(ranks, "threat_label")
    return running.filter(_holds_rank()).select("threat_label", F.col("bytes_transferred").alias("low"))


def _histograms(sizes: DataFrame, parts: DataFrame, ranks: DataFrame) -> DataFrame:
    """The quantile of at most LARGE labels by nested histograms, whatever the range.

    A step cuts the range that still holds the quantile into equal parts, counts the lines per
    part, and goes on in the part where the rank falls. The steps narrow the range of a long to one size, and
    no task ever sees more than the parts of a step.
    """
    zero = F.lit(0).cast("long").alias("low")
    counts, found = _join_few(parts, ranks, "part").select("*", zero), None
    for bits, shift in STEPS:
        if found is not None:
            above = bits + shift
            counts = (
                _join_few(sizes, found, "bytes_transferred")
                .filter(F.shiftrightunsigned(_place(), above) == F.shiftrightunsigned("low", above))
                .groupBy("threat_label", "low", "rank", _part(bits, shift).alias("part"))
                .agg(F.sum("lines").alias("lines"))
            )
        found = (
            counts.withColumn("up_to", _up_to("part"))
            .filter(_holds_rank())
            .select(
                "threat_label",
                (F.col("rank") - (F.col("up_to") - F.col("lines"))).alias("rank"),
                F.col("low").bitwiseOR(F.shiftleft("part", shift)).alias("low"),
            )
        )
    return found.select("threat_label", F.col("low").bitwiseXOR(_smallest()).alias("low"))


def volume_by_protocol(logs: DataFrame) -> DataFrame:
    """Count, sum and mean of the bytes, per threat label and protocol."""
    return _protocol_volume(sized(logs), F.lit(1).cast("long"))


def protocol_volume_of(counts: DataFrame) -> DataFrame:
    """The same from counts per protocol."""
    return _protocol_volume(counts, F.col("lines"))


def _protocol_volume(rows: DataFrame, lines: Column) -> DataFrame:
    return _total_and_average(
        rows.groupBy("threat_label", "protocol").agg(
            F.sum(lines).alias("event_count"), *_sums(F.col("bytes_transferred"), lines)
        )
    ).select("threat_label", "protocol", "event_count", "total_bytes", "avg_bytes")
