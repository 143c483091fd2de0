"""SimHash near-duplicates, compared in bit-sliced blocks."""

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logvigil.llm.common import byte_texts, join_groups, slices, stored, work_folder
from logvigil.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints that one block compares at least before its bucket is cut into chunks.
BLOCK = 8192
#: A bucket with more than this share of the fingerprints is cut too: there are few of them.
BUCKET_SHARE = 4096


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included; of all words if they are fewer; none without words."""
    tokens = text.lower().split()  # on bytes: A to Z only, and the ASCII white space only
    joined, h = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return np.array([h(joined, SEED)] if tokens else [], np.uint64)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends]
    return np.array([h(joined[a : b - 1], SEED) for a, b in zip(starts, ends[words - 1 :])], np.uint64)


def fingerprints(hashes: list[np.ndarray]) -> np.ndarray:
    """One fingerprint per array of hashes: a bit is 1 if set in over half of them."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    flat = np.concatenate([np.empty(0, np.uint64), *hashes])
    owner = np.repeat(np.arange(len(hashes)), sizes)
    counts = np.zeros((len(hashes), 64), np.int64)
    for a in range(0, len(flat), 1 << 17):
        part, who = flat[a : a + (1 << 17)], owner[a : a + (1 << 17)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begin = np.flatnonzero(np.diff(who, prepend=-1))
        counts[who[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
    return np.packbits(counts * 2 > sizes[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def _fingerprint_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrow in slices(batches, "text"):
            fps = fingerprints([shingle_hashes(t, words) for t in byte_texts(arrow.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [arrow.column("doc_id"), arrow.column("row"), pa.array(fps.view(np.int64))],
                names=["doc_id", "row", "fp"],
            )

    return run


def _tables(radius: int) -> list[list[tuple[int, int]]]:
    """The bit ranges of each table: all pairs of radius + 2 blocks.

    At most ``radius`` of these blocks hold a differing bit, so two agree.
    """
    edges = np.linspace(0, 64, radius + 3).round().astype(int).tolist()
    return [list(pair) for pair in combinations(list(zip(edges, edges[1:])), 2)]


def _bucket_keys(fp: Column, radius: int) -> Column:
    keys = []
    for t, ranges in enumerate(_tables(radius)):
        key = F.lit(t).cast("long")
        for a, b in ranges:
            part = F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
            key = F.shiftleft(key, b - a).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


def _planes(fps: np.ndarray) -> np.ndarray:
    """Bit plane j holds bit j of all fingerprints, 64 of them to a word."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    packed = np.packbits(bits, axis=1, bitorder="little")
    words = -(-len(fps) // 64)
    out = np.zeros((64, words * 8), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view(np.uint64)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of n is linked to."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        open_ = low != high
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(label, high[open_], low[open_])
        while (label[label] != label).any():
            label = label[label]
    return label


def close_links(groups: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span, in each group, all pairs within the radius.

    ``groups`` is sorted. Lanes are put in order of falling group size, so that the pairs (i, i + d)
    that lie in one group fill a prefix. All of them are compared at once: plane by plane, the
    differing bits go into carry-save counters, and words of 64 pairs are abandoned
    as soon as all their pairs exceed the radius.
    """
    _, start, size = np.unique(groups, return_index=True, return_counts=True)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 1]
    if not len(order):
        return fps[:0], fps[:0]
    size, start = size[order], start[order]
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    lane = fps[np.repeat(start, size) + at]
    left = np.repeat(size, size) - at  # pairs with i + d stay in the group for d < left
    planes = _planes(lane)
    largest, n = int(size[0]), len(lane)
    planes = np.pad(planes, ((0, 0), (0, largest // 64 + 2)))
    filled = np.searchsorted(-size, -np.arange(largest + 1), side="left")  # groups larger than d
    lanes_of = np.concatenate([[0], np.cumsum(size)])
    counters = (radius + 1).bit_length()
    found_a, found_b, held = [], [], 0
    for d in range(1, largest):
        active = int(lanes_of[filled[d]])
        words, (skip, shift) = -(-active // 64), divmod(d, 64)
        valid = np.zeros(words * 64, bool)
        valid[:active] = left[:active] > d
        alive = np.packbits(valid, bitorder="little").view(np.uint64)
        where = np.arange(words)
        count = [np.zeros(words, np.uint64) for _ in range(counters)]
        over = np.zeros(words, np.uint64)
        for j in range(64):
            x = planes[j, where + skip]
            if shift:
                x = (x >> np.uint64(shift)) | (planes[j, where + skip + 1] << np.uint64(64 - shift))
            carry = x ^ planes[j, where]
            for k in range(counters):
                carry, count[k] = count[k] & carry, count[k] ^ carry
            over |= carry
            if j in (15, 23, 31, 39, 47, 55, 63):
                exceeds, equal = over.copy(), ~np.zeros_like(over)
                for k in reversed(range(counters)):  # is the count larger than the radius?
                    bit = ~np.uint64(0) if radius >> k & 1 else np.uint64(0)
                    exceeds |= equal & count[k] & ~bit
                    equal &= ~(count[k] ^ bit)
                alive = alive & ~exceeds
                if not (open_ := alive != 0).all():
                    where, alive, over = where[open_], alive[open_], over[open_]
                    count = [c[open_] for c in count]
                    if not len(where):
                        break
        if len(where):
            bits = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, bit = np.nonzero(bits)
            i = where[word] * 64 + bit
            found_a.append(i)
            found_b.append(i + d)
            held += len(i)
            if held > 1 << 20:  # keep a spanning set only
                label = _roots(n, np.concatenate(found_a), np.concatenate(found_b))
                moved = np.flatnonzero(label != np.arange(n))
                found_a, found_b, held = [moved], [label[moved]], 0
    if not found_a:
        return fps[:0], fps[:0]
    label = _roots(n, np.concatenate(found_a), np.concatenate(found_b))
    moved = np.flatnonzero(label != np.arange(n))
    return lane[moved], lane[label[moved]]


def _compare(radius: int, most: int = 1 << 18):
    """Links within the rows of a task, which come sorted by bucket and cell."""

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = close_links(np.cumsum(np.any(np.diff(keys, axis=0, prepend=-1), axis=1)), fps, radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for arrow in batches:
            new = np.column_stack([arrow.column("bucket").to_numpy(), arrow.column("cell").to_numpy()])
            keys = np.concatenate([keys, new])
            fps = np.concatenate([fps, arrow.column("fp").to_numpy().view(np.uint64)])
            if len(keys) > most:
                cut = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1:].sum()) + 1
                if (keys[0] != keys[-1]).any():
                    yield links(keys[:cut], fps[:cut])
                    keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield links(keys, fps)

    return run


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints ``fp`` at ``radius`` or fewer differing bits.

    Fingerprints meet in the buckets of 15 tables (at radius 4), each keyed by two of six blocks of bits.
    A bucket above both ``block`` and the share 1 / BUCKET_SHARE is cut into chunks, and each pair of chunks is a
    cell of its own; the list of such buckets is bounded by the share and broadcast.
    """
    total = fps.count()
    largest = max(block, total // BUCKET_SHARE)
    keyed = fps.select("fp", F.explode(_bucket_keys(F.col("fp"), radius)).alias("bucket"))
    hot = keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > largest)
    chunks = F.coalesce(F.ceil(F.col("n") / largest), F.lit(1)).cast("long")
    own = F.pmod(F.xxhash64("fp"), chunks)
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), chunks - 1), lambda j: F.least(j, own) * chunks + F.greatest(j, own)
    )
    placed = keyed.join(F.broadcast(hot), "bucket", "left").select(
        "bucket", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(cells)).alias("cell"), "fp"
    )
    return (
        placed.repartition("bucket", "cell")
        .sortWithinPartitions("bucket", "cell", "fp")
        .mapInArrow(_compare(radius), "a long, b long")
    )


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row per document: doc_id, row, fp (signed long), component_id, group_size, kept.

    Texts are lower-cased (A to Z) and cut at ASCII white space into words and shingles. The
    component is the smallest id reachable over links of ``radius`` or fewer differing bits;
    that document is the one kept. Equal fingerprints are one class before any comparison, so copies
    cost nothing, and every class is compared with all others that can be near.

    NULL text counts as empty; texts without words have fingerprint zero and are linked like any
    other. NULL ids are passed over for component_id unless a component has no other. Of rows that repeat
    an id, one is kept. ``row`` is the row's place in ``docs``. Other columns are ignored.
    """
    folder = work_folder(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return simhash_groups_of(
        stored(texts.mapInArrow(_fingerprint_rows(shingle), "doc_id long, row long, fp long"), folder, "rows"), folder, radius
    )


def simhash_groups_of(rows: DataFrame, folder: str, radius: int = RADIUS) -> DataFrame:
    """The same for stored rows (doc_id, row, fp)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    classes = stored(rows.groupBy("fp").agg(F.count("*").alias("n"), first.alias("first")), folder, "classes")
    roots = components(fingerprint_links(classes.select("fp"), radius), folder).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"), F.sum("n").alias("group_size"))
    groups = stored(rooted.join(heads, "root").select("fp", "n", "head", "group_size"), folder, "groups")
    return join_groups(rows, groups, "fp", "n", "inner").select(
        "doc_id",
        "row",
        "fp",
        F.col("head.doc_id").alias("component_id"),
        "group_size",
        (F.col("row") == F.col("head.row")).alias("kept"),
    )


def kept_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """The documents that stay, one of each component, in a column ``doc`` with all their columns.

    The documents are written once with the place of each row, so that decision and row can't drift apart, and
    the rows that go are taken out by a join on that place.
    """
    folder = work_folder(docs.sparkSession)
    placed = stored(
        docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), folder, "docs"
    )
    texts = placed.select(
        F.col(f"doc.{id_col}").cast("long").alias("doc_id"),
        "row",
        F.coalesce(F.col(f"doc.{text_col}").cast("string"), F.lit("")).alias("text"),
    )
    rows = stored(texts.mapInArrow(_fingerprint_rows(shingle), "doc_id long, row long, fp long"), folder, "rows")
    gone = simhash_groups_of(rows, folder, radius).filter("NOT kept").select("row")
    return placed.join(stored(gone, folder, "gone"), "row", "left_anti").select("doc")
