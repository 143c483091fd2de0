"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections."""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logvigil.llm.common import byte_texts, join_groups, slices, stored, work_folder
from logvigil.llm.components import components

SHINGLE = 5
#: Two texts link when 5 * |A and B| >= 4 * |A or B|.
SHARE = (4, 5)
#: Members that one tile compares before it is cut into cells, and shingles that one cell of the exact step holds.
TILE, CELL = 4096, 1 << 21
#: Counters of a task's sketch of frequent shingles, and frequent shingles that are put last in the common order.
COUNTERS, FREQUENT = 4096, 1 << 16
#: Bits of the shortest and the longest signature, and of the largest filter that is broadcast (16 MB).
BITS, FILTER_BITS = (64, 1 << 15), 1 << 27

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _edges() -> np.ndarray:
    """First size of each band: a size and its 5/4 lie in one band or in two that follow."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] * 5 // 4 + 1)
    return np.array(edges, np.int64)


EDGES = _edges()
#: Bits of the signatures of a band: a power of two that reaches its first size.
BAND_BITS = np.clip(1 << np.ceil(np.log2(EDGES)).astype(np.int64), *BITS)


class _Words(dict):
    """Numbers of words and their hashes by number; emptied when it holds a million words."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(word))
        return n

    def hashed(self, texts: list[list[bytes]]) -> np.ndarray:
        """The hashes of the words of all texts."""
        if len(self.hashes) > 1_000_000:
            self.clear()
            self.hashes = []
        ids: list[int] = []
        for words in texts:
            ids += map(self.__getitem__, words)
        return np.array(self.hashes, np.uint64)[np.array(ids, np.int64)] if ids else np.empty(0, np.uint64)


def shingle_sets(texts: list[bytes], words: _Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its shingles; of all words if they are fewer; none without words."""
    tokens = [t.lower().split() for t in texts]  # on bytes: A to Z only, and the ASCII white space only
    w = words.hashed(tokens)
    ends = np.cumsum([len(t) for t in tokens]).tolist()

    def shingles(w: np.ndarray, k: int) -> np.ndarray:
        h = np.full(len(w) - k + 1, k, np.uint64)
        for j in range(k):
            h = (h ^ w[j : len(w) - k + 1 + j]) * _MIX[j % len(_MIX)]
            h ^= h >> np.uint64(29)
        return h

    every = shingles(w, size) if len(w) >= size else w[:0]  # those across two texts are passed over
    out = []
    for start, end in zip([0, *ends], ends):
        found = np.sort(every[start : end - size + 1] if end - start >= size else shingles(w[start:end], end - start))
        out.append(found[np.flatnonzero(np.diff(found, prepend=~found[:1]))] if end > start else w[:0])
    return out


def signature(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the hashes per bit: the differing bits of two sets never outnumber their differing members."""
    flags = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flags.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sig: np.ndarray, words: int) -> np.ndarray:
    """A signature in fewer words."""
    while len(sig) > words:
        sig = sig[: len(sig) // 2] ^ sig[len(sig) // 2 :]
    return sig


def prefix(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first members in an order common to all sets; two sets that link share one of them.

    Members that aren't frequent come first, by hash. ``frequent`` is sorted by hash, with the place of each in that order.
    """
    n = len(hashes)
    take = n - -(-SHARE[0] * n // SHARE[1]) + 1 if n else 0
    at = np.minimum(np.searchsorted(frequent["hash"], hashes), max(0, len(frequent) - 1))
    common = frequent["hash"][at] == hashes if len(frequent) else np.zeros(n, bool)
    rare = hashes[~common][:take]
    if len(rare) == take:
        return rare
    late = at[common]
    return np.concatenate([rare, frequent["hash"][late[np.argsort(frequent["place"][late])]][: take - len(rare)]])


def spanning(
    sizes: np.ndarray, sigs: np.ndarray, exact: Callable[[int, int], bool] | None = None, label: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all members within reach of each other; ``sizes`` ascend. Members of one ``label`` are connected already.

    The differing bits of two signatures bound the overlap from above. Pairs that pass are linked, or those
    that ``exact`` then confirms. Members already connected aren't compared again.
    """
    label = np.arange(len(sizes)) if label is None else label.copy()
    a, b = [], []
    for i in range(len(sizes) - 1):
        end = np.searchsorted(sizes, sizes[i] * SHARE[1] // SHARE[0], "right")
        js = np.arange(i + 1, end)
        js = js[label[js] != label[i]]
        if not len(js):
            continue
        differ = np.bitwise_count(sigs[js] ^ sigs[i]).sum(axis=1, dtype=np.int64)
        both = sizes[js] + sizes[i]
        js = js[(SHARE[0] + SHARE[1]) * (both - differ) >= 2 * SHARE[0] * both]
        for j in js:
            if label[j] != label[i] and (exact is None or exact(i, j)):
                a.append(i)
                b.append(j)
                label[label == label[j]] = label[i]
    return np.array(a, np.int64), np.array(b, np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the share, by the size of their intersection."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return common * SHARE[1] >= (len(a) + len(b) - common) * SHARE[0]


def _sketches(counters: int, size: int):
    """Frequent shingles of a task, at most ``counters``: all that have more than that share of its rows' shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, keys, counts = _Words(), np.empty(0, np.uint64), np.empty(0, np.int64)
        for arrow in batches:
            for part in slices(iter([arrow]), "text"):
                found = shingle_sets(byte_texts(part.column("text")), words, size)
                new, times = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
                keys, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, back, np.concatenate([counts, times]))
                if len(keys) > counters:
                    total -= np.partition(total, -counters - 1)[-counters - 1]
                keys, counts = keys[total > 0], total[total > 0]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["hash", "count"])

    return run


def frequent_shingles(texts: DataFrame, folder: str, size: int = SHINGLE) -> np.ndarray:
    """At most FREQUENT shingles of all texts, sorted by hash, with their places by rising frequency.

    They only shape the common order: whichever they are, no link is lost.
    """
    sketch = stored(texts.select("text").mapInArrow(_sketches(COUNTERS, size), "hash long, count long"), folder, "sketch")
    top = sketch.groupBy("hash").agg(F.sum("count").alias("count")).orderBy(F.desc("count"), "hash").limit(FREQUENT).toArrow()
    hashes = top.column("hash").to_numpy().astype(np.int64).view(np.uint64)
    out = np.zeros(len(hashes), [("hash", np.uint64), ("place", np.int64)])
    out["hash"], out["place"] = hashes, np.arange(len(hashes))[::-1]
    return np.sort(out, order="hash")


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _set_rows(frequent: np.ndarray, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for arrow in slices(batches, "text"):
            sets = shingle_sets(byte_texts(arrow.column("text")), words, size)
            sizes = np.array([len(s) for s in sets], np.int64)
            bands = np.searchsorted(EDGES, sizes, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    arrow.column("doc_id"),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array(sizes),
                    pa.array(bands.astype(np.int32)),
                    pa.array([signature(s, int(BAND_BITS[b])).tobytes() if len(s) else b"" for s, b in zip(sets, bands)], pa.binary()),
                    pa.array([prefix(s, frequent).view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "digest", "n", "band", "sig", "prefix"],
            )

    return run


def _near(batches: Iterator[pa.RecordBatch], exact: bool) -> Iterator[pa.RecordBatch]:
    """Links of each tile, whose rows come together and in order of their sizes."""
    tile, rows = None, []

    def links() -> pa.RecordBatch:
        words = int(BAND_BITS[tile[1]]) // 64 if not exact else min(len(r[2]) for r in rows) // 8
        sigs = np.array([folded(np.frombuffer(r[2], np.uint64), words) for r in rows])
        sets = [np.frombuffer(r[3], np.uint64) for r in rows] if exact else None
        test = (lambda i, j: linked(sets[i], sets[j])) if exact else None
        a, b = spanning(np.array([r[1] for r in rows]), sigs, test, np.array([r[4] for r in rows]) if exact else None)
        ids = np.array([r[0] for r in rows])
        return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    columns = ["cid", "n", "sig", *(["set", "label"] if exact else [])]
    for arrow in batches:
        keys = zip(*(arrow.column(c).to_pylist() for c in ("key", "band", "cell")))
        for key, row in zip(keys, zip(*(arrow.column(c).to_pylist() for c in columns))):
            if key != tile:
                if len(rows) > 1:
                    yield links()
                tile, rows = key, []
            rows.append(row)
    if len(rows) > 1:
        yield links()


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _near(batches, exact=False)


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _near(batches, exact=True)


def _cells(size: Column, most: int) -> Column:
    """Cells of a member: all pairs of chunks that its own chunk is part of. Any two members meet in one cell at least."""
    chunks = F.greatest(F.ceil(size / most), F.lit(1)).cast("long")
    own = F.pmod(F.xxhash64("cid"), chunks)
    return F.transform(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda j: F.least(j, own) * chunks + F.greatest(j, own))


def _dealt(rows: DataFrame, links) -> DataFrame:
    return rows.repartition("key", "band", "cell").sortWithinPartitions("key", "band", "cell", "n", "cid").mapInArrow(links, "a long, b long")


def _candidates(classes: DataFrame, folder: str) -> DataFrame:
    """(a, b): links that connect all classes whose signatures leave a link possible, within the tiles of shared prefix members.

    Members that one class alone has are left out, and of members with the same classes one stays. A tile holds the classes of one
    member in two bands of sizes that follow; a tile of more than TILE classes is cut into cells.
    """
    places = classes.select("cid", "n", "band", F.explode("prefix").alias("key"))
    shared = stored(places.groupBy("key").agg(F.count("*").alias("classes")).filter("classes > 1"), folder, "shared")
    members = stored(join_groups(places, shared, "key", "classes", "inner"), folder, "members")
    alike = members.groupBy("key", "classes").agg(
        F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y")
    )
    chosen = stored(alike.groupBy("classes", "x", "y").agg(F.min("key").alias("key")).select("key", "classes"), folder, "chosen")
    kept = join_groups(members.drop("classes"), chosen, "key", "classes", "inner")
    both = kept.select("cid", "n", "key", F.explode(F.array("band", F.col("band") - 1)).alias("band")).filter("band >= 0")
    both = stored(both.withColumn("tile", F.xxhash64("key", "band")), folder, "both")
    tiles = both.groupBy("tile").agg(F.count("*").alias("size")).filter("size > 1")
    placed = join_groups(both, stored(tiles, folder, "tiles"), "tile", "size", "inner")
    placed = placed.select("cid", "n", "key", "band", F.explode(_cells(F.col("size"), TILE)).alias("cell"))
    per_class = placed.groupBy("cid").agg(F.count("*").alias("uses"))
    sigs = classes.select("cid", "sig").join(stored(per_class, folder, "uses"), "cid")
    return _dealt(join_groups(placed, stored(sigs, folder, "sigs"), "cid", "uses", "inner"), _bounded)


def _filter_bits(digests: DataFrame, rows: int) -> np.ndarray:
    """Bits of the digests, at most FILTER_BITS of them: 16 MB."""
    bits = min(FILTER_BITS, max(1 << 12, 1 << (8 * rows).bit_length()))
    bit = F.pmod(F.xxhash64("digest"), F.lit(bits))
    words = (
        digests.select((bit / 64).cast("long").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("one"))
        .groupBy("word")
        .agg(F.bit_or("one").alias("ones"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("ones").to_numpy()
    return out.view(np.uint64)


def _wanted_sets(ones: np.ndarray, size: int):
    """The sets whose digest is in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for arrow in slices(batches, "text"):
            rows = []
            for hashes in shingle_sets(byte_texts(arrow.column("text")), words, size):
                digest = _digest(hashes)
                bit = xxhash.xxh64_intdigest(digest, 42) - (xxhash.xxh64_intdigest(digest, 42) >> 63 << 64)
                bit %= len(ones) * 64
                if int(ones[bit // 64]) >> (bit % 64) & 1:
                    rows.append((digest, hashes.tobytes()))
            if rows:
                digests, sets = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], names=["digest", "set"])

    return run


def _each(n: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), n - 1)


def _confirmed(texts: DataFrame, candidates: DataFrame, classes: DataFrame, folder: str, size: int) -> DataFrame:
    """(a, b): exact links that connect all classes within the groups that the candidates span.

    A group of more than CELL shingles is cut into chunks. First each chunk is settled, with one leading class in all of them, which
    connects most copies of one text. Then those that aren't connected to the largest part of their group meet all others.
    """
    roots = components(candidates, f"{folder}/candidates").withColumnRenamed("node", "cid")
    wanted = stored(classes.join(roots, "cid").select("cid", "digest", "n", "sig", "root"), folder, "wanted")
    totals = wanted.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"), F.min("cid").alias("leader"))
    placed = stored(join_groups(wanted, stored(totals, folder, "totals"), "root", "members", "inner"), folder, "placed")
    ones = _filter_bits(wanted.select("digest"), wanted.count())
    found = texts.select("text").mapInArrow(_wanted_sets(ones, size), "digest binary, set binary")
    found = found.groupBy("digest").agg(F.first("set").alias("set"))
    # Sets grow with the input, so neither side is broadcast.
    sets = stored(placed.select("cid", "digest").hint("merge").join(found, "digest").select("cid", "set"), folder, "sets")

    def links(rows: DataFrame) -> DataFrame:
        rows = rows.select("cid", "n", "sig", F.col("root").alias("key"), F.lit(0).alias("band"), "cells", "label")
        with_sets = rows.hint("merge").join(sets, "cid").withColumn("cell", F.explode("cells")).drop("cells")
        return _dealt(with_sets, _exact)

    def chunks(shingles: str) -> Column:
        return F.greatest(F.ceil(F.col(shingles) / CELL), F.lit(1)).cast("long")

    def chunk(of: Column) -> Column:
        return F.pmod(F.xxhash64("cid"), of)

    own = F.array(chunk(chunks("shingles")))
    cells = F.when(F.col("cid") == F.col("leader"), _each(chunks("shingles"))).otherwise(own)
    near = stored(links(placed.withColumns({"cells": cells, "label": F.col("cid")})), folder, "near")

    parts = components(near, f"{folder}/near-parts").select(F.col("node").alias("cid"), F.col("root").alias("part"))
    cut = placed.filter(chunks("shingles") > 1).join(parts, "cid", "left").withColumn("label", F.coalesce("part", "cid"))
    cut = stored(cut.drop("part"), folder, "cut")
    sizes = cut.groupBy("root", "label").agg(F.sum("n").alias("shingles_of"), F.count("*").alias("n_of"))
    split = sizes.groupBy("root").agg(
        F.max_by("label", F.struct("shingles_of", "label")).alias("main"),
        F.max("shingles_of").alias("main_shingles"),
        (F.sum("shingles_of") - F.max("shingles_of")).alias("rest_shingles"),
        F.sum("n_of").alias("uses"),
    )
    split = stored(split.filter("rest_shingles > 0"), folder, "split")
    rows = join_groups(cut, split, "root", "uses", "inner")
    m, r = chunks("main_shingles"), chunks("rest_shingles")
    rest = chunk(r)
    cells = F.when(F.col("label") == F.col("main"), F.transform(_each(r), lambda j: chunk(m) * r + j)).otherwise(
        F.concat(
            F.transform(_each(m), lambda i: i * r + rest),
            F.transform(_each(r), lambda j: m * r + F.least(j, rest) * r + F.greatest(j, rest)),
        )
    )
    return near.unionByName(links(rows.withColumn("cells", cells)))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, group_size (documents of the component).

    A document's set holds its distinct shingles of ``shingle`` words, lower-cased (A to Z); one of all words if they are
    fewer. Sets with a Jaccard similarity of 0.8 or more link, and the component is the smallest id reachable. Equal sets are one class
    before any comparison. Classes that share a member of their prefixes in a common order (rare shingles first) meet in tiles of
    similar sizes; the bit counts of parity signatures bound their overlap from above, and the groups
    that are left are settled by intersecting the sorted sets. No candidate is capped: large tiles and
    groups are cut into cells in which any two members meet.

    Shingles are compared as 64-bit hashes. NULL text counts as empty. Texts without words have an empty set, no links, and their own id
    as component. NULL ids are passed over for component_id unless there is no other. Rows that repeat an
    id are documents of their own. Other columns are ignored; no rows give no rows. Texts may be of any length.
    """
    folder = work_folder(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    frequent = frequent_shingles(texts, folder, shingle)
    schema = "doc_id long, digest binary, n long, band int, sig binary, prefix array<long>"
    rows = stored(texts.mapInArrow(_set_rows(frequent, shingle), schema), folder, "rows")
    classes = rows.groupBy("digest").agg(
        F.count("*").alias("docs"), F.min("doc_id").alias("first"), *[F.first(c).alias(c) for c in ("n", "band", "sig", "prefix")]
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), folder, "classes")
    candidates = stored(_candidates(classes.filter("n > 0"), folder), folder, "links")
    links = stored(_confirmed(texts, candidates, classes, folder, shingle), folder, "confirmed")
    roots = components(links, f"{folder}/links-found").withColumnRenamed("node", "cid")
    rooted = classes.select("cid", "digest", "docs", "first").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    rooted = stored(rooted, folder, "rooted")
    heads = rooted.groupBy("root").agg(
        F.min("first").alias("component_id"), F.sum("docs").alias("group_size"), F.count("*").alias("members")
    )
    groups = join_groups(rooted, stored(heads, folder, "heads"), "root", "members", "inner")
    groups = stored(groups.select("digest", "docs", "component_id", "group_size"), folder, "groups")
    return join_groups(rows.select("doc_id", "digest", "n"), groups, "digest", "docs", "inner").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("n") == 0, F.lit(1).cast("long")).otherwise(F.col("group_size")).alias("group_size"),
    )
