"""Nearest vectors by multiprobe p-stable hashing."""

import itertools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logvigil.llm.common import join_groups, stored, work_folder

#: Tables, hashes per table, width of a hash cell for vectors of length one, and cells probed per table.
TABLES, HASHES, WIDTH, PROBES, SEED = 10, 6, 2.0, 20, 11
#: Distinct vectors that one task of a table holds, about.
PART = 50_000
#: A band of lengths with this many distinct vectors or fewer isn't hashed: every query meets all of it.
SCAN = 256
#: Bands of lengths to an octave.
BANDS = 2
_OFFSET, _RADIX = 1 << 9, 1 << 10


@dataclass(frozen=True)
class Hashes:
    """p-stable hashes floor((a.x + b) / w) of vectors brought to length one, several to a table.

    Rows are hashed in bands of lengths, each at most 1.42 times the shortest of its band, so that within a band
    the nearest directions hold the largest inner products, however uneven the lengths of the table are.
    """

    directions: np.ndarray  # tables x hashes x dimension
    shifts: np.ndarray
    width: float

    @staticmethod
    def draw(dimension: int, tables: int, hashes: int, width: float, seed: int = SEED) -> "Hashes":
        rng = np.random.default_rng(seed)
        return Hashes(rng.normal(size=(tables, hashes, dimension)), rng.uniform(0, width, (tables, hashes)), width)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """Place of each vector in cell widths, (rows, tables, hashes)."""
        unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that no square overflows
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        return (np.einsum("nd,thd->nth", unit, self.directions) + self.shifts) / self.width

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        return keys(np.floor(self.cells(vectors)).astype(np.int64))

    def probes(self, vectors: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` buckets of each query and table that hold a near row likeliest, best first.

        The chance that a near row lies one cell aside falls with the squared distance to that border, so the
        sum of these squares orders the perturbed buckets.
        """
        place = self.cells(vectors)
        home = np.floor(place).astype(np.int64)
        x = place - home
        steps = np.array(list(itertools.product((-1, 0, 1), repeat=x.shape[2])))
        costs = np.stack([x**2, np.zeros_like(x), (1 - x) ** 2], axis=-1)
        most = min(most, len(steps))
        out = np.empty((*x.shape[:2], most), np.int64)
        for t in range(x.shape[1]):
            total = sum(costs[:, t, h][:, steps[:, h] + 1] for h in range(x.shape[2]))
            best = np.argpartition(total, most - 1, axis=1)[:, :most]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(total, best, 1), axis=1, kind="stable"), 1)
            out[:, t] = keys(home[:, None, t] + steps[best])
        return out


def keys(cells: np.ndarray) -> np.ndarray:
    """One number for the cells of a table."""
    out = np.zeros(cells.shape[:-1], np.int64)
    for h in range(cells.shape[-1]):
        out = out * _RADIX + np.clip(cells[..., h] + _OFFSET, 0, _RADIX - 1)
    return out


def _in_band(buckets: np.ndarray, band) -> np.ndarray:
    """The bucket's number in a band of lengths."""
    return buckets ^ (np.asarray(band, np.int64) * 0x1E3779B97F4A7C15)


def _bucket_rows(shared, small: frozenset):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                scanned = pdf["band"].isin(small)
                if scanned.any():  # one bucket of one table
                    rows = pdf[scanned]
                    yield rows.assign(table=0, bucket=_in_band(np.full(len(rows), -1), rows["band"]))[["table", "bucket", "class", "ids", "vector"]]
                pdf = pdf[~scanned].reset_index(drop=True)
            if len(pdf):
                b = shared.value.buckets(np.stack(pdf["vector"].to_numpy()).astype(np.float64))
                n, tables = b.shape
                b = _in_band(b, pdf["band"].to_numpy()[:, None])
                rows = pdf.loc[pdf.index.repeat(tables)].reset_index(drop=True)
                yield rows.assign(table=np.tile(np.arange(tables), n), bucket=b.ravel())[["table", "bucket", "class", "ids", "vector"]]

    return run


def _probe_rows(shared, probes: int, hashed: list[int], small: list[int]):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                for band in small:
                    yield pdf[["class"]].assign(table=0, bucket=int(_in_band(np.array(-1), band)))[["table", "bucket", "class"]]
                b = shared.value.probes(np.stack(pdf["vector"].to_numpy()).astype(np.float64), probes) if hashed else None
                for band in hashed:
                    n, tables, most = b.shape
                    rows = pdf[["class"]].loc[pdf.index.repeat(tables * most)].reset_index(drop=True)
                    yield rows.assign(table=np.tile(np.repeat(np.arange(tables), most), n), bucket=_in_band(b, band).ravel())[["table", "bucket", "class"]]

    return run


def _rerank(wanted: int):
    """Exact products of the probed buckets of one part of a table, and the best per query."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        nothing = pd.DataFrame({"query": [], "class": [], "ids": [], "score": []}).astype({"query": "int64", "class": "int64", "score": "float64"})
        if not len(queries) or not len(rows):
            return nothing
        rows = rows.sort_values("bucket", kind="stable", ignore_index=True)
        vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        bucket, classes = rows["bucket"].to_numpy(), rows["class"].to_numpy()
        edges = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
        span = {k: (a, b) for k, a, b in zip(bucket[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(bucket)])}
        asked = np.stack(queries["vector"].to_numpy()).astype(np.float64)
        by_bucket: dict[int, list[int]] = {}
        for i, probed in enumerate(queries["buckets"]):
            for b in probed:
                if b in span:
                    by_bucket.setdefault(b, []).append(i)
        found_q, found_r, found_s = [], [], []
        for b, who in by_bucket.items():
            first, last = span[b]
            for c in range(first, last, 8192):
                for w in range(0, len(who), 1024):
                    some = np.array(who[w : w + 1024])
                    scores = asked[some] @ vectors[c : min(c + 8192, last)].T
                    k = min(wanted, scores.shape[1])
                    best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                    if k < scores.shape[1]:  # ties with the last one stay, down to the smallest ids
                        least = np.take_along_axis(scores, best, 1).min(1, keepdims=True)
                        order = np.lexsort((np.broadcast_to(classes[c : min(c + 8192, last)], scores.shape), -scores), axis=1) if ((scores >= least).sum(1) > k).any() else None
                        best = best if order is None else order[:, :k]
                    found_q.append(np.repeat(some, k))
                    found_r.append((best + c).ravel())
                    found_s.append(np.take_along_axis(scores, best, 1).ravel())
        if not found_q:
            return nothing
        q, r, s = map(np.concatenate, (found_q, found_r, found_s))
        order = np.lexsort((classes[r], -s, q))
        q, r, s = q[order], r[order], s[order]
        start = np.flatnonzero(np.diff(q, prepend=-1))
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
        q, r, s = (x[rank < wanted] for x in (q, r, s))
        return pd.DataFrame({"query": queries["class"].to_numpy()[q], "class": classes[r], "ids": rows["ids"].to_numpy()[r], "score": s})

    return run


def nearest(
    vectors: DataFrame, is_query: str, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 20,
    tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH, probes: int = PROBES, part: int = PART, scan: int = SCAN,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` rows of largest inner product found for each query.

    ``is_query`` is SQL over the columns ``id`` and ``vector``. Rows are put in bands of lengths, each half an octave wide. Every row lies
    in one bucket of each table of its band; a query visits the likeliest buckets of each table of every band, and
    all rows of bands of ``scan`` or fewer. Rows and visiting queries meet in parts of a table, where the products are exact and
    in double precision; where a part has too many rows or visitors, both are cut, and every cut of rows meets every cut of visitors. What the tables found is
    merged per query, nearest first, ties to the smaller id. A query for which the tables found fewer than ``top`` is compared
    with all rows.

    Equal vectors are one class with its smallest ids, top + 1 of them, which is all that a result can use; so copies cost
    nothing and ties between them are whole. NULL ids, NULL vectors, zero vectors, other dimensions than the most
    common one, and vectors holding NULL, NaN or infinity take no part. Fewer rows than ``top`` give all there are. Other columns are ignored.
    """
    spark = vectors.sparkSession
    folder = work_folder(spark)
    wanted = top + 1
    valid = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(
        F.col("id").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    largest = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.col("largest")) ** 2)
    octave = F.log2("largest") + F.log2(squares) / 2  # of the length
    valid = valid.withColumn("largest", largest).select("id", "vector", octave.alias("octave"))
    sizes = valid.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"), F.max("octave").alias("longest")).orderBy(F.desc("n"), "d").limit(1).collect()
    dimension, total, longest = tuple(sizes[0]) if sizes else (1, 0, 0.0)
    valid = valid.filter(F.size("vector") == dimension).withColumn("band", F.floor((F.lit(longest) - F.col("octave") + 1e-6) * BANDS).cast("int"))
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    classes = stored(
        valid.withColumn("nth", nth)
        .filter(F.col("nth") <= wanted)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"), F.min("band").alias("band"))
        .select(F.col("ids")[0].alias("class"), "ids", "vector", "band"),
        folder,
        "classes",
    )
    asked = valid.filter(is_query)
    query_class = stored(
        asked.groupBy("vector").agg(F.count("*").alias("n")).join(classes.select("class", "vector"), "vector"), folder, "queries"
    )
    shared = spark.sparkContext.broadcast(Hashes.draw(dimension, tables, hashes, width))
    bands = {r["band"]: r["n"] for r in classes.groupBy("band").agg(F.count("*").alias("n")).collect()}  # half octaves of a double: a bounded number
    small = sorted(b for b, n in bands.items() if n <= scan)
    hashed = sorted(bands.keys() - set(small))
    parts = max(1, -(-sum(bands.values()) // part))
    vector_type = "array<double>"
    where = F.pmod(F.xxhash64("bucket"), F.lit(parts)).alias("part")
    placed = classes.mapInPandas(
        _bucket_rows(shared, frozenset(small)), f"table int, bucket long, class long, ids array<long>, vector {vector_type}"
    ).withColumn("part", where)
    visits = stored(
        query_class.select("class", "vector")
        .mapInPandas(_probe_rows(shared, probes, hashed, small), "table int, bucket long, class long")
        .withColumn("part", where)
        .groupBy("table", "part", "class")
        .agg(F.collect_list("bucket").alias("buckets")),
        folder,
        "visits",
    )

    def pieces(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("table", "part").agg(F.ceil(F.count("*") / (2 * part)).cast("long").alias(name))

    own_piece = lambda n: F.pmod(F.xxhash64("class"), F.col(n))
    every_piece = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    key = ["table", "part", "cut", "turn"]

    def met(rows: DataFrame, visits: DataFrame, cuts: DataFrame) -> DataFrame:
        """The best rows of each query class that rows and visits of one table and part hold."""
        placed = rows.join(cuts, ["table", "part"]).withColumn("cut", own_piece("cuts")).withColumn("turn", every_piece("turns"))
        visits = (
            visits.join(query_class.select("class", "vector"), "class")
            .join(cuts, ["table", "part"])
            .withColumn("turn", own_piece("turns"))
            .withColumn("cut", every_piece("cuts"))
        )
        found = (
            visits.select(*key, "class", "buckets", "vector")
            .groupBy(*key)
            .cogroup(placed.select(*key, "bucket", "class", "ids", "vector").groupBy(*key))
            .applyInPandas(
                lambda q, r: _rerank(wanted)(q, r), "query long, class long, ids array<long>, score double"
            )
        )
        once = found.groupBy("query", "class").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
        ranked = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        best = (
            once.select("query", "score", F.explode("ids").alias("id"))
            .withColumn("nth", F.row_number().over(ranked))
            .filter(F.col("nth") <= wanted)
            .groupBy("query")
            .agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("best"))
            .withColumnRenamed("query", "class")
        )
        return best.join(query_class.select("class", "n"), "class")

    cuts = stored(pieces(placed, "cuts").join(pieces(visits, "turns"), ["table", "part"]), folder, "cuts")
    results = stored(met(placed, visits, cuts), folder, "results").filter(F.size("best") >= min(wanted, total))
    # Queries for which the tables held too little meet every row.
    short = stored(query_class.select("class").join(results.select("class"), "class", "left_anti"), folder, "short")
    n_short = short.count()
    if n_short:
        everything = lambda rows: rows.withColumn("table", F.lit(0)).withColumn("part", F.lit(0).cast("long"))
        pieces_of = lambda n: F.lit(-(-n // (2 * part))).cast("long")
        blocks = everything(spark.range(1)).select("table", "part", pieces_of(sum(bands.values())).alias("cuts"), pieces_of(n_short).alias("turns"))
        all_rows = everything(classes.withColumn("bucket", F.lit(0).cast("long")))
        all_visits = everything(short.withColumn("buckets", F.array(F.lit(0).cast("long"))))
        results = results.unionByName(stored(met(all_rows, all_visits, blocks), folder, "completed"))
    with_class = asked.join(query_class.select("class", "vector"), "vector").select("class", F.col("id").alias("query_id"))
    joined = join_groups(with_class, results, "class", "n", "inner")
    own = F.slice(F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, top)
    return joined.select("query_id", F.posexplode(own).alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.score").alias("score")
    )
