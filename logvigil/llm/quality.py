"""Quality votes of the nearest labelled documents in a latent-semantic space."""

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.llm.common import byte_texts, fold, slices

#: At most so many labelled documents are fitted on and broadcast, with RANK numbers each.
LABELLED, RANK, NEIGHBOURS, THRESHOLD = 4000, 48, 25, 0.3
ITERATIONS = 6
#: Words are terms too, in lower case and hashed to so many columns, whose share in a vector is WORD_SHARE that of the other terms.
WORDS, WORD_SHARE = 4096, 0.25
#: Classes of bytes; a term is three classes in a row.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\x0b\x0c", "\n", ".,;:", "!?", "|", "'\"()-/")
_OTHER, _NOT_ASCII = len(CLASSES), 0
K = len(CLASSES) + 1
_REPEATS = 8  # further terms: how often a word is the word before, or known from the text
_FIRST_WORD = K**3 + 2 * _REPEATS
TERMS = _FIRST_WORD + WORDS
_TABLE = np.full(256, _OTHER, np.int64)
_TABLE[128:] = _NOT_ASCII
for _i, _chars in enumerate(CLASSES):
    _TABLE[[ord(c) for c in _chars]] = _i


def terms_of(text: bytes) -> np.ndarray:
    """Weight of each term of a text, by its share of the text."""
    counts = np.zeros(TERMS, np.float32)
    if not text:
        return counts
    c = _TABLE[np.frombuffer(b" " + text + b" ", np.uint8)]
    counts[: K**3] = np.bincount((c[:-2] * K + c[1:-1]) * K + c[2:], minlength=K**3) * (1000 / len(c))
    words = text.split()
    if words:
        for at, share in ((0, sum(map(eq, words, words[1:])) / len(words)), (1, 1 - len(set(words)) / len(words) ** 0.9)):
            a = K**3 + at * _REPEATS
            counts[a : a + int(np.clip(share, 0, 1) * _REPEATS)] = 100
        many = Counter(text.lower().split())
        at = np.fromiter((zlib.crc32(w) % WORDS for w in many), np.int64, len(many)) + _FIRST_WORD
        np.add.at(counts, at, np.fromiter(many.values(), np.float32, len(many)) * (1000 / len(words)))
    return np.log1p(counts)


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # inverse document frequency of each term
    basis: np.ndarray  # terms x rank
    vectors: np.ndarray  # labelled documents x rank, of length one
    labels: np.ndarray
    neighbours: int

    def vectors_of(self, terms: np.ndarray) -> np.ndarray:
        v = (terms * self.weight) @ self.basis
        length = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, length, out=np.zeros_like(v), where=length > 0)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Labels of the nearest vectors, weighted by cosine; the mean label where none is near."""
        if not len(self.labels):
            return np.full(len(terms), 0.5)
        cosine = self.vectors_of(terms) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        near = np.clip(np.take_along_axis(cosine, nearest, 1).astype(np.float64), 0, None)
        total = near.sum(1)
        votes = (near * self.labels[nearest]).sum(1)
        return np.clip(np.divide(votes, total, out=np.full(len(total), self.labels.mean()), where=total > 0), 0, 1)


def fit(
    terms: np.ndarray, labels: np.ndarray, rank: int = RANK, neighbours: int = NEIGHBOURS,
    frequencies: np.ndarray | None = None, documents: int = 0,
) -> Model:
    """Singular vectors of the weighted term table of the labelled documents.

    ``frequencies`` tells in how many of so many ``documents`` each term occurs; by default the labelled ones are counted. The vectors are found by iterating on a
    random start of twice the rank, which is drawn from a fixed seed.
    """
    if frequencies is None:
        frequencies, documents = (terms > 0).sum(0), len(terms)
    weight = np.log((1 + documents) / (1 + frequencies)).astype(np.float32) + 1
    weight[_FIRST_WORD:] *= WORD_SHARE
    weighted = terms * weight
    start = np.random.default_rng(0).normal(size=(TERMS, 2 * rank)).astype(np.float32)
    for _ in range(ITERATIONS):
        start = np.linalg.qr(weighted.T @ (weighted @ start))[0]
    inner = weighted @ start
    basis = (start @ np.linalg.eigh(inner.T @ inner)[1][:, ::-1][:, :rank]).astype(np.float32)
    empty = Model(weight, basis, np.empty((0, basis.shape[1]), np.float32), labels, neighbours)
    return Model(weight, basis, empty.vectors_of(terms), labels.astype(np.float64), neighbours)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for arrow in slices(batches, "text"):
        found = [terms_of(t) for t in byte_texts(arrow.column("text"))]
        at = [np.flatnonzero(x) for x in found]
        yield pa.RecordBatch.from_arrays(
            [
                arrow.column("y"),
                pa.array([x.astype(np.int32) for x in at], pa.list_(pa.int32())),
                pa.array([x[i] for x, i in zip(found, at)], pa.list_(pa.float32())),
            ],
            names=["y", "at", "x"],
        )


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of a task, and in how many of them each term occurs."""
    counts, n = np.zeros(TERMS, np.int64), 0
    for arrow in slices(batches, "text"):
        for text in byte_texts(arrow.column("text")):
            counts += terms_of(text) > 0
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array([[n, *counts.tolist()]], pa.list_(pa.int64()))], names=["counts"])


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all ``texts`` (one column, text) each term occurs, and their number. A task sends one count per term."""
    counts = texts.mapInArrow(_frequencies, "counts array<long>").select(F.posexplode("counts").alias("at", "n"))
    found = counts.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(TERMS + 1, np.int64)
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out[1:], int(out[0])


def train(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
    labelled: int = LABELLED, held_out_of: int = 5,
) -> Model:
    """Fits on at most ``labelled`` documents, those with the smallest hash of their id.

    Documents whose crc32(id) is divisible by ``held_out_of`` are left out. NULL labels and ids take no part; of labels that
    repeat an id the largest counts. The chosen ids are bounded by the parameter and broadcast; the driver gets their
    terms, not their texts. Document frequencies of the terms are counted over all documents.
    """
    order = F.xxhash64(F.col("id").cast("string"))
    chosen = (
        labels.filter(fold(id_col, held_out_of) != 0)
        .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
        .dropna()
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .orderBy(order, "id")
        .limit(labelled)
    )
    rows = (
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "id")
        .select("text", "y")
        .mapInArrow(_sparse, "y int, at array<int>, x array<float>")
        .orderBy(F.xxhash64("at", "x"), "y")
        .limit(labelled)
        .toArrow()
    )
    terms, at, x = np.zeros((rows.num_rows, TERMS), np.float32), rows["at"].to_pylist(), rows["x"].to_pylist()
    for i in range(rows.num_rows):
        terms[i, at[i]] = x[i]
    frequencies, documents = document_frequencies(docs.select(F.col(text_col).cast("string").alias("text")))
    return fit(terms, np.array(rows["y"].to_pylist(), np.float64), frequencies=frequencies, documents=documents)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrow in slices(batches, "_text"):
            found = []
            texts = byte_texts(arrow.column("_text"))
            for a in range(0, len(texts), 512):
                found.append(model.value.scores(np.stack([terms_of(t) for t in texts[a : a + 512]])))
            names = [n for n in arrow.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*[arrow.column(n) for n in names], pa.array(np.concatenate(found))], names=[*names, "score"]
            )

    return run


def quality_scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """One row per document: doc (all its columns) and score, 0 to 1, higher if label 1 is likelier.

    A text is a vector of its words, of class trigrams of its bytes and of how much it repeats itself, reduced to the latent
    space; its cosine with every labelled vector is computed in blocks, and the nearest vote with their cosine as
    weight. Only the text is looked at. NULL and empty texts, and texts near to none, get the mean label; without any
    labelled document every score is 0.5. Repeated rows get equal scores. No rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text_col).cast("string").alias("_text"))
    schema = rows.select("doc").schema.add("score", "double")
    return rows.mapInArrow(_score(shared), schema)
