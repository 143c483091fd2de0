import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from logvigil.llm.segments import Pieces, Segmenter, chunks, decoded, normal, segments, vocabulary_file
from tests.llm.cases import no_documents, odd_documents

TEXTS = ["", " ", "a", "hello world", "  two  spaces ", " x\ny\t", "é漢字𝄞 über", "aaaaaaaaaaaa", "The thn't, 12.5%"]


@pytest.fixture(scope="module")
def pieces():
    return Pieces(vocabulary_file())


def every(pieces, text):
    """All segmentations by plain recursion."""
    if not text:
        return [(0.0, ())]
    out = []
    for b in range(1, len(text) + 1):
        steps = []
        if found := pieces.scores.get(text[:b]):
            steps.append((found[1], found[:1]))
        if b == 1 and text[0] not in pieces.scores:
            steps.append((pieces.unknown, tuple(pieces.bytes[x] for x in text[0].encode())))
        for score, ids in steps:
            out += [(score + s, ids + rest) for s, rest in every(pieces, text[b:])]
    return out


@pytest.mark.parametrize("text", TEXTS + ["to the end of", "  a b"])
@pytest.mark.parametrize("n", [1, 3, 7])
def test_n_best_equals_all_paths(pieces, text, n):
    paths = every(pieces, normal(text))
    want = sorted((s for s, _ in paths), reverse=True)[:n]
    known = {ids: s for s, ids in paths}
    whole = pieces.best(normal(text), n)
    joined = Segmenter(pieces, n).segment([text])[0]
    for got in (whole, joined):
        assert [s for s, _ in got] == want
        assert len({tuple(i) for _, i in got}) == len(got) and all(known[tuple(int(x) for x in i)] == s for s, i in got)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_texts_searched_together_equal_those_searched_alone(pieces, n):
    rng = random.Random(n)
    texts = ["▁" + "".join(rng.choice("theandofuü漢\n1.") for _ in range(rng.randrange(90))) for _ in range(300)]
    scores, sizes, flat = pieces.best_of_all(texts, n)
    cost = {i: s for i, s in pieces.scores.values()}
    spelt = {i for i in pieces.bytes.values()}
    ends = np.cumsum(sizes).reshape(sizes.shape)
    for i, text in enumerate(texts):
        alone = pieces.best(text, n)
        assert scores[i, : len(alone)].tolist() == [s for s, _ in alone] and np.isinf(scores[i, len(alone) :]).all()
        found = [flat[b - a : b].tolist() for a, b in zip(sizes[i], ends[i])][: len(alone)]
        assert len(set(map(tuple, found))) == len(found)
        for ids, score in zip(found, scores[i].tolist()):
            unknown = sum(c not in pieces.scores for c in text)
            assert sum(cost[x] for x in ids if x not in spelt) + unknown * pieces.unknown == pytest.approx(score)
    assert ends[-1, -1] == len(flat)
    assert [x.shape for x in pieces.best_of_all([], n)] == [(0, n), (0, n), (0,)]


def test_chunks_join_to_the_normal_text():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("ab \n") for _ in range(rng.randrange(12)))
        assert "".join(chunks(text)) == normal(text)


def varint(data, at):
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if not byte & 128:
            return value, at


def as_unigram(data):
    """The model file with its type (field 3 of the trainer's message, field 2) set to unigram."""
    out, at = bytearray(), 0
    while at < len(data):
        start = at
        tag, at = varint(data, at)
        size, at = varint(data, at)
        body = data[at : at + size]
        at += size
        if tag >> 3 == 2:
            i, new = 0, bytearray()
            while i < len(body):
                a = i
                t, i = varint(body, i)
                if t & 7 == 0:
                    _, i = varint(body, i)
                elif t & 7 == 5:
                    i += 4
                else:
                    n, i = varint(body, i)
                    i += n
                if t >> 3 == 3:
                    new += bytes([t, 1])
                else:
                    new += body[a:i]
            length, rest = bytearray(), len(new)
            while rest > 127:
                length.append(rest & 127 | 128)
                rest >>= 7
            out += bytes([tag]) + length + bytes([rest]) + new
        else:
            out += data[start:at]
    return bytes(out)


def test_n_best_scores_equal_the_librarys(pieces):
    with open(vocabulary_file(), "rb") as file:
        library = SentencePieceProcessor(model_proto=as_unigram(file.read()))
    score = {i: s for i, s in pieces.scores.values()}
    for text in ["hello world", "thing and the", "Ereninger lich", "12.5%"]:
        total = lambda ids: sum(score[i] for i in ids)
        want = [total(ids) for ids in library.nbest_encode_as_ids(text, 5)]
        assert [s for s, _ in Segmenter(pieces, 5).segment([text])[0]] == want


def test_all_odd_texts_decode_to_themselves(spark):
    docs = odd_documents(spark).unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"), allowMissingColumns=True
    )
    got = segments(docs).withColumn("back", F.transform("scores", lambda s: s)).select(
        "doc.text", "ids", "scores", decoded(F.col("ids")[0]).alias("first"), decoded(F.element_at("ids", -1)).alias("last")
    ).collect()
    assert len(got) == docs.count()
    for row in got:
        assert row.first == row.last == (row.text or "")
        assert row.scores == sorted(row.scores, reverse=True) and len(row.scores) == len(row.ids)
    assert segments(no_documents(spark)).count() == 0


def test_forgetting_changes_nothing(pieces, monkeypatch):
    texts = [" ".join(f"w{i % 37} th{i}" for i in range(k, k + 30)) for k in range(20)]
    want = [Segmenter(pieces, 3).segment([t])[0] for t in texts]
    monkeypatch.setattr("logvigil.llm.segments.CHUNKS_KEPT", 10)
    few = Segmenter(pieces, 3)
    for text, expected in zip(texts, want):
        for (s, i), (t, j) in zip(few.segment([text])[0], expected):
            assert s == t and i.tolist() == j.tolist()
