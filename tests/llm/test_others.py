import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logvigil.llm.html_text import extract_main_text, main_text
from logvigil.llm.neighbours import nearest
from logvigil.llm.packing import encoder, pack, tokenizer_file
from logvigil.llm.pii import _EMAIL, _IP, _IP_RUN, LABELS, all_spans, base_spans, emails, personal_data, redacted, Tagger, train_crf, viterbi
from logvigil.llm.quality import document_frequencies, fit, quality_scores, terms_of, train
from tests.llm.cases import az, no_documents, odd_documents


def test_packing_puts_each_id_in_one_piece(spark):
    docs = odd_documents(spark).filter("doc_id <> 3").coalesce(2)
    encode, texts = encoder(tokenizer_file()), {r.doc_id: r.text or "" for r in docs.collect()}
    rows = pack(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text in texts.items():
        ids, at = np.append(encode(text), np.uint32(0)), 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].astype("<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or at & (at - 1) == 0
    assert pack(no_documents(spark)).count() == 0


def test_fast_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    encode, plain = encoder(tokenizer_file()), Tokenizer.from_file(tokenizer_file())
    for text in ["", "  a\n\n b  ", "l'été 12.5%", "x<|endoftext|>y", "漢字 🙂 "]:
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_quality_on_held_out_documents(spark, data_root):
    docs = spark.read.parquet(f"{data_root}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{data_root}/sf0.01/labels.parquet")
    scored = quality_scores(docs, train(docs, labels, "quality"))
    held = scored.select("doc.doc_id", "score").join(labels, "doc_id").filter("crc32(cast(doc_id AS string)) % 5 = 0").collect()
    assert np.mean([(r.score >= 0.3) == (r.quality == 1) for r in held]) > 0.95
    odd = quality_scores(odd_documents(spark), train(docs, labels, "quality"))
    assert odd.count() == odd_documents(spark).count() and odd.filter("score BETWEEN 0 AND 1").count() == odd.count()
    assert {r.score for r in quality_scores(odd_documents(spark), train(docs, labels.limit(0), "quality")).collect()} == {0.5}


def test_words_are_inputs_of_the_vectors():
    a, b = terms_of(b"The quick brown fox jumps."), terms_of(b"Xqz zzzzz qqqqq xyx zzzzz.")
    model = fit(np.stack([a, b]), np.array([1.0, 0.0]), neighbours=1)
    assert not np.array_equal(a, b) and model.scores(np.stack([a, b])).tolist() == [1.0, 0.0]
    assert np.array_equal(terms_of("über Éa".encode())[-4096:], terms_of("über  Éa".encode())[-4096:])


def test_document_frequencies_cover_all_documents(spark):
    docs = odd_documents(spark).repartition(3)
    counts, n = document_frequencies(docs.select("text"))
    texts = [(r.text or "").encode() for r in docs.collect()]
    assert n == len(texts) and counts.tolist() == sum((terms_of(t) > 0).astype(int) for t in texts).tolist()
    counts, n = document_frequencies(no_documents(spark).select("text"))
    assert n == 0 and not counts.any()


def test_basis_holds_the_largest_singular_vectors():
    rng = np.random.default_rng(5)
    words = [b"alpha", b"beta", b"gamma", b"x1", b"7", b"Yes!", b"|", b"omega"]
    terms = np.stack([terms_of(b" ".join(words[i] for i in rng.integers(0, 8, 20))) for _ in range(50)])
    model = fit(terms, np.ones(50), rank=5)
    weighted = (terms * model.weight).astype(float)
    kept = np.linalg.norm(weighted @ model.basis) ** 2
    assert kept == pytest.approx((np.linalg.svd(weighted, compute_uv=False)[:5] ** 2).sum(), rel=1e-3)


def test_quality_of_no_documents(spark, data_root):
    labels = spark.read.parquet(f"{data_root}/sf0.01/labels.parquet")
    assert quality_scores(no_documents(spark), train(no_documents(spark), labels, "quality")).count() == 0


def test_votes_equal_brute_force():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.choice(list(b"abAB !|*\n9"), rng.integers(1, 60)).tolist()) for _ in range(60)]
    terms, labels = np.stack([terms_of(t) for t in texts]), rng.integers(0, 2, 60).astype(float)
    model = fit(terms, labels, neighbours=7)
    v = model.vectors_of(terms).astype(float)
    for i, score in enumerate(model.scores(terms)):
        cosine = v @ v[i]
        near = np.argsort(-cosine)[:7]
        w = np.clip(cosine[near], 0, None)
        assert score == pytest.approx((w * labels[near]).sum() / w.sum(), abs=1e-3)


def test_base_spans():
    text = "é a.b@c.d.org, 1.2.3.4 999.1.1.1 4111 1111 1111 1111 +1 (807) 555-6237 x"
    kinds = {k: text[a:b] for k, a, b in base_spans(text)}
    assert kinds == {0: "a.b@c.d.org", 1: "1.2.3.4", 3: "+1 (807) 555-6237"} or kinds[2]
    assert base_spans("256.1.1.1") == [] and base_spans("+1234") == []
    assert redacted("to a@b.c now", [(0, 3, 8)]) == "to [EMAIL] now"


def test_linear_patterns_equal_the_fixed_ones():
    rng = np.random.default_rng(4)
    for _ in range(20_000):
        text = "".join(rng.choice(list("ab@@@..-_ é"), rng.integers(0, 25)))
        assert list(emails(text)) == [m.span() for m in _EMAIL.finditer(text)], text
        text = "".join(rng.choice(list("12...0 x"), rng.integers(0, 25)))
        assert [m.span() for m in _IP_RUN.finditer(text)] == [m.span() for m in _IP.finditer(text)], text


def test_long_runs_take_linear_time():
    assert base_spans("a" * 500_000 + " x@y " + "7" * 500_001 + " " + "@a" * 200_000 + " b@c.de")[-1][0] == 0


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    moves, starts = rng.normal(size=(LABELS, LABELS)), rng.normal(size=LABELS)
    lengths = np.array([5, 3, 1])
    e = rng.normal(size=(3, 5, LABELS))
    got = viterbi(e, lengths, moves, starts)
    for i, n in enumerate(lengths):
        paths = np.stack(np.meshgrid(*[np.arange(LABELS)] * n, indexing="ij"), -1).reshape(-1, n)
        total = starts[paths[:, 0]] + e[i, np.arange(n), paths].sum(1) + moves[paths[:, :-1], paths[:, 1:]].sum(1)
        assert got[i, :n].tolist() == paths[total.argmax()].tolist()


def test_personal_data_of_odd_texts(spark):
    docs = odd_documents(spark)
    rows = personal_data(docs).collect()
    assert len(rows) == docs.count() and all(r.spans == "" for r in rows if not r.doc.text)
    found = all_spans(["Call (212) 555-0187 now", "nothing here"], Tagger(train_crf()))
    assert found[0][0] == [] and len(found[0][1]) == 1 and found[1] == ([], [])
    assert personal_data(no_documents(spark)).count() == 0


def test_main_text_of_odd_pages(spark):
    page = "<body><nav><a href=x>Menu</a></nav><article><h1>T &amp; t</h1><p>One  two<br>three<p>Four</article><form>f</form><div class='comments'>c</div><footer>x</footer>"
    assert main_text(page) == "T & t\nOne two three\nFour"
    rows = [(1, "u", page, "p"), (2, "u", None, "p"), (3, None, "", None), (None, "u", "<div>" * 3000 + "deep", "p")]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, page string")).collect()
    assert sorted((r.n_chars, r.text) for r in got) == sorted((len(t), t) for t in (main_text(page), "", "", "deep"))


@pytest.mark.parametrize("part", [50, 5])
def test_nearest_settles_copies_and_leaves_out_bad_rows(spark, part):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    rows += [(i, rows[0][1]) for i in range(200, 260)]
    rows += [(300, None), (320, [0.0] * 8), (340, [float("nan")] + [1.0] * 7), (360, [None] * 8), (None, rows[1][1]), (380, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(dict)
    for r in nearest(table, "id % 20 = 0", top=20, part=part, probes=729).collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    good = {i: np.array(v) for i, v in rows[:260]}
    assert set(got) == {i for i in good if i % 20 == 0}
    for q, found in got.items():
        want = sorted((-round(float(v @ good[q]), 9), i) for i, v in good.items() if i != q)[:20]
        assert sum(found[k + 1][0] == i for k, (_, i) in enumerate(want)) >= 16
        assert [s for _, (_, s) in sorted(found.items())] == sorted((s for _, s in found.values()), reverse=True)


def test_pipeline_stages_keep_the_columns(spark, data_root):
    sf_dir = f"{data_root}/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    schema, n = docs.dtypes, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == schema, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert 0 < docs.count() <= n
    assert docs.filter(F.length("text") != F.col("n_chars")).count() == 0
    assert not [r for r in docs.collect() if re.search(r"[a-z]@mail", r.text)]
    assert corpus_pipeline.run(spark, sf_dir).agg(F.countDistinct("doc_id").alias("d")).first().d == docs.count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_pipeline_stages_take_odd_and_empty_tables(spark, data_root, name, stage):
    sf_dir = f"{data_root}/sf0.001"
    odd = odd_documents(spark, "doc_id long, text string, lang string, score int, doc string, removed int, redacted string")
    odd = odd.withColumn("n_chars", F.length("text").cast("long"))
    empty = no_documents(spark)
    out, none = stage(spark, odd, sf_dir), stage(spark, empty, sf_dir)
    assert none.count() == 0
    if name == "packing":
        ids = {r.doc_id for r in out.collect()}
        assert ids == {r.doc_id for r in odd.collect()}
        return
    assert out.dtypes == odd.dtypes and none.dtypes == empty.dtypes
    before, after = odd.collect(), out.collect()
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in after)
    if name in ("lines", "privacy"):
        assert sorted(map(repr, (r[:1] + r[2:-1] for r in after))) == sorted(map(repr, (r[:1] + r[2:-1] for r in before)))
    else:
        left = list(map(repr, before))
        for r in after:
            left.remove(repr(r))  # rows stay as they are, and none comes twice
    if name == "near_duplicates":
        assert len({" ".join(az(r.text).split()) for r in after}) == len(after) < len(before) - 40  # of equal texts one stays
