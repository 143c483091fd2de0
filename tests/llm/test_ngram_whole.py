"""The query's model holds every triple, those seen once too."""

import pytest

from logvigil.llm.common import fold
from logvigil.llm.ngram_model import lm_scores, train
from logvigil.llm.registry import op3_lm_scores
from tests.llm.test_ngram_model import Plain


def test_the_query_scores_with_all_triples(spark, data_root):
    docs = spark.read.parquet(f"{data_root}/sf0.001/documents.parquet").select("doc_id", "text")
    trained_on = [r.text for r in docs.filter(fold("doc_id", 7) != 2).collect()]
    plain, cut = Plain(trained_on, least=1), Plain(trained_on, least=2)
    assert len(cut.c3) < len(plain.c3)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = op3_lm_scores(spark, f"{data_root}/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.score == pytest.approx(plain.score(texts[r.doc_id]), abs=0.012 * r.n_tokens + 0.01)


def test_a_trie_without_ends_of_texts_is_open(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(8)], "doc_id long, text string")
    plan = train(docs, least_trigram=1, trie_tokens=4)
    plain = Plain([r.text for r in docs.collect()], least=1)
    for r in lm_scores(docs, plan).select("doc.doc_id", "n_tokens", "score").collect():
        text = " ".join(f"w{r.doc_id}x{j}" for j in range(40))
        assert r.score == pytest.approx(plain.score(text), abs=0.012 * r.n_tokens + 0.01)
