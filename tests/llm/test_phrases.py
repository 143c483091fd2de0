import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from logvigil.llm import phrases as P
from logvigil.llm.common import work_folder
from logvigil.llm.registry import LLM_ORACLE_SQL, LLM_QUERIES
from tests.llm.cases import az, no_documents, odd_documents

NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute_counts(rows):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", az(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts


def brute(rows, least, top):
    out = []
    for lang, counts in brute_counts(rows).items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not inside:
                score, cut = min((1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts(seed=2, rows=400):
    """Zipf words, idioms that keep together, and a phrase that few documents repeat, so that a sample can miss it."""
    rng = random.Random(seed)
    words = [f"{c}{i}" for c in "abé" for i in range(12)] + ["A1", "x-y", "日本", " z", "q\u0085"]
    weights = [1 / (i + 1) for i in range(len(words))]
    idioms = ["in any case of doubt", "new york", "to be or not", "New\tYork"]
    out = []
    for i in range(rows):
        parts = rng.choices(words, weights, k=rng.randrange(60))
        for _ in range(rng.randrange(4)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(idioms))
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ; "]) for p in parts)
        out.append((i, rng.choice(["en", "fr", None]), text))
    out += [(rows, "en", "rare beast of prey hunts " * 40), (rows + 1, "en", None), (rows + 2, "de", "")]
    return out


@pytest.mark.parametrize(
    ("sample", "lowered", "bits"), [(2, 0.4, P.FILTER_BITS), (8, 3.0, P.FILTER_BITS), (1000, 1.0, 64), (1, 1.0, 64)]
)
def test_equals_brute_force_whatever_the_sample(spark, monkeypatch, sample, lowered, bits):
    monkeypatch.setattr(P, "SLICE", 3000)
    monkeypatch.setattr(P, "FILTER_BITS", bits)
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    got = P.collocations(docs, least=12, top=60, sample=sample, lowered=lowered)
    assert sorted(tuple(r[c] for c in NAMES) for r in got.collect()) == brute([(lang, t) for _, lang, t in rows], 12, 60)


def test_a_missed_border_is_counted_until_closed(spark):
    """A sample without any row proposes nothing: words come in the full pass, longer phrases pass by pass."""
    rows = texts(rows=150)
    frame = spark.createDataFrame(rows, "id long, lang string, text string").na.fill("und", ["lang"]).na.fill("", ["text"])
    folder = work_folder(spark)
    got = P.frequent_phrases(frame, folder, least=20, sample=10**9).filter("k > 0").collect()
    counts = brute_counts([(lang, t) for _, lang, t in rows])
    assert {(r.lang, r.phrase, r.n) for r in got} == {
        (lang, " ".join(p), n) for lang, found in counts.items() for p, n in found.items() if n >= 20
    }
    assert any(r.phrase == "rare beast of prey hunts" for r in got)


def test_odd_and_empty_documents(spark):
    docs = odd_documents(spark, "doc_id long, text string, lang string, k int, hash string, n int, phrase string")
    got = P.collocations(docs, least=40)
    assert sorted(tuple(r[c] for c in NAMES) for r in got.collect()) == brute([(r.lang, r.text) for r in docs.collect()], 40, 2000)
    assert P.collocations(no_documents(spark)).count() == 0


def test_products_beyond_a_long(spark):
    a, n = 3 * 10**12, 9 * 10**15
    counts = spark.createDataFrame(
        [("en", "", 0, 0, n), ("en", "x", 1, 1, 2 * a), ("en", "y", 1, 2, a + 7), ("en", "x y", 2, 3, a)],
        "lang string, phrase string, k int, hash long, n long",
    )
    row = P.phrase_scores(counts).first()
    assert (row.l, row.r, row.score) == (2 * a, a + 7, 1000 * a * n // (2 * a * (a + 7)))


def test_equals_sql(spark, data_root):
    folder = f"{data_root}/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.sql(LLM_ORACLE_SQL["op12_collocations"])
    got = LLM_QUERIES["op12_collocations"](spark, folder)
    assert tuple(got.columns) == tuple(want.columns) == NAMES
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
