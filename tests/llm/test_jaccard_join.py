import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from logvigil.llm import jaccard_join as J
from tests.llm.cases import az, no_documents, odd_documents


def brute_set(text, k=5):
    words = az(text).encode().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs of rows."""
    sets = [brute_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 80 * (len(a) + len(sets[j]) - common) and sets[j]:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            groups[find(i)].append(doc_id)
    return Counter(
        (doc_id, len(sets[i]), min(groups[find(i)], default=None) if sets[i] else doc_id)
        for i, (doc_id, _) in enumerate(rows)
    )


def edited(seed=3):
    """Texts of many sizes with edits that leave them just above and below the threshold, chains among them."""
    rng = random.Random(seed)
    rows = []
    for size in (1, 4, 5, 6, 9, 13, 14, 24, 60, 150, 400, 900):
        for _ in range(6):
            words = [f"w{rng.randrange(5000)}" for _ in range(size)]
            for _ in range(6):
                rows.append(" ".join(words))
                words = list(words)
                for _ in range(max(1, round(len(words) * rng.choice((0, 0.005, 0.01, 0.015, 0.02, 0.1))))):
                    at = rng.randrange(len(words)) if rng.random() < 0.4 else -1 - rng.randrange(min(3, len(words)))
                    words[at] = f"w{rng.randrange(5000)}"
                if rng.random() < 0.3:
                    words = words[: max(1, int(len(words) * 0.9))]
    shared = " ".join(f"p{i}" for i in range(60))
    rows += [f"{shared} " + " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(5, 80))) for _ in range(60)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("tile", "cell", "frequent"), [(J.TILE, J.CELL, J.FREQUENT), (3, 500, 4)])
def test_equals_brute_force_whatever_the_cuts(spark, monkeypatch, tile, cell, frequent):
    monkeypatch.setattr(J, "TILE", tile)
    monkeypatch.setattr(J, "CELL", cell)
    monkeypatch.setattr(J, "FREQUENT", frequent)
    rows = edited()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = J.jaccard_groups(docs).collect()
    want = brute(rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert len({c for _, _, c in want}) < len(rows) * 0.8  # edits do link


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = J.jaccard_groups(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert J.jaccard_groups(no_documents(spark)).count() == 0


def test_given_documents(spark, data_root):
    docs = spark.read.parquet(f"{data_root}/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = J.jaccard_groups(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)


def test_bounds_never_lose_a_link():
    rng = np.random.default_rng(5)
    frequent = np.zeros(0, [("hash", np.uint64), ("place", np.int64)])
    for n in (1, 2, 5, 9, 40, 333, 2500):
        base = np.unique(rng.integers(0, 1 << 63, n, np.int64).view(np.uint64))
        for drop in range(0, n // 5 + 1, max(1, n // 20)):
            other = np.unique(np.concatenate([base[drop:], rng.integers(0, 1 << 63, drop // 9, np.int64).view(np.uint64)]))
            if not J.linked(base, other):
                continue
            sizes = np.array(sorted([len(base), len(other)]))
            bands = np.searchsorted(J.EDGES, sizes, "right") - 1
            assert bands[1] - bands[0] <= 1
            assert set(J.prefix(base, frequent)) & set(J.prefix(other, frequent))
            bits = int(J.BAND_BITS[bands[0]])
            sigs = np.array([J.folded(J.signature(x, 1 << 15), bits // 64) for x in sorted([base, other], key=len)])
            assert (sigs[0] == J.signature(min(base, other, key=len), bits)).all()
            assert len(J.spanning(sizes, sigs)[0]) == 1
