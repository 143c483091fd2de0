import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logvigil.llm.components import components
from logvigil.llm.common import work_folder
from logvigil.llm.exact_dedup import exact_dedup
from logvigil.llm.line_dedup import line_dedup, removed_lines
from logvigil.llm.simhash import close_links, fingerprint_links, fingerprints, simhash_groups
from tests.llm.cases import az, no_documents, odd_documents


@pytest.mark.parametrize("max_bits", [64, 1 << 20])
def test_exact_dedup_equals_brute_force_at_any_filter_size(spark, max_bits):
    docs = odd_documents(spark)
    groups = defaultdict(list)
    for row in docs.collect():
        groups[az(row.text)].append(-1 if row.doc_id is None else row.doc_id)
    got = exact_dedup(docs, max_bits=max_bits).collect()
    assert len(got) == docs.count()
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    seen, kept = defaultdict(list), Counter()
    for row in got:
        ids = by_sha[row.text_sha256]
        assert row.group_size == len(ids)
        assert row.keep_id == (None if max(ids) < 0 else max(ids))
        seen[row.text_sha256].append(-1 if row.doc_id is None else row.doc_id)
        kept[row.text_sha256] += row.kept
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in by_sha.items()}
    assert set(kept.values()) == {1}


def test_exact_dedup_moves_no_text_and_runs_no_python(spark):
    plan = exact_dedup(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "text#" not in plan.replace("text_sha256#", "")


def test_empty_tables(spark):
    docs = no_documents(spark)
    assert exact_dedup(docs).count() == line_dedup(docs).count() == simhash_groups(docs).count() == 0


def brute_lines(rows, window=3):
    found = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        lines = [(p, x.strip(" \t\r\x0b\x0c")) for p, x in enumerate((text or "").split("\n"))]
        lines = [x for x in lines if x[1]]
        for k in range(len(lines) - window + 1):
            win = lines[k : k + window]
            key = (-1 if doc_id is None else doc_id, i, win[0][0])
            found[tuple(x for _, x in win)].append((key, i, win[0][0], win[-1][0]))
    gone = defaultdict(set)
    for places in found.values():
        (_, first, a, b), *later = sorted(places)
        for _, i, c, d in later:
            gone[i].update(p for p in range(c, d + 1) if i != first or not a <= p <= b)
    return {i: sorted(gone[i]) for i in range(len(rows))}


def test_line_dedup_equals_brute_force(spark):
    docs = odd_documents(spark).filter("doc_id IS NULL OR doc_id <> 3").coalesce(1)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = Counter()
    for i, gone in brute_lines(rows).items():
        lines = (rows[i][1] or "").split("\n")
        left = "\n".join(x for p, x in enumerate(lines) if p not in set(gone))
        want[(rows[i][0], len(lines), tuple(gone), left)] += 1
    got = Counter((r.doc.doc_id, r.n_lines, tuple(r.removed), r.text) for r in line_dedup(docs).collect())
    assert got == want


def test_one_copy_of_overlapping_lines_is_left():
    assert removed_lines(4, [(3, 3)]) == [3]
    assert removed_lines(9, [(1, 3), (2, 4), (7, 9), (6, 5)]) == [1, 2, 3, 4, 7, 8]


def test_a_passage_goes_from_texts_that_are_first_of_their_copies(spark):
    """A holds a passage, B holds it between other lines, and C copies B."""
    passage = "\n".join(f"passage line {i}" for i in range(4))
    b = f"one of b\n{passage}\ntwo of b"
    rows = [(1, f"own a\n{passage}\nend a"), (2, b), (3, b), (4, "\n".join(["same"] * 6))]
    left = {r.doc.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left == {1: rows[0][1], 2: "one of b\ntwo of b", 3: "", 4: "same\nsame\nsame"}


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(fps, radius):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ordered = sorted(fps)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_simhash_equals_brute_force(spark):
    docs = odd_documents(spark)
    rows = docs.collect()
    roots = reach({brute_fingerprint(r.text) for r in rows}, 4)
    groups = defaultdict(list)
    for r in rows:
        groups[roots[brute_fingerprint(r.text)]].append(r.doc_id)
    want = Counter()
    for r in rows:
        ids = [x for x in groups[roots[brute_fingerprint(r.text)]] if x is not None]
        want[(r.doc_id, brute_fingerprint(r.text), min(ids, default=None))] += 1
    got = simhash_groups(docs).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_spark_hashes_shingles_alike(spark):
    one = spark.sql("SELECT xxhash64('it was über all') AS h").collect()[0].h
    assert one % 2**64 == xxhash.xxh64_intdigest("it was über all".encode(), 42)


def near(rng, base, flips):
    for b in rng.sample(range(64), flips):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("block", [4, 8192])
def test_all_links_are_found_in_small_and_cut_buckets(spark, block, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr("logvigil.llm.simhash.BUCKET_SHARE", 1 << 30 if block == 4 else 4096)
    centres = [rng.getrandbits(64) for _ in range(30)]
    fps = {near(rng, c, rng.randrange(5)) for c in centres for _ in range(12)} | {0, 15, 2**64 - 1}
    table = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    links = fingerprint_links(table, block=block)
    pairs = [(r.a % 2**64, r.b % 2**64) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 4 * 12 for a, b in pairs)
    want, root = reach(fps, 4), {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {f: find(f) for f in fps} == want


def test_a_large_group_gives_few_links():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, dtype=np.uint64)
    one = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 700).astype(np.uint64)))
    a, b = close_links(np.zeros(len(one), int), one, 4)
    assert len(a) == len(one) - 1 and (b == one.min()).all() or len(set(b)) == 1


def test_fingerprint_of_a_long_text_in_parts():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 2**63, 400_001, dtype=np.uint64)
    bits = (h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    want = sum(1 << i for i in range(64) if 2 * int(bits[:, i].sum()) > len(h))
    assert fingerprints([h[:0], h, h[:1]]).tolist() == [0, want, int(h[0])]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(8, 40)] + [(5, 5), (300, 200), (250, 300)]
    got = components(spark.createDataFrame(links, "a long, b long"), work_folder(spark))
    assert {r.node: r.root for r in got.collect()} == (
        {i: 100 for i in range(100, 161)} | {x: 7 for x in range(7, 40)} | {5: 5, 200: 200, 250: 200, 300: 200}
    )
    assert got.select(F.count("*")).collect()[0][0] == 61 + 33 + 4
