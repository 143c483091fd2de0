"""An n-gram model in Elias-Fano tries, trained and queried by Spark tasks."""

import functools
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.llm.common import byte_texts, slices, stored, work_folder
from logvigil.llm.elias_fano import EliasFano
from logvigil.llm.shared_files import get, put

DISCOUNT, LEAST_TRIGRAM = 0.75, 1
#: Bytes of text that numpy counts at once; words per vocabulary part and tokens per trie, about.
BATCH, VOCABULARY_PART, TRIE_TOKENS = 8 << 20, 1 << 20, 3_000_000
_END = b" "  # no word holds a space
_HASH = (1 << 62) - 1


def numbered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the texts, each with its end, as numbers; hashes of the numbered words; tokens per text."""
    ids: defaultdict = defaultdict(count().__next__)
    end, parts = ids[_END], []
    for text in texts:
        words = text.lower().split()
        words.append(_END)
        parts.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
    assert end == 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) & _HASH for w in ids), np.int64, len(ids))
    lengths = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts) if parts else np.empty(0, np.int64), hashes, lengths


def _unigram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for arrow in slices(batches, "text", BATCH):
        tokens, hashes, _ = numbered(byte_texts(arrow.column("text")))
        counts = np.bincount(tokens, minlength=len(hashes))
        yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(counts)], names=["h", "c"])


@dataclass(frozen=True)
class Plan:
    """Where the model is, and its few global numbers."""

    folder: str
    parts: int  # of the vocabulary, a power of two
    offsets: tuple  # first id of each part
    words: int
    tokens: int
    texts: int
    tries: int

    @property
    def start(self) -> int:
        """The id of the place before a text."""
        return self.words

    @property
    def radix(self) -> int:
        return self.words + 1

    def part(self, h):
        return h >> (62 - self.parts.bit_length() + 1)

    def trie(self, pair: np.ndarray) -> np.ndarray:
        x = pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % self.tries


class Vocabulary:
    """First level: hash to id and count. Hashes, and sums of counts, are monotone sequences."""

    def __init__(self, plan: Plan):
        self.plan = plan

    @functools.lru_cache(None)  # noqa: B019
    def _part(self, g: int) -> tuple[EliasFano, EliasFano]:
        arrays, facts = get(self.plan.folder, f"words-{g}")
        return EliasFano(arrays, "hash", facts), EliasFano(arrays, "sum", facts)

    @functools.lru_cache(None)  # noqa: B019
    def _left_over(self, g) -> np.ndarray:
        return get(self.plan.folder, f"left-{g}")[0]["left"]

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id, or -1, and count of each hash."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for g, who in _by(self.plan.part(hashes)):
            words, sums = self._part(g)
            at = words.find(hashes[who] - (g << (62 - self.plan.parts.bit_length() + 1)))
            known = at >= 0
            who, at = who[known], at[known]
            ids[who] = at + self.plan.offsets[g]
            counts[who] = sums[at + 1] - sums[at]
        return ids, counts

    def _each(self, ids: np.ndarray, read, start: float) -> np.ndarray:
        out = np.full(len(ids), start, np.float64)
        inner = np.flatnonzero(ids < self.plan.words)
        part = np.searchsorted(np.array(self.plan.offsets), ids[inner], side="right") - 1
        for g, who in _by(part):
            out[inner[who]] = read(g, ids[inner[who]] - self.plan.offsets[g])
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Counts of words; the place before a text counts once per text."""

        def read(g, at):
            sums = self._part(g)[1]
            return sums[at + 1] - sums[at]

        return self._each(ids, read, self.plan.texts)

    def left_over(self, ids: np.ndarray) -> np.ndarray:
        """What the pairs of a first word leave to the level below."""
        return self._each(ids, lambda g, at: self._left_over(g)[at], float(self._left_over("start")[0]))


def _by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key and the places that have it."""
    order = np.argsort(keys, kind="stable")
    edges = np.flatnonzero(np.diff(keys[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(keys)]):
        yield int(keys[order[a]]), order[a:b]


def _vocabulary_part(folder: str, shift: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h")
        h, c = pdf["h"].to_numpy(), pdf["c"].to_numpy()
        g = int(h[0] >> shift)
        arrays, facts = EliasFano.build(h - (g << shift), "hash")
        sums, more = EliasFano.build(np.concatenate([[0], np.cumsum(c)]), "sum")
        put(folder, f"words-{g}", arrays | sums, facts | more)
        return pd.DataFrame({"g": [g], "words": [len(h)], "tokens": [int(c.sum())]})

    return run


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64)[:, 0]


def contexts(tokens: np.ndarray, lengths: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word before each token, the place of that word's token or -1 at the start of a text, and which text it is in."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    before = np.concatenate([[start], tokens[:-1]])
    place = np.arange(len(tokens)) - 1
    before[first], place[first] = start, -1
    return before, place, owner


def _ngram_rows(plan: Plan):
    """Counts of pairs and triples of one slice of texts, combined, sorted and squeezed, a row for each trie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(plan)
        for arrow in slices(batches, "text", BATCH):
            tokens, hashes, lengths = numbered(byte_texts(arrow.column("text")))
            tokens = vocabulary.look_up(hashes)[0][tokens]
            before, place, _ = contexts(tokens, lengths, plan.start)
            pairs, which, pair_counts = np.unique(before * plan.radix + tokens, return_inverse=True, return_counts=True)
            inner = np.flatnonzero(place >= 0)
            triples, triple_counts = np.unique(which[place[inner]] * plan.radix + tokens[inner], return_counts=True)
            of, word = np.divmod(triples, plan.radix)
            trie = plan.trie(pairs)
            triple_trie = trie[of]
            rows = []
            for s, who in _by(trie):
                mine = np.flatnonzero(triple_trie == s)
                at = np.searchsorted(who, of[mine])
                rows.append((s, *map(_squeezed, (np.diff(pairs[who], prepend=0), pair_counts[who], np.diff(at, prepend=0), word[mine], triple_counts[mine]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*rows)], names=["trie", "pairs", "pair_counts", "of", "word", "triple_counts"]
            )

    return run


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    edges = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[edges], np.add.reduceat(counts, edges) if len(edges) else counts[:0]


def quantised(p: np.ndarray) -> tuple[np.ndarray, list[float]]:
    """log10 of each p in 256 equal steps, and the scale."""
    x = np.log10(np.clip(p, 1e-12, 1.0))
    low = float(x.min()) if len(x) else 0.0
    step = max((float(x.max()) - low) / 255, 1e-9) if len(x) else 1.0
    return np.round((x - low) / step).astype(np.uint8), [low, step]


def _trie(plan: Plan, discount: float, least: int):
    """Builds one trie: first words, their successors, and the successors of pairs, with pointers from level to level."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [[_unsqueezed(pdf[c].iloc[i]) for c in ("pairs", "pair_counts", "of", "word", "triple_counts")] for i in range(len(pdf))]
        pairs, pair_counts = _merged(np.concatenate([np.cumsum(p[0]) for p in parts]), np.concatenate([p[1] for p in parts]))
        context = np.concatenate([np.searchsorted(pairs, np.cumsum(p[0]))[np.cumsum(p[2])] for p in parts])
        triples, triple_counts = _merged(context * plan.radix + np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts]))
        first, root, followers = np.unique(pairs // plan.radix, return_inverse=True, return_counts=True)
        total = Vocabulary(plan).counts(first)
        share = np.maximum(pair_counts - discount, 1e-9) / total[root]
        of = triples // plan.radix
        of_total = np.bincount(of, triple_counts, len(pairs))
        keep = triple_counts >= least
        triples, triple_counts, of = triples[keep], triple_counts[keep], of[keep]
        share3 = (triple_counts - discount) / of_total[of]
        left = 1 - np.bincount(of, share3, len(pairs))
        arrays, facts = {}, {}
        for name, values in (
            ("first", first),
            ("second", root * plan.radix + pairs % plan.radix),
            ("pointers", np.searchsorted(of, np.arange(len(pairs) + 1))),
            ("third", triples),
        ):
            more, fact = EliasFano.build(values, name)
            arrays |= more
            facts |= fact
        for name, p in (("p2", share), ("p3", share3)):
            arrays[name], facts[name] = quantised(p)
        codes, facts["left3"] = quantised(np.append(left, 1.0))  # so that the last code is that of 1 in every trie
        arrays["left3"] = codes[:-1]
        put(plan.folder, f"trie-{int(pdf['trie'].iloc[0])}", arrays, facts)
        return pd.DataFrame({"w": first, "followers": followers})

    return run


def _left_part(plan: Plan, discount: float):
    """Stores, for the words of a vocabulary part, what their pairs leave to the level below."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        g = int(pdf["g"].iloc[0])
        ids, followers = pdf["w"].to_numpy(), pdf["followers"].to_numpy()
        left = discount * followers / Vocabulary(plan).counts(ids)
        if g < 0:
            put(plan.folder, "left-start", {"left": left.astype(np.float32)}, {})
        else:
            end = plan.offsets[g + 1] if g + 1 < len(plan.offsets) else plan.words
            whole = np.ones(end - plan.offsets[g], np.float32)
            whole[ids - plan.offsets[g]] = left
            put(plan.folder, f"left-{g}", {"left": whole}, {})
        return pd.DataFrame({"g": [g]})

    return run


class Trie:
    """One mapped trie."""

    def __init__(self, plan: Plan, s: int):
        arrays, facts = get(plan.folder, f"trie-{s}")
        self.radix = plan.radix
        self.first, self.second, self.pointers, self.third = (EliasFano(arrays, n, facts) for n in ("first", "second", "pointers", "third"))
        self.p = {n: (arrays[n], facts[n]) for n in ("p2", "p3", "left3")}

    def value(self, name: str, at: np.ndarray) -> np.ndarray:
        codes, (low, step) = self.p[name]
        return 10 ** (low + step * np.arange(256))[codes[at]]

    def pairs(self, first: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of pairs in the second level, or -1: the successor of the word among those of the first word."""
        words, back = np.unique(first, return_inverse=True)
        root = self.first.find(words)[back]
        return np.where(root >= 0, self.second.find(np.where(root >= 0, root * self.radix + word, -1)), -1)

    def open(self, pair: np.ndarray) -> np.ndarray:
        """Whether a pair has successors, by its pointers; one that leaves all to the level below has none."""
        codes = self.p["left3"][0][pair]
        out = np.zeros(len(pair), bool)
        if self.third.n:
            maybe = np.flatnonzero(codes < 255)
            out[maybe] = self.pointers[pair[maybe] + 1] > self.pointers[pair[maybe]]
        return out

    def triples(self, pair: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places in the third level, or -1: the successor of the word among those of the pair."""
        return self.third.find(pair * self.radix + word)


class Model:
    """Scores texts with mapped levels."""

    def __init__(self, plan: Plan, discount: float = DISCOUNT):
        self.plan, self.discount, self.vocabulary = plan, discount, Vocabulary(plan)

    @functools.lru_cache(None)  # noqa: B019
    def trie(self, s: int) -> Trie:
        return Trie(self.plan, s)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Discounted share, and an even share of the rest among all words and one unknown."""
        plan = self.plan
        if not plan.tokens:
            return np.ones(len(counts))
        rest = self.discount * plan.words / plan.tokens
        return np.maximum(counts - self.discount, 0) / plan.tokens + rest / (plan.words + 1)

    def probabilities(self, ids: np.ndarray, p1: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of each token after the two before it; ids of unknown words are -1."""
        plan = self.plan
        if not plan.tokens or not len(ids):
            return p1
        before, place, _ = contexts(ids, lengths, plan.start)
        known = np.flatnonzero((before >= 0) & (ids >= 0))
        pairs, which = np.unique(before[known] * plan.radix + ids[known], return_inverse=True)
        pair_place, p2, trie = np.full(len(pairs), -1, np.int64), np.zeros(len(pairs)), plan.trie(pairs)
        for s, who in _by(trie):
            at = self.trie(s).pairs(*np.divmod(pairs[who], plan.radix))
            hit = at >= 0
            pair_place[who[hit]], p2[who[hit]] = at[hit], self.trie(s).value("p2", at[hit])
        share = np.zeros(len(ids))
        share[known] = p2[which]
        left = np.ones(len(ids))
        contexts_known = np.flatnonzero(before >= 0)
        words, back = np.unique(before[contexts_known], return_inverse=True)
        left[contexts_known] = self.vocabulary.left_over(words)[back]
        p = share + left * p1
        token_place, token_trie = np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
        token_place[known], token_trie[known] = pair_place[which], trie[which]
        deep = np.flatnonzero(place >= 0)
        deep = deep[token_place[place[deep]] >= 0]
        for s, who in _by(token_trie[place[deep]]):
            t, at = self.trie(s), deep[who]
            pair = token_place[place[at]]
            is_open = t.open(pair)
            at, pair = at[is_open], pair[is_open]
            found = t.triples(pair, np.where(ids[at] >= 0, ids[at], plan.words))
            extra = np.zeros(len(at))
            extra[found >= 0] = t.value("p3", found[found >= 0])
            p[at] = extra + t.value("left3", pair) * p[at]
        return p

    def scores(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, base and model log10 probability."""
        plan = self.plan
        tokens, hashes, lengths = numbered(texts)
        ids, counts = self.vocabulary.look_up(hashes) if plan.tokens else (np.full(len(hashes), -1), np.zeros(len(hashes), np.int64))
        p = self.probabilities(ids[tokens], self.unigram(counts)[tokens], lengths)
        owner = np.repeat(np.arange(len(texts)), lengths)
        base = np.log10((counts + 1) / (plan.tokens + plan.words + 1))
        total = lambda x: np.bincount(owner, x, len(texts))
        return {
            "n_tokens": lengths,
            "n_known": total(counts[tokens] > 0).astype(np.int64),
            "base_score": total(base[tokens]),
            "score": total(np.log10(np.minimum(p, 1.0))),
        }


def train(
    texts: DataFrame, text_col: str = "text", discount: float = DISCOUNT, least_trigram: int = LEAST_TRIGRAM,
    vocabulary_part: int = VOCABULARY_PART, trie_tokens: int = TRIE_TOKENS,
) -> Plan:
    """Counts words, pairs and triples of all texts and writes the model's levels to the shared folder.

    Probabilities are interpolated with absolute discounting: what triples seen fewer than
    ``least_trigram`` times, and the discount, leave goes to the level below. Counts are combined per
    slice of text, and each trie and vocabulary part is built by one task from a share of hashed keys; their
    number grows with the input, so no task grows. A frequent first word is spread over all tries by
    its pairs. The driver gets one row per vocabulary part.

    NULL texts are empty: an end alone. No texts give a model without words.
    """
    folder = work_folder(texts.sparkSession)
    source = texts.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = stored(
        source.mapInArrow(_unigram_rows, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), folder, "counts"
    )
    words = counts.count()
    parts = 1 << max(0, math.ceil(math.log2(max(1, words) / vocabulary_part)))
    shift = 62 - parts.bit_length() + 1
    facts = (
        counts.groupBy(F.shiftright("h", shift).alias("g"))
        .applyInPandas(_vocabulary_part(f"{folder}/model", shift), "g long, words long, tokens long")
        .orderBy("g")
        .collect()
    )
    found = {r["g"]: r for r in facts}
    sizes = [found[g]["words"] if g in found else 0 for g in range(parts)]
    tokens = sum(r["tokens"] for r in facts)
    end = counts.filter(F.col("h") == xxhash.xxh64_intdigest(_END) & _HASH).collect()
    plan = Plan(
        f"{folder}/model", parts, tuple(np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int).tolist()), words, tokens,
        end[0]["c"] if end else 0, max(1, -(-tokens // trie_tokens)),
    )
    if not tokens:
        return plan
    rows = source.mapInArrow(
        _ngram_rows(plan), "trie long, pairs binary, pair_counts binary, of binary, word binary, triple_counts binary"
    )
    followers = stored(
        rows.groupBy("trie").applyInPandas(_trie(plan, discount, least_trigram), "w long, followers long"), folder, "followers"
    )
    bounds = F.array(*[F.lit(o).cast("long") for o in plan.offsets])
    part = F.when(F.col("w") == plan.start, F.lit(-1)).otherwise(F.size(F.filter(bounds, lambda o: o <= F.col("w"))) - 1)
    lefts = followers.groupBy("w").agg(F.sum("followers").alias("followers")).withColumn("g", part)
    lefts.groupBy("g").applyInPandas(_left_part(plan, discount), "g long").count()
    return plan


def _score(plan: Plan, discount: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(plan, discount)
        for arrow in slices(batches, "_text", BATCH):
            found = model.scores(byte_texts(arrow.column("_text")))
            yield pa.RecordBatch.from_arrays(
                [arrow.column("doc"), *[pa.array(found[n]) for n in ("n_tokens", "n_known", "base_score", "score")]],
                names=["doc", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def lm_scores(docs: DataFrame, plan: Plan, text_col: str = "text", discount: float = DISCOUNT) -> DataFrame:
    """One row per document: doc (all its columns but the text), n_tokens, n_known, base_score, score.

    Words are runs of bytes other than ASCII white space, A to Z lower-cased, and each text has an end. ``base_score`` is exact: counts
    are in the vocabulary level. NULL and empty texts are an end alone. Repeated rows get equal scores; no rows give none. A model
    without words gives score 0.
    """
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("doc"), F.col(text_col).cast("string").alias("_text"))
    schema = rows.select("doc").schema.add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")
    return rows.mapInArrow(_score(plan, discount), schema)
