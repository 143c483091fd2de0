"""Phrases whose words keep together: Toivonen mining by a sample, its negative border, and passes until closed."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logvigil.llm.common import byte_texts, slices, stored, work_folder

#: Occurrences of a candidate, its most words, and rows per language.
LEAST, WORDS, TOP = 100, 5, 2000
#: One document in SAMPLE is in the sample, where a phrase needs this share of the occurrences that its part of LEAST would be.
SAMPLE, LOWERED = 8, 0.4
#: Bits per phrase of a filter, and bits of the smallest and the largest one (16 MB), which tasks get with their code.
FILTER_RATE, LEAST_BITS, FILTER_BITS = 16, 1 << 20, 1 << 27
#: Bytes of text that are counted at once, and phrases that a task adds up before it passes them on.
SLICE, HELD = 4 << 20, 300_000

_END = b"\xff"
#: A to Z in lower case, a tab as a blank, and one mark for all characters that end a piece.
_MARKS = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if 10 <= b <= 13 or b in b".,;:!?" else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_COUNTS = "lang string, phrase string, k int, n long"


def numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words of all texts as numbers, 0 where a piece ends (no text holds the byte that stands there); names and hashes of the numbers."""
    ends = b" " + _END + b" "
    marked = _END + b" " + b"\n".join(texts).translate(_MARKS).replace(b"\n", ends) + ends
    found = pc.split_pattern(pa.array([marked], pa.large_binary()), b" ").values.dictionary_encode()
    names, ids = found.dictionary.to_pylist(), found.indices.to_numpy()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
    return ids[ids != names.index(b"")].astype(np.int64), names, hashes


def _mixed(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    h = (h ^ w) * _ODD
    return h ^ (h >> np.uint64(31))


class _Filter:
    """Whether a phrase may be in a set, by one bit of its hash: never a wrong no."""

    def __init__(self, ones: np.ndarray):
        self.ones, self.mask = ones, np.uint64(len(ones) * 64 - 1)

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.ones[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def filter_of(phrases: DataFrame) -> np.ndarray:
    """Bits of the hashes of a table of phrases, at most FILTER_BITS of them: 16 MB. A full filter costs time, not results."""
    bits = min(FILTER_BITS, max(LEAST_BITS, 1 << (FILTER_RATE * phrases.count()).bit_length()))
    bit = F.col("hash").bitwiseAND(F.lit(bits - 1).cast("long"))
    words = (
        phrases.select(F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("one"))
        .groupBy("word")
        .agg(F.bit_or("one").alias("ones"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("ones").to_numpy()
    return out.view(np.uint64)


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode()))


def _following(at: np.ndarray) -> np.ndarray:
    """Places i of ``at`` whose next start is the next word: the phrases there make one that is longer by a word."""
    return np.flatnonzero(at[1:] == at[:-1] + 1)


def hash_counts(
    texts: list[bytes], lang: str, lengths: range, known: _Filter | None, fresh: _Filter | None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the phrases of these lengths and how often they occur, overlaps included.

    Without filters, all phrases. With ``known``, all words, and longer phrases whose first k - 1 and last k - 1 words are
    both known: the known phrases and their negative border. With ``fresh`` too, only what holds a fresh phrase, at any distance: a part
    counts as known if it is shown here itself.
    """
    word, _, hashed = numbered(texts)
    at = np.flatnonzero(word)  # where the phrases of this length start
    h = _mixed(_seed(lang), hashed[word[at]])
    show = np.full(len(at), fresh is None)
    for k in range(1, lengths.stop):
        if k > 1:
            i = _following(at)
            if known is not None:
                have = known.may_have(h)
                if fresh is not None:
                    new = show | (have & fresh.may_have(h))
                    have |= show
                i = i[have[i] & have[i + 1]]
            show = np.ones(len(i), bool) if fresh is None else new[i] | new[i + 1]
            at = at[i]
            h = _mixed(h[i], hashed[word[at + k - 1]])
        if k in lengths and show.any():
            yield np.unique(h[show], return_counts=True)


def phrase_counts(texts: list[bytes], lang: str, most: int, only: _Filter) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """For each length: the phrases in the filter and how often they occur. The empty phrase has the number of all words.

    Phrases are told apart by whole numbers that stand for them, never by hash. The parts of a phrase in the filter are in it too.
    """
    word, terms, hashed = numbered(texts)
    at = np.flatnonzero(word)
    if not len(at):
        return
    yield [b""], np.array([len(at)])
    phrase, base = word[at], len(hashed)  # the number of the phrase at each start
    hashes = _mixed(np.full(base, _seed(lang)), hashed)
    for k in range(1, most + 1):
        have = only.may_have(hashes)
        if k > 1:
            i = _following(at)
            i = i[have[phrase[i]] & have[phrase[i + 1]]]
            left, at = phrase[i], at[i]
            last = word[at + k - 1]
            _, where, phrase = np.unique(left * base + last, return_index=True, return_inverse=True)
            hashes = _mixed(hashes[left[where]], hashed[last[where]])
            phrase, have = phrase.reshape(-1), only.may_have(hashes)
        if not len(at):
            return
        times = np.bincount(phrase, minlength=len(hashes))
        first = np.zeros(len(hashes), np.int64)
        first[phrase] = at
        shown = np.flatnonzero(have & (times > 0))
        columns = [word[first[shown] + j].tolist() for j in range(k)]
        yield [b" ".join([terms[w] for w in words]) for words in zip(*columns)], times[shown]


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    for arrow in slices(batches, "text", SLICE):
        langs: dict[str, list[bytes]] = {}
        for lang, text in zip(arrow.column("lang").to_pylist(), byte_texts(arrow.column("text"))):
            langs.setdefault(lang, []).append(text)
        yield from langs.items()


def _hash_rows(lengths: range, known: np.ndarray | None, fresh: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [None if f is None else _Filter(f) for f in (known, fresh)]
        for lang, texts in _by_lang(batches):
            for hashes, times in hash_counts(texts, lang, lengths, *filters):
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(times.astype(np.int64))], names=["hash", "n"])

    return run


def _phrase_rows(most: int, only: np.ndarray):
    def rows_of(held: dict[str, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            columns = [
                pa.array([lang] * len(counts), pa.string()),
                pa.array(list(counts), pa.binary()).cast(pa.string()),
                pa.array([p.count(b" ") + 1 if p else 0 for p in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "k", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, int]] = {}
        for lang, texts in _by_lang(batches):
            counts = held.setdefault(lang, {})
            for names, times in phrase_counts(texts, lang, most, _Filter(only)):
                for name, n in zip(names, times.tolist()):
                    counts[name] = counts.get(name, 0) + n
            if sum(map(len, held.values())) > HELD:
                yield from rows_of(held)
                held = {}
        yield from rows_of(held)

    return run


def _frequent_hashes(
    texts: DataFrame, lengths: range, least: int, known: np.ndarray | None = None, fresh: np.ndarray | None = None
) -> DataFrame:
    """(hash, n): hashes whose phrases occur that often. Two phrases of one hash add up, so no frequent one is lost."""
    rows = texts.mapInArrow(_hash_rows(lengths, known, fresh), "hash long, n long")
    return rows.groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _frequent(texts: DataFrame, hashes: DataFrame, least: int, most: int) -> DataFrame:
    """(lang, phrase, k, n): exact counts of the phrases with these hashes, as texts."""
    rows = texts.mapInArrow(_phrase_rows(most, filter_of(hashes)), _COUNTS)
    return rows.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _first_words(words: Column) -> Column:
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), words.cast("int"))


def _last_words(words: Column) -> Column:
    return _first_words(-words)


def _proposed(drawn: DataFrame, floor: int, most: int, folder: str) -> DataFrame:
    """Hashes of the phrases that are frequent in the sample, length by length."""
    found = stored(_frequent_hashes(drawn, range(1, 3), floor), folder, "sample-2")
    for k in range(3, most + 1):
        more = stored(_frequent_hashes(drawn, range(k, k + 1), floor, filter_of(found)), folder, f"sample-{k}")
        if more.isEmpty():
            break
        found = found.unionByName(more)
    return found


def frequent_phrases(
    texts: DataFrame, folder: str, least: int = LEAST, most: int = WORDS, sample: int = SAMPLE, lowered: float = LOWERED
) -> DataFrame:
    """(lang, phrase, k, n): phrases of up to ``most`` words that occur ``least`` times or more in all texts (id, lang, text).

    Rows with k = 0 hold the words of a language. The sample proposes phrases at a lowered threshold. One full pass counts them and
    their negative border, which are the phrases that aren't proposed but whose parts are. Border phrases that turn
    out frequent were missed by the sample, and a further pass counts what they make up, through all lengths at once. That closes the set: a
    frequent phrase without a missed one inside has parts that are all proposed, so the first pass counted it; one with a missed one
    inside is counted here, since each part of it is frequent and so either known or counted here too.

    Passes count by hash, which finds all frequent phrases and few others; these are then counted once more as texts. Filters
    only let more through than they should, so every count is whole and exact.
    """
    drawn = texts.filter(F.pmod(F.xxhash64("id", "text"), F.lit(sample)) == 0).select("lang", "text")
    texts = texts.select("lang", "text")
    proposed = _proposed(stored(drawn, folder, "sample"), max(2, int(lowered * least / sample)), most, folder)
    known = stored(_frequent_hashes(texts, range(1, most + 1), least, filter_of(proposed)), folder, "known")
    missed = stored(known.join(proposed.select("hash"), "hash", "left_anti"), folder, "missed")
    if not missed.isEmpty():
        more = _frequent_hashes(texts, range(2, most + 1), least, filter_of(known), filter_of(missed))
        known = known.unionByName(stored(more, folder, "expanded"))
    return stored(_frequent(texts, known, least, most), folder, "counts")


def phrase_scores(counts: DataFrame) -> DataFrame:
    """(lang, phrase, k, a, l, r, n, score) of all frequent phrases of two words and more, at their lowest cut."""
    known = counts.filter("k > 0")
    whole = counts.filter("k = 0").select("lang", F.col("n").alias("words"))
    cuts = known.filter("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"head": _first_words(F.col("cut")), "tail": _last_words(F.col("k") - F.col("cut"))})
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(16,0)")

    # 1000 * a * n in 38 digits: counts of up to 10^16 words, some 50 PB of text.
    above = F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("words")
    score = F.call_function("div", above, exact("l") * exact("r")).cast("long")
    rows = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(whole, "lang")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("lowest")
    return (
        rows.groupBy("lang", "phrase", "k", "a", F.col("words").alias("n"))
        .agg(lowest)
        .select("lang", "phrase", "k", "a", "lowest.l", "lowest.r", "n", "lowest.score")
    )


def collocations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    most: int = WORDS,
    top: int = TOP,
    sample: int = SAMPLE,
    lowered: float = LOWERED,
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language whose words keep together.

    Texts are lower-cased (A to Z), split into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at blanks and tabs.
    Candidates have 2 to ``most`` words and occur a >= ``least`` times within pieces. Cut after some words, a candidate scores
    floor(1000 * a * n / (l * r)) with l and r the occurrences of both parts and n the words of the language; the lowest cut counts,
    of equal ones the first. A candidate that always lies in a longer candidate is dropped. Ranks are by score, then a, then phrase in byte order.

    Counts come from ``frequent_phrases``, so they are exact whatever the sample is; products are decimals. A phrase inside a longer one of
    equal count lies in one that is longer by one word with that count too, so only those are looked at.

    NULL text counts as empty, NULL lang as "und". Rows that repeat an id are documents of their own. Other columns
    are ignored; no rows give no rows. Texts may be of any length.
    """
    folder = work_folder(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("string").alias("id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    counts = frequent_phrases(texts, folder, least, most, sample, lowered)
    scores = stored(phrase_scores(counts), folder, "scores")
    longer = scores.filter("k > 2").select(
        "lang", "a", F.explode(F.array(_first_words(F.col("k") - 1), _last_words(F.col("k") - 1))).alias("phrase")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    per_lang = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    return (
        scores.join(longer, ["lang", "phrase"], "left")
        .filter("longer IS NULL OR longer < a")
        .withColumn("rank", F.row_number().over(per_lang))
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
