"""Personal data: fixed patterns, and a linear-chain conditional random field that adds to them."""

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.llm.common import slices
from logvigil.llm.pii_table import LABELLED_LINES

# Kinds in order, and the pattern of each.
KINDS = ("email", "ip", "card", "phone")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The first two again, for texts with very long runs of their characters: the domain alone, the characters before
# it, and an address that starts where its digits do.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP_RUN = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")

Span = tuple[int, int, int]  # kind, start, end in code points, end exclusive
FEATURES, LABELS = 1 << 12, 1 + len(KINDS)
#: Distinct tokens that a worker remembers; beyond, it starts afresh.
TOKENS_KEPT = 1 << 19
_TRIM = ".,;:!?\"'»«"


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of _EMAIL, in time linear in the text.

    No character but "@" parts a match in two, so a match is a domain and all that may stand before its "@", back to the
    "@" or the match before.
    """
    end = before = 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        least = max(end, before, text.rfind("@", before, at) + 1)
        start = least + len(text[least:at].rstrip(_LOCAL))
        before = at + 1
        if start < at:
            end = m.end()
            yield start, end


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, leftmost and without overlap within a kind."""
    found = []
    if "@" in text:
        found += [(0, *span) for span in emails(text)]
    found += [(1, *m.span()) for m in _IP_RUN.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return found


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


# The model


# Shapes: 9 for digits, X for capitals, x for other letters and all beyond ASCII.
_CLASSES = bytes(
    57 if 48 <= b < 58 else 88 if 65 <= b < 91 else 120 if 97 <= b < 123 or b > 127 else b for b in range(256)
)


def signature(word: str, known: frozenset) -> tuple[bytes, str]:
    """All that the features of a word depend on: its letters' classes, and the word if the table has it."""
    low = word.lower().strip(_TRIM)
    return word.encode("utf-8", "replace").translate(_CLASSES), low if low in known else ""


@lru_cache(1 << 16)
def _features(classes: bytes, known: str) -> tuple[tuple, tuple, tuple]:
    """Hashed features for the label of the word, of the next word, and of the word before."""
    chars = classes.decode("ascii")
    shape = re.sub(r"(.)\1+", r"\1+", chars)
    seen = [f"s={shape}", f"d={min(chars.count('9'), 20)}", f"w={known}"]
    own = [*seen, "1", f"n={min(len(chars), 25)}", f"@={'@' in chars}", f"p={sorted(set(shape) - set('9Xx+'))}", f"b={shape[:2]}", f"e={shape[-2:]}", f".={chars.count('.')}"]
    number = lambda names, place: tuple(zlib.crc32(f"{place}{x}".encode()) % FEATURES for x in names)
    return number(own, "o"), number(seen, "l"), number(seen, "r")


def _label_lines(table: str) -> list[tuple[list[str], list[int]]]:
    """Words and labels of the labelled table."""
    out = []
    for line in table.split("\n"):
        words, labels = [], []
        for part in re.split(r"(\[(?:email|ip|card|phone) (?:[^\[\]]|\[(?:at|dot)\])+\])", line):
            m = re.fullmatch(r"\[(email|ip|card|phone) (.+)\]", part)
            new = (m[2] if m else part).split()
            if not m and words and labels[-1] and new and not part[:1].isspace():
                words[-1] += new.pop(0)  # punctuation that follows a span
            words += new
            labels += [KINDS.index(m[1]) + 1 if m else 0] * len(new)
        out.append((words, labels))
    return out


@dataclass(frozen=True)
class Crf:
    weights: np.ndarray  # features x labels
    moves: np.ndarray  # label x next label
    starts: np.ndarray

    known: frozenset  # the words of the labelled table


def viterbi(emissions: np.ndarray, lengths: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Best labels of a group of sequences, (sequence, time, labels) padded at the end."""
    arrow, time, labels = emissions.shape
    best = starts + emissions[:, 0]
    back = np.zeros((time, arrow, labels), np.int8)
    back[:] = np.arange(labels)
    for t in range(1, time):
        n = int(np.searchsorted(-lengths, -t, side="left"))  # sequences come longest first
        paths = best[:n, :, None] + moves
        came = paths.argmax(1)
        back[t, :n] = came
        best[:n] = np.take_along_axis(paths, came[:, None], 1)[:, 0] + emissions[:n, t]
    out = np.zeros((arrow, time), np.int8)
    state = best.argmax(1)
    for t in reversed(range(time)):
        out[:, t] = state
        state = back[t, np.arange(arrow), state]
    return out


def train_crf(table: str = LABELLED_LINES, rounds: int = 250, rate: float = 0.1, decay: float = 1e-3) -> Crf:
    """Maximum likelihood on the labelled table by forward and backward sums, with Adagrad steps."""
    lines = sorted(_label_lines(table), key=lambda x: -len(x[0]))
    n, time = len(lines), len(lines[0][0])
    lengths = np.array([len(w) for w, _ in lines])
    known = frozenset(w.lower().strip(_TRIM) for words, _ in lines for w in words)
    feats: list[tuple[int, int, int]] = []
    gold = np.zeros((n, time), np.int64)
    for i, (words, labels) in enumerate(lines):
        gold[i, : len(labels)] = labels
        numbers = [_features(*signature(w, known)) for w in words]
        for t, (own, right, left) in enumerate(numbers):
            feats += [(i, t, f) for f in own]
            if t + 1 < len(words):
                feats += [(i, t + 1, f) for f in right]
            if t:
                feats += [(i, t - 1, f) for f in left]
    at_i, at_t, at_f = np.array(feats).T
    mask = np.arange(time) < lengths[:, None]
    eye = np.eye(LABELS)
    params = [np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)]
    history = [np.full_like(p, 1e-8) for p in params]
    want_moves = np.einsum("ntk,ntl->kl", eye[gold][:, :-1] * mask[:, 1:, None], eye[gold][:, 1:] * mask[:, 1:, None])
    for _ in range(rounds):
        w, moves, starts = params
        e = np.zeros((n, time, LABELS))
        np.add.at(e, (at_i, at_t), w[at_f])
        forward, back = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = starts + e[:, 0]
        for t in range(1, time):
            new = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + e[:, t]
            forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        for t in reversed(range(time - 1)):
            new = np.logaddexp.reduce(moves + (e[:, t + 1] + back[:, t + 1])[:, None], axis=2)
            back[:, t] = np.where(mask[:, t + 1, None], new, back[:, t + 1])
        share = np.exp(forward + back - total[:, None, None]) * mask[:, :, None]
        pairs = forward[:, :-1, :, None] + moves + (e + back)[:, 1:, None]
        have_moves = (np.exp(pairs - total[:, None, None, None]) * mask[:, 1:, None, None]).sum((0, 1))
        wrong = eye[gold] * mask[:, :, None] - share
        grad_w = np.zeros_like(w)
        np.add.at(grad_w, at_f, wrong[at_i, at_t])
        for p, h, g in zip(params, history, (grad_w, want_moves - have_moves, wrong[:, 0].sum(0))):
            g = g - decay * n * p
            h += g * g
            p += rate * g / np.sqrt(h)
    return Crf(*[p.astype(np.float32) for p in params], known)


class Tagger:
    """Finds spans with a trained field. Words are looked up once and decoded in batches of lines."""

    def __init__(self, crf: Crf, arrow: int = 1 << 16):
        self.crf, self.arrow = crf, arrow
        self.forget()

    def forget(self) -> None:
        self.ids: defaultdict[str, int] = defaultdict(lambda: len(self.ids))
        self.kinds: dict[tuple, int] = {}
        self.kind_of = np.zeros(0, np.int32)
        self.tables = [np.zeros((0, LABELS), np.float32)] * 3

    def _learn(self) -> None:
        """Scores of words not met before; words with equal features share a row."""
        new, seen = [], len(self.kinds)
        for word in islice(self.ids, len(self.kind_of), None):
            new.append(self.kinds.setdefault(signature(word, self.crf.known), len(self.kinds)))
        self.kind_of = np.concatenate([self.kind_of, np.array(new, np.int32)])
        if fresh := [_features(*k) for k in islice(self.kinds, seen, None)]:
            self.tables = [
                np.concatenate([t, np.stack([self.crf.weights[list(k[j])].sum(0) for k in fresh])])
                for j, t in enumerate(self.tables)
            ]

    def labels(self, lines: list[list[str]]) -> list[np.ndarray]:
        """Labels of the words of each line; lines aren't empty."""
        if len(self.ids) > TOKENS_KEPT:
            self.forget()
        numbers = [np.fromiter(map(self.ids.__getitem__, x), np.int64, len(x)) for x in lines]
        self._learn()
        out: list = [None] * len(lines)
        order = sorted(range(len(lines)), key=lambda i: -len(lines[i]))
        own, right, left = self.tables
        while order:
            time = len(lines[order[0]])
            take = max(1, self.arrow // time)
            part, order = order[:take], order[take:]
            lengths = np.array([len(lines[i]) for i in part])
            ids = self.kind_of[np.concatenate([numbers[i] for i in part])]
            row = np.repeat(np.arange(len(part)), lengths)
            col = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            e = np.zeros((len(part), time, LABELS), np.float32)
            e[row, col] = own[ids]
            inner = np.flatnonzero(col)
            e[row[inner], col[inner]] += right[ids[inner - 1]]
            e[row[inner - 1], col[inner - 1]] += left[ids[inner]]
            best = viterbi(e, lengths, self.crf.moves, self.crf.starts)
            for i, labels, n in zip(part, best, lengths):
                out[i] = labels[:n]
        return out

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """Per text, the spans of each run of words with one label, without outer punctuation."""
        where, lines = [], []
        for i, text in enumerate(texts):
            at = 0
            for line in text.split("\n"):
                if words := line.split():
                    where.append((i, at, line))
                    lines.append(words)
                at += len(line) + 1
        found: list[list[Span]] = [[] for _ in texts]
        for (i, at, line), labels in zip(where, self.labels(lines)):
            if not labels.any():
                continue
            places = _places(line)
            t = 0
            while t < len(labels):
                end = t + 1
                if labels[t]:
                    while end < len(labels) and labels[end] == labels[t]:
                        end += 1
                    a, b = places[t][0], places[end - 1][1]
                    while a < b and line[a] in _TRIM:
                        a += 1
                    while a < b and line[b - 1] in _TRIM:
                        b -= 1
                    if a < b:
                        found[i].append((int(labels[t]) - 1, at + a, at + b))
                t = end
        return found


def _places(line: str) -> list[tuple[int, int]]:
    """Start and end of each word, as str.split() cuts them."""
    out, at = [], 0
    for word in line.split():
        at = line.index(word, at)
        out.append((at, at + len(word)))
        at += len(word)
    return out


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """Per text: base spans, and those with what the field adds beside them."""
    out = []
    for text, more in zip(texts, tagger.spans(texts)):
        base = base_spans(text)
        added = [s for s in more if all(s[2] <= a or s[1] >= b for _, a, b in base)]
        out.append((base, sorted(base + added)))
    return out


def redacted(text: str, spans: list[Span]) -> str:
    """The text with [KIND] for each span; of overlapping spans the one that starts first, then the longest."""
    parts, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            parts += [text[at:a], f"[{KINDS[kind].upper()}]"]
            at = b
        elif b > at:
            at = b
    return "".join([*parts, text[at:]])


def _find(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model.value)
        for arrow in slices(batches, "_text"):
            texts = [t or "" for t in arrow.column("_text").to_pylist()]
            found = all_spans(texts, tagger)
            counts = [[sum(k == kind for k, _, _ in base) for base, _ in found] for kind in range(len(KINDS))]
            names = [n for n in arrow.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[arrow.column(n) for n in names],
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([spans_text(base) for base, _ in found], pa.string()),
                    pa.array([spans_text(every) for _, every in found], pa.string()),
                    pa.array([redacted(t, every) if every else None for t, (_, every) in zip(texts, found)], pa.string()),
                ],
                names=[*names, *[f"n_{k}" for k in KINDS], "base", "spans", "redacted"],
            )

    return run


def personal_data(docs: DataFrame, text_col: str = "text", crf: Crf | None = None) -> DataFrame:
    """One row per document: doc (all its columns), n_email, n_ip, n_card, n_phone, base, spans, redacted.

    The counts and ``base`` are of the fixed patterns. The field is trained on a table of some sixty labelled lines and
    decodes every line of every text; its spans are added where they touch no base span. ``redacted`` is the
    text with [KIND] in place of each span, or NULL where there is none.

    NULL text counts as empty and has no spans. Places count code points of the whole text. Lines may be of any length.
    Repeated rows get equal results, no rows give none, and other columns are carried inside ``doc``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(crf or train_crf())
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text_col).cast("string").alias("_text"))
    schema = rows.select("doc").schema
    for kind in KINDS:
        schema = schema.add(f"n_{kind}", "long")
    return rows.mapInArrow(_find(shared), schema.add("base", "string").add("spans", "string").add("redacted", "string"))
