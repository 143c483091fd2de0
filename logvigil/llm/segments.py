"""N-best segmentation into the pieces of a SentencePiece vocabulary, and decoding."""

import gc
import heapq
import sys
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from logvigil.llm.common import slices

BEST, SPACE = 3, "▁"
#: Distinct chunks that a worker remembers, and ids of theirs; beyond, it keeps those met most often.
CHUNKS_KEPT, IDS_KEPT = 1 << 18, 1 << 22
#: The lattices of so many chunks are made together; longer chunks than SHORT characters are done one by one.
TOGETHER, SHORT = 4096, 64
#: Added to the lowest score for a character that no piece covers.
UNKNOWN = -10.0


def vocabulary_file() -> str:
    """The default vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(2)
def piece_bytes(path: str) -> np.ndarray:
    """The bytes that each id of a model file stands for; none for special ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    out = np.empty(model.get_piece_size(), object)
    for i in range(len(out)):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out[i] = bytes([int(piece[3:-1], 16)])
        else:
            special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            out[i] = b"" if special else piece.replace(SPACE, " ").encode()
    return out


class Trie:
    """The pieces as a trie: nodes are numbered, and a child is found by its parent and character."""

    def __init__(self, ids: dict[str, int]):
        numbers: dict[str, int] = {}
        for piece in ids:
            for k in range(1, len(piece) + 1):
                numbers.setdefault(piece[:k], len(numbers))
        self.depth = max(map(len, ids))
        self.pieces = np.array([ids.get(p, -1) for p in numbers], np.int64)
        self._ones = np.full(sys.maxunicode + 1, -1, np.int32)
        roots = [(ord(p), i) for p, i in numbers.items() if len(p) == 1]
        self._ones[[c for c, _ in roots]] = [i for _, i in roots]
        children = {numbers[p[:-1]] << 21 | ord(p[-1]): i for p, i in numbers.items() if len(p) > 1}
        keys, child = np.array(list(children), np.int64), np.array(list(children.values()), np.int64)
        order = np.argsort(keys)
        self._keys, self._child = keys[order], child[order]

    def ones(self, points: np.ndarray) -> np.ndarray:
        """The nodes of single characters, -1 where there is none."""
        return self._ones[points]

    def next(self, nodes: np.ndarray, points: np.ndarray) -> np.ndarray:
        """The children of nodes by these characters, -1 where there is none."""
        keys = nodes.astype(np.int64) << 21 | points
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._child[at], -1)


class Pieces:
    """Pieces and scores of a model file, and the lattice that they span over a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
        self.scores = {model.id_to_piece(i): (i, model.get_score(i)) for i in ids if not special[i]}
        self.trie = Trie({p: i for p, (i, _) in self.scores.items()})
        self.score_of = np.array([model.get_score(i) for i in ids])
        self.unknown = min(s for _, s in self.scores.values()) + UNKNOWN
        self.bytes = {i: model.piece_to_id(f"<0x{i:02X}>") for i in range(256)}
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("pieces that hold a space after another character aren't supported")

    def lattices(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """The lattices of many texts, one after the other, a text having one place more than characters.

        ``first`` tells for each place, and the one past the last, where the edges that end there begin. An edge has the place it starts at, a
        score, and a code: the id of its piece, or ~c for a character c that no piece covers. ``forward`` is the best
        score up to a place. The edges are found by walking the trie of the pieces from all characters at once, the forward
        scores for the k-th places of all texts at once, or place by place where a text is long.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        base = np.cumsum(sizes + 1) - (sizes + 1)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        n = len(points)
        place = np.arange(n) + np.repeat(np.arange(len(texts)), sizes)
        last = np.repeat(base + sizes, sizes)
        here, node = np.arange(n), self.trie.ones(points)
        alone = np.ones(n, bool)
        begin, end, code = [], [], []
        for length in range(1, self.trie.depth + 1):
            alive = node >= 0
            here, node = here[alive], node[alive]
            piece = self.trie.pieces[node]
            whole = piece >= 0
            at = here[whole]
            begin.append(place[at])
            end.append(place[at] + length)
            code.append(piece[whole])
            if length == 1:
                alone[at] = False
            inside = place[here] + length < last[here]
            here, node = here[inside], node[inside]
            if not len(here):
                break
            node = self.trie.next(node, points[here + length])
        at = np.flatnonzero(alone)
        begin, end = np.concatenate([*begin, place[at]]), np.concatenate([*end, place[at] + 1])
        code = np.concatenate([*code, ~points[at]])
        order = np.lexsort((begin, end))
        begin, end, code = begin[order], end[order], code[order]
        score = np.where(code >= 0, self.score_of[np.maximum(code, 0)], self.unknown)
        places = int(base[-1] + sizes[-1] + 1) if len(texts) else 0
        first = np.searchsorted(end, np.arange(places + 1))
        if sizes.max(initial=0) > SHORT:
            forward = self._forward(first.tolist(), begin.tolist(), score.tolist(), set(base.tolist()))
            return first, begin, score, code, np.array(forward)
        forward = np.full(places, -np.inf)
        forward[base] = 0.0
        step = end - np.repeat(base, sizes + 1)[end]
        by_step = np.argsort(step, kind="stable")
        cuts = np.searchsorted(step[by_step], np.arange(1, int(sizes.max(initial=0)) + 2))
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            edges = by_step[a:b]
            ends = end[edges]
            runs = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
            forward[ends[runs]] = np.maximum.reduceat(forward[begin[edges]] + score[edges], runs)
        return first, begin, score, code, forward

    def _forward(self, first: list[int], starts: list[int], scores: list[float], base: set[int]) -> list[float]:
        out: list = []
        for place, (a, b) in enumerate(zip(first, first[1:])):
            out.append(0.0 if place in base else max(out[starts[i]] + scores[i] for i in range(a, b)))
        return out

    def best(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The n segmentations of a text of largest score, best first."""
        return self._backward(*[x.tolist() for x in self.lattices([text])], len(text), n)

    def best_of_all(self, texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for many texts that aren't empty: scores and numbers of ids, n a text, and all ids in one row.

        Texts without n segmentations have scores of -inf. Short texts are searched together, long ones one by one.
        """
        scores, sizes, flat = [np.zeros((0, n))], [np.zeros((0, n), np.int64)], [np.zeros(0, np.int64)]
        for long, together in groupby(texts, lambda t: len(t) > SHORT):
            for some in batched(together, 1 if long else TOGETHER):
                if long:
                    found = self.best(some[0], n)
                    pad = n - len(found)
                    scores.append(np.array([[s for s, _ in found] + [-np.inf] * pad]))
                    sizes.append(np.array([[len(ids) for _, ids in found] + [0] * pad]))
                    flat += [np.array(ids, np.int64) for _, ids in found]
                else:
                    for to, made in zip((scores, sizes, flat), self._all_backward(list(some), n)):
                        to.append(made)
        return np.concatenate(scores), np.concatenate(sizes), np.concatenate(flat)

    def _all_backward(self, texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_backward`` for many texts in step.

        As the estimate is exact, one extension of the open path of least estimate has the same estimate, so it is the next to be extended,
        down to the start. A round takes the best open path of each text all the way there; the other
        extensions stay open, as many as can still matter.
        """
        first, begin, score, code, forward = self.lattices(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        base = np.cumsum(lengths + 1) - (lengths + 1)
        ends = np.repeat(np.arange(len(first) - 1), np.diff(first))
        top = np.flatnonzero(forward[begin] + score == forward[ends])
        follow = np.zeros(len(forward), np.int64)
        follow[ends[top[::-1]]] = top[::-1]  # of equals the first, which starts nearest to the start
        scores, last = np.full((len(texts), n), -np.inf), np.full((len(texts), n), -1, np.int64)
        codes, parents, made = [], [], 0
        who = np.arange(len(texts))
        still = (who, -forward[base + lengths], base + lengths, np.zeros(len(texts)), np.full(len(texts), -1, np.int64))
        for r in range(n):
            lead = np.concatenate([[True], still[0][1:] != still[0][:-1]]) if len(still[0]) else np.zeros(0, bool)
            kept = [tuple(x[~lead] for x in still)]
            who, _, place, gained, node = (x[lead] for x in still)
            while len(who):
                there = place == base[who]
                if there.any():
                    scores[who[there], r], last[who[there], r] = gained[there], node[there]
                    who, place, gained, node = (x[~there] for x in (who, place, gained, node))
                at, many = first[place], first[place + 1] - first[place]
                to = np.cumsum(many) - many
                row = np.repeat(np.arange(len(who)), many)
                edge = np.arange(len(row)) + (at - to)[row]
                start, sums, new = begin[edge], score[edge] + gained[row], made + np.arange(len(row))
                codes.append(code[edge])
                parents.append(node[row])
                made += len(row)
                go = to + follow[place] - at
                other = np.ones(len(row), bool)
                other[go] = False
                kept.append((who[row[other]], (-sums - forward[start])[other], start[other], sums[other], new[other]))
                place, gained, node = start[go], sums[go], new[go]
            if r == n - 1:
                break
            still = tuple(map(np.concatenate, zip(*kept)))
            order = np.lexsort((still[2], still[1], still[0]))
            owner = still[0][order]
            rank = np.arange(len(order)) - np.searchsorted(owner, owner)
            still = tuple(x[order[rank < n - 1 - r]] for x in still)
        codes, parents = np.concatenate([np.zeros(0, np.int64), *codes]), np.concatenate([np.zeros(0, np.int64), *parents])
        node = last[np.isfinite(scores)]
        path, paths, pieces = np.arange(len(node)), [], []
        while len(node):
            paths.append(path)
            pieces.append(codes[node])
            node = parents[node]
            path, node = path[node >= 0], node[node >= 0]
        paths, flat = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (paths, pieces))
        order = np.argsort(paths, kind="stable")
        paths, flat = paths[order], flat[order]
        if (flat < 0).any():
            rare, at = np.unique(flat[flat < 0], return_inverse=True)
            spelt = [self._spelt(c) for c in rare.tolist()]
            many = np.ones(len(flat), np.int64)
            many[flat < 0] = np.array(list(map(len, spelt)))[at]
            paths, unknown, flat = np.repeat(paths, many), np.repeat(flat < 0, many), np.repeat(flat, many)
            flat[unknown] = [i for k in at.tolist() for i in spelt[k]]
        sizes = np.zeros(scores.shape, np.int64)
        sizes[np.isfinite(scores)] = np.bincount(paths, minlength=int(np.isfinite(scores).sum()))
        return scores, sizes, flat

    def _spelt(self, code: int) -> list[int]:
        """The ids of the bytes of a character that no piece covers."""
        return [self.bytes[x] for x in chr(~code).encode()]

    def _backward(self, first, starts, scores, codes, forward, end: int, n: int) -> list[tuple[float, list[int]]]:
        """The n best paths of the lattice of one text.

        The forward pass gives the best score up to every place. From the end, A* extends paths backward; the forward
        score of the place a path has reached is exactly what it can still gain, so paths come out in
        order. As each open path is sure to reach its estimate, the n best open ones are all that
        can matter, and the queue holds no more. Of equals the path nearest to the start goes on.
        """
        out: list = []
        queue: list = [(-forward[end], end, 0, 0.0, None)]
        made, room = 0, n
        while queue and room:
            _, place, _, gained, path = queue.pop(0)
            if place == 0:
                ids: list = []
                while path is not None:
                    code, path = path
                    ids += [code] if code >= 0 else self._spelt(code)
                out.append((gained, ids))
                room -= 1
                continue
            for i in range(first[place], first[place + 1]):
                a, score = starts[i], scores[i] + gained
                estimate = -score - forward[a]
                if len(queue) >= room:
                    if estimate >= queue[-1][0]:
                        continue
                    queue.pop()
                made += 1
                insort(queue, (estimate, a, made, score, (codes[i], path)))
        return out


def normal(text: str) -> str:
    """A text as the lattice sees it: spaces marked, and one mark before it."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def chunks(text: str) -> list[str]:
    """Parts between which every segmentation has a border: marks and what follows them."""
    if not text:
        return []
    parts = text.split(" ")
    if "" not in parts:
        return [SPACE + p for p in parts]
    out, marks = [], ""
    for part in parts:
        marks += SPACE
        if part:
            out.append(marks + part)
            marks = ""
    return [*out, marks] if marks else out


class Segmenter:
    """Segments texts chunk by chunk. No piece crosses chunks, so the lattice of a text is a chain of theirs."""

    def __init__(self, pieces: Pieces, n: int):
        self.pieces, self.n = pieces, n
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.sizes, self.scores = (np.zeros((0, self.n), t) for t in (np.int64, np.int64, np.float64))
        self.flat, self.used = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _shrink(self) -> None:
        """Keeps chunks met more than once, the most frequent ones, up to half of the room."""
        keep = np.flatnonzero(self.used > 1)
        if len(keep) > CHUNKS_KEPT // 2 or self.sizes[keep].sum() > IDS_KEPT // 2:
            order = keep[np.argsort(-self.used[keep], kind="stable")][: CHUNKS_KEPT // 2]
            keep = np.sort(order[np.cumsum(self.sizes[order].sum(1)) <= IDS_KEPT // 2])
        words = list(self.known)
        self.known = {words[i]: row for row, i in enumerate(keep.tolist())}
        sizes = self.sizes[keep]
        ends = np.cumsum(sizes.ravel())
        begin = ends - sizes.ravel()
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[keep].ravel() - begin, sizes.ravel())
        self.flat, self.starts, self.sizes = self.flat[at], begin.reshape(sizes.shape), sizes
        self.scores, self.used = self.scores[keep], self.used[keep] // 2

    def _learn(self, texts: list[list[str]]) -> None:
        gc.disable()  # what is made here holds no cycles, and there is much of it
        try:
            self._learn_all(texts)
        finally:
            gc.enable()

    def _learn_all(self, texts: list[list[str]]) -> None:
        new = {c for parts in texts for c in parts if c not in self.known}
        if self.known and (len(self.known) + len(new) > CHUNKS_KEPT or len(self.flat) > IDS_KEPT):
            self._shrink()
            new = {c for parts in texts for c in parts if c not in self.known}
        if not new:
            return
        in_order = sorted(new)
        scores, sizes, flat = self.pieces.best_of_all(in_order, self.n)
        starts = (np.cumsum(sizes) - sizes.ravel()).reshape(sizes.shape) + len(self.flat)
        self.known.update(zip(in_order, range(len(self.known), len(self.known) + len(in_order))))
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.scores = np.concatenate([self.scores, scores])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])

    def segment(self, texts: list[str]) -> list[list[tuple[float, np.ndarray]]]:
        """Per text its n best: score and ids."""
        parts = [chunks(t) for t in texts]
        self._learn(parts)
        out = []
        for p in parts:
            rows = np.fromiter(map(self.known.__getitem__, p), np.int64, len(p))
            self.used[rows] += 1
            out.append(self._combined(rows))
        return out

    def _combined(self, rows: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """The n best of a chain of chunks.

        A path differs from the best one by the alternatives it takes, at a loss each. Among the n best only the n - 1
        alternatives of least loss can occur, for with any other there are n paths that lose no more.
        """
        best = self.scores[rows, 0]
        loss = (best[:, None] - self.scores[rows, 1:]).ravel()
        few = min(self.n - 1, len(loss))
        least = np.argpartition(loss, few - 1)[:few] if few else np.empty(0, np.int64)
        least = least[np.lexsort((least, loss[least]))]
        paths: list = [(0.0, {})]
        for i in least[np.isfinite(loss[least])].tolist():
            place, other = divmod(i, self.n - 1)
            more = [(lost + float(loss[i]), {**took, place: other + 1}) for lost, took in paths if place not in took]
            paths = heapq.nsmallest(self.n, paths + more, key=lambda p: p[0])
        out, total = [], float(best.sum())
        for lost, took in paths:
            column = np.zeros(len(rows), np.int64)
            for place, other in took.items():
                column[place] = other
            starts, sizes = self.starts[rows, column], self.sizes[rows, column]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
            out.append((total - lost, self.flat[at]))
        return out


def text_of(raw: np.ndarray, ids: np.ndarray) -> str:
    """The text of piece ids, without the mark before it."""
    text = b"".join(raw[ids].tolist()).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


@lru_cache(2)
def segmenter(path: str, n: int) -> Segmenter:
    """The segmenter of a worker process, which all its tasks share: what it remembers is bounded and changes no result."""
    return Segmenter(Pieces(path), n)


def _segment(path: str, n: int, place: int):
    def texts_beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The documents cross over once; their text is looked up here."""
        for arrow in batches:
            doc = arrow.column("doc")
            yield pa.RecordBatch.from_arrays([doc, pc.struct_field(doc, [place]).cast(pa.string())], names=["doc", "_text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, raw = segmenter(path, n), piece_bytes(path)
        for arrow in slices(texts_beside(batches), "_text", 2 << 20):
            texts = [t or "" for t in arrow.column("_text").to_pylist()]
            found = held.segment(texts)
            same = pa.array([text_of(raw, one[0][1]) == t for t, one in zip(texts, found)], pa.bool_())
            every = [x for one in found for x in one]
            ends = np.cumsum([0, *[len(ids) for _, ids in every]])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *[i for _, i in every]])))
            outer = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            scores = pa.array([s for s, _ in every], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [arrow.column("doc"), pa.ListArray.from_arrays(outer, lists), pa.ListArray.from_arrays(outer, scores), same],
                names=["doc", "ids", "scores", "round_trip"],
            )

    return run


def segments(docs: DataFrame, text_col: str = "text", n: int = BEST, vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc (all its columns), ids and scores of its n best segmentations, best first,
    and round_trip, whether the best one decodes to the text.

    Scores are those of the vocabulary file, summed over pieces; characters that no piece covers become byte pieces. A
    chunk (spaces and what follows) is segmented once per worker by Viterbi forward and A* backward, and
    the n best of a text are put together from its chunks' without loss. Ties are settled by place, in a fixed way.

    NULL and empty texts have one segmentation, without pieces and of score 0. Fewer than n segmentations give what there is. Repeated
    rows get equal results; no rows give none.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    place = [c.lower() for c in docs.columns].index(text_col.lower())
    schema = rows.select("doc").schema.add("ids", ArrayType(ArrayType(IntegerType()))).add("scores", ArrayType(DoubleType()))
    schema = schema.add("round_trip", "boolean")
    return rows.mapInArrow(_segment(vocabulary or vocabulary_file(), n, place), schema)


def _decoder(path: str):
    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        raw = piece_bytes(path)
        for column in columns:
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            nulls = column.is_null().to_pylist()
            yield pa.array([None if null else text_of(raw, flat[a:b]) for a, b, null in zip(ends, ends[1:], nulls)], pa.string())

    decode.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return decode


def decoded(ids: Column | str, vocabulary: str | None = None) -> Column:
    """The text of a column of piece ids, without the mark before it; NULL for NULL. Byte pieces that are no UTF-8 give U+FFFD."""
    return F.arrow_udf(_decoder(vocabulary or vocabulary_file()), "string")(ids)
