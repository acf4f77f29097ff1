"""SentencePiece encoding by suffix-array matching of the pieces, and decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from noticeworks.llm.batches import slices

SPACE = "▁"
#: Segments of a text that no piece reaches across: line feeds, words with the spaces before them, last spaces.
SEGMENTS = re.compile("\n| *[^ \n]+| +")
#: Characters indexed at once; segments remembered at once; symbols up to which segments are merged side by side.
INDEXED, REMEMBERED, SIDE_BY_SIDE = 1 << 18, 1 << 19, 48
#: Edges, or bytes of texts with their ids, that are laid out at once.
LAID_OUT = 1 << 20


class Vocabulary(NamedTuple):
    """What a BPE piece model holds; pieces have spaces for the model's space mark."""

    pieces: list[str]  #: of ordinary pieces
    ids: np.ndarray  #: their ids
    scores: np.ndarray  #: their scores: among possible merges the highest comes first
    bytes_: np.ndarray  #: ids of the 256 bytes
    texts: list[bytes]  #: what each id decodes to

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """The vocabulary in a model file: BPE, identity normalisation, dummy prefix, byte fallback."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, ids, scores, texts = [], [], [], []
        raw = np.zeros(256, dtype=np.int32)
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i).replace(SPACE, " ")
            if model.is_byte(i):
                raw[int(piece[1:-1], 16)] = i
                texts.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unused(i):
                texts.append(b"")
            elif model.is_unknown(i):
                texts.append(" ⁇ ".encode())
            else:
                pieces.append(piece)
                ids.append(i)
                scores.append(model.get_score(i))
                texts.append(piece.encode())
        if any("\n" in p or " " in p.lstrip(" ") or (p.strip(" ") and p.startswith("  ")) for p in pieces):
            raise ValueError("a piece reaches across segments")
        return cls(pieces, np.array(ids, dtype=np.int32), np.array(scores), raw, texts)


def suffix_array(points: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes, sorted by their first ``depth`` (or a few more) code points."""
    rank = np.unique(points, return_inverse=True)[1].astype(np.int64)
    order, reach = np.argsort(rank, kind="stable"), 1
    while reach < depth and rank[order[-1]] < len(rank) - 1:
        later = np.zeros(len(rank), dtype=np.int64)
        later[:-reach] = rank[reach:] + 1
        key = rank * (len(rank) + 1) + later
        order = np.argsort(key, kind="stable")
        rank = np.empty_like(rank)
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        reach *= 2
    return order


class Matcher:
    """Occurrences of all pieces in a text, by binary search in its suffix array."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        lengths = np.array([len(p) for p in vocabulary.pieces], dtype=np.int64)
        self.longest = int(lengths.max())
        self.lengths = lengths
        self.points = np.zeros((len(lengths), self.longest), dtype=np.int64)
        filled = np.arange(self.longest) < lengths[:, None]
        self.points[filled] = np.frombuffer("".join(vocabulary.pieces).encode("utf-32-le"), dtype=np.uint32)
        self.filled = filled

    def edges(self, points: np.ndarray) -> np.ndarray:
        """Of every place and length the piece that stands there, or -1."""
        order = suffix_array(points, self.longest)
        padded = np.concatenate([points, np.full(self.longest, -1)])
        heads = points[order]
        low, high = np.searchsorted(heads, self.points[:, 0], "left"), np.searchsorted(heads, self.points[:, 0], "right")
        live = np.flatnonzero(low < high)
        first = self._bisect(padded, order, live, low[live], high[live], False)
        last = self._bisect(padded, order, live, low[live], high[live], True)
        found = last > first
        piece, first, count = live[found], first[found], (last - first)[found]
        table = np.full((len(points), self.longest + 1), -1, dtype=np.int32)  # edges in the order of their place
        for some in np.split(np.arange(len(piece)), np.flatnonzero(np.diff(np.cumsum(count) // LAID_OUT)) + 1):
            n = count[some]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = order[np.repeat(first[some], n) + within]
            of = np.repeat(piece[some], n)
            table[place, self.lengths[of]] = of
        return table

    def _bisect(self, padded, order, live, low, high, after: bool) -> np.ndarray:
        """The first suffix that is not before (or is after) all that start with the piece."""
        low, high = low.copy(), high.copy()
        wanted, filled = self.points[live], self.filled[live]
        steps = np.arange(self.longest)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            there = padded[order[middle][:, None] + steps]
            differs = (there != wanted[open_]) & filled[open_]
            at = differs.argmax(axis=1)
            rows = np.arange(len(open_))
            before = there[rows, at] < wanted[open_][rows, at]
            goes_up = np.where(differs.any(axis=1), before, after)
            low[open_[goes_up]] = middle[goes_up] + 1
            high[open_[~goes_up]] = middle[~goes_up]


class Numbers(dict):
    """Numbers segments as they are first asked for; ``new`` are those since it was last cleared."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, segment: str) -> int:
        self.new.append(segment)
        self[segment] = n = len(self)
        return n


class Encoder:
    """Ids of segments. Every distinct segment is matched once and remembered, up to ``REMEMBERED`` of them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.matcher = vocabulary, Matcher(vocabulary)
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.ids, self.counts = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, and the number of ids of each text."""
        codes, ends = self.read(texts)
        return self.lay_out(codes, ends)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the segments of all texts after one another, and ``ends``: those of text i are ``[ends[i], ends[i + 1])``. All are then known."""
        if len(self.number) > REMEMBERED:
            self.forget()
        codes, sizes = [], []
        for text in texts:
            segments = SEGMENTS.findall(" " + text.replace(SPACE, " ")) if text else []
            codes.append(np.fromiter(map(self.number.__getitem__, segments), np.int64, len(segments)))
            sizes.append(len(segments))
        self._learn()
        return np.concatenate(codes) if codes else np.zeros(0, dtype=np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def lay_out(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts between neighbouring ``ends`` after one another, and the number of ids of each."""
        codes = codes[ends[0]:ends[-1]]
        counts = self.counts[codes]
        before = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(before[-1]) + np.repeat(self.starts[codes] - before[:-1], counts)
        return self.ids[at], np.diff(before[ends - ends[0]])

    def _learn(self) -> None:
        batch, held = [], 0
        ids, counts = [self.ids], [self.counts]
        for s in [*self.number.new, None]:
            if batch and (s is None or held + len(s) >= INDEXED):
                i, c = self.segments(batch)
                ids.append(i)
                counts.append(c)
                batch, held = [], 0
            if s is not None:
                batch.append(s)
                held += len(s) + 1
        self.number.new.clear()
        self.ids, self.counts = np.concatenate(ids), np.concatenate(counts)
        self.starts = np.cumsum(self.counts) - self.counts

    def segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments after one another, and the number of ids of each.

        The segments are indexed as one text with ends that no piece contains. The edges of
        all pieces are relaxed in the order that BPE asks for: in each round every segment takes its
        best edge over two neighbouring symbols, the leftmost of equal ones, until it has none.
        """
        sizes = np.array([len(s) for s in segments], dtype=np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        points = np.full(int((sizes + 1).sum()), 0x110000, dtype=np.int64)
        inside = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)
        points[inside] = np.frombuffer("".join(segments).encode("utf-32-le"), dtype=np.uint32)
        table = self.matcher.edges(points)
        length = np.zeros(len(points), dtype=np.int64)  # of the symbol that starts at a place, 0 inside one
        length[inside] = 1
        few = np.flatnonzero(sizes <= SIDE_BY_SIDE)
        at = np.arange(int(sizes[few].sum())) + np.repeat(starts[few] - np.cumsum(sizes[few]) + sizes[few], sizes[few])
        self._relax(table, length, at, np.repeat(few, sizes[few]))
        for n in np.flatnonzero(sizes > SIDE_BY_SIDE):
            self._relax_long(table, length, int(starts[n]), int(starts[n] + sizes[n]))
        return self._symbols(points, table, length, starts, sizes)

    def _scores(self, table, place, size) -> np.ndarray:
        piece = np.where(size <= self.matcher.longest, table[place, np.minimum(size, self.matcher.longest)], -1)
        return np.where(piece >= 0, self.vocabulary.scores[piece], -np.inf)

    def _relax(self, table, length, at, segment) -> None:
        sizes = np.ones(len(at), dtype=np.int64)
        while len(at):
            paired = np.concatenate([segment[1:] == segment[:-1], [False]])
            score = np.full(len(at), -np.inf)
            left = np.flatnonzero(paired)
            score[left] = self._scores(table, at[left], sizes[left] + sizes[left + 1])
            first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            best = np.maximum.reduceat(score, first)
            counts = np.diff(np.concatenate([first, [len(at)]]))
            merges = np.flatnonzero((score == np.repeat(best, counts)) & np.isfinite(score))
            merges = merges[np.concatenate([[True], segment[merges][1:] != segment[merges][:-1]])] if len(merges) else merges
            sizes[merges] += sizes[merges + 1]
            length[at[merges]] = sizes[merges]
            length[at[merges + 1]] = 0
            stays = np.repeat(np.isfinite(best), counts)
            stays[merges + 1] = False
            at, sizes, segment = at[stays], sizes[stays], segment[stays]

    def _relax_long(self, table, length, start: int, end: int) -> None:
        """The same for one long segment, with a heap of edges."""
        after = {i: i + 1 for i in range(start, end)}
        before = {i: i - 1 for i in range(start, end)}
        heap: list[tuple[float, int, int, int]] = []
        longest, scores = self.matcher.longest, self.vocabulary.scores

        def offer(a: int) -> None:
            b = after.get(a, end)
            if a >= start and b < end:
                size = int(length[a] + length[b])
                if size <= longest and table[a, size] >= 0:
                    heapq.heappush(heap, (-scores[table[a, size]], a, b, size))

        for i in range(start, end - 1):
            offer(i)
        while heap:
            _, a, b, size = heapq.heappop(heap)
            if not length[a] or not length[b] or after[a] != b or length[a] + length[b] != size:
                continue
            length[a], length[b] = size, 0
            after[a] = after[b]
            if after[a] < end:
                before[after[a]] = a
            offer(a)
            offer(before[a])

    def _symbols(self, points, table, length, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(length)
        piece = table[at, length[at]]
        known = piece >= 0
        ids = np.where(known, self.vocabulary.ids[piece], 0)
        of = np.searchsorted(starts, at, "right") - 1
        if known.all():
            return ids, np.bincount(of, minlength=len(sizes))
        raw = [b"" if k else chr(p).encode() for k, p in zip(known, points[at])]
        width = np.array([1 if k else len(r) for k, r in zip(known, raw)], dtype=np.int64)
        out = np.repeat(ids, width)
        out[np.repeat(~known, width)] = self.vocabulary.bytes_[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return out, np.bincount(of, weights=width, minlength=len(sizes)).astype(np.int64)


_encoders: dict[int, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder for a Python worker, which may run many tasks; what it remembers is bounded."""
    key = hash((tuple(vocabulary.pieces), vocabulary.ids.tobytes(), vocabulary.scores.tobytes()))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


class Decoder:
    """Texts of ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.sizes = np.array([len(t) for t in vocabulary.texts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ordinary = np.zeros(len(self.sizes), dtype=bool)
        self.ordinary[vocabulary.ids] = True
        self.data = np.frombuffer(b"".join(vocabulary.texts), dtype=np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each run of ``counts`` ids, without the space put before it; bytes that are no UTF-8 become U+FFFD."""
        sizes = self.sizes[ids]
        before = np.concatenate([[0], np.cumsum(sizes)])
        data = self.data[np.arange(before[-1]) + np.repeat(self.starts[ids] - before[:-1], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(counts)])
        texts = []
        for a, b in zip(ends, ends[1:]):
            text = data[before[a]:before[b]].decode("utf-8", "replace")
            while a < b and not sizes[a]:  # controls before the text
                a += 1
            texts.append(text[1:] if text.startswith(" ") and self.ordinary[ids[a]] else text)
        return texts


#: Bytes of texts whose segments a task reads at once.
ENCODED_BYTES = 8 << 20


def _with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *new.values()], [*kept, *new])


def _schema(frame: DataFrame, new: dict[str, str]) -> str:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name not in new]
    return ", ".join([*kept, *(f"`{n}` {t}" for n, t in new.items())])


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", check: bool = False) -> DataFrame:
    """All columns of ``docs`` with ``ids`` and ``n_tokens``; columns of these names are replaced.

    The ids are those of the model's library. Null and empty texts have no ids. With
    ``check`` the ids are decoded at once and ``round_trip`` says whether that gives the text
    again; it does not where the text has the space mark U+2581 itself, which the model reads as a space.
    Rows stay where they are: there is no shuffle, and the memory of a task is bounded by its batch.
    """
    new = {"ids": "array<int>", "n_tokens": "int"} | ({"round_trip": "boolean"} if check else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(vocabulary), Decoder(vocabulary)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for first, last in slices(texts, ENCODED_BYTES):
                group = pc.fill_null(texts.slice(first, last - first), "").to_pylist()
                codes, segments = encoder.read(group)
                for a, b in slices(texts.slice(first, last - first), LAID_OUT):
                    ids, counts = encoder.lay_out(codes, segments[a:b + 1])
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    added = {"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), "n_tokens": pa.array(counts, pa.int32())}
                    if check:
                        added["round_trip"] = pa.array([x == y for x, y in zip(decoder.decode(ids, counts), group[a:b])], pa.bool_())
                    yield _with_columns(batch.slice(first + a, b - a), added)

    return docs.mapInArrow(run, _schema(docs, new))


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns with the text of ``ids``; null for null ids, empty for none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col))
            counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            texts = decoder.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), _filled(counts, lists))
            known = lists.is_valid().to_pylist()
            yield _with_columns(batch, {text_col: pa.array([t if k else None for t, k in zip(texts, known)], pa.string())})

    return encoded.mapInArrow(run, _schema(encoded, {text_col: "string"}))


def _filled(counts: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Null lists have no ids even where their slots are not empty."""
    return np.where(lists.is_valid().to_numpy(zero_copy_only=False), counts, 0)


