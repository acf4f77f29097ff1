"""Periodic runs of words: maximal stretches that repeat a period at least twice."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from noticeworks.llm.batches import Words, word_slices

#: Places are sampled modulo this number.
MODULUS = 21
#: Pairs of places that are compared at once.
PAIRS = 1 << 21
#: A run has at least this many words.
LEAST_LENGTH = 12
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def difference_cover(modulus: int) -> np.ndarray:
    """A smallest set of residues that has two at every distance, the first such in order."""
    for size in itertools.count(1):
        for rest in itertools.combinations(range(1, modulus), size - 1):
            cover = (0, *rest)
            if len({(a - b) % modulus for a in cover for b in cover}) == modulus:
                return np.array(cover)


COVER = difference_cover(MODULUS)
#: Of two residues: the least shift that takes both into the cover.
SHIFT = np.array([[next(k for k in range(MODULUS) if (a + k) % MODULUS in COVER and (b + k) % MODULUS in COVER) for b in range(MODULUS)]
                  for a in range(MODULUS)])
#: Of a residue in the cover: its place there.
IN_COVER = np.searchsorted(COVER, np.arange(MODULUS))


class Extensions:
    """How many words are equal from two places of one text on.

    ``words`` has a 0 before and after each text and positive codes inside. Only suffixes at
    the places of a difference cover are sorted, text by text. Two places are compared word by word
    up to the shift that takes both into the cover; what follows is the least of the common
    prefixes between their ranks, from a sparse table.
    """

    def __init__(self, words: np.ndarray):
        self.words = np.concatenate([words, np.zeros(2 * MODULUS, dtype=words.dtype)])
        blocks = -(-len(words) // MODULUS)
        self.places = (np.arange(blocks)[:, None] * MODULUS + COVER).ravel()
        zeros = np.cumsum(self.words == 0)
        text = zeros[self.places] - (self.words[self.places] == 0)
        self.levels = self._ranks(text)
        common = self._neighbours(text)
        self.table = [common]
        longest = int(np.bincount(text).max())
        while 2 << (len(self.table) - 1) <= longest:
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last, np.concatenate([last[half:], np.zeros(half, dtype=last.dtype)])[:len(last)]))
        self.table = np.stack(self.table)

    def _sample(self, places: np.ndarray) -> np.ndarray:
        """The number of sampled places among all of them."""
        block, residue = np.divmod(places, MODULUS)
        return block * len(COVER) + IN_COVER[residue]

    def _ranks(self, text: np.ndarray) -> list[np.ndarray]:
        """Ranks of the sampled suffixes of a text by their first MODULUS, 2 MODULUS, 4 MODULUS ... words.

        Equal ranks are equal beginnings; those of the last level differ.
        """
        rank = np.searchsorted(text, text)
        bits = max(1, int(self.words.max()).bit_length())
        step = min(MODULUS, 62 // bits)
        for depth in range(0, MODULUS, step):
            tied = self._tied(rank)
            if not len(tied):
                break
            key = np.zeros(len(tied), dtype=np.int64)
            for k in range(depth, min(depth + step, MODULUS)):
                key = (key << bits) | self.words[self.places[tied] + k]
            rank = self._refined(rank, tied, key)
        levels = [rank]
        while len(tied := self._tied(rank)):
            reach = MODULUS << (len(levels) - 1)
            rank = self._refined(rank, tied, rank[self._sample(self.places[tied] + reach)])
            levels.append(rank)
        return levels

    @staticmethod
    def _tied(rank: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)

    @staticmethod
    def _refined(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
        order = np.lexsort((key, rank[tied]))
        old, key = rank[tied][order], key[order]
        at = np.arange(len(order))
        opens = np.concatenate([[True], old[1:] != old[:-1]])
        parts = opens | np.concatenate([[True], key[1:] != key[:-1]])
        new = rank.copy()
        new[tied[order]] = old + np.maximum.accumulate(np.where(parts, at, 0)) - np.maximum.accumulate(np.where(opens, at, 0))
        return new

    def _neighbours(self, text: np.ndarray) -> np.ndarray:
        """Of every rank: how many words its suffix has in common with the one before it in the text."""
        order = np.empty(len(text), dtype=np.int64)
        order[self.levels[-1]] = np.arange(len(text))
        common = np.zeros(len(text), dtype=np.int32)
        ranks = np.flatnonzero(text[order][1:] == text[order][:-1]) + 1
        if len(ranks):
            common[ranks] = self._by_levels(self.places[order[ranks - 1]], self.places[order[ranks]])
        return common

    def _by_levels(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        length = np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(self.levels))):
            level = self.levels[k]
            length += (level[self._sample(a + length)] == level[self._sample(b + length)]) * (MODULUS << k)
        return length + self._stepwise(a + length, b + length, np.full(len(a), MODULUS))

    def _stepwise(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from two places on, up to ``most`` of them."""
        length = np.zeros(len(a), dtype=np.int64)
        open_ = np.arange(len(a))
        for step in range(MODULUS):
            open_ = open_[most[open_] > step]
            open_ = open_[self.words[a[open_] + step] == self.words[b[open_] + step]]
            if not len(open_):
                break
            length[open_] = step + 1
        return length

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from the places ``a`` and ``b`` on; these are different places of one text."""
        shift = SHIFT[a % MODULUS, b % MODULUS]
        length = self._stepwise(a, b, shift)
        far = np.flatnonzero(length == shift)
        if len(far):
            x, y = (self.levels[-1][self._sample(p[far] + shift[far])] for p in (a, b))
            low, high = np.minimum(x, y) + 1, np.maximum(x, y)
            k = np.log2(high - low + 1).astype(np.int64)
            length[far] += np.minimum(self.table[k, low], self.table[k, high + 1 - (1 << k)])
        return length


def runs_of(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray, least: int = LEAST_LENGTH) -> tuple[np.ndarray, ...]:
    """All runs of some texts: text, start, length and period, sorted by text, start and period.

    ``words`` has a 0 before and after each text; text t holds ``sizes[t]`` words from
    ``begins[t]`` on. A run of period p covers two neighbouring points of the grid 0, p, 2p ...
    of its text; so the pairs of neighbours of all grids, n/1 + n/2 + ... of them, are
    extended to both sides.
    """
    ahead, back = Extensions(words), Extensions(words[::-1])
    last = len(words) - 1
    periods = sizes // 2
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(periods.sum()) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    points = (sizes[text] - 1) // period  # grid points with a neighbour
    ends = np.cumsum(points)
    found = []
    first = 0
    while first < len(text):
        before = ends[first - 1] if first else 0
        until = max(first + 1, int(np.searchsorted(ends, before + PAIRS, "right")))
        count = points[first:until]
        p = np.repeat(period[first:until], count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(begins[text[first:until]], count) + within * p
        live = np.flatnonzero(words[at] == words[at + p])
        at, p = at[live], p[live]
        after = ahead(at, at + p)
        start = at - back(last - at + 1, last - at - p + 1)
        length = at + p + after - start
        long_ = length >= np.maximum(least, 2 * p)
        found.append(np.stack([np.repeat(text[first:until], count)[live], start, length, p])[:, long_])
        first = until
    if not found:
        return tuple(np.zeros((4, 0), dtype=np.int64))
    t, start, length, p = np.concatenate(found, axis=1)
    order = np.lexsort((p, length, start))  # of equal stretches the smallest period comes first
    t, start, length, p = (c[order] for c in (t, start, length, p))
    once = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])])[:len(t)]
    t, start, length, p = (c[once] for c in (t, start, length, p))
    order = np.lexsort((p, start))
    return t[order], (start - begins[t])[order], length[order], p[order]


def _found(least: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in word_slices(batch["text"], lower=lambda t: t):
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(w.first, w.last - w.first), *_columns(w, least)], schema=schema)
    return run


def _columns(w: Words, least: int) -> list[pa.Array]:
    sizes = np.diff(w.offsets)
    begins = w.offsets[:-1] + np.arange(len(sizes)) + 1
    words = np.zeros(len(w.codes) + len(sizes) + 1, dtype=np.int64)
    place = np.arange(len(w.codes)) + np.repeat(np.arange(len(sizes)) + 1, sizes)
    words[place] = w.codes + 1
    text, start, length, period = runs_of(words, begins, sizes, least)
    later = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(later, begins[text] + start + period, 1)
    np.add.at(later, begins[text] + start + length, -1)
    kept = np.cumsum(later)[place] == 0
    ends = np.concatenate([[0], np.cumsum(kept)])[w.offsets]
    left = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), w.words.take(pa.array(w.codes[kept])))
    runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
    return [
        pa.array(sizes, pa.int64()),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(sizes) + 1)), pa.int32()), runs),
        pc.binary_join(left, " ")]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """Every row with its periodic runs and its text without their repetitions.

    Returned: ``doc_id, n_words, runs, collapsed``. Words stand between ASCII white space and
    are compared as they are. A run is a stretch of words with a smallest period p and at
    least ``least`` and 2p words that no neighbouring word extends; ``runs`` holds start
    (number of the word, from 0), length and period, sorted by start and period. ``collapsed``
    are the words that no run holds behind its first period, joined by one space.

    Null and empty texts have no words, no runs and an empty ``collapsed``. Rows are independent:
    repeated rows, equal ids and rows without id get results of their own. Other columns, whatever their
    names, are not read; an empty table gives an empty one. There is no shuffle; a task holds the
    words of 3 MB of text, or of one longer text, and compares 2 million pairs at a time.
    """
    id_type = docs.schema[id_col].dataType
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    schema = pa.schema([("doc_id", to_arrow_type(id_type)), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _found(least, schema), f"doc_id {id_type.simpleString()}, n_words long, runs array<{RUN}>, collapsed string")
