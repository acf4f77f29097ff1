"""Benchmark passages in documents: exact pieces by the pigeonhole rule, Myers' distance."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MATCH = "item_id long, distance int, match_start long, match_end long"


class Item(NamedTuple):
    item_id: int
    text: str
    budget: int


def plain(text: str | None) -> str:
    """Lower-cased words with one space between; positions of matches count in this form."""
    return " ".join((text or "").lower().split())


def pieces(text: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of near equal length with their places: an edited copy keeps one whole."""
    cuts = [len(text) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to a substring of ``text``, and where the first such ends."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    up, down, distance = full, 0, len(pattern)
    best, end = distance, 0
    for j, c in enumerate(text, 1):
        match = masks.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        rise, fall = down | (full & ~(diagonal | up)), up & diagonal
        distance += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(diagonal | rise)), rise & diagonal
        if distance < best:
            best, end = distance, j
    return best, end


class Matcher:
    """Finds items within their error budget in texts."""

    def __init__(self, items: list[Item]):
        self.items = [x for x in items if x.text]
        places: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(self.items):
            for at, piece in pieces(item.text, item.budget):
                places.setdefault(piece, []).append((n, at))
        self.pieces = ahocorasick.Automaton()
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        if places:
            self.pieces.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(item_id, distance, start, end)`` of the best match of each item in a plain text."""
        starts: dict[int, set[int]] = {}
        for end, (length, where) in self.pieces.iter(text) if self.items else ():
            for n, at in where:
                starts.setdefault(n, set()).add(end + 1 - length - at)
        found = []
        for n, at in sorted(starts.items()):
            item = self.items[n]
            size, budget, best = len(item.text), item.budget, None
            for low, high in _runs(sorted(at), budget + 1):
                first = text.find(item.text, max(0, low), high + size)
                if first >= 0:
                    hit = (0, first, first + size)
                else:
                    base = max(0, low - budget)
                    distance, end = myers(item.text, text[base:high + size + budget])
                    if distance > budget:
                        continue
                    back = myers(item.text[::-1], text[max(base, base + end - size - budget):base + end][::-1])[1]
                    hit = (distance, base + end - back, base + end)
                best = min(best, hit) if best else hit
            if best:
                found.append((item.item_id, *best))
        return found


def _runs(values: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """First and last of runs of sorted values that are at most ``gap`` apart."""
    first = last = values[0]
    for v in values[1:]:
        if v - last > gap:
            yield first, last
            first = v
        last = v
    yield first, last


def item_blocks(benchmark: DataFrame, error_rate: float, block_items: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[Item]]:
    """Items with their error budgets, in blocks of about ``block_items``, one at a time on the driver."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    blocks = max(1, math.ceil(rows.count() / block_items))
    for b in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        texts = [(r["i"], plain(r["t"])) for r in block]
        yield [Item(i, t, int(error_rate * len(t))) for i, t in texts]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, block_items: int = 2000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, distance, match_start, match_end``: the best match of each item in each row.

    An item matches where a substring of the text is within ``error_rate`` times its length of
    edits. Both are compared lower-cased with single spaces. A copy with that many
    edits still holds one of budget + 1 pieces of the item unchanged, so piece hits lose nothing.
    Null or empty texts and items match nothing; repeated rows and items are each reported; a
    null item id is reported as null. Other columns are not read.

    Items are a stated query set: each block of them is sent to all tasks, and each task
    reads its rows once per block, without any shuffle.
    """
    out = None
    for items in item_blocks(benchmark, error_rate, block_items):
        found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
            _search(items), f"doc_id {docs.schema[id_col].dataType.simpleString()}, {MATCH}")
        out = found if out is None else out.unionByName(found)
    return out


def _search(items: list[Item]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items)
        for batch in batches:
            row, found = [], []
            for i, text in enumerate(batch["text"]):
                hits = matcher.find(plain(text.as_py()))
                row += [i] * len(hits)
                found += hits
            columns = list(zip(*found)) if found else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(row, pa.int64())), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()),
                 pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
                ["doc_id", "item_id", "distance", "match_start", "match_end"])
    return search


def without_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, block_items: int = 2000, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which ``find_leaks`` finds no item; no shuffle."""
    def clean(items: list[Item]):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col))
                yield batch.filter(pa.array([not matcher.find(plain(t.as_py())) for t in texts], pa.bool_()))
        return keep

    for items in item_blocks(benchmark, error_rate, block_items):
        docs = docs.mapInArrow(clean(items), docs.schema)
    return docs
