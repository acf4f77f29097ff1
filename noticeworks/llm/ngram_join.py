"""Jaccard join of word n-gram sets by vertical partitioning."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.batches import word_slices
from noticeworks.llm.common import stored

#: Classes of set sizes reach from one bound to this factor times it.
CLASS_RATIO = 1.5
#: Fragments beyond those that the differences of a linked pair can touch.
SPARE = 2


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``[first, last)`` with the row and hash of each distinct n-gram, sorted by row and hash.

    The order of the hashes is the global n-gram order.
    """
    for w in word_slices(texts):
        word = pd.util.hash_array(w.words.to_numpy(zero_copy_only=False).astype(object), categorize=False)[w.codes]
        counts = np.diff(w.offsets)
        rows = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(rows)) - np.repeat(w.offsets[:-1], counts)
        span = np.minimum(counts, width)  # a shorter text is one n-gram as a whole
        starts = np.flatnonzero(place <= (counts - span)[rows])
        gram = np.zeros(len(starts), dtype=np.uint64)
        for k in range(width):
            inside = k < span[rows[starts]]
            gram[inside] = _mix(gram[inside] * np.uint64(3) + word[starts[inside] + k] + np.uint64(k + 1))
        rows = rows[starts]
        order = np.lexsort((gram, rows))
        rows, gram = rows[order], gram[order]
        new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (gram[1:] != gram[:-1])]) if len(rows) else np.zeros(0, bool)
        yield w.first, w.last, rows[new], gram[new]


def _differ(sizes, percent: int):
    """Members in which linked sets whose sizes have this sum can differ.

    Sets of sizes x and y with a Jaccard similarity of t or more differ in at most
    (x + y) (1 - t) / (1 + t) members: (x + y) / 19 for 90 percent, (x + y) / 9 for 80.
    """
    return sizes * (100 - percent) // (100 + percent)


@cache
def _classes(largest: int, percent: int = 90) -> tuple[np.ndarray, np.ndarray]:
    """Least sizes of the classes and the greatest difference of linked sets in each.

    The last class is beyond every size that a set of ``largest`` members can link with.
    """
    least = [1, 2]
    while least[-2] <= 100 * largest // percent:
        least.append(max(least[-1] + 1, int(least[-1] * CLASS_RATIO)))
    return np.array(least[:-1]), _differ(2 * (np.array(least[1:]) - 1), percent)


def _class_keys(rows: np.ndarray, grams: np.ndarray, n_rows: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each step above the own class: rows and keys, ordered by row; of every row how many keys it shares with a set that it links with, and how many members both can differ in.

    See ``fragment_keys``. A linked pair of which the larger set is of the class has at most ``_differ`` unequal
    fragments, for the greatest size the row's set can link with in it. All other keys of the row are keys of the other set
    too, but for ``SPARE`` empty fragments that only the row gives keys for.
    """
    n = np.bincount(rows, minlength=n_rows)
    least, differ = _classes(int(n.max(initial=1)), percent)
    most = np.append(least[1:] - 1, np.iinfo(np.int64).max)
    own = np.searchsorted(least, n, "right") - 1
    for step in range(len(least)):
        of = np.minimum(own + step, len(least) - 1)
        reaches = (n > 0) & ((step == 0) | (100 * n >= percent * least[of]))
        if not reaches.any():
            break
        takes_part = reaches & (differ[of] > 0)
        mine = takes_part[rows]
        r, g = rows[mine], grams[mine]
        if not len(r):
            continue
        cuts = differ[of] + 1 + SPARE
        fragment = ((g >> np.uint64(32)) * cuts[r].astype(np.uint64)) >> np.uint64(32)
        at = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (fragment[1:] != fragment[:-1])]))
        r, fragment = r[at], fragment[at].astype(np.int64)
        content = np.add.reduceat(_mix(g + np.uint64(7)), at)
        where = _mix((of * (1 << 32)).astype(np.uint64)[r] + fragment.astype(np.uint64) + np.uint64(1))
        out_rows, out_keys = [r], [_mix(content + where)]
        full = np.bincount(r, minlength=n_rows)
        can_differ = _differ(n + np.minimum(100 * n // percent, most[of]), percent)
        needs = full - can_differ
        for row in np.flatnonzero(takes_part & (cuts - full > SPARE)):
            empty = np.setdiff1d(np.arange(cuts[row]), fragment[np.searchsorted(r, row):np.searchsorted(r, row, "right")])
            out_rows.append(np.full(len(empty), row))
            out_keys.append(_mix(_mix((np.full(len(empty), of[row]) * (1 << 32)).astype(np.uint64) + empty.astype(np.uint64) + np.uint64(1))))
            needs[row] += len(empty) - SPARE
        out_rows, out_keys = np.concatenate(out_rows), np.concatenate(out_keys)
        order = np.argsort(out_rows, kind="stable")
        yield out_rows[order], out_keys[order], needs, can_differ


def fragment_keys(rows: np.ndarray, grams: np.ndarray, n_rows: int, percent: int = 90) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of the fragments of all sets: linked sets have a key in common.

    The global order of n-grams is cut into equal fragments, ``SPARE`` and one more than linked
    sets of a class can differ in members, so they have ``SPARE`` + 1 equal fragments at least. The key
    of a fragment is a hash of its members. A set takes part in its own class and in each greater one
    that has sizes it can link with. Sets with over ``SPARE`` empty fragments give
    keys for those too, as two of them could have no other equal fragment; two
    sets of which one has fewer always share a fragment that is not empty. Classes in which
    linked sets cannot differ need no keys: equal sets are known by their id.
    """
    steps = list(_class_keys(rows, grams, n_rows, percent))
    if not steps:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    out_rows, out_keys = (np.concatenate(x) for x in list(zip(*steps))[:2])
    order = np.argsort(out_rows, kind="stable")
    return out_rows[order], out_keys[order]


def _lists(rows: np.ndarray, values: np.ndarray, n_rows: int) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _set_ids(rows: np.ndarray, grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of the members and size of each set; 0 for empty sets."""
    ids = np.zeros(len(n), dtype=np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(n)])[:-1][full]
        ids[full] = _mix(np.add.reduceat(_mix(grams), starts) + n[full].astype(np.uint64))
    return ids


def _parts(rows: np.ndarray, grams: np.ndarray, n_rows: int, percent: int) -> pa.ListArray:
    """The parts of each row: see ``_class_keys``."""
    steps = list(_class_keys(rows, grams, n_rows, percent))
    has = [np.bincount(r, minlength=n_rows) for r, *_ in steps]
    at = [np.flatnonzero(h) for h in has]
    row, needs, differ = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (at, *([s[c][i] for s, i in zip(steps, at)] for c in (2, 3))))
    sizes = np.concatenate([np.zeros(0, np.int64), *(h[i] for h, i in zip(has, at))])
    keys = np.concatenate([np.zeros(0, np.uint64), *(s[1] for s in steps)])
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    order = pa.array(np.argsort(row, kind="stable"))
    parts = pa.StructArray.from_arrays([pa.array(needs), pa.array(differ), pa.ListArray.from_arrays(ends, pa.array(keys.view(np.int64)))], ["needs", "differ", "keys"])
    of_row = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n_rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(of_row), parts.take(order))


def _emit_sets(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, rows, grams in shingle_sets(batch["text"], width):
                n = np.bincount(rows, minlength=last - first)
                ids = _set_ids(rows, grams, n)
                once = np.zeros(last - first, dtype=bool)
                once[np.unique(ids, return_index=True)[1]] = True  # equal sets of one slice give keys once
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["text_key"], pa.array(n, pa.int64()), pa.array(ids.view(np.int64)),
                     _parts(rows[once[rows]], grams[once[rows]], last - first, percent)],
                    ["doc_id", "text_key", "n", "set_id", "parts"])
    return run


def _emit_grams(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, rows, grams in shingle_sets(batch["text"], width):
                n = np.bincount(rows, minlength=last - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_set_ids(rows, grams, n).view(np.int64)), _lists(rows, grams, last - first)], ["set_id", "grams"])
    return run


def _compare(percent: int):
    """The pairs of sets that link. The overlap is counted in every fragment of the larger set's class, and summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_values, b_values = (batch[x].flatten().to_numpy().view(np.uint64) for x in ("grams_a", "grams_b"))
            a_ends, b_ends = (batch[x].offsets.to_numpy() for x in ("grams_a", "grams_b"))
            linked = []
            for i in range(len(batch)):
                a, b = a_values[a_ends[i] - a_ends[0]:a_ends[i + 1] - a_ends[0]], b_values[b_ends[i] - b_ends[0]:b_ends[i + 1] - b_ends[0]]
                in_a = np.isin(b, a, assume_unique=True)
                least, most = _classes(max(len(a), len(b)), percent)
                cuts = most[np.searchsorted(least, max(len(a), len(b)), "right") - 1] + 1 + SPARE
                overlaps = np.bincount((((b[in_a] >> np.uint64(32)) * np.uint64(cuts)) >> np.uint64(32)).astype(np.int64), minlength=cuts)
                common = int(overlaps.sum())
                linked.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return run


def _links(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs that link; stored. Each pair carries the n-grams of one of its sets through a shuffle."""
    both = (
        pairs.join(grams.select(F.col("set_id").alias("b"), F.col("grams").alias("grams_b")).hint("merge"), "b")
        .join(grams.select(F.col("set_id").alias("a"), F.col("grams").alias("grams_a")).hint("merge"), "a")
    )
    return stored(both.select("a", "b", "grams_a", "grams_b").mapInArrow(_compare(percent), "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that can be reached over links ``a, b``; only nodes with links.

    In each round every node takes the smallest label of its neighbours and then the label
    of its label; rounds are written to the shared folder and end when nothing changes.
    """
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        hooked = labels.join(near, F.col("node") == F.col("a")).select("node", "component", F.least("component", "near").alias("hooked"))
        next_ = labels.select(F.col("node").alias("hooked"), F.col("component").alias("jumped"))
        moved = stored(hooked.join(next_, "hooked").select(
            "node", F.least("hooked", "jumped").alias("component"), (F.least("hooked", "jumped") < F.col("component")).alias("moved")), "labels")
        labels = moved.select("node", "component")
        if not moved.where("moved").limit(1).count():
            return labels


def _several(members: DataFrame, by: list[str], value: str) -> DataFrame:
    """The rows of those groups that hold more than one ``value``."""
    spread = members.groupBy(*by).agg(F.min(value).alias("_low"), F.max(value).alias("_high")).where("_low <> _high").select(*by)
    return members.join(spread, by, "left_semi")


def _enough(shared: DataFrame) -> DataFrame:
    """The keys that several sets share, of those parts that share as many as a link needs."""
    parts = Window.partitionBy("set_id", "step")
    return stored(_several(
        shared.withColumn("_keys", F.count("*").over(parts)).where("_keys >= needs").drop("_keys"), ["key"], "set_id"), "ngram-enough")


def _rarest(shared: DataFrame) -> DataFrame:
    """Of the keys of each part the rarest, one more than all without those that a link needs.

    Keys of one set alone would come first of all and are no part of ``shared``. A linked pair shares as many keys as it needs, so
    the rarest of those is among the keys that are left of both. ``room`` is negative where the pair may not differ in so
    many members as keys come before: if it and the differences of a pair sum up to less than 0, this is not the rarest key of a pair that links.
    """
    sizes = shared.groupBy("key").agg(F.count("*").alias("_sets"))
    parts = Window.partitionBy("set_id", "step")
    ranked = shared.join(sizes, "key").withColumn("_left", F.count("*").over(parts) - F.col("needs") + 1 - F.row_number().over(parts.orderBy("_sets", "key")))
    return _several(ranked.where("_left >= 0").select("key", "set_id", "n", (F.col("_left") - F.col("differ")).alias("room")), ["key"], "set_id")


def _rarest_grams(open_: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """``gram, set_id, n, component, at``: of each of the sets ``set_id, n, component`` the n-grams of which one is the first in common with a linked set.

    ``at`` members come before in one order of all n-grams: those of sets of one component alone, then the rarest. Linked
    sets have at least ``percent`` of the larger one in common, so of both sets ``n - at`` is that at least for the first n-gram in common.
    An edit gives a copy n-grams of its own, so few sets of a group of near copies have one of its base's among their first.
    """
    each = open_.join(grams, "set_id").select("set_id", "n", "component", F.explode("grams").alias("gram"))
    spread = each.groupBy("gram").agg(F.count("*").alias("_sets"), F.min("component").alias("_low"), F.max("component").alias("_high")).where(
        "_low <> _high").select("gram", "_sets")
    of_set = Window.partitionBy("set_id")
    ranked = each.join(spread, "gram").withColumn(
        "at", F.col("n") - F.count("*").over(of_set) + F.row_number().over(of_set.orderBy("_sets", "gram")) - 1)
    first = stored(ranked.where(f"100 * at <= {100 - percent} * n").drop("_sets"), "rarest-grams")
    return _several(first, ["gram"], "component")


def ngram_components(
    docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text", percent: int = 90,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    A text's set are its distinct ``width``-word n-grams (shorter texts: all words as one);
    words stand between ASCII white space, A-Z are lower-cased. Texts link when their sets
    have a Jaccard similarity of ``percent`` (1 to 100) or more, and ``component_id`` is the smallest id
    reachable over links. Null or empty texts have empty sets and link with nothing, so their own id
    is their component's. Null ids do not count as smallest unless there is no other. Repeated rows
    are each returned. N-grams are known by 64-bit hashes. Other columns are not read.

    1. Sets and fragment keys of every text are stored; rows with one key meet by one shuffle, in
       which neighbours of the sorted rows tell whether a key holds several sets.
    2. Linked sets share all keys but as many as they can differ in. Sets that share fewer with others go, twice, and
       of the rest of each set the rarest keys stay, so many that a linked pair still has one in common.
    3. In each key the set with most shared keys is the hub. Pairs with a hub are compared first, so a
       group of n near copies costs n comparisons, and their links make components.
    4. A linked pair that is left lies in two components of one key. Of the sets of such keys the rarest n-grams are taken, and pairs
       are compared that have one in common whose places in both sets leave room for a link.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    sets = stored(texts.mapInArrow(
        _emit_sets(width, percent),
        f"doc_id {id_type}, text_key long, n long, set_id long, parts array<struct<needs long, differ long, keys array<long>>>"), "ngram-sets")

    by_key = Window.partitionBy("key").orderBy("set_id")
    parts = sets.select("set_id", "n", F.posexplode("parts").alias("step", "part"))
    shared = stored(
        parts.select("set_id", "step", F.explode("part.keys").alias("key"))
        .withColumns({"_before": F.lag("set_id").over(by_key), "_after": F.lead("set_id").over(by_key)})
        .where("_before <> set_id or _after <> set_id").select("key", "set_id", "step").distinct(), "ngram-shared")
    needed = parts.select("set_id", "step", "n", "part.needs", "part.differ").dropDuplicates(["set_id", "step"])
    members = stored(_rarest(_enough(_enough(shared.join(needed, ["set_id", "step"])))), "ngram-members")

    # the n-grams of sets that share a key, taken from the first of the texts of each
    wanted = members.select("set_id").distinct().join(sets.select("set_id", "text_key"), "set_id").groupBy("set_id").agg(
        F.min("text_key").alias("text_key"))
    grams = stored(
        texts.join(wanted.select("text_key").distinct().hint("merge"), "text_key", "left_semi").select("text")
        .mapInArrow(_emit_grams(width), "set_id long, grams array<long>").dropDuplicates(["set_id"]), "ngrams")

    often = members.groupBy("set_id").agg(F.count("*").alias("keys"))
    hubs = members.join(often, "set_id").groupBy("key").agg(F.max(F.struct("keys", "set_id", "n", "room")).alias("hub"))
    spokes = stored(members.join(hubs.select("key", "hub.set_id", "hub.n", "hub.room").toDF("key", "hub", "n_hub", "room_hub"), "key"), "spokes")
    may_link = "100 * least(n_x, n_y) >= {p} * greatest(n_x, n_y) and least(room_x, room_y) + (n_x + n_y) * {q} div {r} >= 0".format(
        p=percent, q=100 - percent, r=100 + percent)
    near = spokes.where("hub <> set_id").select(
        "hub", "set_id", *[F.col(c).alias(f"{c}_y") for c in ("n", "room")], F.col("n_hub").alias("n_x"), F.col("room_hub").alias("room_x"))
    links = _links(near.where(may_link).select(F.col("hub").alias("a"), F.col("set_id").alias("b")).distinct(), grams, percent)
    first = components(links)

    grouped = spokes.where("hub <> set_id").join(first, F.col("set_id") == F.col("node"), "left").select(
        "key", "set_id", "n", F.coalesce("component", "set_id").alias("component"))
    open_ = stored(_several(grouped, ["key"], "component").select("set_id", "n", "component").distinct(), "open")
    rare = stored(_rarest_grams(open_, grams, percent), "open-grams")
    x, y = ([F.col(c).alias(f"{c}_{side}") for c in ("set_id", "n", "component", "at")] for side in "xy")
    left = rare.select("gram", *x).join(rare.select("gram", *y), "gram").where(
        f"component_x < component_y and least(n_x - at_x, n_y - at_y) * {100 + percent} >= {percent} * (n_x + n_y)")
    more = _links(left.select(F.col("set_id_x").alias("a"), F.col("set_id_y").alias("b")).distinct(), grams, percent)
    joined = components(links.union(more))

    of_set = sets.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_id")).join(
        joined, F.col("set_id") == F.col("node"), "left").select("set_id", "first_id", F.coalesce("component", "set_id").alias("component"))
    ends = of_set.groupBy("component").agg(F.min("first_id").alias("component_id"))
    placed = of_set.join(ends, "component").select(F.col("set_id").alias("_set"), "component_id")
    return sets.select("doc_id", "n", "set_id").join(placed, (F.col("set_id") == F.col("_set")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
