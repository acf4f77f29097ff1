"""Exact dedup, line dedup, sharding and the n-gram join."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeworks.llm import exact_dedup, line_dedup, ngram_join, ring_sharding
from noticeworks.llm.common import stored
from tests.llm.frames import SCHEMA, empty, odd

WORDS = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_dedup_of_odd_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in odd(spark).collect()]
    got = exact_dedup.exact_dedup(odd(spark), capacity=2).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    assert len(got) == len(rows)
    for r in got:
        same = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        assert r["group_size"] == len(same)
        assert r["keep_id"] == max((i for i in same if i is not None), default=None)
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_directory_doubles_until_buckets_fit(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("h"))
    cells = exact_dedup.directory(hashes, 100, 10).collect()
    held = Counter()
    of = {r["cell"]: (r["bucket"], r["local_depth"]) for r in cells}
    for r in hashes.collect():
        held[of[(r["h"] % 2 ** 64) >> 54]] += 1
    assert max(held.values()) <= 100 and sum(held.values()) == 3000
    for (bucket, depth), n in held.items():  # no bucket was split without need
        parent = (bucket >> (11 - depth)) << (11 - depth)
        assert depth == 0 or sum(m for (b, d), m in held.items() if (b >> (11 - depth)) << (11 - depth) == parent) > 100
    # at the last depth a bucket may stay overfull
    same = spark.range(50).select(F.lit(7).cast("long").alias("h"))
    assert [r["local_depth"] for r in exact_dedup.directory(same, 10, 4).collect()] == [4]


def test_colliding_hashes_are_told_apart(spark):
    # all texts of one bucket: the bytes decide, not the bucket
    docs = spark.createDataFrame([(i, f"t{i % 7}") for i in range(70)], "doc_id long, text string")
    got = exact_dedup.exact_dedup(docs, capacity=10 ** 6).select("text_sha256", "group_size", "local_depth").distinct().collect()
    assert sorted((r["group_size"], r["local_depth"]) for r in got) == [(10, 0)] * 7


def test_line_dedup(spark):
    rows = [(i, f"own {i}\n shared \nshared\r\n\ntail {i % 2}", "en", f"s{i % 6}") for i in range(12)]
    rows += [(50, None, "en", "s1"), (None, "shared\nx", "en", "s2"), (51, "", "en", "s1"), (52, "shared", "en", None), (0, "shared\nagain", "en", "s1")]
    got = {(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.line_dedup(odd(spark, rows), min_sites=5).collect()}
    want = {(i, f"own {i}\n" + (" shared \n" if i == 0 else "") + f"\ntail {i % 2}", 5, 1 if i == 0 else 2) for i in range(12)}
    want |= {(50, None, 0, 0), (None, "x", 2, 1), (51, "", 1, 0), (52, "", 1, 1), (0, "shared\nagain", 2, 0)}
    assert got == want
    assert line_dedup.line_dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("sites", [29, 30, 31])
def test_near_threshold_counts_are_exact(spark, sites):
    lines = spark.range(400 * sites).select(
        (F.col("id") % 400).alias("h"), F.floor(F.col("id") / 400).cast("string").alias("site"), F.col("id").alias("doc_id"))
    assert line_dedup.spread_lines(lines, 30, sketch_bits=4).count() == (400 if sites >= 30 else 0)


def sequential(counts, owner, loads):
    """Rows one after another, then the leftover ones walking on cell by cell."""
    room, placed, waiting = list(loads), {}, []
    for cell, n in enumerate(counts):
        for k in range(n):
            s = owner[cell]
            if room[s]:
                room[s] -= 1
                placed[cell, k] = s
            else:
                waiting.append((cell, k))
    walking = [(c, c, k) for c, k in waiting]
    queue = sorted(walking)
    active, cells = [], len(counts)
    for turn in range(3):
        for at in range(cells):
            if owner[at] != owner[at - 1]:
                while queue and turn == 0 and queue[0][0] < at:
                    active.append(queue.pop(0))
                while active and room[owner[at]]:
                    _, c, k = active.pop(0)
                    placed[c, k] = owner[at]
                    room[owner[at]] -= 1
        active += queue
        queue = []
    return placed


def test_ring_is_filled_as_one_by_one():
    rnd = np.random.default_rng(5)
    for _ in range(20):
        owner = ring_sharding.ring(5, 4, 64)
        counts = rnd.integers(0, 6, 64) * (rnd.random(64) < 0.7)
        total = int(counts.sum())
        loads = np.full(5, total // 5) + (np.arange(5) < total % 5)
        got = {(c, k): s for c, a, b, s, _ in ring_sharding.fill(counts, owner, loads) for k in range(a, b)}
        assert got == sequential(counts, owner, loads)


def test_shards_are_full_and_slots_have_no_gaps(spark):
    docs = spark.range(5003).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("é"), "id")).alias("text"))
    got = ring_sharding.bounded_ring_shards(docs).toPandas()
    assert len(got) == 5003 and got["doc_id"].nunique() == 5003
    sizes = got.groupby("shard").size()
    assert sorted(sizes.index) == list(range(24)) and sizes.max() - sizes.min() <= 1
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))
    plain = ring_sharding.ring(24, 64, 2 ** 16)
    assert np.bincount(plain, minlength=24).min() > 0
    assert ring_sharding.bounded_ring_shards(odd(spark)).count() == 13
    assert ring_sharding.bounded_ring_shards(empty(spark)).count() == 0
    alone = ring_sharding.bounded_ring_shards(spark.createDataFrame([(None, None)], "doc_id long, text string")).first()
    assert (alone["size"], alone["text_crc32"], alone["law"], alone["grown_shard"]) == (8, 0, "rows", None)


def test_growing_moves_few_rows(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    a = ring_sharding.bounded_ring_shards(docs, 24, 256).select("doc_id", F.col("shard").alias("a"))
    b = ring_sharding.bounded_ring_shards(docs, 25, 256).select("doc_id", F.col("shard").alias("b"))
    assert a.join(b, "doc_id").where("a <> b").count() < 6000  # 19,200 if shards were numbers mod 25


def grams(text, width=3):
    w = WORDS.findall(low(text))
    return {tuple(w)} - {()} if len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute_components(rows):
    sets = [grams(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j]:
            n = len(sets[i] & sets[j])
            if 100 * n >= 90 * (len(sets[i]) + len(sets[j]) - n):
                up[top(i)] = top(j)
    low_id = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None and (low_id[top(i)] is None or d < low_id[top(i)]):
            low_id[top(i)] = d
    return sorted(((d, len(s), low_id[top(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def test_ngram_join_of_odd_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in odd(spark).collect()]
    assert sorted(map(tuple, ngram_join.ngram_components(odd(spark)).collect()), key=repr) == brute_components(rows)
    assert ngram_join.ngram_components(empty(spark)).count() == 0


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10 ** 6)}"
    return words


@pytest.mark.parametrize("seed,size", [(1, 12), (2, 25), (3, 60), (4, 150), (5, 400)])
def test_ngram_join_of_near_copies(spark, seed, size):
    """Groups around a base text with edits about the threshold, chains, a shared passage and borders of size."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(size // 2)]
    rows = []
    for g in range(4):
        base = [f"g{g}w{rnd.randrange(10 ** 6)}" for _ in range(size + g)]
        for _ in range(25):
            text = edited(rnd, base, rnd.randrange(0, max(2, size // 25)))
            if rnd.random() < 0.3:
                text += [f"x{rnd.randrange(3)}"] * rnd.randrange(1, max(2, size // 12))
            rows.append(text)
        chain = base
        for _ in range(6):
            chain = edited(rnd, chain, max(1, size // 70))
            rows.append(chain)
    rows += [passage + [f"o{rnd.randrange(10 ** 6)}" for _ in range(size // 2)] for _ in range(30)]
    rows = [(i * 3 % 1000, " ".join(t)) for i, t in enumerate(rows)]
    frame = spark.createDataFrame([(i, t, None, None, 0, "", "", 0, 0, "", "") for i, t in rows], SCHEMA)
    assert sorted(map(tuple, ngram_join.ngram_components(frame).collect()), key=repr) == brute_components(rows)


def test_sets_of_one_hub_that_cannot_link_are_not_paired(spark, monkeypatch):
    """Texts with two passages in common are no candidates for each other: no n-grams of them are read."""
    read, store = {}, ngram_join.stored

    def kept(frame, label):
        read[label] = store(frame, label)
        return read[label]

    monkeypatch.setattr(ngram_join, "stored", kept)
    a, b = ([f"{x}{i}" for i in range(80)] for x in "ab")
    rows = [(i, " ".join(a + (b if i else []) + [f"t{i}w{j}" for j in range(80)])) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.ngram_components(docs).collect()), key=repr) == brute_components(rows)
    assert read["ngrams"].count() == 0


def test_copies_of_one_base_are_not_all_compared(spark, monkeypatch):
    """Copies with three edits each share most of the base, but none links with another: few pairs are left to compare."""
    pairs, link = [], ngram_join._links

    def counted(frame, *others):
        pairs.append(frame.count())
        return link(frame, *others)

    monkeypatch.setattr(ngram_join, "_links", counted)
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rnd, base, 1 if i < 20 else 3))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.ngram_components(docs).collect()), key=repr) == brute_components(rows)
    assert len(pairs) == 2 and pairs[0] > 0 and pairs[1] < 2 * len(rows)


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("shuffle_")

    counts = spark.range(1000).groupBy(F.col("id") % 10).count()
    before = files()
    stored(counts, "counts")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before


def test_sets_with_empty_fragments_still_meet():
    """Linked sets always have a key in common, also where most fragments are empty."""
    rnd = np.random.default_rng(3)
    for size in (20, 21, 40, 57):
        crowded = np.unique(rnd.integers(0, 2 ** 60, size, dtype=np.uint64))  # all in the lowest fragments
        for base in (crowded, np.unique(rnd.integers(0, 2 ** 63, size, dtype=np.uint64))):
            for drop in range(1, len(base) // 10 + 1):
                other = np.delete(base, rnd.choice(len(base), drop, replace=False))
                if 10 * len(other) < 9 * len(base):
                    continue
                rows = np.concatenate([np.zeros(len(base), int), np.ones(len(other), int)])
                of, keys = ngram_join.fragment_keys(rows, np.concatenate([base, other]), 2)
                assert set(keys[of == 0].tolist()) & set(keys[of == 1].tolist())


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (102, 100)]
    got = dict(map(tuple, ngram_join.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 102: 100}
