"""Collocations against counts of all phrases."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from noticeworks.llm import collocations as co
from tests.llm.frames import empty, odd


def brute(rows, threshold, percent=100, top=2000, longest=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    often = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= threshold}
    inside = set()
    for (lang, words), c in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * c >= percent * f[lang, words[i:i + k]]:
                    inside.add((lang, words[i:i + k]))
    by_lang = {}
    for (lang, words), a in often.items():
        if (lang, words) not in inside:
            parts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, k = min((1000 * a * n[lang] // (left * right), k) for k, (left, right) in enumerate(parts))
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), *parts[k]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, v in by_lang.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(v)[:top], 1))


@pytest.fixture(scope="module")
def texts(spark):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text").collect()]


@pytest.mark.parametrize("threshold, percent, top, longest, shards, log2", [
    (8, 100, 2000, 5, 4, 26), (5, 80, 7, 4, 1, 26), (4, 100, 2000, 7, 3, 4), (30, 100, 50, 2, 2, 20)])
def test_equals_counts_of_all_phrases(spark, texts, threshold, percent, top, longest, shards, log2):
    docs = spark.createDataFrame(texts, "lang string, text string").repartition(5)
    got = co.collocations(docs, threshold=threshold, percent=percent, top=top, longest=longest, shards=shards, log2=log2)
    assert sorted(map(tuple, got.collect())) == brute(texts, threshold, percent, top, longest)


ODD = [
    (None, "A b, a B! a b\x0ba\x0bb"), ("und", "a b a b c"), ("", "a b " * 6), ("x", None), ("x", ""), ("x", " \t ; .. "), ("x", "a a a a a a a"),
    ("x", "É é. É é; É é"), ("x", "\x1ca b \x1ca b \x1ca b"), ("y", "a b c d e f " * 5), ("y", "w " * 2_000 + "long"), ("y", "a b c d e f " * 5)]


def test_odd_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(lang, t, 1, "p", 2) for lang, t in ODD], "lang string, text string, key int, phrase string, count int")
    for shards in (1, 3):
        got = sorted(map(tuple, co.collocations(docs, threshold=3, shards=shards).collect()))
        assert got == brute(ODD, 3)


def test_tables_without_frequent_phrases(spark):
    assert co.collocations(empty(spark)).collect() == []
    assert co.collocations(spark.createDataFrame([("en", "a b c")], "lang string, text string")).collect() == []
    assert {r["lang"] for r in co.collocations(odd(spark), threshold=30).collect()} == {"en"}


def test_lengths_are_interleaved_and_every_cycle_is_whole(spark, texts):
    docs = spark.createDataFrame(texts * 3, "lang string, text string").repartition(8)
    tokens = co.tokenized(docs, "text", "lang", 4)
    counted = co.count_phrases(tokens, 12, 5, 4, 26)
    first = {r["key"] & 7: r["first"] for r in counted.frequent.groupBy("key").agg({"first": "min"}).toDF("key", "first").orderBy("first", ascending=False).collect()}
    assert first[2] < 4 and first[3] < 8  # longer phrases begin before the words and pairs have been through all shards
    assert counted.steps <= 5 * 4


def test_driver_holds_few_bitmaps(spark):
    """However many scans there are: bitmaps of 8 MB are packed when the next one is made."""
    docs = spark.createDataFrame([("en", "a b c d e f g") for _ in range(40)], "lang string, text string").repartition(4)
    tokens = co.tokenized(docs, "text", "lang", 4)
    tracemalloc.start()
    try:
        steps = co.count_phrases(tokens, 12, 5, 4, 26).steps
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert steps >= 6 and peak < 45e6


def test_bits_hold_what_was_added(spark):
    rng = random.Random(5)
    keys = [rng.getrandbits(64) - 2**63 for _ in range(500)]
    for log2 in (3, 10, 20):
        bits = co.Bits.empty(log2).plus(spark.createDataFrame([(k,) for k in keys], "key long"))
        assert bits.holds(np.array(keys).view(np.uint64)).all()
        places = {(k % 2**64) >> (64 - log2) for k in keys}
        assert int(np.unpackbits(bits.bits).sum()) == len(places)


def test_products_beyond_64_bits(spark):
    counts = [(3 * 10**12, 10**13, 7 * 10**12, 9 * 10**12 + 1)]
    frame = spark.createDataFrame(counts, "count long, n long, l long, r long")
    row = frame.selectExpr(co.SCORE.format(left="l", right="r") + " as score").first()
    a, n, left, right = counts[0]
    assert row["score"] == 1000 * a * n // (left * right)


def test_keys_tell_language_and_length(spark):
    a, b = co.word_keys("en", pa.array(["x", "y"])), co.word_keys("de", pa.array(["x", "y"]))
    assert len({*a.tolist(), *b.tolist()}) == 4
    assert {int(k) & 7 for k in co.longer_keys(a, b, 5)} == {5}
