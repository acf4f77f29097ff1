"""Katz scores against a plain computation with dictionaries."""

import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from noticeworks.llm import katz

WORDS = re.compile("[^\x20\x09-\x0d]+")


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*WORDS.findall(low), None]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows):
    """Scores of rows, and the conditional probability as a function."""
    words, pairs, after = Counter(), Counter(), defaultdict(set)
    starts = 0
    for i, text in rows:
        if not held_out(i):
            starts += 1
            for a, b in zip(["<start>", *tokens(text)], tokens(text)):
                words[b] += 1
                pairs[a, b] += 1
                after[a].add(b)
    n = sum(words.values())

    def discounts(counts):
        of = Counter(counts.values())
        return katz.Discounts.good_turing([of[r] for r in range(1, katz.DISCOUNTED + 2)])

    def kept(d, r):
        return d.at[r] * r if r <= katz.DISCOUNTED else r - d.loss

    dw, dp = discounts(words), discounts(pairs)
    unknown = 1 - sum(kept(dw, r) for r in words.values()) / n if n else 1.0

    def lower(w):
        return kept(dw, words[w]) / n if words[w] else unknown

    def context(a):
        return starts if a == "<start>" else words[a]

    def p(a, w):
        if pairs[a, w]:
            return kept(dp, pairs[a, w]) / context(a)
        if not context(a):
            return lower(w)
        left = 1 - sum(kept(dp, pairs[a, x]) for x in after[a]) / context(a)
        return left / (1 - sum(lower(x) for x in after[a])) * lower(w)

    out = []
    for i, text in rows:
        t = tokens(text)
        out.append((
            i, held_out(i), len(t), sum(words[w] > 0 for w in t), n, sum(math.log10((words[w] + 1) / (n + len(words) + 1)) for w in t),
            sum(math.log10(p(a, w)) for a, w in zip(["<start>", *t], t))))
    return out, p, [*words, "<unknown>"], [*after, "<never>"]


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    got = sorted((tuple(r) for r in katz.katz_scores(docs).collect()), key=repr)
    want = sorted(brute(rows)[0], key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_scores_match_on_real_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_odd_rows(spark):
    check(spark, [(None, "a b"), (1, None), (1, ""), (2, "A b\x0bc d"), (2, "a b"), (3, "É é É"), (4, "a " * 3000), (9, "zz yy zz")])


def test_rows_that_come_out_of_a_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = sorted(map(tuple, katz.katz_scores(docs).collect()))
    others = docs.select("doc_id").distinct()
    for shuffled in (docs.repartition(64, "doc_id"), docs.distinct(), docs.hint("shuffle_hash").join(others.repartition(7), "doc_id")):
        got = sorted(map(tuple, katz.katz_scores(shuffled).collect()))
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], rel=1e-9)


def test_nothing_to_learn_from(spark):
    alone = next(i for i in range(100) if held_out(i))
    check(spark, [(alone, "a b c")])
    assert katz.katz_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_each_context_sums_to_one(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(20).collect()]
    _, p, words, contexts = brute(rows)
    for a in contexts[::37] + contexts[-1:]:
        assert sum(p(a, w) for w in words) == pytest.approx(1.0, abs=1e-9)


def test_discounts_of_uneven_counts():
    for n in ([0] * 6, [5, 0, 3, 0, 0, 1], [1, 1, 1, 1, 1, 1], [100, 40, 20, 12, 8, 6]):
        d = katz.Discounts.good_turing(n)
        assert all(0 < x < 1 for x in d.at[1:]) and 0 < d.loss < katz.DISCOUNTED


def test_memory_of_a_slice_by_its_tokens():
    """A slice sorts its pairs only, and the buffers of its words are gone by then."""
    rng = np.random.default_rng(3)
    texts = pa.array([" ".join(f"w{i}" for i in rng.zipf(1.3, 1000) % 50_000) for _ in range(500)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    tracemalloc.start()
    slices = list(katz._slices(batch))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    (_, _, s), = slices
    assert len(s.row) == 500_500 and peak < 100 * len(s.row)
    words = s.keys & np.uint64(1) == 0
    assert words[s.word].all() and not words[s.pair].any() and (np.diff(s.keys.astype(object)) > 0).all()
    assert (s.before[1:][s.row[1:] == s.row[:-1]] == s.word[:-1][s.row[1:] == s.row[:-1]]).all() and (s.before[np.flatnonzero(np.diff(s.row)) + 1] == -1).all()
