"""Periodic runs against a scan of every period."""

import hashlib
import random
import re
import zlib

import numpy as np

from noticeworks.llm import periodic_runs as pr
from noticeworks.llm.queries import QUERIES
from tests.llm.frames import empty, odd


def brute(words, least=12):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def planted(rng, n, letters):
    words = [rng.randint(1, letters) for _ in range(n)]
    for _ in range(rng.randint(0, 2) if n > 20 else 0):
        first = rng.randrange(n)
        last = rng.randint(first, n)
        p = 1 + (last - first) // rng.randint(2, 9)
        for i in range(first, last):
            words[i] = words[first + (i - first) % p]
    return words


def test_cover_has_every_distance():
    for modulus in (1, 2, 7, 13, 21):
        cover = pr.difference_cover(modulus)
        assert {int(a - b) % modulus for a in cover for b in cover} == set(range(modulus))


def test_extensions_equal_a_comparison_word_by_word():
    rng = random.Random(3)
    texts = [planted(rng, n, k) for n, k in ((0, 1), (1, 1), (90, 1), (200, 2), (300, 3), (300, 40))]
    words = np.array([0, *(w for t in texts for w in [*t, 0])])
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    extend = pr.Extensions(words)
    for t, begin in zip(texts, begins):
        for _ in range(300 if len(t) > 1 else 0):
            a, b = rng.sample(range(len(t)), 2)
            n = 0
            while max(a, b) + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            assert extend(np.array([begin + a]), np.array([begin + b]))[0] == n


def test_runs_equal_a_scan_of_every_period(monkeypatch):
    rng = random.Random(1)
    for trial in range(200):
        monkeypatch.setattr(pr, "PAIRS", rng.choice([1, 50, 1 << 21]))
        texts = [planted(rng, rng.choice([0, 1, 5, 12, 30, 200, 400]), rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(0, 5))]
        words = np.array([0, *(w for t in texts for w in [*t, 0])])
        begins = np.cumsum([1, *(len(t) + 1 for t in texts)])[:-1]
        got = [[] for _ in texts]
        for t, *run in zip(*(c.tolist() for c in pr.runs_of(words, begins, np.array([len(t) for t in texts], dtype=np.int64)))):
            got[t].append(tuple(run))
        assert got == [brute(t) for t in texts]


def check(spark, rows, got):
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()), key=repr)
    want = [(i, len(split(t)), brute(split(t)), collapsed(split(t), brute(split(t)))) for i, t in rows]
    assert got == sorted(want, key=repr)


def test_odd_rows(spark):
    rows = [
        (1, None), (1, ""), (None, "a b " * 9), (2, "x " * 11), (2, "x " * 12), (2, "x " * 12), (3, " \t\n"), (4, "A a " * 6 + "\x0bq\x1cq é É"),
        (5, "u v w " * 3 + "u v w x " * 4 + "v w x " * 5), (6, " ".join(f"w{i % 701}" for i in range(5_000)))]
    docs = spark.createDataFrame([(i, t, "r", 1) for i, t in rows], "doc_id long, text string, runs string, period int")
    check(spark, rows, pr.periodic_runs(docs))


def test_a_long_text_and_the_shared_odd_table(spark):
    got = {r["doc_id"]: r for r in pr.periodic_runs(odd(spark)).collect()}
    assert [tuple(r) for r in got[5]["runs"]] == [(0, 40_000, 977)]
    assert got[5]["collapsed"].split(" ") == [f"w{i}" for i in range(977)]
    assert got[6]["n_words"] == 40_001 and got[6]["collapsed"].endswith("w976 more")
    assert pr.periodic_runs(odd(spark)).count() == odd(spark).count()
    assert pr.periodic_runs(empty(spark)).collect() == []


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    want = {}
    for i, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        words = split(text)[:]
        h = zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        runs = brute(words)
        s, length, p = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        digests = ("".join("%d,%d,%d\n" % r for r in runs), collapsed(words, runs))
        want[i] = (len(runs), s, length, p, 1000 * length // p if p else None, *(hashlib.sha256(x.encode()).hexdigest() for x in digests))
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    assert got == want
    assert sum(1 for w in want.values() if w[0]) > len(want) // 15
