"""Stages of the pipeline against brute force."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from noticeworks.llm import language, ngram_join
from tests.llm.frames import SCHEMA, odd
from tests.llm.test_dedup import edited, grams


def frame(spark, rows):
    """Documents from id, text and, if given, lang and source."""
    return spark.createDataFrame([(*r, *("en", "a")[len(r) - 2:], len(r[1] or ""), "", "", 0, 0, "", "") for r in rows], SCHEMA)


def brute_labels(rows, width, percent):
    """The smallest row number reachable over links, for every row."""
    sets, up = [grams(r[1], width) for r in rows], list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        n = len(sets[i] & sets[j])
        if n and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            a, b = sorted((up[i], up[j]))
            up = [a if x == b else x for x in up]
    return up


def near_copies(seed, size):
    """Groups with edits about the threshold of 0.8 on five words, chains and texts with a shared passage."""
    rnd = random.Random(seed)
    passage, texts = [f"p{i}" for i in range(size // 2)], []
    for g in range(4):
        base = [f"g{g}w{rnd.randrange(10 ** 6)}" for _ in range(size + g)]
        for _ in range(20):
            text = edited(rnd, base, rnd.randrange(0, max(2, size // 25)))
            texts.append(text + [f"x{rnd.randrange(3)}"] * rnd.choice([0, 0, rnd.randrange(1, max(2, size // 5))]))
        for _ in range(6):
            base = edited(rnd, base, max(1, size // 50))
            texts.append(base)
    texts += [passage + [f"o{rnd.randrange(10 ** 6)}" for _ in range(size // 2)] for _ in range(20)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,size", [(1, 30), (2, 100), (3, 300)])
def test_near_copies_stage_is_brute_force(spark, seed, size):
    rows = near_copies(seed, size)
    kept = corpus_pipeline.one_of_near_copies(spark, frame(spark, rows), "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(brute_labels(rows, 5, 80)))


def test_one_row_of_each_group_stays(spark):
    """One id on different texts, equal rows, rows without id, and empty texts."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a), (2, a + " more"), (2, b), (3, c), (3, c), (None, d), (None, d), (None, c), (5, ""), (5, ""), (6, None), (7, b + " z"), (None, " ")]
    kept = corpus_pipeline.one_of_near_copies(spark, frame(spark, rows), "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted(
        [(1, a), (2, b), (3, c), (None, d), (5, ""), (5, ""), (6, None), (None, " ")], key=repr)
    assert kept[0].asDict().keys() == {x.split()[0] for x in SCHEMA.split(", ")}


def test_two_changed_words_in_a_hundred_are_a_near_copy(spark):
    words = [f"w{i}" for i in range(100)]
    other = ["x" if i in (30, 70) else w for i, w in enumerate(words)]
    assert len(corpus_pipeline.one_of_near_copies(spark, frame(spark, [(1, " ".join(words)), (2, " ".join(other))]), "").collect()) == 1


def sizes_of_stored(monkeypatch):
    """Rows of all that is stored from now on, by label."""
    sizes, store = {}, ngram_join.stored

    def counted(frame, label):
        out = store(frame, label)
        sizes[label] = sizes.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    return sizes


def test_texts_with_a_shared_passage_are_not_compared(spark, monkeypatch):
    """They share keys, but fewer than linked texts do, so none of their sets is sent to be compared."""
    sizes = sizes_of_stored(monkeypatch)
    passage = [f"p{i}" for i in range(120)]
    rows = [(i, " ".join(passage + [f"t{i}w{j}" for j in range(240)])) for i in range(20)]
    assert corpus_pipeline.one_of_near_copies(spark, frame(spark, rows), "").count() == 20
    assert sizes["ngram-shared"] > 0 and sizes["ngrams"] == 0


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (2, 50), (1, 35), (2, 100)])
def test_join_of_other_bounds(spark, width, percent):
    rows = near_copies(7, 40)
    got = ngram_join.ngram_components(frame(spark, rows), width=width, percent=percent).collect()
    assert [r["component_id"] for r in sorted(got, key=lambda r: r["doc_id"])] == brute_labels(rows, width, percent)


@pytest.mark.parametrize("percent", [90, 80, 50, 30])
def test_linked_sets_have_a_key_in_common(percent):
    rnd = np.random.default_rng(3)
    for size in (20, 21, 40, 57):
        for bits in (60, 63):  # for 60 most fragments are empty
            base = np.unique(rnd.integers(0, 2 ** bits, size, dtype=np.uint64))
            for drop in range(1, len(base) * (100 - percent) // 100 + 1):
                other = np.delete(base, rnd.choice(len(base), drop, replace=False))
                rows = np.concatenate([np.zeros(len(base), int), np.ones(len(other), int)])
                of, keys = ngram_join.fragment_keys(rows, np.concatenate([base, other]), 2, percent)
                assert set(keys[of == 0].tolist()) & set(keys[of == 1].tolist())


def test_every_accepted_row_survives_the_language_stage(spark):
    text = "one two three four five"
    given = [(20, "en-GB", "a"), (21, "EN", "a"), (22, "", "a"), (23, " en", "a"), (24, "xx-not-a-lang", "a"), (25, "en", "Capital.Source"), (26, None, None)]
    docs = odd(spark).unionByName(frame(spark, [(i, text, lang, source) for i, lang, source in given]))
    found = language.identify(docs, language.fit_text_model(docs), declared=F.col("lang"), host=F.col("source"))
    accepted = [r["id"] for r in found.where("accepted").collect()]
    assert {i for i, _, _ in given} <= set(accepted)
    kept = [r["doc_id"] for r in corpus_pipeline.known_language(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted(accepted, key=repr)


def test_rare_languages_are_fitted_and_copies_count_once(spark):
    common = spark.range(3000).select(F.concat(F.lit("common"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"), F.lit("en").alias("lang"))
    copies = spark.range(2000).select(F.lit("again zzzz").alias("text"), F.lit("en").alias("lang"))
    rare = spark.range(10).select(F.lit("qqqq").alias("text"), F.lit("xx").alias("lang")).union(
        spark.createDataFrame([("wwww", "xx"), ("vvvv", "xx")], "text string, lang string"))
    langs, table = language.fit_text_model(common.union(copies).union(rare), max_rows=100)
    assert langs == ["en", "xx"]

    def seen(word, lang):  # how often its middle trigram was counted
        column = np.exp(table[:, langs.index(lang)])
        return round(0.5 * column[language.trigrams(pa.array([word]))[0][1]] / column.min() - 0.5)

    assert [seen(w, "xx") for w in ("qqqq", "wwww", "vvvv")] == [2, 2, 2]  # once each, with two equal trigrams
    assert seen("zzzz", "en") <= 2 and 50 <= seen("com", "en") <= 150
    assert language._bound([3, 3000], 100) == 97 and language._bound([3, 5], 100) >= 5
