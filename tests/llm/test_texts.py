"""Pieces, preference pairs, toxicity, decontamination, language and the pipeline."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from noticeworks.llm import decontaminate, language, ordinal, pieces, preference
from noticeworks.llm.queries import PIECE_MODEL
from tests.llm.frames import empty, odd

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(PIECE_MODEL)


def texts_of(spark):
    return [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


def test_pieces_are_the_library_s(spark, vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rnd = random.Random(1)
    texts = texts_of(spark) + [
        "", " a", "a  b", " a ", "a\nb\tc", "ﬁ Ａ é", "\x00x", "a\xa0b", "<s>", "▁x", "a\r\nb", "  ", "x" * 500, "the" * 200, "😀 hi   there\n\n  x"]
    texts += ["".join(rnd.choice("abc  \n.éß😀12thein") for _ in range(rnd.randrange(300))) for _ in range(200)]
    ids, counts = pieces.Encoder(vocabulary).encode(texts)
    ends = np.concatenate([[0], np.cumsum(counts)])
    got = [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]
    assert got == library.encode(texts)
    assert pieces.Decoder(vocabulary).decode(ids, counts) == library.decode(got)
    assert pieces.Decoder(vocabulary).decode(np.array([0, 1, 230, 3]), np.array([4])) == library.decode([[0, 1, 230, 3]])


def test_encoder_forgets_without_changes(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    monkeypatch.setattr(pieces, "INDEXED", 40)
    small, large = pieces.Encoder(vocabulary), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for text in texts_of(spark)[:20]:
        assert small.encode([text])[0].tolist() == large.encode(text)


def test_pieces_of_odd_rows(spark, vocabulary):
    coded = pieces.encode(odd(spark), vocabulary, check=True)
    rows = coded.collect()
    assert len(rows) == 13 and all(r["round_trip"] for r in rows) and all(r["n_tokens"] == len(r["ids"]) for r in rows)
    assert [r["ids"] for r in rows if not r["text"]] == [[], [], []]
    back = pieces.decode(coded.drop("h"), vocabulary, text_col="h").collect()
    assert all(r["h"] == (r["text"] or "") for r in back)
    lost = pieces.decode(spark.createDataFrame([(None,), ([264],)], "ids array<int>"), vocabulary).collect()
    assert [r["decoded"] for r in lost] == [None, "a"]
    assert pieces.encode(empty(spark), vocabulary).count() == 0


def segments(spark, rows):
    frame = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string")
    return preference.preference_segments(frame.withColumn("part", F.lit(1)).withColumn("own_pair", F.lit("x")))


def test_preference_segments(spark):
    a, b = "chosen", "rejected"
    rows = [
        (1, a, 0, "user", "q"), (1, b, 0, "user", "q"), (1, a, 1, "assistant", "good"), (1, b, 1, "assistant", "bad"), (1, b, 2, "user", "?"),
        (2, a, 0, "user", "q"), (2, b, 0, "user", "q"), (3, b, 5, None, None), (None, a, 0, "user", "n"), (None, a, None, "assistant", "m"),
        (4, a, 0, "user", "t"), (4, a, 0, "user", "t"), (4, b, 0, "user", "t"), (5, a, None, "user", "t"), (5, b, None, "user", "t")]
    got = sorted(((r["pair_id"], r["part"], r["turn"], r["rendered"][r["mask_start"]:r["mask_end"]]) for r in segments(spark, rows).collect()), key=repr)
    want = [
        (1, "prompt", 0, ""), (1, a, 1, "good<|end|>"), (1, b, 1, "bad<|end|>"), (1, b, 2, ""), (2, "prompt", 0, ""), (3, b, 5, ""),
        (None, a, 0, ""), (None, a, None, "m<|end|>"), (4, a, 0, ""), (4, a, 0, ""), (4, b, 0, ""), (5, "prompt", None, "")]
    assert got == sorted(want, key=repr)
    assert segments(spark, []).count() == 0
    pair = preference.pair_rows(segments(spark, rows)).where("pair_id = 1").first()
    assert pair["prompt"] == "<|user|>\nq<|end|>\n" and pair["chosen"] == "<|assistant|>\ngood<|end|>\n"
    assert [pair["rejected"][s["from"]:s["to"]] for s in pair["rejected_spans"]] == ["bad<|end|>"]


def test_swapped_endings(spark):
    turns = spark.createDataFrame(
        [(0, 0, "user", "a"), (0, 1, "assistant", "b"), (1, 0, "user", "c"), (1, 1, "assistant", "d"), (4, 0, "user", "e"), (None, 0, "user", "f")],
        "conv_id long, turn long, role string, text string")
    got = {tuple(r) for r in preference.swapped_endings(turns).where("side = 'rejected'").collect()}
    assert got == {(0, "rejected", 0, "user", "a"), (0, "rejected", 1, "assistant", "d"), (1, "rejected", 0, "user", "c"), (1, "rejected", 1, "assistant", "b")}


def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    got = ordinal.ordinal_toxicity(docs, labels.where(fold > 0)).join(
        labels.where(fold == 0).select("doc_id", F.col("toxic").alias("y")), "doc_id").toPandas()
    assert (got["toxic"] == (got["y"] == 1)).mean() > 0.98
    assert got[got["y"] == 1]["expected_severity"].mean() > 10 * got[got["y"] == 0]["expected_severity"].mean()


def test_ordinal_slopes_are_right():
    """The fitted point is a minimum: no small step in any direction lowers the loss."""
    rnd = np.random.default_rng(2)
    words = [np.unique(rnd.integers(0, 6, 3)) for _ in range(200)]
    grade = np.array([min(3, int(sum(c == 1) + 2 * sum(c == 2) + rnd.integers(0, 2))) for c in words])
    sample = ordinal.Sample.of(pa.table({"toxic": grade, "cols": pa.array([list(map(int, w)) for w in words])}))
    model = ordinal.fit(sample, grade, ridge=0.01, steps=4000, rate=0.02, least=0.0)
    assert list(model.words) == list(range(6)) and list(model.thresholds) == sorted(model.thresholds)

    def loss(w, t):
        at = np.array([w[c].sum() for c in words])
        edge = np.concatenate([[-np.inf], t, [np.inf]])
        p = ordinal._logistic(edge[grade + 1] - at) - ordinal._logistic(edge[grade] - at)
        return -np.log(p).mean() + 0.005 * (w ** 2).sum()

    best = loss(model.weights, model.thresholds)
    for step in (-0.05, 0.05):
        for k in range(6):
            assert loss(model.weights + step * (np.arange(6) == k), model.thresholds) > best - 1e-6
        for k in range(3):
            assert loss(model.weights, model.thresholds + step * (np.arange(3) == k)) > best - 1e-6


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 1), (2, 1, 0), (None, 1, 1), (9, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    rows = ordinal.ordinal_toxicity(odd(spark), labels).collect()
    assert len(rows) == 13 and all(0 <= r["expected_severity"] <= 3 for r in rows)
    assert ordinal.ordinal_toxicity(odd(spark), labels.limit(0)).count() == 13
    assert ordinal.ordinal_toxicity(empty(spark), labels).count() == 0


def distance(pattern, text):
    """The least edit distance of the pattern to a substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(before[j - 1] + (p != t), before[j] + 1, row[-1] + 1))
    return min(row)


def test_myers_is_the_plain_distance():
    rnd = random.Random(3)
    for _ in range(150):
        pattern = "".join(rnd.choice("abc ") for _ in range(rnd.randrange(1, 70)))
        text = "".join(rnd.choice("abc ") for _ in range(rnd.randrange(0, 120)))
        best, end = decontaminate.myers(pattern, text)
        assert best == distance(pattern, text)
        assert best == len(pattern) or distance(pattern, text[:end]) == best


def test_leaks_are_those_of_brute_force(spark):
    rnd = random.Random(4)
    words = [f"{a}{b}" for a in ("re", "th", "on") for b in ("in", "er", "at", "ou")]
    items = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 25))) for _ in range(12)] + ["", None, "x"]
    docs = []
    for i in range(60):
        text = [rnd.choice(words) for _ in range(rnd.randrange(0, 40))]
        if items[i % 12] and i % 2:
            leak = list(items[i % 12])
            for _ in range(rnd.randrange(0, 1 + len(leak) // 15)):
                leak[rnd.randrange(len(leak))] = rnd.choice("abz ")
            text.insert(rnd.randrange(len(text) + 1), "".join(leak).upper())
        docs.append((i, "  \n".join(text)))
    docs += [(None, items[0]), (70, None), (71, ""), (72, items[1]), (72, items[1])]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = []
    for i, t in docs:
        for k, x in enumerate(items):
            p, q = decontaminate.plain(x), decontaminate.plain(t)
            if p and (n := distance(p, q)) <= int(0.05 * len(p)):
                want.append((i, k, n))
    for block in (2000, 4):
        got = decontaminate.find_leaks(d, b, block_items=block).collect()
        assert sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        q = decontaminate.plain(next(t for i, t in docs if i == r["doc_id"]))
        assert distance(decontaminate.plain(items[r["item_id"]]), q[r["match_start"]:r["match_end"]]) == r["distance"]
    clean = decontaminate.without_leaks(d, b, block_items=4)
    assert clean.columns == d.columns
    assert clean.count() == len(docs) - len({n for n, (i, t) in enumerate(docs) for k in range(len(items)) if (i, k) in {w[:2] for w in want}})
    assert decontaminate.find_leaks(d, b.limit(0)).count() == 0 and decontaminate.find_leaks(empty(spark), b).count() == 0


def test_language_by_hand(spark):
    """Posteriors of a tiny model, computed again without Spark."""
    model = (["aa", "bb"], np.log(np.tile([0.5, 0.5], (language.BUCKETS, 1))))
    bucket, _ = language.trigrams(pa.array(["yes"]))
    model[1][bucket] = np.log([0.9, 0.1])
    rows = spark.createDataFrame(
        [(1, "yes", "aa", "x.a.org"), (2, "yes", "bb", "y.a.org"), (3, "no no", "bb", "x.a.org"), (4, "", "bb-CC", None), (5, None, None, None), (6, "77", "aa", "z")],
        "doc_id long, text string, lang string, host string")
    got = {r["id"]: r for r in language.identify(rows, model, declared=F.col("lang"), host=F.col("host"), strength=2.0).collect()}
    by_text = {1: 0, 2: 0, 3: 0}  # ties go to the first language
    overall = [4.0, 1.0]
    share = [0.8, 0.2]
    domain = [(3 + 2 * share[0]) / 5, (0 + 2 * share[1]) / 5]
    x_host = [(2 + 2 * domain[0]) / 4, (0 + 2 * domain[1]) / 4]
    declared = {"aa": [(1 + 1) / (overall[0] + 1), 1 / (overall[1] + 1)]}
    suffix = [(3 + 1) / (overall[0] + 1), 1 / (overall[1] + 1)]
    n = len(bucket)
    lik = [math.log(0.9) * n / 3, math.log(0.1) * n / 3]
    odds = sum(math.log(v[0] / v[1]) for v in (x_host, declared["aa"], suffix)) + lik[0] - lik[1]
    assert by_text and got[1]["language"] == "aa" and got[1]["accepted"]
    assert got[1]["confidence"] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-5)
    assert not got[4]["accepted"] and not got[5]["accepted"] and not got[6]["accepted"]
    assert got[4]["declared"] == "bb" and got[5]["by_text"] is None


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    got = language.identify(docs.where(fold == 1), language.fit_text_model(docs.where(fold == 0))).join(
        docs.select(F.col("doc_id").alias("id"), "lang"), "id").toPandas()
    assert (got["language"] == got["lang"]).mean() > 0.98 and got["accepted"].mean() > 0.98


def test_language_of_pages_uses_markup_and_address(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select(
        "page_id", F.regexp_replace("html", "(?s)<(script|style).*?</\\1>|<[^>]*>", " ").alias("text"),
        F.regexp_extract("html", '<html[^>]* lang="([^"]*)"', 1).alias("markup"), F.expr("parse_url(url, 'HOST')").alias("host"))
    model = language.fit_text_model(spark.read.parquet(f"{SF}/documents.parquet"))
    got = language.identify(pages, model, id_col="page_id", declared=F.col("markup"), host=F.col("host")).toPandas()
    assert len(got) == pages.count() and got["declared"].notna().mean() > 0.5 and got["accepted"].mean() > 0.9


def test_language_of_odd_rows(spark):
    model = language.fit_text_model(odd(spark))
    got = language.identify(odd(spark), model, declared=F.col("lang"), host=F.col("source")).collect()
    assert len(got) == 13 and all(not r["accepted"] for r in got if r["id"] in (3, 4, 7))
    nothing = language.fit_text_model(empty(spark))
    assert nothing[0] == [] and not language.identify(odd(spark), nothing).where("accepted").count()
    assert language.identify(empty(spark), model).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, SF)
        assert at.columns == docs.columns and at.schema.simpleString() == docs.schema.simpleString()
    last = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(last) == {r["doc_id"] for r in at.collect()} and all(r["round_trip"] for r in last.values())
    bench = [decontaminate.plain(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(b in decontaminate.plain(r["text"]) for b in bench for r in last.values())
    assert len(last) > 0.8 * docs.count() and len({r["text"] for r in last.values()}) == len(last)


def test_pipeline_decisions_on_odd_rows(spark):
    assert corpus_pipeline.one_of_near_copies(spark, odd(spark), SF).count() == 10
    kept = corpus_pipeline.without_shared_lines(spark, odd(spark, [(i, "all\nthe same", "en", f"s{i}") for i in range(12)]), SF).collect()
    assert [r["doc_id"] for r in kept] == [0]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SF).count() == 0


def test_memory_of_the_encoder_does_not_follow_its_batch():
    """Ids of a batch are laid out in parts, in step with the bytes of its texts, and are the library's."""
    class Task:
        schema = []

        def mapInArrow(self, run, schema):
            return run

    texts = [None, "", "Ein Dokument äöü ▁ x\n y " * 20_000, "one two", "bb " * (pieces.LAID_OUT // 3 + 2), "three"] * 2
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    out = list(pieces.encode(Task(), pieces.Vocabulary.load(PIECE_MODEL), check=True)(iter([batch])))
    assert len(out) > 2 and max(sum(len(t or "") for t in b["text"].to_pylist()) for b in out) <= pieces.LAID_OUT + 5
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    assert [i for b in out for i in b["ids"].to_pylist()] == [library.encode(t or "") for t in texts]
    assert [t for b in out for t in b["text"].to_pylist()] == texts
