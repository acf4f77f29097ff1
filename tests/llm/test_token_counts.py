"""Token counts against the library's encoding of whole texts."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from noticeworks.llm import token_counts as tc
from noticeworks.llm.queries import QUERIES
from tests.llm.frames import empty, odd

SPEC = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(SPEC)
CUT = tc.PreTokens(SPEC)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_query_counts_as_the_library(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op13_token_counts"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        n = library(texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((texts[r["doc_id"]] or "").encode()), n, n > 2048)


HARD = [
    "", " ", "a", "It's  we'LL 'Sx don'ts", "x<|endoftext|>y <|startoftext|><|endoftext|>", "<|endoftext", "éå ́ ́x", "İI ΑΣ ΑΣ. ﬁ",
    "a b c\u0085d", "\x00\x1c\x1f a\x1fb", "१२३ 12³½ ⅷ", "日本語テスト 한국어", "👩‍👩‍👧 \U0001f1f8\U0001f1ea!?", "-- '' '' ...a", "﻿x​z", "A" * 5000,
    "w.o,r;d " * 700, "\r\n\t\x0b\x0c x"]


def test_odd_texts_and_rows(spark):
    rows = [(i, t) for i, t in enumerate([*HARD, None, None])] + [(None, "null id"), (3, HARD[3]), (3, "same id, another text")]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, slice int, pre_tokens string")
    got = sorted((tuple(r) for r in tc.token_counts(docs, SPEC).collect()), key=repr)
    assert got == sorted(((i, len((t or "").encode()), library(t)) for i, t in rows), key=repr)


def test_shared_odd_table_and_other_id_types(spark):
    assert tc.token_counts(odd(spark), SPEC).count() == odd(spark).count()
    assert tc.token_counts(empty(spark), SPEC).collect() == []
    named = spark.createDataFrame([("x", "a b c"), (None, None)], "k string, body string")
    got = tc.token_counts(named, SPEC, "k", "body")
    assert got.dtypes[0] == ("doc_id", "string") and sorted(got.collect(), key=repr) == sorted([("x", 5, 3), (None, 0, 0)], key=repr)


def test_slices_and_blocks_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(map(tuple, tc.token_counts(docs, SPEC).collect()))
    spread = tc.token_counts(docs.repartition(13, "doc_id"), SPEC, block_words=1)
    assert sorted(map(tuple, spread.collect())) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" '<|>stdl9.́ \x1d")), max_size=12), max_size=6))
def test_words_are_cut_as_in_whole_texts(parts):
    text = " ".join([*parts, "<|endoftext|>"])
    words = [w for w in tc.re.split("[\x20\x09-\x0d]+", text) if w]
    assert sum(CUT.size(p) for found in CUT.of(words) for p in found) == library(text)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tc.PreTokens(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
