"""Collocations by dynamic itemset counting of phrases."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.batches import slices, word_slices
from noticeworks.llm.common import stored

#: What each byte becomes: A-Z are lower-cased, ends of pieces line feeds.
BYTES = np.arange(256, dtype=np.uint8)
BYTES[65:91] += 32
BYTES[[*b".,;:!?\n\x0b\x0c\r"]] = 10
#: Rows of one Arrow batch that leaves a task; distinct phrases that a task sums up before it emits them.
EMITTED, WAITING = 1 << 18, 3 << 19
#: Bits of a key that hold the length of its phrase.
LENGTH_BITS = 3
TOKENS = "slice long, shard int, lang string, words array<string>, keys array<long>, counts array<long>, codes binary, places long"
#: Of a cut; 38 decimal digits hold the products of two counts, by 1000 too.
SCORE = (
    "cast(1000 * count as decimal(19, 0)) * cast(n as decimal(18, 0)) "
    "div (cast({left} as decimal(18, 0)) * cast({right} as decimal(18, 0)))")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _key(x: np.ndarray, length: int) -> np.ndarray:
    low = np.uint64((1 << LENGTH_BITS) - 1)
    return (_mix(x) & ~low) | np.uint64(length)


def word_keys(lang: str, words: pa.Array) -> np.ndarray:
    """Keys of phrases of one word."""
    own = pd.util.hash_array(np.array([lang], dtype=object), categorize=False)
    return _key(pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False) + np.uint64(3) * _mix(own), 1)


def longer_keys(prefix: np.ndarray, suffix: np.ndarray, length: int) -> np.ndarray:
    """Keys of phrases of ``length`` words, from those without the last and without the first word."""
    return _key(_mix(prefix) * np.uint64(5) + suffix, length)


class Bits(NamedTuple):
    """A set of keys as a bitmap of fixed size; it may hold keys that were never added."""

    bits: np.ndarray
    log2: int

    @classmethod
    def empty(cls, log2: int) -> Bits:
        return cls(np.zeros(1 << max(0, log2 - 3), dtype=np.uint8), log2)

    def packed(self) -> bytes:
        """Compressed: a few bytes for each key while keys are few."""
        return pa.Codec("zstd").compress(self.bits.tobytes(), asbytes=True)

    @classmethod
    def unpacked(cls, data: bytes, log2: int) -> Bits:
        size = len(cls.empty(log2).bits)
        return cls(np.frombuffer(pa.Codec("zstd").decompress(data, size, asbytes=True), dtype=np.uint8), log2)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(64 - self.log2)
        return (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 != 0

    def plus(self, keys: DataFrame) -> Bits:
        """With the keys of a table. Their bits come to the driver: ``2 ** log2`` at most, however many keys."""
        place = F.shiftrightunsigned("key", 64 - self.log2) + 1
        rows = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        bits = self.bits.copy()
        for bucket, part in rows.collect():
            part = np.frombuffer(bytes(part), dtype=np.uint8)[:len(bits)]
            bits[(bucket - 1) * len(part):bucket * len(part)] |= part
        return Bits(bits, self.log2)


def _pieces(texts: pa.Array) -> pa.Array:
    """The pieces of all texts, lower-cased."""
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    changed = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(BYTES[data])])
    return pc.list_flatten(pc.split_pattern(changed, "\n"))


def _cut(shards: int):
    """Slices of texts of one language as codes of their words; each slice belongs to a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = itertools.count(task)
        for batch in batches:
            for lang in pc.unique(batch["lang"]).to_pylist():
                texts = pc.fill_null(batch.filter(pc.equal(batch["lang"], lang))["text"], "")
                for first, last in slices(texts):
                    for w in word_slices(_pieces(texts.slice(first, last - first)), lower=lambda t: t, limit=1 << 62):
                        codes = np.full(len(w.codes) + len(w.offsets) - 1, -1, dtype=np.int32)
                        codes[np.arange(len(w.codes)) + np.repeat(np.arange(len(w.offsets) - 1), np.diff(w.offsets))] = w.codes
                        n = next(number)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(_mix(np.array([task << 32 | n - task], dtype=np.uint64)).view(np.int64)),
                            pa.array([n % shards], pa.int32()), pa.array([lang]), pa.array([w.words.to_pylist()], pa.list_(pa.string())),
                            pa.array([word_keys(lang, w.words).view(np.int64)], pa.list_(pa.int64())),
                            pa.array([np.bincount(w.codes, minlength=len(w.words))], pa.list_(pa.int64())),
                            pa.array([pa.Codec("zstd").compress(codes.tobytes(), asbytes=True)], pa.binary()), pa.array([len(codes)], pa.int64())],
                            ["slice", "shard", "lang", "words", "keys", "counts", "codes", "places"])
    return run


def _active(codes: np.ndarray, keys: np.ndarray, now: Bits, before: Bits, longest: int):
    """Of every length from 2 on: keys, prefixes and suffixes of the active phrases at all their places, and which are complete.

    A phrase is active from the step on at which both its subphrases have reached the threshold,
    for which ``now`` stands, and complete if it was so one cycle ago, for which ``before`` stands.
    """
    reached, earlier = now.holds(keys), before.holds(keys)
    place = np.flatnonzero((codes >= 0) & reached[codes])
    key, old = keys[codes[place]], earlier[codes[place]]
    for length in range(2, longest + 1):
        first = np.flatnonzero(place[1:] == place[:-1] + 1)
        prefix, suffix, place = key[first], key[first + 1], place[first]
        key, old = longer_keys(prefix, suffix, length), old[first] & old[first + 1]
        yield key, prefix, suffix, old
        reached = now.holds(key)
        place, key, old = place[reached], key[reached], (old & before.holds(key))[reached]


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.uint64, np.ndarray, np.ndarray]]:
    """Of each slice its number, the codes of its words and the keys behind them."""
    for batch in batches:
        for i in range(len(batch)):
            keys = batch["keys"][i].values.to_numpy().view(np.uint64)
            places = batch["places"][i].as_py()
            if len(keys):
                yield batch["slice"].to_numpy().view(np.uint64)[i], np.frombuffer(pa.Codec("zstd").decompress(batch["codes"][i].as_py(), places * 4, asbytes=True), dtype=np.int32), keys


def _parts(*columns: tuple[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for first in range(0, len(columns[0][1]), EMITTED):
        yield pa.RecordBatch.from_arrays([pa.array(c[first:first + EMITTED].view(np.int64)) for _, c in columns], [n for n, _ in columns])


def _counted(now: Broadcast, before: Broadcast, log2: int, longest: int):
    """How often the active phrases that are not complete occur in the slices of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = [tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.uint64))]

        def summed():
            every, counts, where = (np.concatenate(c) for c in zip(*held))
            keys, at, place = np.unique(every, return_index=True, return_inverse=True)
            return ("key", keys), ("count", np.bincount(place, weights=counts, minlength=len(keys)).astype(np.int64)), ("slice", where[at])

        waiting = 0
        reached, earlier = Bits.unpacked(now.value, log2), Bits.unpacked(before.value, log2)
        for number, codes, keys in _blobs(batches):
            found = [key[~old] for key, _, _, old in _active(codes, keys, reached, earlier, longest)]
            key, count = np.unique(np.concatenate(found), return_counts=True)
            held.append((key, count, np.full(len(key), number)))
            waiting += len(key)
            if waiting >= WAITING:
                yield from _parts(*summed())
                held, waiting = held[:1], 0
        yield from _parts(*summed())
    return run


def _traced(now: Broadcast, wanted: Broadcast, log2: int, longest: int):
    """The prefixes and suffixes of wanted phrases, each from the slice that it was noted with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached, traced = Bits.unpacked(now.value, log2), Bits.unpacked(wanted.value, log2)
        for number, codes, keys in _blobs(batches):
            found = [np.stack([key, prefix, suffix])[:, traced.holds(key ^ number)]
                     for key, prefix, suffix, _ in _active(codes, keys, reached, reached, longest)]
            key, prefix, suffix = np.concatenate(found, axis=1)
            key, at = np.unique(key, return_index=True)
            yield from _parts(("key", key), ("prefix", prefix[at]), ("suffix", suffix[at]))
    return run


class Phrases(NamedTuple):
    """What was counted."""

    words: DataFrame  #: lang, word, key, count of all words
    frequent: DataFrame  #: key, count, prefix, suffix and first step of the phrases of two words and more that reach the threshold
    steps: int  #: scans of a shard


def count_phrases(tokens: DataFrame, threshold: int, longest: int, shards: int, log2: int) -> Phrases:
    """Dynamic itemset counting over the shards of a table made by ``tokenized``."""
    spark = tokens.sparkSession
    history, words, complete, open_ = [Bits.empty(log2).packed()], [], [], None  # packed, as the driver holds those of all scans
    sent: dict[int, Broadcast] = {}

    def bits(step: int) -> Broadcast:
        if step not in sent:
            sent[step] = spark.sparkContext.broadcast(history[step])
        return sent[step]

    step = 0
    while step < shards or history[step] != history[step - shards]:
        shard = tokens.where(F.col("shard") == step % shards)
        parts = [] if open_ is None else [open_]
        if step < shards:
            each = shard.select("lang", F.explode(F.arrays_zip("words", "keys", "counts")).alias("w"))
            words.append(stored(each.groupBy("lang", F.col("w.words").alias("word"), F.col("w.keys").alias("key")).agg(
                F.sum("w.counts").alias("count")), "phrase-words"))
            parts.append(words[-1].select("key", "count", F.lit(step).alias("first"), F.lit(0).cast("long").alias("slice")))
        if step:
            found = shard.select("slice", "keys", "codes", "places").mapInArrow(
                _counted(bits(step), bits(max(0, step - shards)), log2, longest), "key long, count long, slice long")
            parts.append(found.select("key", "count", F.lit(step).alias("first"), "slice"))
        merged = stored(functools.reduce(DataFrame.unionByName, parts).groupBy("key").agg(
            F.sum("count").alias("count"), F.min("first").alias("first"), F.first("slice").alias("slice")), "phrase-counts")  # any slice will do
        length = F.col("key").bitwiseAND((1 << LENGTH_BITS) - 1)
        often = F.col("count") >= threshold
        history.append(Bits.unpacked(history[step], log2).plus(merged.where(often & (length < longest))).packed())
        # A phrase that was first found in this step of the last cycle or before has been through all shards.
        complete.append(merged.where(often & (F.col("first") == step - shards + 1)))
        open_ = merged.where(F.col("first") > step - shards + 1)
        step += 1
        if step > shards and step - shards - 1 in sent:
            sent.pop(step - shards - 1).destroy()
    complete.append(open_.where(F.col("count") >= threshold))
    found = stored(functools.reduce(DataFrame.unionByName, complete).where(
        F.col("key").bitwiseAND((1 << LENGTH_BITS) - 1) > 1).select("key", "count", "first", "slice"), "phrase-frequent")
    wanted = spark.sparkContext.broadcast(Bits.empty(log2).plus(found.select(F.col("key").bitwiseXOR(F.col("slice")).alias("key"))).packed())
    traced = tokens.select("slice", "keys", "codes", "places").mapInArrow(
        _traced(bits(step), wanted, log2, longest), "key long, prefix long, suffix long").groupBy("key").agg(
        F.min("prefix").alias("prefix"), F.min("suffix").alias("suffix"))
    frequent = stored(found.join(traced, "key").select("key", "count", "prefix", "suffix", "first"), "phrase-parts")
    for bitmap in (wanted, *sent.values()):
        bitmap.destroy()  # all that reads them is stored
    every = functools.reduce(DataFrame.unionByName, words).groupBy("lang", "word", "key").agg(F.sum("count").alias("count"))
    return Phrases(stored(every, "phrase-vocabulary"), frequent, step)


def tokenized(docs: DataFrame, text_col: str, lang_col: str, shards: int) -> DataFrame:
    """Slices of the texts by language and shard, as codes of their words; stored."""
    return stored(docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).mapInArrow(_cut(shards), TOKENS), "phrase-tokens")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", threshold: int = 100, percent: int = 100, top: int = 2000,
    longest: int = 5, shards: int = 4, log2: int = 26,
) -> DataFrame:
    """The best collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z are lower-cased, texts are cut to pieces at ``. , ; : ! ?`` and line ends and these to words at
    spaces and tabs. Phrases are 2 to ``longest`` (7 at most) words of a piece that occur at least ``threshold``
    times in their language, overlaps included. Cut after k words a phrase scores
    floor(1000 a n / (l r)) with a its count, n all words of the language, l and r the counts of both parts; the
    lowest cut counts, of equal ones the first. A phrase inside a longer one that has ``percent`` of
    its count or more is dropped. ``top`` phrases of each language are returned.

    Null and empty texts have no words; a null language is ``und``. Repeated rows count repeatedly. Ties in
    score and count go by the bytes of the phrase. Other columns are not read; a table
    without frequent phrases, or without rows, gives an empty one.

    Lengths are interleaved: shards are scanned in a cycle, words from the first scan on. After every
    scan the phrases that have reached the threshold are noted, and from the next scan on
    phrases are counted of which both subphrases are noted, each for one full cycle. Notes are a bitmap of
    ``2 ** log2`` bits whatever the size of the corpus, broadcast to the scans. A bit may
    stand for another phrase too; then a phrase is counted without need, but its count is
    whole all the same. Phrases are known by 61-bit hashes, words by their strings.
    """
    counted = count_phrases(tokenized(docs, text_col, lang_col, shards), threshold, longest, shards, log2)
    totals = counted.words.groupBy("lang").agg(F.sum("count").alias("n"))
    table = counted.words.where(F.col("count") >= threshold).select(
        "key", "lang", F.array("word").alias("words"), F.array("count").alias("heads"), F.array("count").alias("tails"))
    levels = []
    for length in range(2, longest + 1):
        # heads and tails: the counts of the first and of the last 1, 2, 3 ... words
        head = table.select(F.col("key").alias("prefix"), "lang", "words", "heads")
        tail = table.select(F.col("key").alias("suffix"), F.element_at("words", -1).alias("word"), "tails")
        of = counted.frequent.where(F.col("key").bitwiseAND((1 << LENGTH_BITS) - 1) == length)
        # Stored, as the next length and the result read it again.
        table = stored(of.join(head, "prefix").join(tail, "suffix").select(
            "key", "lang", F.concat("words", F.array("word")).alias("words"),
            F.concat("heads", F.array("count")).alias("heads"), F.concat("tails", F.array("count")).alias("tails"), "count"), "phrase-level")
        levels.append(table)
    longer = counted.frequent.select(F.explode(F.array("prefix", "suffix")).alias("key"), "count").groupBy("key").agg(F.max("count").alias("longer"))
    left, right = "heads[k - 1]", "tails[size(words) - k - 1]"
    score = SCORE.format(left=left, right=right)
    cut = F.expr(f"array_min(transform(sequence(1, size(words) - 1), k -> struct({score} as score, k, {left} as l, {right} as r)))")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return (
        functools.reduce(DataFrame.unionByName, levels).join(longer, "key", "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("count")))
        .join(totals, "lang").withColumn("cut", cut)
        .select("lang", F.array_join("words", " ").alias("phrase"), F.col("count").alias("a"), "cut.l", "cut.r", "n", "cut.score")
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
