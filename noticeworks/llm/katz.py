"""Katz backoff bigram scores of texts with Good-Turing discounts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.batches import row_sums, slices, word_slices
from noticeworks.llm.common import stored
from noticeworks.llm.ngram_join import _mix

#: Bytes of text counted and scored together in one task, and of the text behind one partition of counts.
SLICE_BYTES, BUCKET_BYTES = 3 << 20, 8 << 20
#: Counts up to this one are discounted by Good-Turing.
DISCOUNTED = 5
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
STATS = [f"{kind}{r}" for kind in ("words", "pairs") for r in range(1, DISCOUNTED + 2)] + ["tokens", "types", "pair_tokens", "pair_types"]


class Discounts(NamedTuple):
    """``at[r]`` of a count r up to ``DISCOUNTED`` is discounted to ``at[r] * r``, a greater r to ``r - loss``."""

    at: np.ndarray
    loss: float

    @classmethod
    def good_turing(cls, n: list[int]) -> Discounts:
        """From the numbers of types that occur 1, 2, ... ``DISCOUNTED`` + 1 times.

        Where these are too few or uneven to give discounts between 0 and 1, all counts lose
        n1 / (n1 + 2 n2), and one half if that is not between 0 and 1 either. Counts beyond
        lose as much as the last one, so that every context has probability left.
        """
        k = DISCOUNTED
        at = np.ones(k + 1)
        if min(n) > 0:
            common = (k + 1) * n[k] / n[0]
            if common < 1:
                at[1:] = [((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common) for r in range(1, k + 1)]
        if not np.all((at[1:] > 0) & (at[1:] < 1)):
            loss = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
            loss = loss if 0 < loss < 1 else 0.5
            at[1:] = [1 - loss / r for r in range(1, k + 1)]
        return cls(at, float(k * (1 - at[k])))

    def apply(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= DISCOUNTED, self.at[np.minimum(counts, DISCOUNTED)] * counts, counts - self.loss)


class Slice(NamedTuple):
    """Tokens of some whole texts, and the sorted keys of their words and pairs."""

    row: np.ndarray  #: of each token: its text
    word: np.ndarray  #: of each token: the place of its word's key in ``keys``
    before: np.ndarray  #: of each token: the place of the key of the word before it, -1 at the start
    pair: np.ndarray  #: of each token: the place of the key of the pair
    keys: np.ndarray


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Slice]]:
    for w in word_slices(batch["text"], limit=SLICE_BYTES):
        rows, first, last = w.last - w.first, w.first, w.last
        counts = np.diff(w.offsets) + 1  # with the end
        row = np.repeat(np.arange(rows), counts)
        ends = np.cumsum(counts) - 1
        inside = np.ones(len(row), dtype=bool)
        inside[ends] = False
        # Only the pairs are sorted token by token; words are by their dictionary.
        words, of_word = np.unique(np.concatenate([_word_keys(w.words), [_even(END)]]), return_inverse=True)
        token = np.full(len(row), of_word[-1], dtype=np.int32)
        token[inside] = of_word[w.codes]
        del w
        pair = np.concatenate([[START], words[token[:-1]]]).astype(np.uint64)
        pair[ends[:-1] + 1] = START
        pair *= np.uint64(3)
        pair += words[token]
        pair = _mix(pair) | np.uint64(1)
        pairs, of_pair = np.unique(pair, return_inverse=True)
        del pair
        of_pair = of_pair.astype(np.int32)
        keys = np.concatenate([words, pairs])
        order = np.argsort(keys)
        keys, place = keys[order], np.empty(len(keys), dtype=np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        word_at, pair_at = place[token], place[len(words) + of_pair]
        before = np.concatenate([np.array([-1], dtype=np.int32), word_at[:-1]])
        before[ends[:-1] + 1] = -1
        yield first, last, Slice(row, word_at, before, pair_at, keys)


def _even(x: np.ndarray) -> np.ndarray:
    """Keys of words are even, those of pairs odd."""
    return x & ~np.uint64(1)


def _word_keys(words: pa.Array) -> np.ndarray:
    return _even(_mix(pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)))


def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the keys of each bucket, a range of keys, begin among sorted keys; and their end."""
    bounds = [np.uint64((b << 64) // buckets) for b in range(buckets)]
    return np.concatenate([np.searchsorted(keys, np.array(bounds, dtype=np.uint64)), [len(keys)]])


def _packed(**columns: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table({k: pa.array(v) for k, v in columns.items()})
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(data).read_all()
    return {c: table[c].to_numpy() for c in table.column_names}


def _ask(buckets: int):
    """Of each slice and bucket: the steps between its sorted keys, and their counts in training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held_out = batch["held_out"].to_numpy(zero_copy_only=False)
            for first, last, s in _slices(batch):
                train = ~held_out[first:last][s.row]
                counts = np.bincount(s.word[train], minlength=len(s.keys)) + np.bincount(s.pair[train], minlength=len(s.keys))
                cuts = _buckets(s.keys, buckets)
                asked = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
                data = [_packed(step=_steps(s.keys[cuts[b]:cuts[b + 1]]), count=counts[cuts[b]:cuts[b + 1]].astype(np.int32)) for b in asked]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch["row"][first].as_py()] * len(asked), pa.int64()), pa.array(asked, pa.int32()), pa.array(data, pa.binary())],
                    ["slice", "bucket", "data"])
    return run


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([keys[:1], np.diff(keys)])


def _answer(table: pa.Table) -> pa.Table:
    """The counts of a bucket, for each slice that asked; and what the bucket adds to the statistics.

    An answer is twice the count, and one more for the first slice that asked for the key.
    """
    order = np.argsort(table["slice"].to_numpy(), kind="stable")
    asked = [_unpacked(table["data"][int(i)].as_py()) for i in order]
    keys = [np.cumsum(a["step"], dtype=np.uint64) for a in asked]
    every, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([a["count"] for a in asked])).astype(np.int64)
    own = np.zeros(len(place), dtype=bool)
    own[first] = True
    answer = total[place] * 2 + own
    ends = np.cumsum([len(k) for k in keys])
    data = [_packed(answer=a) for a in np.split(answer, ends[:-1])]
    pairs = (every & np.uint64(1)).astype(bool)
    stats = []
    for counts in (total[~pairs], total[pairs]):
        stats += [int((counts == r).sum()) for r in range(1, DISCOUNTED + 2)]
    for counts in (total[~pairs], total[pairs]):
        stats += [int(counts.sum()), int((counts > 0).sum())]
    none = [None] * (len(order) - 1)
    return pa.table({
        "slice": table["slice"].combine_chunks().take(pa.array(order)), "bucket": table["bucket"].combine_chunks().take(pa.array(order)),
        "data": pa.array(data, pa.binary())} | {n: pa.array([v, *none], pa.int64()) for n, v in zip(STATS, stats)})


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per slice, with its texts."""
    for batch in batches:
        for first, last in slices(batch["text"], SLICE_BYTES):
            part = batch.slice(first, last - first)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(part)
            yield pa.RecordBatch.from_arrays(
                [part["row"][:1], pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["slice", "texts"])


class Model(NamedTuple):
    """The scalars of the model; counts and backoff weights stay in tables."""

    words: Discounts
    pairs: Discounts
    tokens: int
    types: int
    unknown: float  #: probability of all unknown words together

    @classmethod
    def of(cls, stats: dict[str, int]) -> Model:
        n = [[stats[f"{kind}{r}"] for r in range(1, DISCOUNTED + 2)] for kind in ("words", "pairs")]
        words, pairs = Discounts.good_turing(n[0]), Discounts.good_turing(n[1])
        low = np.array(n[0][:DISCOUNTED])
        r = np.arange(1, DISCOUNTED + 1)
        high_types, high_tokens = stats["types"] - low.sum(), stats["tokens"] - (low * r).sum()
        kept = (words.at[1:] * r * low).sum() + high_tokens - words.loss * high_types
        return cls(words, pairs, stats["tokens"], stats["types"], 1 - kept / stats["tokens"] if stats["tokens"] else 1.0)

    def of_word(self, counts: np.ndarray) -> np.ndarray:
        """The probability of words by their counts without a context."""
        return np.where(counts > 0, self.words.apply(counts) / max(1, self.tokens), self.unknown)


SCORED = (
    "kind string, row long, n_tokens long, n_known long, base_score double, score double, "
    "context long, context_count long, discounted double, lower double, gaps long"
)


def _scorer(model: Model, documents: int):
    """Scores the texts of a slice with the answers to what it asked.

    Rows of kind 'text' hold the sums over the tokens whose pair or context decides alone,
    rows of kind 'gap' how often a text needs the backoff weight of a context, rows of kind
    'context' what the pairs that this slice answers for take from a context and from the words.
    """
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        batch = pa.ipc.open_stream(texts["texts"][0].as_py()).read_all().combine_chunks().to_batches()[0]
        order = np.argsort(answers["bucket"].to_numpy(), kind="stable")
        answer = np.concatenate([_unpacked(answers["data"][int(i)].as_py())["answer"] for i in order])
        (_, n_rows, s), = _slices(batch)
        count, own = answer >> 1, (answer & 1).astype(bool)
        ends = np.concatenate([[0], np.cumsum(np.bincount(s.row, minlength=n_rows))])
        of_word, of_pair = count[s.word], count[s.pair]
        of_context = np.where(s.before >= 0, count[s.before], documents)
        base = np.log10((of_word + 1) / (model.tokens + model.types + 1))
        seen = of_pair > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            log_p = np.where(seen, np.log10(model.pairs.apply(of_pair) / of_context), np.log10(model.of_word(of_word)))
        rows = batch["row"].to_numpy()
        kinds = [pa.table({
            "kind": pa.array(["text"] * n_rows), "row": rows, "n_tokens": np.diff(ends), "n_known": row_sums((of_word > 0).astype(np.int64), ends),
            "base_score": row_sums(base, ends), "score": row_sums(log_p, ends)})]

        gap = ~seen & (of_context > 0)
        each, gaps = np.unique(s.row[gap] * (len(s.keys) + 1) + s.before[gap] + 1, return_counts=True)
        at = each % (len(s.keys) + 1) - 1
        kinds.append(pa.table({
            "kind": pa.array(["gap"] * len(each), pa.string()), "row": rows[each // (len(s.keys) + 1)], "context": _context(s, at), "gaps": gaps}))

        _, one = np.unique(s.pair, return_index=True)  # a token of each pair
        one = one[own[s.pair[one]] & (of_pair[one] > 0)]
        place, where = np.unique(s.before[one], return_inverse=True)
        kinds.append(pa.table({
            "kind": pa.array(["context"] * len(place), pa.string()), "context": _context(s, place),
            "context_count": np.where(place >= 0, count[place], documents),
            "discounted": np.bincount(where, weights=model.pairs.apply(of_pair[one]), minlength=len(place)),
            "lower": np.bincount(where, weights=model.of_word(of_word[one]), minlength=len(place))}))
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[t]) for n, t in (c.split() for c in SCORED.split(", "))])
        return pa.concat_tables([k.cast(pa.schema([schema.field(c) for c in k.column_names])) for k in kinds], promote_options="default").select(schema.names)
    return run


def _context(s: Slice, places: np.ndarray) -> np.ndarray:
    return np.where(places >= 0, s.keys[places], START).astype(np.uint64).view(np.int64)


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its log10 probability under a bigram model of the rows that are not held out.

    Held out are rows with crc32(id as text) mod 7 = 2. A-Z are lower-cased, words stand between
    ASCII white space, every text ends with one end token; null texts count as empty, a null
    id as the empty text. Repeated rows count and are scored repeatedly. Other columns are not read.
    Rows may come from files or from any shuffle; they are numbered once and stored. A text is
    never cut: a long one is a slice of its own.
    Returned: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    A pair seen in training has its discounted count over the count of its context; another
    word has the backoff weight of the context times its own probability, and after an unseen
    context only that. The weight is what the seen pairs leave of the context divided by what
    their words leave of the words, so that the probabilities of all words and of the unknown
    sum to one in every context. Words and pairs are known by 64-bit hashes.

    1. Slices of the texts ask for the counts of their distinct words and pairs. Counts are
       summed in partitions of the keys, and answered to every slice; a frequent pair is one key per
       slice. The answers are stored by slice and partition, the count-of-counts with them.
    2. Every slice meets its answers and scores its tokens. What its pairs take from each
       context is summed over all slices to the table of backoff weights.
    3. Texts that need a backoff weight get it by a join on the context.
    """
    # Stored, as the numbers of rows that come out of a shuffle may differ from job to job.
    texts = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2).alias("held_out")), "katz-texts")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(size // BUCKET_BYTES) + 1
    read = texts.select("row", "text", "held_out")  # the same columns each time, so that batches and slices are cut alike
    answers = stored(
        read.mapInArrow(_ask(buckets), "slice long, bucket int, data binary")
        .groupBy("bucket").applyInArrow(_answer, "slice long, bucket int, data binary, " + ", ".join(f"{n} long" for n in STATS)), "katz-counts")
    stats = answers.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in STATS]).first().asDict()  # one row
    known = texts.select("row", "doc_id", "held_out")
    documents = known.where("not held_out").count()
    packed = read.mapInArrow(_pack, "slice long, texts binary")
    scored = stored(
        packed.groupBy("slice").cogroup(answers.select("slice", "bucket", "data").groupBy("slice"))
        .applyInArrow(_scorer(Model.of(stats), documents), SCORED), "katz-scores")

    weights = scored.where("kind = 'context'").groupBy("context").agg(
        (F.log10(1 - F.sum("discounted") / F.max("context_count")) - F.log10(1 - F.sum("lower"))).alias("weight"))
    backed_off = scored.where("kind = 'gap'").select("row", "context", "gaps").join(weights, "context").groupBy("row").agg(
        F.sum(F.col("gaps") * F.col("weight")).alias("backed_off"))
    return (
        known.join(scored.where("kind = 'text'").select("row", "n_tokens", "n_known", "base_score", "score"), "row")
        .join(backed_off, "row", "left").select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(stats["tokens"]).cast("long").alias("train_tokens"), "base_score",
            (F.col("score") + F.coalesce("backed_off", F.lit(0.0))).alias("score")))
