"""Token counts of texts from the piece counts of their distinct pre-tokens."""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from noticeworks.llm.batches import Words, row_sums, word_slices
from noticeworks.llm.common import stored

#: Bytes of text that are cut together; a longer text is a slice of its own.
SLICE_BYTES = 3 << 20
#: Distinct words after which a task begins a new block of slices, and words cut in one call.
BLOCK_WORDS, TOGETHER = 1 << 19, 256
#: Stands before the string of a special token, which is one token; no pre-token has it.
SPECIAL = "\0"


class PreTokens:
    """The pre-tokens of words, as the tokenizer of a ``.json`` file cuts them."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(a.normalized or a.single_word or a.lstrip or a.rstrip for a in added):
            raise ValueError("an added token depends on what stands around it")
        contents = sorted((a.content for a in added), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, contents)) + ")") if contents else None
        if self._plain(" Ab\n \t's\r9. ") != [p for w in ("Ab", "'s", "9.") for p in self._plain(w)]:
            raise ValueError("pre-tokens of this tokenizer depend on the white space around words")

    def of(self, words: list[str]) -> list[list[str]]:
        """Pre-tokens of each word, special tokens in it with ``SPECIAL`` before them."""
        found = []
        for first in range(0, len(words), TOGETHER):
            part = words[first:first + TOGETHER]
            found += self._together(part) or [self._one(w) for w in part]
        return found

    def _together(self, words: list[str]) -> list[list[str]] | None:
        """Pre-tokens of words cut in one go; None where the library does not tell the words apart."""
        t, joined = self.tokenizer, " ".join(words)
        if self.special and self.special.search(joined):
            return None
        text = t.normalizer.normalize_str(joined) if t.normalizer else joined
        if text.count(" ") != len(words) - 1 or not t.pre_tokenizer:
            return None
        cut = t.pre_tokenizer.pre_tokenize_str(text)
        ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32) == 32)
        word = np.searchsorted(ends, [at for _, (at, _) in cut])
        found: list[list[str]] = [[] for _ in words]
        for w, (piece, _) in zip(word.tolist(), cut):
            found[w].append(piece)
        return found

    def _one(self, word: str) -> list[str]:
        parts = self.special.split(word) if self.special else [word]
        return [p for i, part in enumerate(parts) for p in ([SPECIAL + part] if i % 2 else self._plain(part))]

    def _plain(self, part: str) -> list[str]:
        t = self.tokenizer
        part = t.normalizer.normalize_str(part) if t.normalizer else part
        pieces = [p for p, _ in t.pre_tokenizer.pre_tokenize_str(part)] if t.pre_tokenizer else [part]
        return [p for p in pieces if p]

    def size(self, pre_token: str) -> int:
        """Number of pieces of a pre-token."""
        return 1 if pre_token.startswith(SPECIAL) else len(self.tokenizer.model.tokenize(pre_token))


@functools.lru_cache(maxsize=1)
def _cutter(spec: str) -> PreTokens:
    """One for the tasks that a Python worker runs after one another."""
    return PreTokens(spec)


def _frequencies(spec: str, schema: pa.Schema, block_words: int):
    """One row per slice: its texts, and how often each has each pre-token; one row per block: its distinct pre-tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, block = _cutter(spec), TaskContext.get().partitionId() << 32
        names: dict[str, int] = {}
        known: dict[str, list[int]] = {}
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).cast(pa.int64())
            for w in word_slices(batch["text"], lower=lambda t: t, limit=SLICE_BYTES):
                words = w.words.to_pylist()
                new = [x for x in words if x not in known]
                known.update((x, [names.setdefault(p, len(names)) for p in found]) for x, found in zip(new, cut.of(new)))
                row, piece, times = _counted(w, [known[x] for x in words], len(names))
                rows = w.last - w.first
                yield _row(schema, block=pa.array([block]), ids=_one_list(batch["doc_id"].slice(w.first, rows)),
                           n_bytes=_one_list(sizes.slice(w.first, rows)), per_text=pa.array([_packed(np.bincount(row, minlength=rows))]),
                           steps=pa.array([_packed(np.diff(piece, prepend=0))]), times=pa.array([_packed(times)]))
                if len(known) >= block_words:
                    yield _row(schema, block=pa.array([block]), pre_tokens=pa.array([list(names)], pa.list_(pa.string())))
                    names, known, block = {}, {}, block + 1
        yield _row(schema, block=pa.array([block]), pre_tokens=pa.array([list(names)], pa.list_(pa.string())))
    return run


def _row(schema: pa.Schema, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(1, f.type) for f in schema], schema=schema)


def _counted(w: Words, parts: list[list[int]], names: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, pre-token and how often the text has it, sorted by text and pre-token."""
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int64)
    flat = np.fromiter(itertools.chain.from_iterable(parts), dtype=np.int64, count=ends[-1])
    row = np.repeat(np.arange(w.last - w.first), np.diff(w.offsets))
    each, times = np.unique(row * max(1, len(parts)) + w.codes, return_counts=True)
    row, word = np.divmod(each, max(1, len(parts)))
    row, piece, times = _spread(row, word, times, ends, flat)
    each, place = np.unique(row * max(1, names) + piece, return_inverse=True)
    return *np.divmod(each, max(1, names)), np.bincount(place, weights=times, minlength=len(each)).astype(np.int64)


def _spread(row, word, times, ends, flat):
    """Every (row, word, times) as (row, pre-token, times)."""
    count = np.diff(ends)[word] if len(word) else np.zeros(0, dtype=np.int64)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(row, count), flat[np.repeat(ends[word], count) + within], np.repeat(times, count)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers, first bytes first: small numbers leave long stretches of zeros."""
    planes = np.ascontiguousarray(values.astype(np.int32).view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], n * 4, asbytes=True), dtype=np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel().astype(np.int64)


def _sizes(spec: str):
    """The sizes of pre-tokens that come sorted; each is encoded once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, last = _cutter(spec), (None, 0)
        for batch in batches:
            coded = batch["pre_token"].dictionary_encode()
            sizes = [last[1] if p == last[0] else cut.size(p) for p in coded.dictionary.to_pylist()]
            if sizes:
                last = coded.dictionary[-1].as_py(), sizes[-1]
            yield pa.RecordBatch.from_arrays(
                [batch["asks"], batch["place"], pa.array(sizes, pa.int32()).take(coded.indices)], ["asks", "place", "size"])
    return run


def _sums(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The sums of the texts of a block; the answers are the sizes of its pre-tokens, in any order."""
    sizes = np.zeros(answers.num_rows, dtype=np.int64)
    sizes[answers["place"].to_numpy()] = answers["size"].to_numpy()
    parts = [(pa.array([], texts.schema.field("ids").type.value_type), pa.array([], pa.int64()), np.zeros(0, dtype=np.int64))]
    for slice_ in texts.to_batches(max_chunksize=1):
        products = sizes[np.cumsum(_unpacked(slice_["steps"][0].as_py()))] * _unpacked(slice_["times"][0].as_py())
        ends = np.concatenate([[0], np.cumsum(_unpacked(slice_["per_text"][0].as_py()))])
        parts.append((slice_["ids"].flatten(), slice_["n_bytes"].flatten(), row_sums(products, ends)))
    ids, n_bytes, n_tokens = zip(*parts)
    return pa.table({"doc_id": pa.chunked_array(ids), "n_bytes": pa.chunked_array(n_bytes), "n_tokens": np.concatenate(n_tokens)})


def token_counts(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row with the bytes and tokens of its text: ``doc_id, n_bytes, n_tokens``.

    ``spec`` is what a ``.json`` file of the ``tokenizers`` library holds. Counts are those of
    ``encode(text, add_special_tokens=False)``; strings of special tokens inside a text count
    as one token each. The tokenizer must drop white space; one whose pre-tokens
    depend on it raises an error.

    Null and empty texts have no tokens. Rows with equal ids or equal texts, and rows without
    id, are counted one by one. Other columns, whatever their names, are not read; an empty
    table gives an empty one.

    1. Texts are cut into slices. For every slice it is stored how often each text has each
       pre-token; for the slices of a task together, a block, their distinct pre-tokens.
    2. The pre-tokens of all blocks meet, equal ones side by side, and each is encoded once, for
       its number of pieces only. A frequent pre-token is one row per block.
    3. The numbers are joined to the frequencies of their block, and summed per text as frequency
       times number.

    A task cuts 3 MB of text at a time, or one text that is longer. A block ends with its partition
    or after ``block_words`` distinct words.
    """
    id_type = docs.schema[id_col].dataType
    arrow = pa.schema([
        ("block", pa.int64()), ("pre_tokens", pa.list_(pa.string())), ("ids", pa.list_(to_arrow_type(id_type))), ("n_bytes", pa.list_(pa.int64())),
        ("per_text", pa.binary()), ("steps", pa.binary()), ("times", pa.binary())])
    named = id_type.simpleString()
    blocks = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
            _frequencies(spec, arrow, block_words),
            f"block long, pre_tokens array<string>, ids array<{named}>, n_bytes array<long>, per_text binary, steps binary, times binary"),
        "token-frequencies")
    asked = blocks.select(F.col("block").alias("asks"), F.posexplode("pre_tokens").alias("place", "pre_token"))
    answers = asked.repartition("pre_token").sortWithinPartitions("pre_token").mapInArrow(_sizes(spec), "asks long, place int, size int")
    texts = blocks.where("pre_tokens is null").drop("pre_tokens")
    return texts.groupBy("block").cogroup(answers.groupBy("asks")).applyInArrow(_sums, f"doc_id {named}, n_bytes long, n_tokens long")
