"""Severity of toxicity by cumulative-link ordinal regression on sparse words of the text."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.batches import row_sums, word_slices

EDGES = ".,;:!?\"'()[]{}*_-"


class Model(NamedTuple):
    """P(grade <= k) is logistic(thresholds[k] - sum of the weights of the text's words), the weights shared by all k."""

    words: np.ndarray  #: sorted hashes of the features that have a weight
    weights: np.ndarray
    thresholds: np.ndarray

    def of(self, words: np.ndarray) -> np.ndarray:
        """The weights of hashed features; 0 for all others."""
        if not len(self.words):
            return np.zeros(words.shape)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.weights[at], 0.0)


#: Beginnings of words that are features too: inflected words share what they say with their stem.
PREFIXES = (4, 5, 6)


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hashes of the features of each word, a column each: the word without punctuation at its edges, its beginnings.

    A beginning as long as the word or longer counts as the word.
    """
    plain = pc.utf8_trim(words, characters=EDGES)
    whole = pd.util.hash_array(plain.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    columns = [whole]
    for n in PREFIXES:
        begun = pc.binary_join_element_wise(pc.utf8_slice_codeunits(plain, 0, n), "", "-").dictionary_encode()
        of = pd.util.hash_array(begun.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
        longer = pc.greater(pc.utf8_length(plain), n).to_numpy(zero_copy_only=False)
        columns.append(np.where(longer, of[begun.indices.to_numpy()], whole))
    return np.stack(columns, axis=1).view(np.int64)


def _bags(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``[first, last)`` with the row and hash of each distinct feature."""
    for w in word_slices(texts, pc.utf8_lower):
        rows = np.repeat(np.arange(w.last - w.first), np.diff(w.offsets))
        names, place = np.unique(hashed(w.words), return_inverse=True)
        place = place.reshape(-1, 1 + len(PREFIXES))
        keys = np.unique((rows[:, None] * max(1, len(names)) + place[w.codes]).ravel())
        yield w.first, w.last, keys // max(1, len(names)), names[keys % max(1, len(names))]


def _emit_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, rows, cols in _bags(batch["text"]):
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=last - first))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch["toxic"].slice(first, last - first), pa.ListArray.from_arrays(ends, pa.array(cols, pa.int64()))], ["toxic", "cols"])


def labelled_bags(docs: DataFrame, labels: DataFrame, max_rows: int) -> pa.Table:
    """Words of at most ``max_rows`` labelled documents, those with the smallest hashes of their id."""
    chosen = (
        labels.where("doc_id is not null and toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_rows)
    )
    return (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
        .mapInArrow(_emit_bags, "toxic int, cols array<long>").toArrow()
    )


class Sample(NamedTuple):
    """Labelled texts as lists of features: of each entry its row and its feature's number."""

    toxic: np.ndarray
    words: np.ndarray  #: sorted hashes of all words
    row: np.ndarray
    col: np.ndarray

    @classmethod
    def of(cls, bags: pa.Table) -> Sample:
        words, col = np.unique(pc.list_flatten(bags["cols"]).to_numpy().astype(np.int64), return_inverse=True)
        row = np.repeat(np.arange(len(bags)), pc.list_value_length(bags["cols"]).to_numpy())
        return cls(bags["toxic"].to_numpy() > 0, words, row.astype(np.int32), col.astype(np.int32))

    def rates(self) -> tuple[np.ndarray, np.ndarray]:
        """In how many toxic and other rows each word is."""
        yes = self.toxic[self.row]
        return np.bincount(self.col[yes], minlength=len(self.words)), np.bincount(self.col[~yes], minlength=len(self.words))

    def without_near_copies(self) -> Sample:
        """The first of all rows that agree in two min-hashes of their rare features.

        Copies of one text would make all its words look as if they went with its label. Rare are
        features in at most one of a hundred rows; rows without such stay.
        """
        n = len(self.toxic)
        rare = np.bincount(self.col, minlength=len(self.words))[self.col] <= max(1, n // 100)
        least = np.full((n, 2), len(self.words))
        for k in range(2):
            order = np.random.default_rng(k + 1).permutation(len(self.words))
            np.minimum.at(least[:, k], self.row[rare], order[self.col[rare]])
        keep = least[:, 0] == len(self.words)
        keep[np.unique(least, axis=0, return_index=True)[1]] = True
        entries = keep[self.row]
        return Sample(self.toxic[keep], self.words, (np.cumsum(keep) - 1)[self.row[entries]], self.col[entries])


def severity_grades(sample: Sample, grades: int = 4) -> np.ndarray:
    """Grades 0 to ``grades - 1`` from labels that only say toxic or not.

    Grade 0 are the rows not labelled toxic. The toxic rows are cut into equal parts by how
    many of their features go with the label: those in at least five toxic rows whose rate there
    is more than eight times that in other rows. Rows with equally many get equal grades.
    """
    toxic = sample.toxic
    if not toxic.any():
        return np.zeros(len(toxic), dtype=np.int64)
    yes, no = sample.rates()
    tied = (yes >= 5) & ((yes + 0.5) / (toxic.sum() + 1) > 8 * (no + 0.5) / ((~toxic).sum() + 1))
    number = np.bincount(sample.row[tied[sample.col]], minlength=len(toxic))
    cuts = np.quantile(number[toxic], np.arange(1, grades - 1) / (grades - 1))
    return np.where(toxic, 1 + np.searchsorted(cuts, number, "left"), 0)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def screened(sample: Sample, least: float, rows: int = 5) -> np.ndarray:
    """Words in ``rows`` texts or more whose rates in toxic and other texts differ by ``least`` standard errors."""
    yes, no = sample.rates()
    n_yes, n_no = sample.toxic.sum(), (~sample.toxic).sum()
    share = (yes + no) / len(sample.toxic)
    error = np.sqrt(share * (1 - share) * (1 / n_yes + 1 / n_no))
    return np.flatnonzero((np.abs(yes / n_yes - no / n_no) >= least * error) & (error > 0) & (yes + no >= rows))


def fit(
    sample: Sample, grade: np.ndarray, grades: int = 4, ridge: float = 1e-5, steps: int = 600, rate: float = 0.05, least: float = 5.0,
) -> Model:
    """Maximum likelihood with a ridge on the weights, by Adam steps on all rows at once.

    Only ``screened`` words have weights: among very many rare words some go with noisy
    labels by chance, and common words would drown what the telling ones say. Thresholds are the first
    one plus positive gaps, so they stay in order. Without toxic or without other rows no word has
    a weight.
    """
    free = np.concatenate([[2.0], np.zeros(grades - 2)])  # first threshold, log gaps
    if sample.toxic.all() or not sample.toxic.any():
        none = np.zeros(0)
        return Model(none.astype(np.int64), none, free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))]))
    n = len(grade)
    used = screened(sample, least)
    kept = np.isin(sample.col, used)
    cols, row = np.searchsorted(used, sample.col[kept]), sample.row[kept]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
    state = np.zeros(len(used) + len(free))
    state[len(used):] = free
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        gaps = np.exp(state[len(used) + 1:])
        cut = state[len(used)] + np.concatenate([[0], np.cumsum(gaps)])
        score = row_sums(state[cols], offsets)
        edge = np.concatenate([[-np.inf], cut, [np.inf]])
        low, high = _logistic(edge[grade] - score), _logistic(edge[grade + 1] - score)
        p = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low) / p, high * (1 - high) / p  # slopes of -log p at the two edges, but for the sign
        by_score = d_high - d_low
        at_cut = np.array([d_low[grade == k + 1].sum() - d_high[grade == k].sum() for k in range(len(cut))])
        tail = np.cumsum(at_cut[::-1])[::-1]
        slope = np.concatenate([
            np.bincount(cols, weights=by_score[row], minlength=len(used)) / n + ridge * state[:len(used)],
            np.concatenate([tail[:1], tail[1:] * gaps]) / n])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope ** 2
        state -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Model(sample.words[used], state[:len(used)], state[len(used)] + np.concatenate([[0], np.cumsum(np.exp(state[len(used) + 1:]))]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_telling, expected_severity, grade, p_toxic, toxic`` of every row.

    ``n_telling`` is the number of distinct features with a weight, ``expected_severity`` the mean of
    the grade, ``grade`` its median, ``p_toxic`` the probability of a grade over 0, ``toxic``
    whether that is at least one half. Null or empty texts have no words and get what the
    thresholds say. Every word of a text is looked up.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in word_slices(batch["text"], pc.utf8_lower):
                n = w.last - w.first
                names = hashed(w.words)
                told = model.of(names) != 0
                hit = np.flatnonzero(told.any(axis=1)[w.codes])  # few words tell anything
                rows = np.repeat(np.arange(n), np.diff(w.offsets))[hit]
                words = w.codes[hit]
                pairs = (rows[:, None] * (len(model.words) + 1) + np.searchsorted(model.words, names[words]))[told[words]]
                pairs = np.unique(pairs)
                rows, place = pairs // (len(model.words) + 1), pairs % (len(model.words) + 1)
                at = np.bincount(rows, weights=model.weights[place], minlength=n)
                above = 1 - _logistic(model.thresholds[None, :] - at[:, None])  # P(grade > k)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(w.first, n), pa.array(np.bincount(rows, minlength=n), pa.int64()), pa.array(above.sum(axis=1)),
                     pa.array((above > 0.5).sum(axis=1), pa.int32()), pa.array(above[:, 0]), pa.array(above[:, 0] >= 0.5)],
                    ["doc_id", "n_telling", "expected_severity", "grade", "p_toxic", "toxic"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_telling long, expected_severity double, grade int, p_toxic double, toxic boolean")


def ordinal_toxicity(docs: DataFrame, labels: DataFrame, grades: int = 4, max_rows: int = 4000) -> DataFrame:
    """Scores of all ``docs`` by a model fitted on at most ``max_rows`` labelled ones.

    The bound is a parameter; the sample is what the driver gets, as word counts. Rows without id or
    label are not used for fitting, but all rows are scored. Repeated labels count repeatedly.
    """
    sample = Sample.of(labelled_bags(docs, labels, max_rows)).without_near_copies()
    return score(docs, fit(sample, severity_grades(sample, grades), grades))
