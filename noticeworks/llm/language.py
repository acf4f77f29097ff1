"""Language by Bayesian fusion of text, declared language, address suffix and host priors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.batches import row_sums, word_slices
from noticeworks.llm.common import stored

#: Rows of the table of trigram probabilities.
BUCKETS = 1 << 16
#: Every byte of a word stands in three trigrams, so each counts as a third of evidence.
EVIDENCE = 1 / 3
UNKNOWN = "und"


def trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of words with their edges; offsets of each word.

    Words with digits have none: numbers, keys and addresses belong to no language.
    """
    words = pc.if_else(pc.match_substring_regex(words, "[0-9]"), "", words).cast(pa.binary())
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint8)
    number = np.repeat(np.arange(len(lengths)), lengths)
    padded = np.full(len(data) + 2 * len(lengths), 32, dtype=np.uint32)
    at = np.arange(len(data)) + 2 * number
    padded[at + 1] = data
    code = (padded[at] << 16) | (padded[at + 1] << 8) | padded[at + 2]
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64), np.concatenate([[0], np.cumsum(lengths)])


def fit_text_model(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_rows: int = 20_000) -> tuple[list[str], np.ndarray]:
    """Languages and the log probabilities of trigram buckets in each.

    Fitted on about ``max_rows`` different labelled texts, chosen by their hash. Every language has
    the same bound, and what rare ones leave of it is shared by the others, so a language with
    fewer texts than its bound is fitted on all of them. Counts are
    aggregated by Spark, and the table has ``BUCKETS`` rows. Rows without language do not count.
    """
    rows = labelled.select(F.col(text_col).alias("text"), _plain(F.col(lang_col)).alias("lang")).where("lang is not null")
    place = F.xxhash64("text")
    held = {r["lang"]: r["count"] for r in rows.select("lang", place.alias("h")).distinct().groupBy("lang").count().collect()}
    bound = _bound(list(held.values()), max_rows)
    cuts = {lang: int(bound / n * (1 << 30)) + 1 for lang, n in held.items() if n > bound}
    if cuts:
        cut = F.create_map(*[F.lit(x) for item in cuts.items() for x in item])[F.col("lang")]
        rows = rows.where(F.pmod(place, F.lit(1 << 30)) < F.coalesce(cut, F.lit(1 << 30)))
    chosen = rows.distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch["lang"].to_pylist(), dtype=object)
            for w in word_slices(batch["text"], pc.utf8_lower):
                bucket, offsets = trigrams(w.words)
                of_row = np.repeat(np.arange(w.first, w.last), np.diff(w.offsets))
                for lang in set(langs[w.first:w.last]):
                    seen = np.bincount(w.codes[langs[of_row] == lang], minlength=len(w.words))
                    n = np.bincount(bucket, weights=np.repeat(seen, np.diff(offsets)), minlength=BUCKETS).astype(np.int64)
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "bucket": at, "n": n[at]})

    counted = chosen.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    table = np.full((BUCKETS, len(langs)), 0.5)
    table[counted["bucket"].to_numpy(dtype=np.int64), np.searchsorted(langs, counted["lang"].to_numpy(dtype=str)) if langs else []] += counted["n"].to_numpy(dtype=float)
    return langs, np.log(table / table.sum(axis=0))


def _bound(held: list[int], total: int) -> float:
    """The bound of each group with which groups of these sizes have ``total`` members together, at least 1."""
    left, bound = total, float(total)
    for k, n in enumerate(sorted(held)):
        bound = left / (len(held) - k)
        if n > bound:
            break
        left -= n
    return max(1.0, bound)


def _plain(lang: Column) -> Column:
    """``en`` from ``en-GB`` or `` EN``; null if there is none."""
    name = F.lower(F.regexp_extract(lang, r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(name != "", name)


def _scorer(table: np.ndarray) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in word_slices(batch["text"], pc.utf8_lower):
                bucket, offsets = trigrams(w.words)
                n = row_sums(np.diff(offsets)[w.codes], w.offsets)
                likely = np.empty((w.last - w.first, table.shape[1]))
                for k in range(table.shape[1]):
                    likely[:, k] = row_sums(row_sums(table[bucket, k], offsets)[w.codes], w.offsets)
                ends = np.arange(len(likely) + 1, dtype=np.int32) * table.shape[1]
                rest = batch.slice(w.first, w.last - w.first).drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns, pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(likely.ravel()))],
                    [*rest.schema.names, "n_trigrams", "likely"])
    return score


def _counts(langs: list[str]) -> list[Column]:
    return [F.sum((F.col("by_text") == i).cast("double")).alias(f"n{i}") for i in range(len(langs))]


def _array(*values: Column) -> Column:
    return F.array(*values).cast("array<double>")


def identify(
    rows: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text",
    declared: Column | None = None, host: Column | None = None, strength: float = 20.0, min_confidence: float = 0.5,
) -> DataFrame:
    """The language of every row with its probability, and whether the row is accepted.

    Evidence: the likelihood of the text under each language of ``model``; the
    language that the markup declares, weighed by how often each declared value goes with each
    language; the last label of the host's name, weighed the same way; and the prior of the host,
    smoothed by ``strength`` rows of the prior of its domain (the last two labels), which is smoothed
    the same way by that of all rows. All these counts are aggregated over all rows, by the
    language that the text alone suggests. The further language 'und' has the same probability
    for all trigrams and a prior of 1 in a million.

    Not accepted are rows whose language is 'und', whose probability is under ``min_confidence``
    or whose text has no word without digits. Null texts count as empty, null or odd declared
    languages and hosts are no evidence; without any model language all rows are 'und'. Returns
    ``id, row_key`` (a hash of id, text and the given ``declared`` and ``host``), ``declared, language, confidence, by_text, accepted``.
    """
    langs, table = model
    host = host if host is not None else F.lit(None).cast("string")
    declared = declared if declared is not None else F.lit(None).cast("string")
    key = row_key(id_col, text_col, declared, host)  # of the columns as they are given
    host, declared = F.lower(host), _plain(declared)
    seen = rows.select(
        F.col(id_col).alias("id"), key.alias("row_key"), declared.alias("declared"),
        host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract(host, r"\.([^.]+)$", 1).alias("suffix"), F.col(text_col).alias("text"))
    kept = {f.name: f.dataType.simpleString() for f in seen.schema if f.name != "text"}
    schema = ", ".join(f"`{n}` {t}" for n, t in kept.items()) + ", n_trigrams long, likely array<double>"
    scored = stored(
        seen.mapInArrow(_scorer(table), schema)
        .withColumn("by_text", F.when(F.col("n_trigrams") > 0, F.array_position("likely", F.array_max("likely")) - 1)), "language-scores")
    if not langs:
        return scored.select(
            "id", "row_key", "declared", F.lit(UNKNOWN).alias("language"), F.lit(1.0).alias("confidence"),
            F.lit(None).cast("string").alias("by_text"), F.lit(False).alias("accepted"))

    n = len(langs)
    per_host = stored(scored.groupBy("host", "domain").agg(*_counts(langs)), "host-counts")
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(n)]
    per_domain = per_host.groupBy("domain").agg(*sums)
    overall = per_host.agg(*sums).first()  # one row
    overall = [(overall[f"n{i}"] or 0.0) + 1.0 for i in range(n)]
    shares = [x / sum(overall) for x in overall]

    def smoothed(counts: list[Column], prior: list[Column]) -> Column:
        held = sum(counts[1:], counts[0])
        return _array(*[(c + strength * p) / (held + strength) for c, p in zip(counts, prior)])

    domains = per_domain.select(F.col("domain").alias("_domain"), smoothed(
        [F.col(f"n{i}") for i in range(n)], [F.lit(p) for p in shares]).alias("domain_prior"))
    hosts = stored(per_host.join(domains, F.col("domain").eqNullSafe(F.col("_domain")), "left").select(
        F.col("host").alias("_host"), smoothed(
            [F.col(f"n{i}") for i in range(n)], [F.col("domain_prior")[i] for i in range(n)]).alias("prior")), "host-priors")

    def given(name: str) -> DataFrame:
        """P(value | language) of a column, up to a factor that is the same for all languages."""
        counted = scored.where(F.col(name).isNotNull() & (F.col(name) != "")).groupBy(F.col(name).alias(f"_{name}")).agg(*_counts(langs))
        return stored(counted.select(
            f"_{name}", _array(*[(F.col(f"n{i}") + 1.0) / (overall[i] + 1.0) for i in range(n)]).alias(f"{name}_given")), f"{name}-given")

    # only languages and hosts are on the right-hand sides, one row each; the rows have no text
    fused = scored
    for right, on in ((hosts, "host"), (given("declared"), "declared"), (given("suffix"), "suffix")):
        fused = fused.join(right, F.col(on).eqNullSafe(F.col(f"_{on}")), "left")

    def evidence(i: int) -> Column:
        return (
            F.log(F.coalesce(F.col("prior")[i], F.lit(shares[i]))) + F.coalesce(F.log(F.col("declared_given")[i]), F.lit(0.0))
            + F.coalesce(F.log(F.col("suffix_given")[i]), F.lit(0.0)) + EVIDENCE * F.col("likely")[i])

    def unknown() -> Column:
        given_any = [F.log(sum((F.col(f"{x}_given")[i] * shares[i] for i in range(1, n)), F.col(f"{x}_given")[0] * shares[0])) for x in ("declared", "suffix")]
        return sum((F.coalesce(g, F.lit(0.0)) for g in given_any), F.lit(math.log(1e-6)) - EVIDENCE * math.log(BUCKETS) * F.col("n_trigrams"))

    names = F.array(*[F.lit(x) for x in [*langs, UNKNOWN]])
    fused = fused.withColumn("evidence", _array(*[evidence(i) for i in range(n)], unknown()))
    fused = fused.withColumn("top", F.array_max("evidence"))
    language = F.element_at(names, F.array_position("evidence", F.col("top")).cast("int"))
    confidence = 1.0 / F.aggregate("evidence", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("top")))
    return fused.select("id", "row_key", "declared", language.alias("language"), confidence.alias("confidence"), F.when(
        F.col("by_text").isNotNull(), F.element_at(names, (F.col("by_text") + 1).cast("int"))).alias("by_text"), "n_trigrams").select(
        "id", "row_key", "declared", "language", "confidence", "by_text",
        ((F.col("language") != UNKNOWN) & (F.col("confidence") >= min_confidence) & (F.col("n_trigrams") > 0)).alias("accepted"))


def row_key(id_col: str, text_col: str, declared: Column, host: Column) -> Column:
    """Rows with one key have the same id and evidence, so they get the same decision."""
    return F.xxhash64(F.col(id_col), F.col(text_col), declared, host)
