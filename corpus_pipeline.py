"""A corpus cleaned in five stages: language, lines, near copies, benchmark passages, pieces.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written to the
shared folder and read again as the documents of the next one. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm import decontaminate, language, line_dedup, ngram_join, pieces
from noticeworks.llm.common import stored
from noticeworks.llm.queries import PIECE_MODEL


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the declared one is replaced by it."""
    found = language.identify(docs, language.fit_text_model(docs), declared=F.col("lang"), host=F.col("source"))
    decided = found.groupBy("row_key").agg(F.first("language").alias("_language"), F.first("accepted").alias("_accepted"))
    key = language.row_key("doc_id", "text", F.col("lang"), F.col("source"))
    return (
        docs.withColumn("_key", key).join(decided.hint("merge"), F.col("_key") == F.col("row_key")).where("_accepted")
        .withColumn("lang", F.col("_language")).select(*docs.columns)
    )


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sites share; those of which nothing is left go."""
    kept = line_dedup.line_dedup(docs).where((F.col("n_removed") == 0) | (F.btrim("text", F.lit(" \t\r\n")) != ""))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(
        F.char_length("text").cast(docs.schema["n_chars"].dataType))).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one: that with the smallest id, of equal ids the one with the smallest hash of its text.

    Documents link when their sets of five-word n-grams have a Jaccard similarity of 0.8 or more.
    A row is known by its id and text, so different texts with one id are judged apart; of rows that agree in
    both, one stays. Rows without id take part like others and stay if no row of their group has
    an id and none without comes before. Null and empty texts link with nothing and all stay, repeated ones too.
    """
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.unhex(F.sha2("text", 256)).alias("text_key"))
    found = ngram_join.ngram_components(docs.select(row.alias("_row"), "text"), width=5, id_col="_row", percent=80)
    stay = found.where("component_id = doc_id").select(F.col("doc_id").alias("_row"), (F.col("n_shingles") > 0).alias("_linked")).distinct()
    kept = docs.withColumn("_row", row).join(stay.hint("merge"), "_row")
    one = kept.where("_linked").dropDuplicates(["_row"])
    return one.unionByName(kept.where("not _linked")).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, and whether decoding gives the text again."""
    return pieces.encode(docs, pieces.Vocabulary.load(PIECE_MODEL), check=True)


STAGES = [
    ("language", known_language),
    ("lines", without_shared_lines),
    ("near copies", one_of_near_copies),
    ("benchmark", without_benchmark),
    ("pieces", as_pieces),
]

#: SQL has no language model, edit distance search or piece encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, f"stage-{name.replace(' ', '-')}")
    return docs
