"""The archive of runs: raw contents and extracted rows, each different content kept once.

``blobs`` holds contents by their SHA-256, in folders by its first two digits, with the run
that brought them. ``runs`` holds a manifest per run: which content stood where. A run over
unchanged pages adds its manifest only, and every run can be given back byte for byte.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks import session
from noticeworks.operators.loading import overwrite_partitions

ITEM = "kind string, source string, name string, part long"
BLOBS = "hash binary, content string, bytes long, run_id string, prefix string"
MANIFEST = f"{ITEM}, hash binary, run_id string"


def page_items(pages: DataFrame) -> DataFrame:
    """Contents of fetched pages, ``source, url, content``; those without content are left out."""
    return pages.where(F.col("content").isNotNull()).select(
        F.lit("page").alias("kind"), "source", F.col("url").cast("string").alias("name"), F.lit(0).cast("long").alias("part"), "content")


def row_items(records: DataFrame, source: str, url: str, position: str) -> DataFrame:
    """Extracted rows as JSON with all their columns, nulls included."""
    return records.select(
        F.lit("row").alias("kind"), F.col(source).cast("string").alias("source"), F.col(url).cast("string").alias("name"),
        F.col(position).cast("long").alias("part"),
        F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("content"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the archive; empty before the first run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def blobs(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, f"{path}/blobs", BLOBS)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, f"{path}/runs", MANIFEST)


def _hash(content: str = "content") -> Column:
    return F.unhex(F.sha2(content, 256))


def missing_blobs(items: DataFrame, stored: DataFrame, run_id: str) -> DataFrame:
    """One row per content that is not stored yet.

    Hashes alone are compared with those of stored blobs; contents are moved only if they are new.
    """
    new = session.stored(items.select(_hash().alias("hash")).distinct().join(stored.select("hash"), "hash", "left_anti"), "new-hashes")
    hashed = items.select(_hash().alias("hash"), "content").join(new, "hash", "left_semi")
    # Spark keeps one row per hash and task before the shuffle, however often a content occurs.
    return hashed.dropDuplicates(["hash"]).select(
        "hash", "content", F.octet_length("content").cast("long").alias("bytes"), F.lit(run_id).alias("run_id"),
        F.lower(F.left(F.hex("hash"), F.lit(2))).alias("prefix"))


def archive_run(items: DataFrame, path: str, run_id: str) -> None:
    """Stores the items of a run: first the contents that are new, then the manifest.

    A run that failed may be repeated: contents that got stored are found, the manifest of the run
    is replaced. Without its manifest a run does not exist.
    """
    spark = items.sparkSession
    new = missing_blobs(items, blobs(spark, path), run_id)
    new.repartition("prefix").write.mode("append").partitionBy("prefix").parquet(f"{path}/blobs")
    entries = items.select("kind", "source", "name", "part", _hash().alias("hash"), F.lit(run_id).alias("run_id"))
    overwrite_partitions(entries, f"{path}/runs", "run_id")


def rebuild(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The items of a run as they were given."""
    entries = manifest(spark, path).where(F.col("run_id") == run_id)
    return entries.join(blobs(spark, path).select("hash", "content"), "hash").select("kind", "source", "name", "part", "content")


def run_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Per run: items, and the contents and bytes that it added."""
    listed = manifest(spark, path).groupBy("run_id").agg(F.count("*").alias("items"))
    added = blobs(spark, path).groupBy("run_id").agg(F.count("*").alias("blobs_added"), F.sum("bytes").alias("bytes_added"))
    zero = F.lit(0).cast("long")
    return listed.join(added, "run_id", "left").select(
        "run_id", "items", F.coalesce("blobs_added", zero).alias("blobs_added"), F.coalesce("bytes_added", zero).alias("bytes_added"))
