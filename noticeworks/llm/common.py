"""Shared helpers: the shared folder, stored tables and texts with only A-Z lower-cased."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.session import shared_folder

#: Spark's setting by which the shuffle files of a query go when it ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written once to the shared folder and read back.

    This cuts the lineage: a lost executor costs its running tasks, not the steps before.
    The size of the files is known to the optimizer, which broadcasts only small ones. The shuffle
    files behind it are not needed again and go at once, so steps do not add up on the executors' disks.
    """
    path = f"{shared_folder(frame.sparkSession)}/{label}-{uuid.uuid4().hex}"
    conf = frame.sparkSession.conf
    before = conf.get(SHUFFLES_GO, "false")
    conf.set(SHUFFLES_GO, "true")
    try:
        frame.write.parquet(path)
    finally:
        conf.set(SHUFFLES_GO, before)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """``text`` with A-Z lower-cased, all other letters as they are; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
