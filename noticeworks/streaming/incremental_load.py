"""Extension: the batch load run by Structured Streaming as files of records arrive.

Every micro-batch goes through the same insert rule as a daily run.  The target is
appended to once per batch id, so a batch that is repeated after a failure does not
add rows twice: its rows are found in the target and ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from noticeworks.operators import loading


def read_records(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def start_load(records: DataFrame, target_path: str, checkpoint: str, primary: str, key: Sequence[str],
               dedup: Sequence[str], order: Sequence[str]) -> StreamingQuery:
    """Appends what each micro-batch adds to the target; stops when all input is read."""
    def load(batch: DataFrame, _batch_id: int) -> None:
        target = batch.sparkSession.read.schema(batch.schema).parquet(target_path)
        loading.append(loading.insert_records(target, batch, primary, key, dedup, order), target_path)

    return (
        records.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
