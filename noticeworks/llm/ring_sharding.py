"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.common import stored

#: The ring has ``2 ** CELL_BITS`` cells; the plan has about one row per cell, whatever the table's size.
CELL_BITS = 16


def ring(shards: int, virtual_nodes: int, cells: int) -> np.ndarray:
    """The shard that owns each cell: that of the next virtual node clockwise."""
    points = sorted(
        (int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % cells, s)
        for s in range(shards) for v in range(virtual_nodes))
    at = np.array([p for p, _ in points])
    own = np.array([s for _, s in points])
    return own[np.searchsorted(at, np.arange(cells)) % len(own)]


def fill(counts: np.ndarray, owner: np.ndarray, loads: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(cell, first rank, ranks' end, shard, first slot)`` of a filled ring.

    Each shard first takes the rows of its own cells, clockwise, up to its load. What a full
    shard leaves continues clockwise and is taken by the next shards with room, the rows that
    have come furthest first. The loads must sum to the number of rows.
    """
    room = loads.astype(np.int64).copy()
    pieces: list[tuple[int, int, int, int, int]] = []

    def take(cell: int, start: int, end: int, shard: int) -> int:
        n = int(min(end - start, room[shard]))
        if n:
            pieces.append((cell, start, start + n, shard, int(loads[shard] - room[shard])))
            room[shard] -= n
        return start + n

    over = []
    for cell in np.flatnonzero(counts):
        start = take(int(cell), 0, int(counts[cell]), int(owner[cell]))
        if start < counts[cell]:
            over.append((int(cell), start, int(counts[cell])))
    # virtual nodes in ring order: the cells at which the owner changes
    stops = np.flatnonzero(owner != np.roll(owner, 1))
    waiting: deque[tuple[int, int, int]] = deque()
    turn = 0
    while (over or waiting) and turn < 3:
        queue, over = over, []
        at = 0
        for stop in stops:
            while at < len(queue) and queue[at][0] < stop:
                waiting.append(queue[at])
                at += 1
            while waiting and room[owner[stop]]:
                cell, start, end = waiting.popleft()
                start = take(cell, start, end, int(owner[stop]))
                if start < end:
                    waiting.appendleft((cell, start, end))
        waiting += queue[at:]
        turn += 1
    return pieces


def bounded_ring_shards(docs: DataFrame, shards: int = 24, virtual_nodes: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its shard and its slot there; shard sizes differ by one row at most.

    The key is the id; a row's place on the ring is the hash of its id. The load of a
    shard is bounded by its equal share of the rows, so all shards become exactly full and rows
    that a full shard cannot take continue clockwise. Law ``rows`` holds. Null ids share one
    place on the ring, null texts count as empty, and rows that are equal in all three
    columns are interchangeable. An empty table gives no rows. Other columns are not read.

    The rows are counted per cell of the ring; the plan for cells, whose number is fixed, is
    made on the driver. Every row then finds its piece of the plan by its cell and its rank in
    the cell, so no shard and no list of rows ever has to fit into one task.
    """
    spark = docs.sparkSession
    rows = stored(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(id_col).alias("place")), "ring-rows").withColumn("cell", F.shiftrightunsigned("place", 64 - CELL_BITS))
    counted = rows.groupBy("cell").agg(F.count("*").alias("n")).toPandas()  # one row per cell at most
    counts = np.zeros(2 ** CELL_BITS, dtype=np.int64)
    counts[counted["cell"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy(dtype=np.int64)
    total = int(counts.sum())
    loads = np.full(shards, total // shards) + (np.arange(shards) < total % shards)
    pieces = fill(counts, ring(shards, virtual_nodes, len(counts)), loads)
    plan = spark.createDataFrame(
        pd.DataFrame(pieces, columns=["cell", "first", "end", "shard", "slot"], dtype="int64"),
        "cell long, first long, end long, shard long, slot long")
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("place", "doc_id", "text_crc32", "size")) - 1
    return (
        rows.withColumn("rank", rank).join(F.broadcast(plan), "cell")
        .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
            (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
