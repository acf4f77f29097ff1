"""Changed pages as a stream: the hash of every page is kept in the state store.

The batch run joins the pages of a run to the table of hashes and rewrites it. Here the last
hash of each (source, url) is state, and a micro-batch touches the state of its own pages and of their cells only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

PAGES = "source string, url string, verified boolean, content_hash string, run long"
CHANGED = "source string, url string, content_hash string, run long"
#: Pages are dealt to so many cells by their hash. A call of Python serves all pages of a cell that a micro-batch has.
CELLS = 1 << 13


def _changes(key: tuple[int], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    known = {(s, u): (h, r) for s, u, h, r in zip(*state.get)} if state.exists else {}
    pages = pd.concat(list(parts)).sort_values("run", kind="stable")
    changed = []
    for source, url, verified, new, run in zip(*(pages[c].tolist() for c in ("source", "url", "verified", "content_hash", "run"))):
        page = (None if pd.isna(source) else source, None if pd.isna(url) else url)
        last, seen = known.get(page, (None, None))
        new = None if pd.isna(new) else new
        if seen is not None and run <= seen:
            continue  # a page that is delivered again
        stored = last if seen == run - 1 else None
        if not (verified is not None and not pd.isna(verified) and verified and new is not None and stored == new):
            changed.append((*page, new, int(run)))
        known[page] = (new, int(run))
    if known:
        state.update(tuple(map(list, zip(*((*page, *last) for page, last in known.items())))))
    if changed:
        yield pd.DataFrame(changed, columns=["source", "url", "content_hash", "run"])


def changed_pages(pages: DataFrame, cells: int = CELLS) -> DataFrame:
    """Of a stream of pages those that a run must read: new, changed, unverified or without hash.

    ``pages`` has ``source, url, verified, content_hash, run``, with ``run`` counting the runs of
    the source by one. A page is skipped as in ``shaping.unchanged_page_filter``: its source is verified and
    its hash is that of the source's last run. As ``loading.update_page_hashes`` keeps the hashes of a
    source's last run only, a page that a run left out counts as new when it comes back.
    A page that is delivered twice for one run is taken once, in whichever micro-batch.

    The state is one hash and one number per page ever seen, kept in ``cells`` lists, which a checkpoint
    fixes; runs of one page must arrive in order, a run that comes after a later one is left out.
    """
    return pages.select(
        F.pmod(F.xxhash64("source", "url"), F.lit(cells)).cast("int").alias("cell"),
        "source", "url", "verified", "content_hash", F.col("run").cast("long").alias("run")).groupBy("cell").applyInPandasWithState(
        _changes, CHANGED, "sources array<string>, urls array<string>, hashes array<string>, runs array<long>", "append", GroupStateTimeout.NoTimeout)


def start_changes(pages: DataFrame, path: str, checkpoint: str, cells: int = CELLS) -> StreamingQuery:
    """Appends the changed pages of all input that is there to files at ``path``, each once, and stops.

    A query that is started again with the same checkpoint, and as many cells, goes on where it ended.
    """
    return changed_pages(pages, cells).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(
        availableNow=True).start(path)
