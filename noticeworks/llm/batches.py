"""Arrow batches of texts as word codes, a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters' bytes of one slice; a single longer text is a slice of its own.
SLICE_BYTES = 3 << 20


class Words(NamedTuple):
    """Words of the rows ``[first, last)`` of a batch."""

    first: int
    last: int
    codes: np.ndarray  #: of every word in reading order: its place in ``words``
    offsets: np.ndarray  #: ``codes[offsets[i]:offsets[i + 1]]`` are those of row ``first + i``
    words: pa.Array  #: the distinct words


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows that hold at most ``limit`` bytes together."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, before = 0, 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield first, last
        first, before = last, int(sizes[last - 1])


def word_slices(texts: pa.Array, lower=pc.ascii_lower, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """Words between ASCII white space; null counts as empty."""
    for first, last in slices(texts, limit):
        split = pc.ascii_split_whitespace(lower(pc.fill_null(texts.slice(first, last - first), "").cast(pa.string())))
        ends = split.offsets.to_numpy()
        flat = pc.list_flatten(split)
        full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        coded = flat.filter(pa.array(full)).dictionary_encode()
        offsets = np.concatenate([[0], np.cumsum(full, dtype=np.int64)])[ends - ends[0]]
        codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        del split, ends, flat, full, coded  # not held while the caller works on the slice
        pa.default_memory_pool().release_unused()
        yield Words(first, last, codes, offsets, words)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring offsets; 0 where there is nothing between."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.result_type(values, np.float64 if values.dtype.kind == "f" else np.int64))])
    return total[offsets[1:]] - total[offsets[:-1]]
