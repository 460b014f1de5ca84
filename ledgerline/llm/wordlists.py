"""Words of a column of texts as Arrow arrays, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are split at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, count) of consecutive rows that hold about ``limit`` bytes."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, stop - start
        start = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` in order, and where each text's words begin (one more entry than texts).

    Words are maximal runs of bytes other than space, tab, LF, VT, FF and CR;
    a null text has none.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    some = np.asarray(pc.binary_length(flat)) > 0  # white space at either end gives an empty word
    starts = np.concatenate([[0], np.cumsum(some, dtype=np.int64)])[offsets]
    return flat.filter(pa.array(some)), starts


def join_words(flat: pa.Array, starts: np.ndarray) -> pa.Array:
    """Texts of the words between consecutive starts, joined by one space."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), flat), " ")
