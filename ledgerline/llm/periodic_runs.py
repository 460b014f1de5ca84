"""Runs of repeated words (maximal periodicities), found from suffix classes.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical) that no neighbouring word extends keeping the period, of at least
``min_length`` words and ``min_exponent`` periods.

Method, per document: descending-LCP Kruskal. The suffixes of the word
sequence are sorted (prefix doubling in numpy) and neighbours are joined in
order of decreasing LCP by union-find; every class keeps its positions as an
ordered set, the smaller set is merged into the larger. Two positions ``i`` and
``i + q`` of a run's first two periods share the next ``length - q`` words, and
no other position with as long a match lies between them (else the period
would not be the smallest one). So they become neighbours exactly when their
classes meet, at LCP ``length - q >= q``: newly adjacent positions at a distance
within the LCP seed a run, and the seed whose words before differ is its start.
Start, period and LCP give the whole run; nothing has to be extended.

Joins below the least LCP that a reportable run can have (``least_lcp``; 5 for
six words and four periods) cannot seed one and are not made. A document
without two equal stretches of so many words has no such joins at all: it is
told by a hashed comparison over whole batches, whose collisions only cost time.

Runs as Arrow batches on executors, no shuffle. Memory is bounded by a slice of
texts (``wordlists.SLICE_BYTES``) or one document: 12 bytes a word besides its
text for the suffix order, and the positions of its repeated stretches.

Defined cases: a null, empty or blank text has no words and no runs, its
collapsed text is empty; a null key is kept; repeated rows each give a row; an
empty table gives an empty result. Only key and text are read, so other
columns, whatever their names, cannot clash. Long texts are never cut.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.wordlists import join_words, slices, split_words

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: A block of an ordered position set is split beyond this size.
SET_BLOCK = 1024

RUN = pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])


class Positions:
    """Ordered set of positions in blocks: neighbours and insertion cost about a block."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, first: int) -> None:
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The nearest positions below and above ``x`` (which is not in the set)."""
        b = bisect_right(self.heads, x) - 1
        if b < 0:
            return None, self.heads[0]
        block = self.blocks[b]
        k = bisect_right(block, x)
        if k < len(block):
            return block[k - 1], block[k]
        return block[-1], self.heads[b + 1] if b + 1 < len(self.heads) else None

    def add(self, x: int) -> None:
        b = max(0, bisect_right(self.heads, x) - 1)
        block = self.blocks[b]
        insort(block, x)
        self.heads[b] = block[0]
        self.size += 1
        if len(block) > SET_BLOCK:
            half = len(block) // 2
            self.blocks.insert(b + 1, block[half:])
            self.heads.insert(b + 1, block[half])
            del block[half:]

    def take(self, other: "Positions") -> Iterator[tuple[int, int]]:
        """Merge a smaller set into this one; yields the pairs (i, j), i < j, that become neighbours."""
        own = list(other)
        met = [self.around(x) for x in own]
        for k, (x, (below, above)) in enumerate(zip(own, met, strict=True)):
            if below is not None and (k == 0 or own[k - 1] < below):
                yield below, x
            if above is not None and (k + 1 == len(own) or own[k + 1] > above):
                yield x, above
        for x in own:
            self.add(x)


def least_lcp(min_length: int, min_exponent: int) -> int:
    """Least LCP at which a reportable run is seeded: the least of length minus period."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, max(2, min_length) + 1))


def suffix_order(words: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``words`` in lexicographic order (a prefix comes before what it begins)."""
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while True:
        follow = np.zeros(n, dtype=np.int64)
        follow[:n - width] = rank[width:] if width < n else 0
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[1], ordered[1:] != ordered[:-1]])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == n or width >= n:
            return order
        width *= 2


def neighbour_lcp(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """LCP of each suffix in ``order`` with the one before it (0 for the first), in linear time."""
    n = len(words)
    before = np.full(n, -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    common = np.zeros(n, dtype=np.int32)  # by text position
    w, prev, out = memoryview(words.astype(np.int32)), memoryview(before), memoryview(common)
    same = 0
    for i in range(n):
        j = prev[i]
        if j < 0:
            same = 0
            continue
        stop = n - max(i, j)
        while same < stop and w[i + same] == w[j + same]:
            same += 1
        out[i] = same
        if same:
            same -= 1
    return common[order]


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of word numbers, by start, then period."""
    if min_length < 2 or min_exponent < 2:
        raise ValueError("a run has two words and two periods at least")
    n = len(words)
    if n < min_length:
        return []
    order = suffix_order(words)
    lcp = neighbour_lcp(words, order)
    slots = np.flatnonzero(lcp >= least_lcp(min_length, min_exponent))
    slots = slots[np.argsort(-lcp[slots], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}

    def root(slot: int) -> int:
        if slot not in parent:
            parent[slot], members[slot] = slot, Positions(int(order[slot]))
        while parent[slot] != slot:
            parent[slot] = parent[parent[slot]]
            slot = parent[slot]
        return slot

    runs = []
    for slot, shared in zip(slots.tolist(), lcp[slots].tolist(), strict=True):
        a, b = root(slot - 1), root(slot)
        if members[a].size < members[b].size:
            a, b = b, a
        parent[b] = a
        for i, j in members[a].take(members.pop(b)):
            period = j - i
            if (period <= shared and shared + period >= max(min_length, min_exponent * period)
                    and (i == 0 or words[i - 1] != words[j - 1])):
                runs.append((i, shared + period, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _may_repeat(words: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the documents in which some stretch of ``width`` words may occur twice (no false negatives)."""
    total = len(words)
    if total < width:
        return np.empty(0, dtype=np.int64)
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    with np.errstate(over="ignore"):
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        key = doc[:total - width + 1].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(width):
            key = (key ^ mixed[k:total - width + 1 + k]) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(32)
    inside = doc[:total - width + 1] == doc[width - 1:]
    key, doc = key[inside], doc[:total - width + 1][inside]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.empty(0, dtype=np.int64)
    return np.unique(doc[np.isin(key, twice)])


def _runs_of(texts: pa.Array, min_length: int, min_exponent: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(number of words, runs, collapsed text) of each text."""
    flat, starts = split_words(texts)
    numbers = np.asarray(flat.dictionary_encode().indices, dtype=np.int64)
    kept = np.ones(len(flat), dtype=bool)
    found: list[tuple[int, int, int]] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for d in _may_repeat(numbers, starts, least_lcp(min_length, min_exponent)).tolist():
        at, end = int(starts[d]), int(starts[d + 1])
        runs = find_runs(numbers[at:end], min_length, min_exponent)
        counts[d] = len(runs)
        found += runs
        for start, length, period in runs:
            kept[at + start + period:at + start + length] = False
    left = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])[starts]
    collapsed = join_words(flat.filter(pa.array(kept)), left)
    columns = np.array(found, dtype=np.int64).reshape(-1, 3).T
    structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(RUN))
    ends = np.concatenate([[0], np.cumsum(counts)])
    return pa.array(np.diff(starts)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs), collapsed


def detect(df: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
           min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): one row per input row.

    ``runs`` is an array of (start, length, period) by start, then period;
    ``collapsed`` is the text without the words of a run after its first
    period, its words joined by one space.
    """
    least_lcp(min_length, min_exponent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count in slices(batch.column(1)):
                keys, texts = batch.column(0).slice(start, count), batch.column(1).slice(start, count)
                yield pa.RecordBatch.from_arrays([keys, *_runs_of(texts, min_length, min_exponent)],
                                                 names=["doc_id", "n_words", "runs", "collapsed"])

    rows = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, "
                                "runs array<struct<start: long, length: long, period: long>>, collapsed string")
