"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of whole documents of one partition, up to ``SHARD_WORDS``
words. Its words become symbols: words of the benchmark get a number, every
other word and every document end becomes a barrier that no phrase contains.
The shard's suffix array gives its Burrows-Wheeler transform, kept as a wavelet
matrix that answers ``rank`` for any symbol. All test phrases (windows of
benchmark items) are searched backward at once, one word per step; the rows of
the final intervals are followed back by LF steps to the nearest sampled suffix
position, which locates each occurrence. Occurrences merge into removal spans.

Benchmark phrases are sent to the executors in blocks of at most
``BLOCK_BYTES``; a larger benchmark adds passes over the documents. Each pass but the
last is written to the shared folder before the next begins, so a task holds
one block and one broadcast is alive at a time. Nothing is shuffled: each
document's result is made where its text is.

Defined cases: a null text has no words and no hits; null item ids are left
out; null or word-less items have no windows; repeated documents and items
each count; an empty benchmark leaves every document clean. ``scan`` and
``verdicts`` replace input columns named like one that they add;
``decontaminate`` returns every input column, whatever its name.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import cut, shielded

WINDOW_WORDS = 13
#: Words of one shard (a longer document is a shard of its own).
SHARD_WORDS = 1 << 20
#: Text bytes of one block of benchmark items.
BLOCK_BYTES = 16 << 20
#: Suffix positions divisible by this are sampled, and those that follow a barrier.
SAMPLE = 8

#: ASCII other than digits and letters separates words; A-Z becomes a-z; all bytes of other characters are word bytes.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
                    for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


# ---------------------------------------------------------------- phrases
@dataclass
class Phrases:
    """Distinct phrases of one block of benchmark items."""

    numbers: dict[bytes, int]  #: word -> symbol, from 1
    symbols: np.ndarray        #: phrase x width, right-aligned
    lengths: np.ndarray        #: words of each phrase
    item_of: np.ndarray        #: item ids, phrase after phrase
    item_from: np.ndarray      #: where each phrase's items start


def phrases_of(items: list[tuple[int | None, str | None]], window: int = WINDOW_WORDS) -> Phrases:
    """Windows of the items; an item shorter than a window is one phrase."""
    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[int]] = {}
    for item, text in items:
        found = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        if not found or item is None:
            continue
        width = min(window, len(found))
        for i in range(len(found) - width + 1):
            owners.setdefault(tuple(found[i:i + width]), set()).add(item)
    lengths = np.array([len(p) for p in owners], dtype=np.int64)
    symbols = np.zeros((len(owners), window), dtype=np.int64)
    for row, phrase in enumerate(owners):
        symbols[row, window - len(phrase):] = phrase
    counts = [len(s) for s in owners.values()]
    return Phrases(numbers, symbols, lengths, np.array([i for s in owners.values() for i in sorted(s)], dtype=np.int64),
                   np.concatenate(([0], np.cumsum(counts))).astype(np.int64))


# --------------------------------------------------------------- FM-index
def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order; each 0 is a barrier of its own, smaller than any symbol, in order of place.

    Prefix doubling: ranks by the first ``k`` symbols give ranks by ``2k``.
    Only suffixes whose rank is still shared are sorted again, and barriers end
    every comparison, so copies cost rounds in the logarithm of their length.
    """
    n = len(text)
    barriers = np.flatnonzero(text == 0)
    key = text + len(barriers)
    key[barriers] = np.arange(len(barriers))
    order = np.argsort(key, kind="stable")
    in_order = key[order]
    first = np.concatenate(([True], in_order[1:] != in_order[:-1]))
    starts = np.flatnonzero(first)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    alone = first & np.append(first[1:], True)
    open_places = np.flatnonzero(~alone)  # places of the order that are not settled
    k = 1
    while len(open_places):
        at = order[open_places]
        # A shared prefix holds no barrier, so at + k is inside the text (it ends with one).
        major, minor = rank[at], rank[at + k]
        again = np.lexsort((minor, major))
        at, major, minor = at[again], major[again], minor[again]
        order[open_places] = at
        new = np.concatenate(([True], (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(at)))
        rank[at] = np.repeat(open_places[starts], sizes)
        open_places = open_places[np.repeat(sizes > 1, sizes)]
        k *= 2
    return order


class WaveletMatrix:
    """Rank of any symbol in a prefix, over a sequence of small non-negative numbers."""

    def __init__(self, sequence: np.ndarray, largest: int):
        self.bits = max(1, int(largest).bit_length())
        self.ones: list[np.ndarray] = []   # ones before each place, level by level
        self.zeros: list[int] = []
        row = sequence
        for level in range(self.bits - 1, -1, -1):
            bit = ((row >> level) & 1).astype(bool)
            ones = np.zeros(len(row) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(row) - int(ones[-1]))
            row = np.concatenate((row[~bit], row[bit]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        begin, end = np.zeros_like(end), end.copy()
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros, strict=True):
            one = ((symbol >> level) & 1).astype(bool)
            ones_b, ones_e = ones[begin], ones[end]
            begin = np.where(one, zeros + ones_b, begin - ones_b)
            end = np.where(one, zeros + ones_e, end - ones_e)
        return end - begin


class FMIndex:
    """Index over a sequence of symbols (0: barrier) that ends with a barrier."""

    def __init__(self, text: np.ndarray, largest: int):
        order = suffix_array(text)
        self.last = text[order - 1]  # the symbol before each suffix; text[-1], a barrier, before the first
        self.wavelet = WaveletMatrix(self.last, largest)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1))))  # smaller symbols
        sampled = (self.last == 0) | (order % SAMPLE == 0)
        self.sample_at = np.concatenate(([0], np.cumsum(sampled)))
        self.samples = order[sampled]
        self.size = len(text)

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [low, high) of right-aligned phrases, all searched at once from their last word."""
        low = np.zeros(len(symbols), dtype=np.int64)
        high = np.full(len(symbols), self.size, dtype=np.int64)
        for step in range(1, symbols.shape[1] + 1):
            live = np.flatnonzero((lengths >= step) & (low < high))
            if not len(live):
                break
            symbol = symbols[live, -step]
            low[live] = self.below[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: LF steps back to a sampled suffix."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        found = np.empty(len(rows), dtype=np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            row = at[todo]
            hit = self.sample_at[row + 1] > self.sample_at[row]
            done = todo[hit]
            found[done] = self.samples[self.sample_at[at[done]]] + steps[done]
            todo = todo[~hit]
            symbol = self.last[at[todo]]
            at[todo] = self.below[symbol] + self.wavelet.rank(symbol, at[todo])
            steps[todo] += 1
        return found


def occurrences(index: FMIndex, phrases: Phrases, block: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrase, position) of all occurrences, in blocks of about ``block`` rows."""
    low, high = index.search(phrases.symbols, phrases.lengths)
    hits = np.flatnonzero(high > low)
    counts = (high - low)[hits]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, block):
        nth = np.arange(begin, min(begin + block, total))
        which = np.searchsorted(ends, nth, side="right")
        phrase = hits[which]
        yield phrase, index.locate(low[phrase] + nth - (ends - counts)[which])


# ------------------------------------------------------- documents of a shard
def _scan(texts: list[list[int]], phrases: Phrases) -> list[tuple[list[int], list[int]]]:
    """For each document's symbols: removal spans (flat starts and ends, in words) and item ids."""
    n_docs = len(texts)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))  # one barrier after each document
    whole = np.zeros(int(starts[-1]), dtype=np.int64)
    for start, t in zip(starts, texts, strict=False):
        whole[start:start + len(t)] = t
    # Runs of barriers say no more than one of them.
    kept = np.flatnonzero((whole != 0) | np.append(whole[1:] != 0, True))
    index = FMIndex(whole[kept], len(phrases.numbers))
    change = np.zeros(len(whole) + 1, dtype=np.int64)
    pairs = []
    for phrase, at in occurrences(index, phrases):
        begin = kept[at]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + phrases.lengths[phrase], -1)
        doc = np.searchsorted(starts, begin, side="right") - 1
        pairs.append(np.unique(doc * len(phrases.lengths) + phrase))
    items: list[list[int]] = [[] for _ in range(n_docs)]
    spans: list[list[int]] = [[] for _ in range(n_docs)]
    if not pairs:
        return list(zip(spans, items, strict=True))
    for code in np.unique(np.concatenate(pairs)):
        doc, phrase = divmod(int(code), len(phrases.lengths))
        items[doc] += phrases.item_of[phrases.item_from[phrase]:phrases.item_from[phrase + 1]].tolist()
    covered = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
    for begin, end in zip(edges[::2], edges[1::2], strict=True):
        doc = int(np.searchsorted(starts, begin, side="right")) - 1
        spans[doc] += [int(begin - starts[doc]), int(end - starts[doc])]
    return [(s, sorted(set(i))) for s, i in zip(spans, items, strict=True)]


def merged(spans: list[int]) -> list[int]:
    """Flat list of starts and ends, overlapping and touching spans joined."""
    out: list[int] = []
    for begin, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())),
                      T.StructField("items", T.ArrayType(T.LongType()))])


def _search_block(df: DataFrame, text: str, phrases, shard_words: int) -> DataFrame:
    """One pass: adds a block's spans and items to the ``_found`` column."""
    schema = df.schema
    at_text, at_found = schema.names.index(text), schema.names.index("_found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Phrases = phrases.value
        number = own.numbers.get

        def finished(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, held = batch.column(at_text), batch.column(at_found).to_pylist()
            found: list = []
            shard: list[list[int]] = []
            size = 0
            for t in texts:
                symbols = [number(w, 0) for w in words_of(t.as_py())]
                if shard and size + len(symbols) > shard_words:
                    found += _scan(shard, own)
                    shard, size = [], 0
                shard.append(symbols)
                size += len(symbols) + 1
                held[len(found) + len(shard) - 1]["n_words"] = len(symbols)
            if shard:
                found += _scan(shard, own)
            for old, (spans, items) in zip(held, found, strict=True):
                if items:
                    old["spans"] = merged(old["spans"] + spans)
                    old["items"] = sorted({*old["items"], *items})
            columns = list(batch.columns)
            columns[at_found] = pa.array(held, type=batch.schema.field(at_found).type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

        for batch in batches:
            yield finished(batch)

    return df.mapInArrow(run, schema)


def item_blocks(benchmark: DataFrame, key: str, text: str, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The items with words, in lists of at most ``limit`` text bytes (or one item); one list is held at a time."""
    block, size = [], 0
    rows = benchmark.select(F.col(key).cast("long"), F.col(text)).filter(F.col(key).isNotNull() & F.col(text).isNotNull())
    for item, value in rows.toLocalIterator():
        length = len(value.encode("utf-8", "surrogatepass"))
        if block and size + length > limit:
            yield block
            block, size = [], 0
        block.append((item, value))
        size += length
    if block:
        yield block


def scan(spark: SparkSession, df: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
         item_text: str = "text", window: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES,
         shard_words: int = SHARD_WORDS) -> DataFrame:
    """``df`` with ``_found`` (n_words, spans, items).

    ``spans`` are word offsets, flat: start, end, start, end. Items are ascending.
    """
    empty = F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast("array<bigint>").alias("spans"),
                     F.array().cast("array<bigint>").alias("items"))
    out = df.drop("_found").withColumn("_found", empty)
    blocks = item_blocks(benchmark, item_key, item_text, block_bytes)
    sent = None
    for items in itertools.chain([next(blocks, [])], blocks):
        if sent is not None:
            # the pass before ends here: no task runs two passes, and no two broadcasts are alive
            out = cut(out, "scanned")
            sent.destroy()
        sent = spark.sparkContext.broadcast(phrases_of(items, window))
        out = _search_block(out, text, sent, shard_words)
    return out


def verdicts(found: DataFrame) -> DataFrame:
    """Adds n_words, n_hit, n_items, contaminated; a document is contaminated when 5 % of its words are hit."""
    def total(spans):
        signed = F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
        return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)

    names = ("n_words", "n_hit", "n_items", "contaminated")
    rows = found.drop(*names)
    hit = total(F.col("_found.spans"))
    return rows.select("*", F.col("_found.n_words").alias("n_words"), hit.alias("n_hit"),
                       F.size("_found.items").cast("long").alias("n_items"),
                       ((hit > 0) & (20 * hit >= F.col("_found.n_words"))).alias("contaminated"))


def clean_text(text: str | None, spans: list[int]) -> str | None:
    """``text`` without the words of its removal spans and the separators inside each."""
    if not text or not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    marked = np.frombuffer(raw.translate(_WORD_BYTES), dtype=np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([False], marked, [False])).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for begin, end in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[at:begins[begin]])
        at = int(ends[end - 1])
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def items_digest(items) -> str:
    """Hex SHA-256 of the item ids, sorted as strings and joined by commas."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def decontaminate(spark: SparkSession, df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The clean rows of ``df``, unchanged, in its columns."""
    rows, at = shielded(df)
    marked = scan(spark, rows, benchmark, **options | {"text": at[options.get("text", "text")]})
    spans = F.aggregate(F.transform("_found.spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                        F.lit(0).cast("long"), lambda a, x: a + x)
    clean = (spans == 0) | (20 * spans < F.col("_found.n_words"))
    return marked.filter(clean).select(*rows.columns).toDF(*df.columns)
