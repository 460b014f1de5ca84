"""Phrase collocations from a weighted de Bruijn graph of four-word sequences.

Texts are split at ``SEPARATORS`` into pieces and those into words. Per language,
a candidate is a phrase of two to four words that occurs ``min_count`` times or
more within pieces. Cutting it in two gives the score
``floor(2000000 * a / (l + r))`` of its count ``a`` and the counts of both parts; the
lowest cut counts. A candidate leaves when a longer candidate contains it and
has at least ``CONTAINED`` percent of its count.

Method:

1. Sketches. Words and pairs of neighbouring words are hashed into
   2^``SKETCH_BITS`` counters, summed over all texts. Counters never undercount, so a
   pair whose counter stays below ``min_count`` is no part of any candidate, and
   pieces may be cut there without changing any count that matters: a frequent
   phrase has only frequent pairs, so all its occurrences lie inside what is
   left. A second sketch counts three and four words in what is left, and ends
   grams early that cannot be frequent. Each sketch comes to the driver as one bit
   a counter (2^27 bits, 16 MB, whatever the input) and is broadcast. With very many
   different phrases the sketches fill up and cut less; the result stays the same.
2. Edges. Every place of what is left of a piece starts a four-word gram, an edge
   from the node of its first three words to that of its last three. At the last
   three places, and where the sketch ends it early, a gram is shorter: these are
   the piece-end corrections. Equal
   grams are counted within a slice of texts first, then by one shuffle on
   language and first node.
3. Flow. The count of a three-word node is the sum of its outgoing edges plus
   the pieces that end with it; the counts of two words and of one word are sums
   of the nodes that begin with them plus the pieces that end there.
4. Unary paths. A node with one incoming and one outgoing edge, both of its own
   count, is inside a path that is passed as a whole: it is compacted away, and
   needs no score, as the edges around it contain it with its whole count.
   ``paths`` returns the maximal paths themselves (pointer doubling along edges).
5. Parts, cuts and containment are joins of the frequent phrases on language and
   phrase; only these are left by then.

Integer arithmetic is in decimals where products may pass 64 bits.

Defined cases: a null text has no words, a null language is ``und``; empty and
very long texts are taken as they are (a task holds one slice of texts); ties go
to the smaller cut and the smaller phrase in byte order; repeated rows count
each; an empty table gives an empty result. Only text and language are read, so
other columns, whatever their names, cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut
from ledgerline.llm.wordlists import slices, split_words

SEPARATORS = r"[.,;:!?\n\x0b\x0c\r]"
LONGEST = 4
MIN_COUNT, CONTAINED, TOP = 30, 80, 2000
UNKNOWN = "und"
#: Counters of the sketch, in segments of 2^16; one bit of each reaches the driver.
SKETCH_BITS, SEGMENT_BITS = 27, 16
SLICE_BYTES = 8 << 20
SEED = 42

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Places:
    """Word places of a slice of texts: word numbers, languages, and whether the next place is in the same piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array) -> None:
        marked = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS, " . ")
        flat, starts = split_words(marked)
        word = np.asarray(pc.not_equal(flat, "."))
        piece = np.cumsum(~word)
        doc = np.repeat(np.arange(len(texts)), np.diff(starts))
        coded = flat.filter(pa.array(word)).dictionary_encode()
        self.words = coded.dictionary
        self.ids = np.asarray(coded.indices, dtype=np.int64)
        piece, doc = piece[word], doc[word]
        tongue = langs.dictionary_encode()
        self.langs = tongue.dictionary
        self.lang = np.asarray(tongue.indices, dtype=np.int64)[doc]
        n = len(self.ids)
        self.joined = np.zeros(n, dtype=bool)
        self.joined[:n - 1] = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])

    def counters(self, sketch_bits: int) -> list[np.ndarray]:
        """Sketch counters of the one to four words from each place (meaningless where they leave the piece)."""
        hashed = lambda values: np.array([xxhash.xxh64_intdigest(v, SEED) for v in values.cast(pa.binary()).to_pylist()],
                                         dtype=np.uint64)
        if not len(self.ids):
            return [np.empty(0, dtype=np.int64)] * LONGEST
        with np.errstate(over="ignore"):
            word = hashed(self.words)[self.ids]
            grown = [_mix(word ^ _mix(hashed(self.langs) + _U(1))[self.lang])]
            for k in range(1, LONGEST):
                grown.append(_mix((grown[-1] + _U(0x9E3779B97F4A7C15)) ^ np.roll(word, -k)))
        return [(x >> _U(64 - sketch_bits)).astype(np.int64) for x in grown]

    def room(self, linked: np.ndarray) -> np.ndarray:
        """Words from each place on to the end of its run of linked places, four at most."""
        length = np.ones(len(linked), dtype=np.int64)
        for _ in range(LONGEST - 1):
            length[:-1] = np.where(linked[:-1], np.minimum(length[1:] + 1, LONGEST), 1)
        return length


def _slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Places]:
    for batch in batches:
        for start, count in slices(batch.column(1), SLICE_BYTES):
            yield Places(batch.column(0).slice(start, count), batch.column(1).slice(start, count))


def sketch(rows: DataFrame, min_count: int, sketch_bits: int = SKETCH_BITS, pairs: Broadcast | None = None) -> np.ndarray:
    """For each counter whether it reached ``min_count``, packed into 2^``sketch_bits`` bits.

    ``rows``: (lang, text). Counts words and pairs, or three and four words where
    the sketch of ``pairs`` lets all their pairs pass.
    """
    width = 1 << SEGMENT_BITS

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places in _slices_of(batches):
            at = places.counters(sketch_bits)
            if pairs is None:
                counted = [at[0], at[1][places.joined]]
            else:
                room = places.room(places.joined & _is_set(pairs.value, at[1]))
                counted = [at[2][room >= 3], at[3][room >= 4]]
            found, counts = np.unique(np.concatenate(counted), return_counts=True)
            if not len(found):
                continue
            counts = np.minimum(counts, min_count).astype(np.uint32)
            segment = found >> SEGMENT_BITS
            edges = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            ends = np.append(edges[1:], len(found))
            within = (found & (width - 1)).astype(np.uint16)
            narrow = counts.astype(np.uint8) if min_count < 256 else counts
            yield pa.RecordBatch.from_arrays(
                [pa.array(segment[edges].astype(np.int32)),
                 pa.array([within[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary()),
                 pa.array([narrow[a:b].tobytes() for a, b in zip(edges, ends, strict=True)], pa.binary())],
                names=["segment", "at", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums the blocks of each segment; rows come sorted, so one segment is held at a time."""
        kind = np.uint8 if min_count < 256 else np.uint32
        now, total = None, np.zeros(width, dtype=np.uint32)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(total >= min_count).tobytes()])],
                                              names=["segment", "bits"])

        for batch in batches:
            for i in range(batch.num_rows):
                segment = batch.column(0)[i].as_py()
                if segment != now:
                    if now is not None:
                        yield done()
                    now, total = segment, np.zeros(width, dtype=np.uint32)
                at = np.frombuffer(batch.column(1)[i].as_buffer(), dtype=np.uint16)
                # capped, so that no counter overflows; at or above the limit stays there
                total[at] = np.minimum(total[at] + np.frombuffer(batch.column(2)[i].as_buffer(), dtype=kind), min_count)
        if now is not None:
            yield done()

    blocks = rows.mapInArrow(tally, "segment int, at binary, counts binary")
    merged = blocks.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, bits binary")
    bits = np.zeros((1 << (sketch_bits - SEGMENT_BITS), width // 8), dtype=np.uint8)
    for row in merged.toLocalIterator():  # at most 2^sketch_bits bits in all
        bits[row.segment] = np.frombuffer(row.bits, dtype=np.uint8)
    return bits.reshape(-1)


def _is_set(bits: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (bits[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 == 1


def grams(rows: DataFrame, min_count: int, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """(lang, head, last, n): counted grams of slices of texts, and (lang, null, null, words).

    ``head`` has the first three words; ``last`` the fourth, or null where the
    piece (or what the sketches leave of it) ends before.
    """
    context = rows.sparkSession.sparkContext
    pairs = context.broadcast(sketch(rows, min_count, sketch_bits))
    longer = context.broadcast(sketch(rows, min_count, sketch_bits, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places in _slices_of(batches):
            yield from _grams_of(places, pairs.value, longer.value, sketch_bits)

    return rows.mapInArrow(run, "lang string, head string, last string, n long")


def _grams_of(places: Places, pairs: np.ndarray, longer: np.ndarray, sketch_bits: int) -> Iterator[pa.RecordBatch]:
    names = ["lang", "head", "last", "n"]
    if not len(places.ids):
        return
    lang, words = np.unique(places.lang, return_counts=True)
    none = pa.nulls(len(lang), pa.string())
    yield pa.RecordBatch.from_arrays([places.langs.take(pa.array(lang)), none, none, pa.array(words)], names=names)
    at = places.counters(sketch_bits)
    length = places.room(places.joined & _is_set(pairs, at[1]))
    length = np.where((length >= 3) & ~_is_set(longer, at[2]), 2, length)
    length = np.where((length >= 4) & ~_is_set(longer, at[3]), 3, length)
    starts = np.flatnonzero((length > 1) | _is_set(pairs, at[0]))
    length = length[starts]
    # word numbers of each gram, 0 for none
    number = np.zeros((LONGEST, len(starts)), dtype=np.int64)
    for k in range(LONGEST):
        inside = length > k
        number[k, inside] = places.ids[starts[inside] + k] + 1
    tongue = places.lang[starts]
    size = len(places.words) + 1
    first = np.unique((tongue * size + number[0]) * size + number[1], return_inverse=True)[1]
    second = np.unique(number[2] * size + number[3], return_inverse=True)[1]
    both = first.astype(np.int64) * (int(second.max(initial=0)) + 1) + second
    _, one, counts = np.unique(both, return_index=True, return_counts=True)
    word = [pc.take(places.words, pa.array(number[k, one] - 1, mask=number[k, one] == 0)) for k in range(LONGEST)]
    head = pc.binary_join_element_wise(word[0], word[1], word[2], " ", null_handling="skip")
    yield pa.RecordBatch.from_arrays([places.langs.take(pa.array(tongue[one])), head, word[3], pa.array(counts)], names=names)


def phrase_counts(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                  sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """(lang, phrase, n) of every phrase of one to four words with ``min_count`` or more, and (lang, null, all words)."""
    rows = df.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").alias("text"))
    edges = (grams(rows, min_count, sketch_bits).repartition("lang", "head").groupBy("lang", "head", "last")
             .agg(F.sum("n").alias("n")))
    node = Window.partitionBy("lang", "head").orderBy("last").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = Window.partitionBy("lang", "head").orderBy("last")
    flowed = edges.select("lang", "head", "last", "n", F.sum("n").over(node).alias("flow"), F.row_number().over(one).alias("k"))
    prefix = lambda words: F.substring_index("head", " ", words)
    width = _width(F.col("head"))
    is_node = F.col("k") == 1
    out = F.array(
        F.when(F.col("last").isNotNull() & (F.col("n") >= min_count),
               F.struct(F.concat_ws(" ", "head", "last").alias("phrase"), F.col("n").alias("n"))),
        F.when(is_node & ((width == 3) & (F.col("flow") >= min_count) | F.col("head").isNull()),
               F.struct(F.col("head").alias("phrase"), F.col("flow").alias("n"))),
        F.when(is_node & (width >= 2), F.struct(prefix(2).alias("phrase"), F.col("flow").alias("n"))),
        F.when(is_node & (width >= 1), F.struct(prefix(1).alias("phrase"), F.col("flow").alias("n"))))
    parts = flowed.select("lang", F.explode(F.filter(out, lambda x: x.isNotNull())).alias("p")).select("lang", "p.phrase", "p.n")
    total = parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return total.filter((F.col("n") >= min_count) | F.col("phrase").isNull())


def _width(phrase: Column) -> Column:
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def _node_in(phrase: Column) -> Column:
    return F.substring_index(phrase, " ", LONGEST - 1)


def _node_out(phrase: Column) -> Column:
    return F.substring_index(phrase, " ", 1 - LONGEST)


def unary_nodes(counts: DataFrame) -> DataFrame:
    """(lang, node, before, after): three-word nodes with one edge in and one out, both of the node's own count."""
    edges = counts.filter(_width(F.col("phrase")) == LONGEST)
    outs = edges.groupBy("lang", _node_in(F.col("phrase")).alias("node")).agg(
        F.count("*").alias("d_out"), F.min("n").alias("n_out"), F.min("phrase").alias("after"))
    ins = edges.groupBy("lang", _node_out(F.col("phrase")).alias("node")).agg(
        F.count("*").alias("d_in"), F.min("n").alias("n_in"), F.min("phrase").alias("before"))
    nodes = counts.filter(_width(F.col("phrase")) == LONGEST - 1).withColumnRenamed("phrase", "node")
    found = nodes.join(outs, ["lang", "node"]).join(ins, ["lang", "node"])
    return found.filter("d_in = 1 and d_out = 1 and n_in = n and n_out = n").select("lang", "node", "before", "after")


def paths(counts: DataFrame) -> DataFrame:
    """(lang, path, place, phrase, n): the edges of each maximal unary path in order.

    ``path`` is the path's first edge, ``place`` counts from 0. The whole path reads:
    its first edge, then the last word of each further edge. Edges on a cycle of
    unary nodes, which has no first edge, are paths of one edge.
    """
    edges = counts.filter(_width(F.col("phrase")) == LONGEST)
    steps = unary_nodes(counts).select("lang", F.col("after").alias("phrase"), F.col("before").alias("back"))
    now = cut(edges.join(steps, ["lang", "phrase"], "left").select(
        "lang", "phrase", "n", F.coalesce("back", "phrase").alias("to"), F.when(F.col("back").isNull(), 0).otherwise(1).alias("d"),
        F.col("back").isNull().alias("ended")), "paths")
    left = now.filter("not ended").count()
    while left:
        # An edge whose pointer has reached a first edge is done; others jump on by their pointer's own pointer.
        ahead = now.select("lang", F.col("phrase").alias("to"), F.col("to").alias("next"), F.col("d").alias("more"),
                           F.col("ended").alias("last"))
        now = cut(now.join(ahead, ["lang", "to"]).select(
            "lang", "phrase", "n", F.col("next").alias("to"), (F.col("d") + F.col("more")).alias("d"), F.col("last").alias("ended")),
            "paths")
        still = now.filter("not ended").count()
        if still == left:  # a path that is still open would have had an edge that ends in this step: all left are cycles
            break
        left = still
    return now.select("lang", F.when(F.col("ended"), F.col("to")).otherwise(F.col("phrase")).alias("path"),
                      F.when(F.col("ended"), F.col("d")).otherwise(0).alias("place"), "phrase", "n")


def mine(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, contained: int = CONTAINED,
         top: int = TOP, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language."""
    counts = cut(phrase_counts(df, text, lang, min_count, sketch_bits), "phrases")
    total = counts.filter("phrase is null").select("lang", F.col("n").alias("total"))
    known = counts.filter("phrase is not null").withColumn("width", _width(F.col("phrase")))
    wide = lambda c: F.col(c).cast("decimal(20,0)")

    candidates = known.filter("width >= 2").select("lang", "phrase", F.col("n").alias("a"), "width")
    longer = candidates.filter("width > 2").select("lang", F.split("phrase", " ").alias("w"), "width", "a")
    subs = F.flatten(F.transform(F.sequence(F.lit(2), F.col("width") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("width") - size + 1), lambda i: F.array_join(F.slice("w", i, size), " "))))
    inside = longer.select("lang", F.explode(subs).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    compacted = unary_nodes(known).select("lang", F.col("node").alias("phrase"))
    kept = (candidates.join(compacted, ["lang", "phrase"], "left_anti").join(inside, ["lang", "phrase"], "left")
            .filter(F.col("most").isNull() | (wide("most") * 100 < wide("a") * contained)))

    cuts = F.transform(F.sequence(F.lit(1), F.col("width") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("w", F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice("w", k + 1, F.col("width") - k), " ").alias("right")))
    parted = kept.withColumn("w", F.split("phrase", " ")).select("lang", "phrase", "a", F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    scored = parted.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn(
        "score", F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (lowest.select("lang", "phrase", "a", "c.l", "c.r", "c.score").withColumn("rank", F.row_number().over(order))
              .filter(F.col("rank") <= top))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                             F.col("total").alias("n"), F.col("score").cast("long").alias("score"))
