"""SimHash near-duplicate groups through a byte-position inverted index.

1. Fingerprint: every shingle of a text is hashed with XXH64 (seed 42); a bit
   of the 64-bit fingerprint is set when it is set in over half the hashes.
   numpy inside Arrow batches; whole texts, one pass.
2. Equal fingerprints are folded first, so a group of exact copies is one row
   from here on, however large it is.
3. Inverted index over byte positions. Two fingerprints that differ in at most
   ``d`` bits share at least ``8 - d`` of their 8 positional bytes (the
   guaranteed minimum). Single-byte posting lists would hold 1/256 of all
   fingerprints each, so postings are keyed by *four* positional bytes: the 14
   position sets of ``position_sets`` meet every set of five positions, so a
   pair sharing five bytes meets in at least one list, and unrelated
   fingerprints meet with chance 14/2^32.
4. Count filter. Members of a posting list meet inside a task, in blocks of at
   most ``BLOCK``: for each pair the shared positional bytes are tallied, pairs
   below the minimum leave, the rest are verified by the bit distance, and the list
   returns a spanning forest of its links (``ties``), as many rows as it has
   members at most. A list with more than a block of members is first cut by a
   fifth positional byte, which any pair of it must share too. (``links`` returns all
   pairs instead, by an equi-join; there sharing five bytes follows from the distance.)
5. Connected components of the verified links by alternating large-star and
   small-star steps, each written to the shared folder.

Defined cases: null, empty and blank texts have fingerprint 0, linked like any
other; rows with equal texts share a component; a null doc_id never names a
component unless all members have none; keys may be of any orderable type; an
empty table gives an empty result. ``near_duplicates`` reads key and text only;
``keep_one`` returns every input column, whatever its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, shielded

SEED = 42
BITS, BYTES = 64, 8
#: Members of a posting list that a block has at most; pairs of blocks are compared at a time.
BLOCK = 1024
#: Hashes whose bits are unpacked at a time (64 bytes of memory each).
TALLY_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """Fingerprint of one text, unsigned."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not found:
        return 0
    if len(found) < shingle:
        grams = iter([b" ".join(found)])
        count = 1
    else:
        grams = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False))
        count = len(found) - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), dtype=np.uint64, count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, count, TALLY_BLOCK):
        block = hashes[at:at + TALLY_BLOCK].astype(">u8").view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(df: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): one narrow row per input row; fp is the signed 64-bit value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), dtype=np.uint64,
                                 count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    rows = df.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def position_sets() -> list[tuple[int, ...]]:
    """14 sets of four byte positions such that any five of the eight positions contain one.

    The positions are split into two halves of four. The six pairs of a half
    fall into three classes of disjoint pairs; the sets are both halves and
    every union of two pairs of the same class. Five positions are either
    4 + 1 (a half), or 3 + 2: the two are a pair of some class, and among any
    three positions of a half exactly one pair has that class.
    """
    classes = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
    sets = [(0, 1, 2, 3), (4, 5, 6, 7)]
    for pairs in classes:
        sets += [(*p, q[0] + 4, q[1] + 4) for p in pairs for q in pairs]
    return sets


def _mask(positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >= 1 << 63 else value


def shared_bytes(a: Column, b: Column) -> Column:
    """Number of positional bytes two fingerprints share."""
    diff = a.bitwiseXOR(b)
    return sum((F.when(diff.bitwiseAND(F.lit(_mask((p,)))) == 0, 1).otherwise(0) for p in range(BYTES)), F.lit(0))


def links(values: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints at most ``max_bits`` apart."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the index guarantees distances of 0 to 3 bits")
    keys = F.array(*[F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(_mask(s))).alias("at"))
                     for i, s in enumerate(position_sets())])
    postings = values.select("fp", F.explode(keys).alias("p")).select("fp", "p.list", "p.at")
    a, b = postings.alias("a"), postings.alias("b")
    meets = (F.col("a.list") == F.col("b.list")) & (F.col("a.at") == F.col("b.at")) & (F.col("a.fp") < F.col("b.fp"))
    enough = shared_bytes(F.col("a.fp"), F.col("b.fp")) >= BYTES - max_bits
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    return a.join(b, meets & enough & near).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).distinct()


def _by_byte(value: Column, position: Column) -> Column:
    """The byte at a position, in place."""
    return value.bitwiseAND(F.call_function("shiftleft", F.lit(0xFF).cast("long"), position * 8))


def ties(values: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints at most ``max_bits`` apart that connect all such pairs."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the index guarantees distances of 0 to 3 bits")
    sets = position_sets()
    keys = F.array(*[F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(_mask(s))).alias("at"))
                     for i, s in enumerate(sets)])
    postings = values.select("fp", F.explode(keys).alias("p")).select("fp", "p.list", "p.at")
    sizes = postings.groupBy("list", "at").agg(F.count("*").alias("n")).filter("n > 1")
    others = F.array(*[F.array(*[F.lit(p) for p in range(BYTES) if p not in s]) for s in sets])
    fifth = F.when(F.col("n") > BLOCK, F.get(others, F.col("list"))).otherwise(F.array(F.lit(-1)))
    members = postings.join(sizes, ["list", "at"]).select("fp", "list", "at", F.explode(fifth).alias("fifth"))
    byte = F.when(F.col("fifth") < 0, F.lit(0)).otherwise(_by_byte(F.col("fp"), F.col("fifth"))).alias("byte")
    members = members.select("fp", "list", "at", "fifth", byte)
    group = ["list", "at", "fifth", "byte"]
    counts = members.groupBy(*group).agg(F.count("*").alias("n")).filter("n > 1")
    dealt = (members.join(counts, group).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
             .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*group, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "fp"))

    def forest(key: tuple, table: pa.Table) -> pa.Table:
        fp, block = table.column("fp").to_numpy(), table.column("block").to_numpy()
        low, high = key[4].as_py(), key[5].as_py()
        parent = list(range(len(fp)))
        u, v = [], []

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        place = np.arange(len(fp))
        for i in np.flatnonzero(block == low).tolist():
            meet = np.flatnonzero((block == high) & ((place > i) | (low != high)))
            differ = (fp[meet] ^ fp[i]).view(np.uint64)
            shared = (differ[:, None].view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)  # the tally of positional bytes
            meet, differ = meet[shared >= BYTES - max_bits], differ[shared >= BYTES - max_bits]
            for j in meet[np.bitwise_count(differ) <= max_bits].tolist():
                a, b = root(i), root(j)
                if a != b:
                    parent[b] = a
                    u.append(int(fp[i]))
                    v.append(int(fp[j]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    found = dealt.groupBy(*group, "low", "high").applyInArrow(forest, "u long, v long")
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node it can reach."""
    def least(pairs: DataFrame) -> DataFrame:
        return cut(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    now = cut(edges.select("u", "v"), "edges")
    last = mark(now)
    while last[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(least(both), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = cut(large, "large")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        joined = down.join(least(down), "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(joined.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        now = cut(small, "small")
        new = mark(now)
        if new == last:
            break
        last = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(df: DataFrame, shingle: int = 3, max_bits: int = 3, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, component_id, keeper): one row per input row.

    ``component_id`` is the smallest doc_id that links reach; ``keeper`` is
    true for the rows of the (doc_id, text) that stands for the component.
    """
    rows = cut(fingerprints(df, shingle, key, text), "fingerprints")
    # The smallest doc_id first, a missing one last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    values = cut(rows.groupBy("fp").agg(first), "values")
    found = components(ties(values.select("fp"), max_bits))
    roots = values.join(found, values["fp"] == found["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    heads = cut(roots.groupBy("root").agg(F.min("first").alias("head")), "heads")
    named = cut(roots.join(heads, "root").select("fp", "head"), "named")
    keeper = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_hash") == F.col("head.text_hash"))
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", F.col("head.doc_id").alias("component_id"),
                                         keeper.alias("keeper"))


def keep_one(df: DataFrame, shingle: int = 3, max_bits: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``df`` for each near-duplicate group, all its columns unchanged.

    The row of the smallest doc_id stays (of rows repeating it with the same
    text, one). Rows travel once, by (doc_id, text hash), which no group shares.
    """
    inner, at = shielded(df)
    key, text = at[key], at[text]
    marked = near_duplicates(inner, shingle, max_bits, key, text)
    keep = cut(marked.filter("keeper").select(F.col("doc_id").alias("_keep_id"), F.col("text_hash").alias("_keep_hash"))
               .distinct(), "keepers")
    rows = inner.withColumn("_id", F.col(key)).withColumn("_hash", F.xxhash64(F.col(text)))
    stay = rows.join(keep, (rows["_hash"] == keep["_keep_hash"]) & rows["_id"].eqNullSafe(keep["_keep_id"]),
                     "left_semi")
    rest = [F.col(c) for c in inner.columns if c not in (key, text)]
    order = Window.partitionBy("_hash", "_id").orderBy(F.to_json(F.struct(F.lit(0).alias("_"), *rest)))
    return stay.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").select(*inner.columns).toDF(*df.columns)
