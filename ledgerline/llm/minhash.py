"""MinHash near-duplicate groups: banded universal hash minima, verified links, star components.

Two texts are linked when the Jaccard similarity of their sets of distinct
``shingle``-word sequences is at least ``percent`` / 100 (integer arithmetic).

1. Sets. Words are hashed once per distinct word of a batch, shingles by mixing
   the hashes of their words (64 bits). A text of fewer words is one shingle of
   all of them; a text without words has an empty set and no links.
2. Signature: ``BANDS * ROWS`` minima of multiply-add universal hashes modulo
   2^64, numpy inside Arrow batches, a block of shingles of many texts at a time.
   The low byte of each minimum is kept for verification, the minima of a band
   are hashed into a bucket.
3. Rows with the same set (two independent 64-bit sums of mixed shingle hashes,
   and the size) are folded first, so a group of exact copies is one node from
   here on, however large it is.
4. Candidates, without pairing off a bucket. First every member of a bucket is
   paired with the bucket's smallest node only; the signatures and then the full
   sets of these pairs are compared, and the links found give a first set of
   components. Buckets whose members all lie in one component are done: a
   further link inside a component changes nothing. In the others, members of
   different components are compared by signature inside tasks (numpy, blocks of
   at most ``BLOCK`` members, classes of similar set size first). Members that
   agree with one across are tied to a local group, one row each; the connected
   groups are then dealt out with their full sets, again in blocks, and all
   intersections of a block are counted by an inverted index over its shingles.
   A block returns a spanning forest of its links: as many as it has members at
   most, however many links there are.
5. Components of all confirmed links by alternating large-star and small-star
   steps (``simhash.components``), each written to the shared folder.

Chance of losing a link: a pair at exactly 80 % shares no bucket with
probability (1 - 0.8^5)^40 = 1.3e-7, and its signatures agree in fewer than
``MIN_AGREE`` of 200 places with probability below 1e-7; both fall steeply above
80 %. Confirmed links are exact but for 64-bit collisions of shingles within a
pair of sets.

Defined cases: null, empty and blank texts have no set, their component is
their own id; a null key never names a component unless all members have none;
repeated rows (same key, same text) each give a row; ties go to the smallest
key; an empty table gives an empty result. Only key and text are read, so other
columns, whatever their names, cannot clash. Whole texts are used, however long;
a task holds a slice of texts or one text and its set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut
from ledgerline.llm.simhash import components
from ledgerline.llm.wordlists import slices, split_words

SHINGLE_WORDS, PERCENT = 4, 80
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
#: Agreeing signature bytes below which a pair is not compared in full (5.6 standard deviations below 80 %).
MIN_AGREE = 128
#: Members of a bucket, and shingles of a group, that a block has at most; pairs of blocks are compared at a time.
BLOCK, BLOCK_SHINGLES = 512, 1 << 18
#: Rows of an Arrow batch that carry two full sets each.
SET_BATCH = 256
SEED = 42
#: Shingles whose hash values are worked out at a time (8 bytes each, for one hash function).
HASH_BLOCK = 1 << 15

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of the universal hashes, from a fixed seed."""
    drawn = np.random.default_rng(SEED).integers(0, 1 << 63, size=(2, HASHES), dtype=np.uint64)
    return drawn[0] * _U(2) + _U(1), drawn[1] * _U(2)


def _word_hashes(flat: pa.Array) -> np.ndarray:
    coded = flat.dictionary_encode()
    digest = xxhash.xxh64_intdigest
    known = np.fromiter((digest(w, SEED) for w in coded.dictionary.cast(pa.binary()).to_pylist()), dtype=np.uint64,
                        count=len(coded.dictionary))
    return known[np.asarray(coded.indices)] if len(flat) else np.empty(0, dtype=np.uint64)


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and where each text's set begins."""
    flat, starts = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    word = _word_hashes(flat)
    counts = np.diff(starts)
    with np.errstate(over="ignore"):
        gram = np.zeros(max(0, len(word) - shingle + 1), dtype=np.uint64)
        for k in range(shingle):
            gram = _mix((gram ^ word[k:len(word) - shingle + 1 + k]) + _U(0x9E3779B97F4A7C15))
    sets = []
    for d in range(len(texts)):
        at, n = int(starts[d]), int(counts[d])
        if n >= shingle:
            sets.append(np.unique(gram[at:at + n - shingle + 1]))
        elif n:
            # fewer words: one shingle, told from full ones by the number of its words
            with np.errstate(over="ignore"):
                one = _U(n) << _U(32)
                for k in range(n):
                    one = _mix((one ^ word[at + k:at + k + 1]) + _U(0x9E3779B97F4A7C15))
            sets.append(one)
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima of all hash functions over each set, a row per set; ``values`` from one start to the next, none empty.

    A function is worked out for a block of shingles at a time, of however many
    sets, so short texts cost no calls of their own.
    """
    a, b = _coefficients()
    least = np.full((HASHES, len(starts) - 1), np.iinfo(np.uint64).max, dtype=np.uint64)
    work = np.empty(min(len(values), HASH_BLOCK), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(values), HASH_BLOCK):
            block = values[at:at + HASH_BLOCK]
            hashed = work[:len(block)]
            # sets with shingles in the block; the first and the last may have others elsewhere
            low, high = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + len(block), "left")
            begin = np.maximum(starts[low:high] - at, 0)
            for h in range(HASHES):
                np.multiply(block, a[h], out=hashed)
                np.add(hashed, b[h], out=hashed)
                own = least[h, low:high]
                np.minimum(own, np.minimum.reduceat(hashed, begin), out=own)
    return np.ascontiguousarray(least.T)


def signature(members: np.ndarray) -> np.ndarray:
    """Minima of all hash functions over one non-empty set."""
    return minima(members, np.array([0, len(members)]))[0]


def buckets(least: np.ndarray) -> np.ndarray:
    """One hash for each band of each signature (a row), different bands apart."""
    bands = least.reshape(-1, BANDS, ROWS)
    with np.errstate(over="ignore"):
        out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93), (len(bands), 1))
        for k in range(ROWS):
            out = _mix(out ^ bands[:, :, k])
    return out.view(np.int64)


_SIGNED = "doc_id long, text_hash long, n_shingles long, sum_a long, sum_b long, bands array<long>, signature binary"


def signed_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``signed_rows`` for batches of (doc_id, text_hash, text)."""
    for batch in batches:
        for start, count in slices(batch.column(2)):
            part = batch.slice(start, count)
            values, starts = shingle_sets(part.column(2), shingle)
            size = np.diff(starts)
            some = np.flatnonzero(size)
            least = minima(values, np.append(starts[some], len(values)))
            sums = np.zeros((2, count), dtype=np.uint64)
            with np.errstate(over="ignore"):
                for of, mixed in zip(sums, (_mix(values), _mix(values * _U(0x9E3779B97F4A7C15) + _U(7))), strict=True):
                    of[some] = np.add.reduceat(mixed, starts[some]) if len(some) else 0
                # mixed before the byte is taken: the low bits of a product depend on the low bits of its factors only
                low = _mix(least).astype(np.uint8)
            bands = pa.ListArray.from_arrays(np.arange(0, BANDS * len(some) + 1, BANDS, dtype=np.int32), buckets(least).ravel())
            sig = pa.FixedSizeBinaryArray.from_buffers(pa.binary(HASHES), len(some), [None, pa.py_buffer(low.tobytes())])
            at = pa.array(np.cumsum(size > 0) - 1, pa.int64(), mask=size == 0)  # rows without a set have neither
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(size, pa.int64()), *(pa.array(x.view(np.int64)) for x in sums),
                 bands.take(at), sig.take(at).cast(pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "sum_a", "sum_b", "bands", "signature"])


def signed_rows(df: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """(doc_id, text_hash, n_shingles, sum_a, sum_b, bands, signature): one row per input row."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
                     F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(lambda batches: signed_batches(batches, shingle), _SIGNED)


def _sets_of(docs: DataFrame, shingle: int) -> DataFrame:
    """(node, members): the full set of each row (node, text) as sorted 64-bit values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count in slices(batch.column(1)):
                part = batch.slice(start, count)
                values, starts = shingle_sets(part.column(1), shingle)
                members = [values[int(starts[d]):int(starts[d + 1])].tobytes() for d in range(count)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(members, pa.binary())], names=["node", "members"])

    return docs.select("node", "text").mapInArrow(run, "node long, members binary")


def _agreeing(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs (u, v) whose signatures agree in ``MIN_AGREE`` places at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, HASHES) for c in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((a == b).sum(axis=1) >= MIN_AGREE))

    left = signatures.select(F.col("node").alias("u"), F.col("signature").alias("sig_u"))
    right = signatures.select(F.col("node").alias("v"), F.col("signature").alias("sig_v"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "sig_u", "sig_v").mapInArrow(run, "u long, v long")


def _confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in (2, 3))
                if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
                    continue
                both = np.sort(np.concatenate([a, b]))
                shared = int((both[1:] == both[:-1]).sum())
                linked[i] = 100 * shared >= percent * (len(a) + len(b) - shared)
            yield batch.select([0, 1]).filter(pa.array(linked))

    sets = _full_sets(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), nodes, texts, shingle)
    left = sets.select(F.col("node").alias("u"), F.col("members").alias("set_u"))
    right = sets.select(F.col("node").alias("v"), F.col("members").alias("set_v"))
    both = pairs.join(right, "v").join(left, "u").select("u", "v", "set_u", "set_v")
    return _cut_in_batches(both.mapInArrow(run, "u long, v long"), "links")


def _cut_in_batches(df: DataFrame, name: str) -> DataFrame:
    """``cut`` with Arrow batches of at most ``SET_BATCH`` rows, as these hold full sets."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(SET_BATCH))
    try:
        return cut(df, name)
    finally:
        conf.set(key, before)


def _full_sets(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(node, members) of the wanted nodes, from the text of the row that stands for each."""
    needed = wanted.join(nodes.select("node", "first"), "node")
    same = texts["doc_id"].eqNullSafe(needed["first.doc_id"]) & (texts["text_hash"] == needed["first.text_hash"])
    sets = _sets_of(texts.join(needed, same).select("node", "text"), shingle)
    # rows repeating a key and its text give equal sets
    return cut(sets.groupBy("node").agg(F.first("members").alias("members")), "sets")


class _Forest:
    """Union-find over a few labels of one task."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.parent.setdefault(x, x)
        while up != self.parent[up]:
            self.parent[up] = up = self.parent[self.parent[up]]
        self.parent[x] = up
        return up

    def unite(self, x: int, y: int) -> bool:
        """True if the two were apart; the smaller label becomes the root."""
        a, b = sorted((self.root(x), self.root(y)))
        self.parent[b] = a
        return a != b


def _dealt(placed: DataFrame) -> DataFrame:
    """Rows with ``block`` of ``blocks``, once for each pair of blocks (low, high) that theirs is part of."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return placed.select("*", other.alias("other")).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")


def _across(members: DataFrame) -> DataFrame:
    """(u, v): each member that agrees by signature with one of another component, tied to its local group's first.

    ``members``: (bucket, node, root, n_shingles, signature). Sets that reach
    80 % differ in size by a factor of 1.25 at most, so members meet within a
    class of sizes or with the class below. Hot classes are dealt out in
    blocks, each pair of blocks a group of its own, so no group is larger than
    about two blocks.
    """
    size_class = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(1.26))).cast("int")
    classed = members.withColumn("class", F.explode(F.array(size_class, size_class + 1))).withColumn(
        "own", F.col("class") == size_class)
    held = classed.groupBy("bucket", "class").agg(F.count("*").alias("rows"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    held = held.filter("r0 != r1").select("bucket", "class", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    placed = classed.join(held, ["bucket", "class"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = _dealt(placed).select("bucket", "class", "low", "high", "block", "own", "node", "root", "signature")

    def tie(group: tuple, table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        root, block, own = (table.column(c).to_numpy() for c in ("root", "block", "own"))
        sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint8).reshape(-1, HASHES)
        low, high = group[2].as_py(), group[3].as_py()
        ties, met = _Forest(), set()
        for i in np.flatnonzero(block == low).tolist():
            # one side of the class's own size at least; within a block every pair once
            fit = (root != root[i]) & (own | own[i]) & (block == high)
            if low == high:
                fit &= node > node[i]
            at = np.flatnonzero(fit)
            at = at[(sig[at] == sig[i]).sum(axis=1) >= MIN_AGREE]
            for other in node[at].tolist():
                ties.unite(int(node[i]), other)
            if len(at):
                met.add(int(node[i]))
                met.update(node[at].tolist())
        found = sorted(met)
        return pa.table({"u": pa.array([ties.root(x) for x in found], pa.int64()), "v": pa.array(found, pa.int64())})

    return dealt.groupBy("bucket", "class", "low", "high").applyInArrow(tie, "u long, v long").distinct()


def _links_within(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Spanning forests (u, v) of the links between members of a group that lie in different components.

    ``groups``: (group, node, root, n_shingles); every pair of a group meets in one pair of blocks.
    """
    size = groups.groupBy("group").agg(F.sum("n_shingles").alias("shingles"), F.count("*").alias("rows"))
    blocks = F.greatest(F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.ceil(F.col("rows") / BLOCK)).cast("int")
    placed = groups.join(size.select("group", blocks.alias("blocks")), "group").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = _dealt(placed).join(sets, "node").select("group", "low", "high", "block", "node", "root", "members")

    def link(group: tuple, table: pa.Table) -> pa.Table:
        low, high = group[1].as_py(), group[2].as_py()
        node, root, block = (table.column(c).to_numpy() for c in ("node", "root", "block"))
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in table.column("members")]
        size = np.array([len(x) for x in sets], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), size)
        number = np.unique(every, return_inverse=True)[1]
        order = np.argsort(number, kind="stable")
        lists = owner[order]  # members of each shingle, one shingle after the other
        begin = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=1))])
        ties, u, v = _Forest(), [], []
        for i in np.flatnonzero(block == low).tolist():
            own = number[ends[i]:ends[i + 1]]
            first, many = begin[own], begin[own + 1] - begin[own]
            at = np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            shared = np.bincount(lists[at], minlength=len(sets))
            near = (100 * shared >= percent * (size + size[i] - shared)) & (block == high) & (root != root[i])
            if low == high:
                near &= node > node[i]
            for j in np.flatnonzero(near).tolist():
                if ties.unite(int(root[i]), int(root[j])):
                    u.append(int(node[i]))
                    v.append(int(node[j]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return dealt.groupBy("group", "low", "high").applyInArrow(link, "u long, v long")


def near_duplicates(df: DataFrame, shingle: int = SHINGLE_WORDS, percent: int = PERCENT, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id): one row per input row.

    ``component_id`` is the smallest key that links reach, the row's own included.
    """
    if percent < PERCENT:
        raise ValueError(f"the bands are laid out for similarities of {PERCENT} % or more")
    rows = cut(signed_rows(df, shingle, key, text), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    folded = rows.filter("n_shingles > 0").groupBy("n_shingles", "sum_a", "sum_b").agg(
        first, F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    # Numbers given before the table is written stay the same however often it is read.
    nodes = cut(folded.withColumn("node", F.monotonically_increasing_id()), "nodes")
    signatures = nodes.select("node", "signature")
    texts = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
                      F.col(f"`{text}`").alias("text"))

    member = nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("most")).filter("pivot != most")
    met = cut(member.join(shared.select("bucket", "pivot"), "bucket"), "buckets")
    star = met.filter("node != pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    links = _confirmed(cut(_agreeing(star, signatures), "star"), nodes, texts, shingle, percent)

    found = components(links)
    labelled = met.join(found, met["node"] == found["node"], "left").select(
        "bucket", met["node"], "n_shingles", F.coalesce("root", met["node"]).alias("root"))
    labelled = cut(labelled, "labelled")
    mixed = labelled.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a != b").select("bucket")
    members = labelled.join(mixed, "bucket").join(signatures, "node")
    tied = components(cut(_across(members), "across").filter("u != v"))
    groups = cut(tied.select(F.col("root").alias("group"), "node").join(
        labelled.select("node", "n_shingles", "root").distinct(), "node"), "groups")
    sets = _full_sets(groups.select("node"), nodes, texts, shingle)
    rest = cut(_links_within(groups, sets, percent), "rest")

    found = components(links.union(rest))
    roots = nodes.join(found, nodes["node"] == found["node"], "left").select(
        "n_shingles", "sum_a", "sum_b", "first", F.coalesce("root", nodes["node"]).alias("root"))
    heads = roots.groupBy("root").agg(F.min("first").alias("head"))
    named = cut(roots.join(heads, "root").select("n_shingles", "sum_a", "sum_b", F.col("head.doc_id").alias("head_id")), "named")
    held = rows.select("doc_id", "text_hash", "n_shingles", "sum_a", "sum_b").join(
        named, ["n_shingles", "sum_a", "sum_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("head_id")).otherwise(F.col("doc_id"))
    return held.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"))
