"""Token ids packed into fixed-width rows by best-fit decreasing.

Texts become token ids of a public tokenizer and an end mark each. A document
longer than a row is cut into pieces of a row's width (nothing is dropped);
pieces are placed longest first, each into the row that it fills best. Rows
are found by their free space with a segment tree over capacities: a leaf per
free space holds the rows that have it, and a descent gives the smallest free
space that is large enough, in the logarithm of the width.

Packing is local to a block of documents (a few million ids of one partition),
so it needs no shuffle, its memory is bounded and a lost task repeats the same
rows; blocks of that size fill rows to well over 99 %.

Each output row is one row of an id matrix (``matrix`` names the block): the
ids, the cumulative lengths of its segments (starting at 0, pad excluded),
positions that restart at 0 in every segment, and the document and piece of
each segment. Ids and positions are little-endian 32-bit integers.

Defined cases: a null or empty text is the end mark alone; a null doc_id is
kept; repeated rows are packed as often as they occur; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 2048
#: Ids of a packing block; a block ends with the document that reaches it.
BLOCK_IDS = 1 << 22
#: Where the vocabulary is on the driver, the pattern it belongs to, and the id that its files leave free.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_ID = PAD_ID = 50256


def load_vocabulary(path: str = VOCABULARY) -> bytes:
    """The rank file, read on the driver; a vocabulary has a fixed size of about a megabyte."""
    with open(path, "rb") as f:
        return f.read()


def tokenizer(ranks: bytes, pattern: str = PATTERN) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                             mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs})


#: The tokenizer's pattern matcher gives up on far longer runs of white space (Unicode's White_Space, as in its pattern);
#: runs from this length on are found here.
MAX_SPACE_RUN = 1 << 14
_LONG_SPACE = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{MAX_SPACE_RUN},}}")


def encode(coder: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of the whole text; special tokens in it are ordinary text.

    A long run of white space is the piece that the pattern makes of it: all of
    it at the end of the text, else all but the last character, which goes with
    what follows.
    """
    parts, at = [], 0
    for run in _LONG_SPACE.finditer(text) if len(text) >= MAX_SPACE_RUN else ():
        stop = run.end() if run.end() == len(text) else run.end() - 1
        parts.append(coder.encode_to_numpy(text[at:run.start()], disallowed_special=()))
        parts.append(np.array(coder._encode_single_piece(text[run.start():stop]), dtype=np.int32))
        at = stop
    parts.append(coder.encode_to_numpy(text[at:], disallowed_special=()))
    return np.concatenate(parts).astype(np.int32)


class FreeSpace:
    """Rows by free space: a segment tree whose leaf ``c`` counts the rows with ``c`` places free."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def _change(self, space: int, by: int) -> None:
        node = space + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, row: int, space: int) -> None:
        if space:
            self.rows[space].append(row)
            self._change(space, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """A row of the smallest free space that is at least ``need``, and that space."""
        node, count = need + self.leaves, self.count
        while not count[node]:
            while node & 1:  # a right child: nothing further right below this parent
                node >>= 1
            if not node:
                return None
            node += 1  # the right sibling
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        space = node - self.leaves
        self._change(space, -1)
        return self.rows[space].pop(), space


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Rows, each a list of piece numbers; every length is between 1 and ``width``."""
    free, rows = FreeSpace(width), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = free.take(lengths[piece])
        if found is None:
            found = len(rows), width
            rows.append([])
        row, space = found
        rows[row].append(piece)
        free.put(row, space - lengths[piece])
    return rows


SCHEMA = ("matrix string, row int, ids binary, cu_seqlens array<int>, positions binary, doc_ids array<long>, "
          "pieces array<int>")


def pack_block(matrix: str, docs: list[tuple[int | None, np.ndarray]], width: int, pad_id: int) -> Iterator[tuple]:
    """Packed rows of one block of (doc_id, ids)."""
    pieces = [(doc, at // width, ids[at:at + width]) for doc, ids in docs for at in range(0, len(ids), width)]
    for n, row in enumerate(best_fit_decreasing([len(p[2]) for p in pieces], width)):
        ids = np.full(width, pad_id, dtype="<i4")
        positions = np.zeros(width, dtype="<i4")
        ends = [0]
        for i in row:
            segment = pieces[i][2]
            ids[ends[-1]:ends[-1] + len(segment)] = segment
            positions[ends[-1]:ends[-1] + len(segment)] = np.arange(len(segment))
            ends.append(ends[-1] + len(segment))
        yield (matrix, n, ids.tobytes(), ends, positions.tobytes(), [pieces[i][0] for i in row], [pieces[i][1] for i in row])


def pack(spark: SparkSession, df: DataFrame, vocabulary: str = VOCABULARY, width: int = WIDTH, end_id: int = END_ID,
         pad_id: int = PAD_ID, block_ids: int = BLOCK_IDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Packed rows of all documents."""
    if width < 1:
        raise ValueError("width must be at least 1")
    ranks = spark.sparkContext.broadcast(load_vocabulary(vocabulary))
    types = [pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(ranks.value)
        part, blocks, block, size = TaskContext.get().partitionId(), 0, [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            rows = list(pack_block(f"{part:06d}-{blocks:06d}", block, width, pad_id))
            for at in range(0, len(rows), 1000):
                columns = zip(*rows[at:at + 1000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)],
                                                 names=names)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, value in enumerate(batch.column(1)):
                found = encode(coder, value.as_py() or "")
                block.append((ids[i], np.append(found, np.int32(end_id))))
                size += len(found) + 1
                if size >= block_ids:
                    yield from packed()
                    blocks, block, size = blocks + 1, [], 0
        if block:
            yield from packed()

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def unpack(rows) -> dict[tuple[str, int | None], list[np.ndarray]]:
    """(matrix, doc_id) -> the pieces found in packed rows, in piece order (for tests and readers)."""
    found: dict = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype="<i4")
        for i, (doc, piece) in enumerate(zip(r["doc_ids"], r["pieces"], strict=True)):
            found.setdefault((r["matrix"], doc), []).append((piece, ids[r["cu_seqlens"][i]:r["cu_seqlens"][i + 1]]))
    return {k: [p for _, p in sorted(v, key=lambda x: x[0])] for k, v in found.items()}
