"""Shard assignment by a pseudo-random permutation of global row numbers.

Every row gets a global number: rows are ordered by (hash bucket, row hash),
numbered inside their bucket by a window and moved up by the number of rows in
lower buckets. No single task ever sees all rows, and the numbering depends on
the rows alone, not on partitions or retries. A balanced Feistel network with
cycle walking then permutes ``[0, n)``. A permuted number gives the place
directly: ``shard = p mod shards`` and ``slot = p div shards``, so shard sizes
differ by at most one, slots have no gaps, and the place of any row (and the
row of any place, through the inverse network) can be computed.

Defined cases: a null key or text takes part in the row hash as ``null``;
rows equal in key and text are interchangeable and take neighbouring numbers;
an empty table stays empty; input columns ``shard`` and ``slot`` are replaced, all
others returned, whatever their names. The input is evaluated three times
(count, bucket counts, placing): give a table or a written result, not a long plan. ``number_rows`` uses names of its own:
give it a table without them, as ``shard_rows`` does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import shielded, unused

#: Rows that one numbering bucket holds on average, and the least number of buckets.
ROWS_PER_BUCKET = 1_000_000
MIN_BUCKETS = 4096
ROUNDS = 6


def _round_keys(seed: int, rounds: int) -> list[int]:
    keys, x = [], seed & (2**64 - 1)
    for _ in range(rounds):
        x = (x + 0x9E3779B97F4A7C15) & (2**64 - 1)
        z = x
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
        keys.append(z ^ (z >> 31))
    return keys


def _mix(half: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    z = half ^ np.uint64(key)
    z = (z ^ (z >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    z = (z ^ (z >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (z ^ (z >> np.uint64(33))) & mask


def _half_bits(n: int) -> int:
    return max(1, -(-max(1, (n - 1).bit_length()) // 2))


def permute(numbers: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Feistel permutation of ``[0, n)``, applied to each number.

    The network permutes the next power of four; a number that leaves
    ``[0, n)`` is sent through again until it is back (cycle walking), which
    keeps the map one-to-one. Fewer than four walks are needed on average.
    """
    x = np.asarray(numbers, dtype=np.uint64).copy()
    if n <= 1:
        return x.astype(np.int64)
    bits = np.uint64(_half_bits(n))
    mask = np.uint64((1 << int(bits)) - 1)
    keys = _round_keys(seed, ROUNDS)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> bits, x[todo] & mask
        if inverse:
            for key in reversed(keys):
                left, right = right ^ _mix(left, key, mask), left
        else:
            for key in keys:
                left, right = right, left ^ _mix(right, key, mask)
        x[todo] = (left << bits) | right
        todo = todo[x[todo] >= np.uint64(n)]
    return x.astype(np.int64)


def place(row_number: int, n: int, shards: int, seed: int) -> tuple[int, int]:
    """Shard and slot of one global row number."""
    p = int(permute(np.array([row_number]), n, seed)[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """Global row number at a place (the inverse of ``place``)."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def _permuted(number: Column, n: int, seed: int) -> Column:
    @F.pandas_udf("long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(permute(part.to_numpy(), n, seed))

    return run(number)


def row_hash(key: Column, text: Column) -> Column:
    """Hash that orders the rows; depends on key and whole text only."""
    shown = F.coalesce(key.cast("string"), F.lit("null"))
    return F.md5(F.concat(shown, F.lit("/"), F.coalesce(F.md5(text), F.lit("null"))))


def number_rows(df: DataFrame, order_hash: Column, n: int) -> DataFrame:
    """Add ``row_number`` (0 to n-1) and drop nothing."""
    buckets = max(MIN_BUCKETS, -(-n // ROWS_PER_BUCKET))
    bucket = F.conv(F.substring("_row_hash", 1, 12), 16, 10).cast("long") % F.lit(buckets)
    rows = df.withColumn("_row_hash", order_hash).withColumn("_bucket", bucket)
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # One row per bucket, so the running total and its broadcast stay small:
    # MIN_BUCKETS rows, or one per ROWS_PER_BUCKET rows of input.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy("_row_hash")
    return (rows.withColumn("_inside", F.row_number().over(inside) - 1)
            .join(F.broadcast(starts), "_bucket")
            .withColumn("row_number", F.col("_start") + F.col("_inside"))
            .drop("_bucket", "_row_hash", "_inside", "_start"))


def shard_rows(df: DataFrame, shards: int, seed: int = 17, key: str = "doc_id", text: str = "text",
               order_hash: Column | None = None) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long) for every row.

    ``order_hash`` replaces the hash over key and text where the caller has
    computed it already (and dropped the text). Counting the rows is one
    action; for Parquet input it reads file footers only.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    df = df.drop("shard", "slot")
    n = df.count()
    hashed = row_hash(F.col(key), F.col(text)) if order_hash is None else order_hash
    order = unused(df, "_order")
    inner, at = shielded(df.withColumn(order, hashed))
    numbered = number_rows(inner, F.col(at[order]), n)
    return (numbered.withColumn("_permuted", _permuted(F.col("row_number"), n, seed))
            .withColumn("shard", (F.col("_permuted") % shards).cast("int"))
            .withColumn("slot", F.expr(f"_permuted div {int(shards)}"))
            .select(*[at[c] for c in df.columns], "shard", "slot").toDF(*df.columns, "shard", "slot"))
