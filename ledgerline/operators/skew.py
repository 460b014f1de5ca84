"""Equi-joins that stay balanced when one key holds a large share of rows.

Adaptive execution splits a skewed sort-merge partition only when *both*
inputs of the join are fresh shuffles. A join against an aggregate's output
(key counts), or against a side already partitioned by an earlier join on the
same key, does not qualify, so a key with a third of all rows would be
processed by one task. ``skew_join`` salts such keys:

1. exact row counts per key of the big side (partial aggregation: a hot key
   ships one row per task);
2. a key is *hot* when it has more rows than one task is to take
   (``spark.ledgerline.rowsPerTask``), whatever the size of the table; it gets
   as many salts as it needs tasks. There are fewer hot keys than rows divided
   by rows per task, so their broadcast has a size bound: a million rows per
   task and 10^12 rows give at most a million short rows;
3. a big row takes the salt that its own columns and its input partition hash
   to (the partition spreads identical copies; both are the same when a task
   runs again), small rows of hot keys are repeated once per salt, and the two
   sides meet on key and salt in one shuffle join.

Each side is read once for the join and the big side's key column once for the
counts. NULL keys match nothing and are spread by their row hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
ROWS_PER_TASK_CONF = "spark.ledgerline.rowsPerTask"
NULL_KEY_SALTS = 1 << 20


def rows_per_task(df: DataFrame) -> int:
    """Rows of one key that a task may take: the session's setting, else ``ROWS_PER_TASK``."""
    value = int(df.sparkSession.conf.get(ROWS_PER_TASK_CONF, str(ROWS_PER_TASK)))
    if value < 1:
        raise ValueError(f"{ROWS_PER_TASK_CONF} must be at least 1")
    return value


def key_row_counts(df: DataFrame, key: str, count_col: str = "_n") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count_col))


def hot_keys(counts: DataFrame, key: str, limit: int, count_col: str = "_n") -> DataFrame:
    """(_hot_key, _salts) of the keys with more than ``limit`` rows."""
    return counts.filter(F.col(count_col) > limit).select(
        F.col(key).alias("_hot_key"), F.ceil(F.col(count_col) / limit).cast("int").alias("_salts"))


def row_salt(columns: list[str], key: str) -> Column:
    """Salt of a big row whose key has ``_salts`` salts (null: one)."""
    spread = F.xxhash64(*[F.col(c) for c in columns], F.spark_partition_id())
    return F.when(F.col(key).isNull(), F.pmod(spread, F.lit(NULL_KEY_SALTS))).otherwise(
        F.pmod(spread, F.coalesce(F.col("_salts"), F.lit(1)))).cast("int")


def salted(big: DataFrame, small: DataFrame, key: str, counts: DataFrame | None = None,
           count_col: str = "_n") -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``; the small side also keeps ``_salts`` (1 unless hot)."""
    counts = counts if counts is not None else key_row_counts(big, key, count_col)
    hot = F.broadcast(hot_keys(counts, key, rows_per_task(big), count_col))
    big_side = (big.join(hot, big[key] == hot["_hot_key"], "left")
                .withColumn("_salt", row_salt(big.columns, key)).select(*big.columns, "_salt"))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    small_side = (small.join(hot, small[key] == hot["_hot_key"], "left")
                  .select(*small.columns, salts.alias("_salts"))
                  .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))))
    return big_side, small_side


def skew_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
              counts: DataFrame | None = None, count_col: str = "_n") -> DataFrame:
    """``big JOIN small USING (key)`` for inner / left / left_semi / left_anti.

    ``big`` may hold hot keys; the rows of ``small`` for a hot key are repeated
    once per salt. ``counts`` may pass precomputed (key, count_col) rows of
    ``big``. Output columns are those of ``big.join(small, key, how)``.
    """
    big_side, small_side = salted(big, small, key, counts, count_col)
    return big_side.join(small_side.drop("_salts"), [key, "_salt"], how).drop("_salt")
