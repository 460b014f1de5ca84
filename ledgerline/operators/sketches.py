"""Profiles kept as mergeable states: distinct counts and frequent items.

A state is a few kilobytes whatever the rows behind it. States of days, files
or runs are kept as rows of a table and merged when a profile is asked for, so
a profile of all days reads states, not rows.

* Distinct counts: HyperLogLog sketches of 2^``LOG_K`` registers; relative standard
  error 1.04 / sqrt(2^LOG_K), 0.8 % here; ``ERROR`` is five of them.
* Frequent items: at most ``TRACKED`` items a state. A count is off by at most
  ``max_error``: 0 while a state tracks every item it saw, else 3.5 / TRACKED of
  all rows at most (the sketch's own bound for its map of tracked items).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_K = 14
ERROR = 5 * 1.04 / (1 << (LOG_K // 2))
TRACKED = 1 << 14


def distinct_states(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(by, column, sketch): one state per value of ``by`` and column, in one pass over ``df``."""
    sketched = df.groupBy(by).agg(*[F.hll_sketch_agg(F.col(c), F.lit(LOG_K)).alias(c) for c in columns])
    return sketched.unpivot([by], columns, "column", "sketch")


def distinct_counts(states: DataFrame) -> DataFrame:
    """(column, estimate) over all states given; NULLs count as no value."""
    merged = states.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("column", F.hll_sketch_estimate("sketch").alias("estimate"))


def frequent_states(df: DataFrame, by: str, item: str, tracked: int = TRACKED) -> DataFrame:
    """(by, state, rows, items): one frequent-items state per value of ``by``."""
    return df.groupBy(by).agg(
        F.call_function("approx_top_k_accumulate", F.col(item), F.lit(tracked)).alias("state"),
        F.count(F.lit(1)).alias("rows"))


def frequent_items(states: DataFrame, k: int, tracked: int = TRACKED) -> DataFrame:
    """(item, n, max_error): the ``k`` most frequent items over all states given."""
    merged = states.agg(F.call_function("approx_top_k_combine", F.col("state"), F.lit(tracked)).alias("state"),
                        F.sum("rows").alias("rows"))
    found = F.call_function("approx_top_k_estimate", F.col("state"), F.lit(k))
    listed = merged.select("rows", found.alias("found"))
    # fewer items than a merged state tracks: none was ever dropped, and the counts are exact
    error = F.when(F.size("found") < tracked * 3 // 4, F.lit(0)).otherwise(F.ceil(F.col("rows") * 3.5 / tracked)).cast("long")
    return listed.select(error.alias("max_error"), F.explode("found").alias("f")).select("f.item", F.col("f.count").alias("n"), "max_error")
