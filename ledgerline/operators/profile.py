"""Data-quality profiles: frequencies, filtered counts, distinct values,
top-k and previews. All distributed aggregates; nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frequency(df: DataFrame, column: str, descending: bool = True, total: str = "total") -> DataFrame:
    """``column, count(*) AS total`` ordered by the count (ties by value)."""
    agg = df.groupBy(column).agg(F.count(F.lit(1)).alias(total))
    order = F.col(total).desc() if descending else F.col(total).asc()
    return agg.orderBy(order, F.col(column).asc_nulls_last())


def top_k(df: DataFrame, column: str, k: int, total: str = "total") -> DataFrame:
    """The k most frequent values (value ascending breaks ties).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps k
    rows, the driver merges k rows per task.
    """
    return frequency(df, column, True, total).limit(k)


def bottom_k(df: DataFrame, column: str, k: int, total: str = "total") -> DataFrame:
    """The k least frequent values (value ascending breaks ties)."""
    return frequency(df, column, False, total).limit(k)


def count_rows(df: DataFrame, condition: Column | None, name: str) -> DataFrame:
    """One row: number of rows satisfying ``condition`` (all rows if None)."""
    src = df if condition is None else df.filter(condition)
    return src.agg(F.count(F.lit(1)).alias(name))


def count_values(df: DataFrame, column: str, condition: Column | None, name: str) -> DataFrame:
    """One row: number of non-NULL ``column`` values among matching rows."""
    src = df if condition is None else df.filter(condition)
    return src.agg(F.count(F.col(column)).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def as_rows(counts: DataFrame) -> DataFrame:
    """(stage, row_count): one row per column of a one-row DataFrame of counts."""
    pairs = F.array(*[F.struct(F.lit(c).alias("stage"), F.col(c).alias("row_count")) for c in counts.columns])
    return counts.select(F.explode(pairs).alias("c")).select("c.stage", "c.row_count")


def row_counts(counts: list[DataFrame]) -> DataFrame:
    """(stage, row_count) of several one-row DataFrames, each with a column per stage."""
    return reduce(DataFrame.unionByName, [as_rows(c) for c in counts])


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First n rows in key order (a deterministic ``show``)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)
