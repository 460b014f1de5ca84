"""Data-quality primitives: duplicate-key quarantine, required fields,
mean imputation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.skew import skew_join


class Split(NamedTuple):
    clean: DataFrame   # rows whose key occurs exactly once
    bad: DataFrame     # every row of a key that occurs more than once


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key. Partial aggregation collapses a hot key map-side, so the
    shuffle carries at most one row per key per input partition."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def tag_key_counts(df: DataFrame, key: str, count_col: str = "_rows") -> DataFrame:
    """Rows with a non-NULL key, each tagged with how often its key occurs.

    One shuffle of the rows, salted where a key has more rows than a task is
    to take. Rows with a NULL key are dropped before any shuffle.
    """
    rows = df.filter(F.col(key).isNotNull())
    counts = key_counts(rows, key)
    tagged = skew_join(rows, counts, key, "inner", counts=counts, count_col="_rows")
    return tagged.select(*df.columns, F.col("_rows").alias(count_col))


#: Types of fixed width: their first value is kept in place, so groups can be hashed.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def unique_rows(df: DataFrame, key: str, whole: bool = False) -> DataFrame:
    """Rows whose non-NULL key occurs exactly once.

    One pass and one shuffle: rows fold into one per key with their number, map
    side first, so a hot key ships one row per task. A group of one row returns
    that row; larger groups leave, so which of their values survive is of no matter.

    Columns that the caller does not use are pruned. ``whole``: for callers that use
    every column; those of varying width (text) are carried as one value, which is
    cheaper than one aggregate value per column but keeps them from being pruned.
    """
    rest = [f for f in df.schema.fields if f.name != key]
    packed = [f.name for f in rest if whole and not isinstance(f.dataType, FIXED_WIDTH)]
    first = [F.first(F.col(f"`{f.name}`")).alias(f.name) for f in rest if f.name not in packed]
    if packed:
        first.append(F.first(F.struct(*[F.col(f"`{c}`") for c in packed])).alias("_packed"))
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *first)
    return counted.filter(F.col("_rows") == 1).select(
        *[F.col("_packed").getField(c).alias(c) if c in packed else F.col(f"`{c}`") for c in df.columns])


#: Keys that a join may broadcast, with what their table takes beside their text.
BROADCAST_BYTES, KEY_BYTES = 32 * 1024 * 1024, 32


def _repeated_keys(rows: DataFrame, key: str, cut: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, bool]:
    """(key, _rows) of keys that occur more than once, cut, and whether they are few enough to broadcast."""
    repeated = cut(key_counts(rows, key).filter(F.col("_rows") > 1))
    size = F.sum(F.octet_length(F.col(key).cast("string")) + F.lit(KEY_BYTES).cast("long"))
    return repeated, (repeated.agg(size).first()[0] or 0) <= BROADCAST_BYTES


def _split_materialised(rows: DataFrame, key: str, cut: Callable[[DataFrame], DataFrame]) -> Split:
    """Both sides of a split by the keys that occur more than once.

    Where those keys are few no row is shuffled; else the rows meet them in a salted join.
    """
    repeated, few = _repeated_keys(rows, key, cut)

    def side(how: str) -> DataFrame:
        if few:
            found = rows.join(F.broadcast(repeated.select(key)), key, how)
        else:
            found = skew_join(rows, repeated, key, how, counts=repeated, count_col="_rows")
        return found.select(*rows.columns)

    return Split(side("left_anti"), side("left_semi"))


def split_unique(df: DataFrame, key: str, cut: Callable[[DataFrame], DataFrame] | None = None) -> Split:
    """Quarantine rows with a duplicated key.

    ``clean`` keeps rows whose key occurs once, ``bad`` keeps all rows of keys
    that occur more than once. Rows with a NULL key are in neither output
    (``NULL IN (...)`` is never true). ``cut`` materialises the input once for
    jobs that write both, whole.
    """
    if cut is not None:
        return _split_materialised(cut(df).filter(F.col(key).isNotNull()), key, cut)
    return Split(unique_rows(df, key), tag_key_counts(df, key).filter(F.col("_rows") > 1).drop("_rows"))


def all_present(df: DataFrame, columns: list[str]) -> Column:
    """True where no column is NULL (or NaN, for floating columns)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    conds = []
    for c in columns:
        cond = F.col(c).isNotNull()
        if isinstance(types[c], (T.FloatType, T.DoubleType)):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    return reduce(lambda a, b: a & b, conds)


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with NULL (or NaN, for floating columns) in any of ``columns``.

    Same rows as ``na.drop(how="any", subset=columns)``, but written as one
    ``IS NOT NULL`` per column so the checks are pushed into the file scan
    (``PushedFilters``), where ``na.drop``'s combined predicate is not.
    """
    return df.filter(all_present(df, columns))


def floor_mean(df: DataFrame, column: str):
    """FLOOR(AVG(column)) as a scalar-subquery column (evaluated once, in-plan)."""
    return df.select(F.floor(F.avg(column))).scalar()


def impute_floor_mean(df: DataFrame, column: str) -> DataFrame:
    """Fill NULLs of ``column`` with the floored mean of its non-NULL values.

    The mean is a scalar subquery: one distributed aggregate, no driver
    round-trip and no join. When the column has no value at all there is no
    mean; filling then fails, as a fill with a missing value does.
    """
    dtype = df.schema[column].dataType
    mean = floor_mean(df, column)
    fill = F.when(mean.isNull(), F.raise_error(F.lit(f"no mean to impute {column}"))).otherwise(mean)
    if not isinstance(dtype, (T.LongType, T.DecimalType)):
        fill = fill.cast(dtype)
    return df.withColumn(column, F.coalesce(F.col(column), fill))


def fill_zero_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast each count column to INT (truncating) and fill NULL with 0."""
    from ledgerline.functions.cleaning import count_or_zero
    return df.withColumns({c: count_or_zero(c) for c in columns})
