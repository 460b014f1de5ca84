"""Incremental refresh of the customer-loan mart by member partitions.

The mart is written in ``PARTS`` partitions by member hash. A refresh takes the
members whose rows changed in any input, finds the partitions they lie in,
rebuilds those from inputs filtered to them before any join, and overwrites only
these partitions (dynamic partition overwrite). Partitions that are left without
rows go. Members without id are one partition's (they join with nothing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.mart import customer_loan_mart

PARTS = 64
PART = "member_part"


def member_part(key: Column, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def build(tables: dict[str, DataFrame], path: str, parts: int = PARTS) -> None:
    """Write the whole mart, partitioned by member."""
    _write(_mart(tables), path, parts, "static")


def _mart(t: dict[str, DataFrame]) -> DataFrame:
    return customer_loan_mart(t["customers"], t["loans"], t["repayments"], t["delinquencies"], t["delinquencies_public_records"])


def _write(mart: DataFrame, path: str, parts: int, mode: str) -> None:
    rows = mart.withColumn(PART, member_part(F.col("member_id"), parts))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(PART).parquet(path))


def touched_parts(changed: DataFrame, parts: int = PARTS) -> list[int]:
    """Partitions of the changed members: at most ``parts`` numbers reach the driver."""
    return sorted(r[0] for r in changed.select(member_part(F.col("member_id"), parts).alias("p")).distinct().collect())


def refresh(spark: SparkSession, tables: dict[str, DataFrame], changed: DataFrame, path: str, parts: int = PARTS) -> list[int]:
    """Rebuild the partitions of ``changed`` (member_id) from the current tables; returns the partitions rewritten."""
    touched = touched_parts(changed, parts)
    if not touched:
        return []
    inside = member_part(F.col("member_id"), parts).isin(touched)
    current = {name: df.filter(inside) if "member_id" in df.columns else df for name, df in tables.items()}
    _write(_mart(current), path, parts, "dynamic")
    _drop_empty(spark, path, touched, current["customers"], parts)
    return touched


def _drop_empty(spark: SparkSession, path: str, touched: list[int], customers: DataFrame, parts: int) -> None:
    """A dynamic overwrite leaves a partition alone that has no new rows: remove those (the mart has a row per customer)."""
    held = set(touched_parts(customers, parts))
    jvm = spark.sparkContext._jvm
    for part in touched:
        if part not in held:
            at = jvm.org.apache.hadoop.fs.Path(f"{path}/{PART}={part}")
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)
