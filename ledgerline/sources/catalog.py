"""Catalog publishing: databases, external tables over written files,
permanent views and table-as-select."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.sources.files import write_csv, write_parquet


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_external_table(spark: SparkSession, name: str, schema: T.StructType,
                          path: str, fmt: str = "csv") -> None:
    """External (unmanaged) table over files: dropping it keeps the files."""
    opts = " OPTIONS ('header' = 'true', 'inferSchema' = 'false')" if fmt == "csv" else ""
    drop_table(spark, name)
    spark.sql(f"CREATE EXTERNAL TABLE {name} ({schemas.ddl_columns(schema)}) "
              f"USING {fmt}{opts} LOCATION '{path}'")


def publish(spark: SparkSession, tables: dict[str, DataFrame], db: str, root: str,
            fmt: str = "csv") -> dict[str, str]:
    """Write each DataFrame below ``root`` and expose it as ``db.<name>``.

    Table schemas are the published ones (``schemas.PUBLISHED``); a CSV
    table reads its files positionally with those types.
    """
    create_database(spark, db)
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        (write_csv if fmt == "csv" else write_parquet)(df, path)
        schema = schemas.PUBLISHED.get(name, df.schema)
        create_external_table(spark, f"{db}.{name}", schema, path, fmt)
        paths[name] = path
    return paths


def publish_bucketed(spark: SparkSession, tables: dict[str, DataFrame], db: str, root: str,
                     buckets: dict[str, tuple[str, int]]) -> dict[str, str]:
    """Write Parquet tables bucketed (and sorted) on their join key.

    Tables bucketed on the same key with the same bucket count are joined
    without a shuffle: loans and repayments on loan_id is the score's largest
    join. Tables without an entry in ``buckets`` are written plainly. The
    files live at ``root/<name>`` (external tables: dropping keeps the data).
    All rows of a key are in one bucket, so bucket on keys without hot values:
    loan_id, and member_id of tables with a row per member.
    """
    create_database(spark, db)
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        drop_table(spark, f"{db}.{name}")
        if name in buckets:
            col, n = buckets[name]
            # one task per bucket, hence one file per bucket
            w = df.repartition(n, col).write.bucketBy(n, col).sortBy(col)
        else:
            w = df.write
        w.mode("overwrite").format("parquet").option("path", path).saveAsTable(f"{db}.{name}")
        paths[name] = path
    return paths


def create_view(spark: SparkSession, create_sql: str) -> None:
    spark.sql(create_sql)


def create_table_as(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Managed table from a DataFrame (CREATE TABLE ... AS SELECT)."""
    drop_table(spark, name)
    df.write.format(fmt).saveAsTable(name)
