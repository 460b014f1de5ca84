"""Quarantine of malformed CSV rows, with a reason for each, in the scan that reads them.

A positional schema turns a cell that does not parse into NULL without a word.
``read_checked`` reads the same typed values and adds the raw record of every
row with such a cell, or with too many or too few cells, and the reasons.
``divert`` then writes the input once, split into good and bad rows: cleaners
read the good rows typed, the bad rows go to a sink, and the CSV text is
parsed once for both.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.files import CORRUPT_COLUMN, with_ingest_time

REASONS = "_reasons"
SURPLUS = "_surplus_cells"
TOO_MANY, TOO_FEW = "too many cells", "too few cells"


class Diverted(NamedTuple):
    good: DataFrame   # typed columns of rows without a malformed cell
    bad: DataFrame    # typed columns, raw record and reasons of the others


def _reasons(schema: T.StructType) -> Column:
    """array<struct<column, cell, expected>>: empty for a good row.

    Cells are taken from the raw record as text; a cell is malformed where its
    text is there and its typed value is not. A record whose cells all parse
    is malformed by their number. (A short record with a malformed cell has
    that cell as its reason.)
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(SURPLUS, T.StringType())])
    cells = F.from_csv(F.col(CORRUPT_COLUMN), ", ".join(f"`{f.name}` STRING" for f in as_text.fields))

    def reason(column: str | None, cell: Column, expected: str) -> Column:
        return F.struct(F.lit(column).cast("string").alias("column"), cell.alias("cell"), F.lit(expected).alias("expected"))

    def found(cells: Column) -> Column:
        wrong = [F.when(F.col(f.name).isNull() & cells[f.name].isNotNull(),
                        reason(f.name, cells[f.name], f.dataType.simpleString().upper()))
                 for f in schema.fields if not isinstance(f.dataType, T.StringType)]
        wrong.append(F.when(cells[SURPLUS].isNotNull(), reason(None, cells[SURPLUS], TOO_MANY)))
        some = F.filter(F.array(*wrong), lambda x: x.isNotNull())
        short = F.array(reason(None, F.lit(None).cast("string"), TOO_FEW))
        return F.when(F.size(some) > 0, some).otherwise(short)

    none = F.array().cast("array<struct<column: string, cell: string, expected: string>>")
    # bound once per row: the record would else be parsed again for every column
    judged = F.transform(F.array(cells), found)[0]
    return F.when(F.col(CORRUPT_COLUMN).isNull(), none).otherwise(judged)


def read_checked(spark: SparkSession, path: str, schema: T.StructType, ingest_ts: str | None = None,
                 header: bool = True) -> DataFrame:
    """CSV scan with the typed columns, ingest time, ``_corrupt_record`` and ``_reasons``.

    Every column is parsed whatever is selected later (the parser checks
    only columns that a query needs, and the number of cells only if it needs
    all), because ``_reasons`` refers to every typed column and column pruning is off.
    """
    flagged = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    df = (spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
          .option("columnPruning", False).csv(path, header=header, schema=flagged))
    return with_ingest_time(df.withColumn(REASONS, _reasons(schema)), ingest_ts)


def is_malformed() -> Column:
    return F.size(F.col(REASONS)) > 0


def divert(checked: DataFrame, staging: str) -> Diverted:
    """Write a checked scan once below ``staging``, split by its reasons, and return both sides.

    The two sides are partitions of one write, so the input is scanned and
    parsed once; either side is read back from files any executor can reach.
    """
    checked.withColumn("_bad", is_malformed()).write.partitionBy("_bad").mode("overwrite").parquet(staging)
    schema = T.StructType([*checked.schema.fields, T.StructField("_bad", T.BooleanType())])
    staged = checked.sparkSession.read.schema(schema).parquet(staging)
    good = staged.filter(~F.col("_bad")).drop("_bad", CORRUPT_COLUMN, REASONS)
    return Diverted(good, staged.filter("_bad").drop("_bad"))


def malformed_cells(bad: DataFrame, *keep: str) -> DataFrame:
    """One row per reason: the ``keep`` columns, column, cell, expected and the raw record."""
    return bad.select(*keep, F.explode(REASONS).alias("_r"), F.col(CORRUPT_COLUMN).alias("record")).select(
        *keep, "_r.column", "_r.cell", "_r.expected", "record")


def malformed_counts(bad: DataFrame, relation: str) -> DataFrame:
    """(relation, column, expected, n): how many rows each reason was found in."""
    return (bad.select(F.explode(REASONS).alias("_r")).groupBy("_r.column", "_r.expected").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(relation).alias("relation"), "column", "expected", "n"))
