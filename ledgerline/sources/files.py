"""CSV and Parquet readers/writers with the lending conventions.

Readers apply an explicit schema (positional, header line skipped) and append
the ingest timestamp. Writers overwrite a directory; CSV keeps a header line.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas


def with_ingest_time(df: DataFrame, ingest_ts: str | None = None) -> DataFrame:
    """Append ``ingest_date``: the query start time, or a pinned literal."""
    ts = F.current_timestamp() if ingest_ts is None else F.lit(ingest_ts).cast("timestamp")
    return df.withColumn(schemas.INGEST_COLUMN, ts)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             ingest: bool = True, ingest_ts: str | None = None) -> DataFrame:
    """CSV scan with a declared schema (no inference pass over the data)."""
    df = spark.read.csv(path, header=True, schema=schema)
    return with_ingest_time(df, ingest_ts) if ingest else df


CORRUPT_COLUMN = "_corrupt_record"


def read_csv_flagging_corrupt(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Schema'd CSV scan that keeps the raw line of any row with a malformed
    typed cell in ``_corrupt_record`` (the typed value itself reads as NULL,
    exactly as in the plain read)."""
    flagged = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    return (spark.read.option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            .csv(path, header=header, schema=flagged))


def corrupt_row_count(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """One row: how many input rows had a cell that did not parse as its type.

    A positional schema silently turns such cells into NULL (for example
    "178050.0" in an INTEGER column); this count makes the loss visible.
    """
    df = read_csv_flagging_corrupt(spark, path, schema, header)
    # Every typed column is referenced: the CSV parser only parses (and so
    # only validates) the columns a query needs, and a scan of the
    # corrupt-record column alone is refused.
    any_value = F.coalesce(*[F.col(f.name).cast("string") for f in schema.fields], F.lit(""))
    flagged_row = F.when(F.col(CORRUPT_COLUMN).isNotNull(), any_value)
    return df.agg(F.count(flagged_row).alias("corrupt_rows"))


def read_customers(spark, path, ingest_ts=None):
    return read_csv(spark, path, schemas.RAW_CUSTOMERS, ingest_ts=ingest_ts)


def read_loans(spark, path, ingest_ts=None):
    return read_csv(spark, path, schemas.RAW_LOANS, ingest_ts=ingest_ts)


def read_repayments(spark, path, ingest_ts=None):
    return read_csv(spark, path, schemas.RAW_REPAYMENTS, ingest_ts=ingest_ts)


def read_delinquencies(spark, path, ingest_ts=None):
    return read_csv(spark, path, schemas.RAW_DELINQUENCIES, ingest_ts=ingest_ts)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan that infers column types (one extra pass over the files).

    Meant for profiling an unknown export; production reads use a schema.
    """
    return spark.read.csv(path, header=True, inferSchema=True)


def rename_raw_customer_columns(df: DataFrame) -> DataFrame:
    """Map the upstream export's header names onto the lending column names."""
    present = {k: v for k, v in schemas.RAW_CUSTOMER_HEADER_RENAMES.items() if k in df.columns}
    return df.withColumnsRenamed(present)


#: How Spark's CSV writer writes a timestamp by default.
CSV_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]"


def csv_text(df: DataFrame) -> DataFrame:
    """Timestamps as the CSV writer's text: that of a run's constant ingest time is made once, not per row."""
    return df.withColumns({f.name: F.date_format(F.col(f"`{f.name}`"), CSV_TIMESTAMP) for f in df.schema.fields
                           if isinstance(f.dataType, T.TimestampType)})


def write_csv(df: DataFrame, path: str, keep_whitespace: bool = False) -> None:
    """Overwrite ``path`` with header CSV.

    Spark's CSV writer trims leading/trailing blanks by default (as the
    published sinks do); ``keep_whitespace`` writes values verbatim, which is
    what a raw export such as " 36 months" needs.
    """
    w = csv_text(df).write.mode("overwrite").option("header", True)
    if keep_whitespace:
        w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    w.csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


class Writes:
    """Independent writes submitted side by side, so that a small one's tasks run beside a large one's.

    Leaving the block waits for all of them; the first error of a write is raised there.
    """

    def __init__(self, spark: SparkSession, at_once: int = 4):
        self.spark, self._pool, self._futures = spark, ThreadPoolExecutor(at_once), []

    def submit(self, write: Callable[..., None], *args, **kwargs) -> None:
        # each with the job group and local properties of the thread that submits it
        self._futures.append(self._pool.submit(inheritable_thread_target(self.spark)(write), *args, **kwargs))

    def __enter__(self) -> Writes:
        return self

    def __exit__(self, failed, *_) -> None:
        self._pool.shutdown(wait=True, cancel_futures=failed is not None)
        if failed is None:
            for f in self._futures:
                f.result()
