"""Incremental cleaning of newly arriving raw CSV files.

The loan and repayment cleaners are row-local (filters and column rewrites
only), so the very same DataFrame functions run on a file stream: each
micro-batch reads only new files, and the checkpoint (in the shared folder)
records which files were done, so a restarted or failed query resumes
without duplicates. The customer and delinquency cleaners quarantine keys
that occur more than once in the *whole* input; a later file can turn a
clean key into a duplicate, so they are not append-only and stay batch jobs
(``plans.batch``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators import clean
from ledgerline.schemas import RAW_LOANS, RAW_REPAYMENTS
from ledgerline.sources.files import with_ingest_time

ROW_LOCAL_CLEANERS = {
    "loans": (RAW_LOANS, lambda df, mode: clean.clean_loans(df)),
    "repayments": (RAW_REPAYMENTS, clean.clean_repayments),
}


def raw_stream(spark: SparkSession, kind: str, source_dir: str,
               max_files_per_trigger: int | None = None) -> DataFrame:
    schema, _ = ROW_LOCAL_CLEANERS[kind]
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_ingest_time(reader.csv(source_dir))


def start_cleaning(spark: SparkSession, kind: str, source_dir: str, sink_dir: str,
                   checkpoint_dir: str, mode: str = "reference",
                   available_now: bool = True) -> StreamingQuery:
    """Clean new ``kind`` files from ``source_dir`` into Parquet at ``sink_dir``.

    ``checkpoint_dir`` records the files that are done; the same folder on every
    start makes a restart go on where the last run ended.
    ``available_now`` processes everything present and stops (scheduled
    incremental runs); otherwise the query keeps polling for new files.
    """
    _, cleaner = ROW_LOCAL_CLEANERS[kind]
    cleaned = cleaner(raw_stream(spark, kind, source_dir), mode)
    writer = (cleaned.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
