"""Duplicate-key quarantine over arriving files.

A key is clean while one row of it has arrived; a later file can repeat it, and
then all its rows are bad. Two streaming queries, run one after the other:

1. *arrivals*: new raw files, row-local filter, append to ``root/arrived`` (Parquet,
   exactly once);
2. *key states*: reads ``arrived`` as a stream and folds it into one state per key:
   the number of rows and the least row (and the greatest, where equal rows
   count once). The fold is a plain streaming aggregation, so rows of a hot key
   are combined map-side and its state is one row however often it comes.
   Each micro-batch writes the states it changed to ``root/changes/batch=<id>``:
   a key's first row adds it to the clean side, its second retracts it. A batch
   that runs again overwrites its own folder.

The sides are views over those files: clean keys come from their latest change
(the row is in the state, so there is no join), bad rows are the arrived rows of
retracted keys (semi join, salted where a key is hot). ``compact`` folds the
changes so far into one row per key.

State lives in RocksDB on the executors with its changelog in the checkpoint,
so memory does not bound the number of keys. The number of state partitions is
that of ``spark.sql.shuffle.partitions`` at the first start; a checkpoint keeps it.

Rows with a NULL key are on neither side, as in the batch split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.quality import Split
from ledgerline.operators.skew import skew_join
from ledgerline.schemas import INGEST_COLUMN
from ledgerline.sources.files import with_ingest_time

STATE_CONF = "spark.sql.streaming.stateStore.providerClass"
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Arriving:
    """Where one relation arrives and what makes its keys.

    ``distinct_rows``: equal rows (but for the ingest time) count once, as in the
    customer cleaner; else every row counts, as for delinquencies.
    ``keep``: SQL condition of rows that take part, applied to each row by itself.
    """
    schema: T.StructType
    key: str
    source_dir: str
    root: str
    distinct_rows: bool = False
    keep: str = "true"

    @property
    def arrived_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(INGEST_COLUMN, T.TimestampType())])

    @property
    def row_columns(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name != self.key]


def start_arrivals(spark: SparkSession, a: Arriving) -> StreamingQuery:
    """Append the rows of new files in ``source_dir`` to ``root/arrived``."""
    raw = with_ingest_time(spark.readStream.schema(a.schema).option("header", True).csv(a.source_dir))
    return (raw.filter(a.keep).writeStream.format("parquet").outputMode("append").option("path", f"{a.root}/arrived")
            .option("checkpointLocation", f"{a.root}/_arrivals").trigger(availableNow=True).start())


def key_states(arrived: DataFrame, a: Arriving) -> DataFrame:
    """(key, n, duplicate, first): one state per non-NULL key of a batch or a stream."""
    row = F.struct(*[F.col(c) for c in a.row_columns])
    # the row is compared without its ingest time; the time of the row that stands for the key goes along
    timed = F.struct(row.alias("row"), F.col(INGEST_COLUMN).alias(INGEST_COLUMN))
    states = arrived.filter(F.col(a.key).isNotNull()).groupBy(a.key).agg(
        F.count(F.lit(1)).alias("n"), F.min(timed).alias("first"), F.max(row).alias("last"))
    different = ~F.col("first.row").eqNullSafe(F.col("last"))
    duplicate = different if a.distinct_rows else F.col("n") > 1
    return states.select(a.key, "n", duplicate.alias("duplicate"), "first")


def start_key_states(spark: SparkSession, a: Arriving) -> StreamingQuery:
    """Fold newly arrived rows into the key states and log the states that changed."""
    arrived = spark.readStream.schema(a.arrived_schema).parquet(f"{a.root}/arrived")

    def log(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{a.root}/changes/batch={batch_id}")

    writer = (key_states(arrived, a).writeStream.outputMode("update").foreachBatch(log)
              .option("checkpointLocation", f"{a.root}/_key_states").trigger(availableNow=True))
    before = spark.conf.get(STATE_CONF, None)
    spark.conf.set(STATE_CONF, STATE_PROVIDER)
    try:
        return writer.start()  # the query keeps the settings it was started with
    finally:
        spark.conf.unset(STATE_CONF) if before is None else spark.conf.set(STATE_CONF, before)


def take_in(spark: SparkSession, a: Arriving) -> None:
    """Process everything that has arrived: rows first, then the key states that follow from them."""
    for start in (start_arrivals, start_key_states):
        query = start(spark, a)
        query.awaitTermination()


def _compacted(spark: SparkSession, a: Arriving) -> int | None:
    """The last batch that a finished compaction covers."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{a.root}/compacted")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return None
    done = [s.getPath() for s in fs.listStatus(base)]
    return max((int(p.getName().split("=")[1]) for p in done
                if p.getName().startswith("upto=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))), default=None)


def _changes(spark: SparkSession, a: Arriving) -> DataFrame:
    """(key, n, duplicate, first, batch): the compacted states and every later change."""
    upto = _compacted(spark, a)
    later = spark.read.parquet(f"{a.root}/changes").withColumn("batch", F.col("batch").cast("long"))
    if upto is None:
        return later
    return spark.read.parquet(f"{a.root}/compacted/upto={upto}").unionByName(later.filter(F.col("batch") > upto))


def current_states(spark: SparkSession, a: Arriving) -> DataFrame:
    """(key, n, duplicate, first, batch): the latest state of every key."""
    latest = F.max(F.struct("batch", "n", "duplicate", "first")).alias("s")
    return _changes(spark, a).groupBy(a.key).agg(latest).select(a.key, "s.n", "s.duplicate", "s.first", "s.batch")


def compact(spark: SparkSession, a: Arriving) -> int:
    """Fold all changes so far into one row per key; returns the last batch covered."""
    states = current_states(spark, a)
    upto = _changes(spark, a).agg(F.max("batch")).first()[0]
    states.write.mode("overwrite").parquet(f"{a.root}/compacted/upto={upto}")
    return upto


def _columns(a: Arriving, value: Column) -> list[Column]:
    """The relation's columns in order from a state's row."""
    return [F.col(a.key) if f.name == a.key else value.getField("row").getField(f.name).alias(f.name) for f in a.schema.fields]


def split(spark: SparkSession, a: Arriving) -> Split:
    """(clean, bad) rows of everything taken in so far, with their ingest time."""
    states = current_states(spark, a)
    first = F.col("first")
    clean = states.filter("not duplicate").select(*_columns(a, first), first.getField(INGEST_COLUMN).alias(INGEST_COLUMN))
    arrived = spark.read.schema(a.arrived_schema).parquet(f"{a.root}/arrived").filter(F.col(a.key).isNotNull())
    bad = skew_join(arrived, states.filter("duplicate").select(a.key), a.key, "left_semi")
    if a.distinct_rows:
        bad = bad.groupBy(*[f.name for f in a.schema.fields]).agg(F.min(INGEST_COLUMN).alias(INGEST_COLUMN))
    return Split(clean, bad.select(*[f.name for f in a.schema.fields], INGEST_COLUMN))


def retractions(spark: SparkSession, a: Arriving) -> DataFrame:
    """(key, added, retracted): keys that were clean after some batch and were taken back by a later one.

    Batches before a compaction are known by its files no more.
    """
    sides = _changes(spark, a).groupBy(a.key).agg(F.min(F.when(~F.col("duplicate"), F.col("batch"))).alias("added"),
                                                  F.min(F.when(F.col("duplicate"), F.col("batch"))).alias("retracted"))
    return sides.filter("added is not null and retracted is not null")
