"""Session construction and shared scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Adaptive execution re-plans joins from
# runtime sizes (broadcast only what it measured to be small), splits skewed
# sort-merge partitions and coalesces tiny shuffle outputs.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the adaptive settings applied.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    number of shuffle partitions should then come from the cluster config.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ADAPTIVE_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Uses the folder the cluster names in ``spark.checkpoint.dir`` (or the
    checkpoint folder set on the context). Where neither is set, a ``local``
    master, whose tasks all run on this machine, gets a private folder; any
    other master is refused, because a folder made here would be missing on
    its executors.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared folder."""
    root = shared_dir(spark)
    return "/".join([root, "ledgerline", uuid.uuid4().hex, *parts])


def default_parallelism(spark: SparkSession) -> int:
    """Partition count of shuffles in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


TARGET_PARTITION_BYTES = 256 * 1024 * 1024
#: A shuffle has partitions times map tasks blocks to fetch; beyond this count they cost more than larger partitions do.
MAX_SHUFFLE_PARTITIONS = 20_000


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(hconf).getContentSummary(path).getLength()
    return total


def size_shuffle_partitions(spark: SparkSession, paths: list[str],
                            target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Set ``spark.sql.shuffle.partitions`` so one shuffle partition of the
    input volume is about ``target_bytes`` (never below the current value, and
    raised to ``MAX_SHUFFLE_PARTITIONS`` at most: sorts and joins spill).

    Adaptive execution coalesces partitions that turn out small and splits
    skewed ones; starting from a count that scales with the input keeps every
    partition within executor memory at any size. Returns the count set.
    """
    current = default_parallelism(spark)
    wanted = max(current, min(MAX_SHUFFLE_PARTITIONS, -(-input_bytes(spark, paths) // target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_bytes, 128 * 1024 * 1024)))
    return wanted
