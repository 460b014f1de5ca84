"""Atomic publication of a run: all tables of a database switch in one catalog step.

A run writes below its own folder, ``root/runs/<run_id>``. Each published table
``db.t`` is a view over ``db.t_runs``, an external table partitioned by run whose
partitions lie in the runs' folders. The views read the partition that
``db.current_run`` names, a view of one literal: replacing that one view switches
all tables at once. The planner folds the literal into a static partition
filter, so a reader scans the files of one run and no other.

A run that fails leaves a folder, perhaps some partitions, and the readers
with the run before it. A query planned before a switch goes on reading its
run's files, which stay until ``expire`` drops them.

One publisher at a time: of two that commit, the later pointer counts.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.sources.catalog import create_database

RUN_COLUMN = "run_id"
POINTER = "current_run"


class Run:
    """One run's staged tables; invisible to readers until ``commit``."""

    def __init__(self, publication: Publication, run_id: str):
        self.publication, self.run_id = publication, run_id
        self.folder = f"{publication.root}/runs/{run_id}"
        self.staged: dict[str, tuple[T.StructType, str, str]] = {}

    def stage(self, name: str, schema: T.StructType, path: str, fmt: str = "csv") -> None:
        """Files of ``db.name`` in this run; they must lie below the run's folder."""
        if not path.startswith(f"{self.folder}/"):
            raise ValueError(f"{path} is not in this run's folder {self.folder}")
        self.staged[name] = (schema, path.rstrip("/"), fmt)

    def table(self, name: str) -> DataFrame:
        """A staged table, read by the run itself before it is published."""
        schema, path, fmt = self.staged[name]
        reader = self.publication.spark.read.schema(schema)
        return (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)

    def commit(self) -> None:
        """Register the staged partitions, then switch every table to this run in one step."""
        self.publication.publish(self)


class Publication:
    """The published tables of database ``db``, with their runs below ``root``."""

    def __init__(self, spark: SparkSession, db: str, root: str):
        self.spark, self.db, self.root = spark, db, root.rstrip("/")

    def begin(self, run_id: str | None = None) -> Run:
        run_id = run_id or f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id):
            raise ValueError("a run id has letters, digits, '.', '_' and '-' only")
        return Run(self, run_id)

    def current(self) -> str | None:
        """The run that readers see, or None before the first commit."""
        if not self.spark.catalog.tableExists(f"{self.db}.{POINTER}"):
            return None
        return self.spark.table(f"{self.db}.{POINTER}").first()[RUN_COLUMN]

    def _point(self, run_id: str | None) -> None:
        literal = f"'{run_id}'" if run_id else "CAST(NULL AS STRING)"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.db}.{POINTER} AS SELECT {literal} AS {RUN_COLUMN}")

    def _ensure(self, name: str, schema: T.StructType, fmt: str) -> None:
        """The partitioned table and the view of a name; both are made once."""
        runs = f"{self.db}.{name}_runs"
        options = " OPTIONS ('header' = 'true', 'inferSchema' = 'false')" if fmt == "csv" else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {runs} ({schemas.ddl_columns(schema)}, {RUN_COLUMN} STRING) "
                       f"USING {fmt}{options} PARTITIONED BY ({RUN_COLUMN}) LOCATION '{self.root}/tables/{name}'")
        columns = ", ".join(f"`{f.name}`" for f in schema.fields)
        self.spark.sql(f"CREATE VIEW IF NOT EXISTS {self.db}.{name} AS SELECT {columns} FROM {runs} "
                       f"WHERE {RUN_COLUMN} = (SELECT {RUN_COLUMN} FROM {self.db}.{POINTER})")

    def publish(self, run: Run) -> None:
        if not run.staged:
            raise ValueError("nothing is staged")
        create_database(self.spark, self.db)
        before = self.current()
        if before is None:
            self._point(None)
        for name, (schema, path, fmt) in run.staged.items():
            if not _exists(self.spark, f"{path}/_SUCCESS"):
                raise RuntimeError(f"{path} was not written to its end")
            self._ensure(name, schema, fmt)
            self.spark.sql(f"ALTER TABLE {self.db}.{name}_runs ADD IF NOT EXISTS "
                           f"PARTITION ({RUN_COLUMN} = '{run.run_id}') LOCATION '{path}'")
        self._point(run.run_id)

    def runs(self) -> list[str]:
        """Registered runs, oldest id first."""
        found: set[str] = set()
        for name in self._tables():
            found |= {r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.db}.{name}").collect()}
        return sorted(found)

    def _tables(self) -> list[str]:
        return [t.name for t in self.spark.catalog.listTables(self.db) if t.tableType != "VIEW" and t.name.endswith("_runs")]

    def rollback(self, run_id: str) -> None:
        """Switch every table back to a run that is still registered."""
        if run_id not in self.runs():
            raise ValueError(f"run {run_id} is not registered")
        self._point(run_id)

    def expire(self, keep: int = 2) -> list[str]:
        """Drop the partitions and folders of all but the current run and the ``keep`` - 1 newest others."""
        now = self.current()
        others = [r for r in self.runs() if r != now]
        old = others[:max(0, len(others) - (keep - 1))]
        for run_id in old:
            for name in self._tables():
                self.spark.sql(f"ALTER TABLE {self.db}.{name} DROP IF EXISTS PARTITION ({RUN_COLUMN} = '{run_id}')")
            _delete(self.spark, f"{self.root}/runs/{run_id}")
        return old


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def visible_rows(spark: SparkSession, db: str, names: list[str]) -> DataFrame:
    """(table_name, row_count) of the published tables as a reader sees them now."""
    counts = [spark.table(f"{db}.{n}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n in names]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out
