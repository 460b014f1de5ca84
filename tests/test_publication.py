"""All tables of a run become visible in one step, or none."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.plans.batch import BatchPaths, run_batch
from ledgerline.session import scratch_path
from ledgerline.sources import files
from ledgerline.sources.fixtures import RAW_SCHEMAS, LendingInputs
from ledgerline.sources.publication import Publication, visible_rows

A, B = schemas._struct(k="integer", v="string"), schemas._struct(k="integer")


@pytest.fixture
def publication(spark):
    db = f"atomic_{uuid.uuid4().hex[:8]}"
    return Publication(spark, db, scratch_path(spark, db))


def write(spark, run, n, names=("a", "b")):
    for name in names:
        path = f"{run.folder}/{name}"
        df = spark.range(n).select(F.col("id").cast("int").alias("k"), F.lit(run.run_id).alias("v"))
        files.write_csv(df if name == "a" else df.select("k"), path)
        run.stage(name, A if name == "a" else B, path)


def seen(publication):
    rows = visible_rows(publication.spark, publication.db, ["a", "b"]).collect()
    return {r.table_name: r.row_count for r in rows}


def test_switch_is_for_all_tables_at_once(spark, publication):
    assert publication.current() is None
    first = publication.begin("r1")
    write(spark, first, 3)
    assert first.table("a").count() == 3 and publication.current() is None
    first.commit()
    assert seen(publication) == {"a": 3, "b": 3} and publication.current() == "r1"
    planned = spark.table(f"{publication.db}.a")
    second = publication.begin("r2")
    write(spark, second, 5)
    assert seen(publication) == {"a": 3, "b": 3}
    second.commit()
    assert seen(publication) == {"a": 5, "b": 5}
    assert planned.count() == 3  # planned before the switch: its run's files
    publication.rollback("r1")
    assert seen(publication) == {"a": 3, "b": 3}
    with pytest.raises(ValueError):
        publication.rollback("r7")


@pytest.mark.parametrize("failure", ["unwritten sink", "between catalog steps"])
def test_failed_run_changes_nothing(spark, publication, failure, monkeypatch):
    run = publication.begin("good")
    write(spark, run, 4)
    run.commit()
    bad = publication.begin("bad")
    write(spark, bad, 9, names=("a",))
    if failure == "unwritten sink":
        bad.stage("b", B, f"{bad.folder}/b")
    else:
        write(spark, bad, 9, names=("b",))

        def stop(run_id):
            raise RuntimeError("lost the catalog")
        monkeypatch.setattr(publication, "_point", stop)
    with pytest.raises(RuntimeError):
        bad.commit()
    monkeypatch.undo()
    assert seen(publication) == {"a": 4, "b": 4} and publication.current() == "good"
    again = publication.begin("bad")  # the same run may be tried again
    write(spark, again, 2)
    again.commit()
    assert seen(publication) == {"a": 2, "b": 2}


def test_readers_scan_one_run(spark, publication):
    for i in range(4):
        run = publication.begin(f"r{i}")
        write(spark, run, i + 1)
        run.commit()
    df = spark.table(f"{publication.db}.a")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "Join" not in plan, plan
    assert {f.split("/runs/")[1].split("/")[0] for f in df.inputFiles()} == {"r3"}


def test_expire_keeps_the_current_run(spark, publication):
    for i in range(4):
        run = publication.begin(f"r{i}")
        write(spark, run, i + 1)
        run.commit()
    publication.rollback("r1")
    assert publication.expire(keep=2) == ["r0", "r2"]
    assert publication.runs() == ["r1", "r3"] and seen(publication) == {"a": 2, "b": 2}
    publication.rollback("r3")
    assert seen(publication) == {"a": 4, "b": 4}


def test_misuse(spark, publication):
    run = publication.begin()
    with pytest.raises(ValueError):
        run.commit()
    with pytest.raises(ValueError):
        run.stage("a", A, "/elsewhere/a")
    with pytest.raises(ValueError):
        publication.begin("a' b")


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_atomic_batch_equals_plain_batch(spark, size):
    inputs = LendingInputs(spark, f"/root/testdata/sf{size}")
    raw = {name: scratch_path(spark, f"raw_{name}") for name in RAW_SCHEMAS}
    for name, path in raw.items():
        files.write_csv(inputs.raw(name, ingest=False), path, keep_whitespace=True)
    dbs = {atomic: f"lending_{uuid.uuid4().hex[:8]}" for atomic in (True, False)}
    for atomic, db in dbs.items():
        run_batch(spark, BatchPaths(out_root=scratch_path(spark, db), db=db, atomic=atomic, ingest_ts="2024-01-02 03:04:05", **raw))
    for name in [*schemas.PUBLISHED, "customers_loan_v"]:
        a, b = (spark.table(f"{db}.{name}") for db in dbs.values())
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert spark.table(f"{dbs[True]}.credit_score").count() > 0
    with pytest.raises(ValueError):
        run_batch(spark, BatchPaths(out_root="x", atomic=True, table_buckets=4, **raw))


def test_outputs_of_a_run_are_written_side_by_side(spark, sf_dir, monkeypatch):
    """Two outputs that wait for each other are written; one that fails keeps the whole run from readers."""
    inputs = LendingInputs(spark, sf_dir)
    raw = {name: scratch_path(spark, f"raw_{name}") for name in RAW_SCHEMAS}
    for name, path in raw.items():
        files.write_csv(inputs.raw(name, ingest=False), path, keep_whitespace=True)
    db = f"lending_{uuid.uuid4().hex[:8]}"
    paths = BatchPaths(out_root=scratch_path(spark, db), db=db, atomic=True, **raw)
    write, met, broken = files.write_csv, threading.Barrier(2, timeout=60), []

    def watched(df, path, *args, **kwargs):
        if path.endswith(("/cleaned/loans", "/cleaned/repayments")):
            met.wait()
        if any(path.endswith(name) for name in broken):
            raise OSError("disk full")
        write(df, path, *args, **kwargs)
    monkeypatch.setattr(files, "write_csv", watched)
    run_batch(spark, paths)
    first = Publication(spark, db, paths.out_root).current()
    broken.append("/cleaned/repayments")
    with pytest.raises(OSError):
        run_batch(spark, paths)
    assert Publication(spark, db, paths.out_root).current() == first is not None
