"""End-to-end batch job over raw CSV files."""

import threading
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import queries as Q
from ledgerline.plans.batch import BatchPaths, run_batch
from ledgerline.session import scratch_path
from ledgerline.sources import files
from ledgerline.sources.fixtures import LendingInputs


def test_batch_job_matches_query(spark, sf_dir):
    inputs = LendingInputs(spark, sf_dir)
    raw = {}
    for name in ("customers", "loans", "repayments", "delinquencies"):
        raw[name] = scratch_path(spark, f"raw_{name}")
        files.write_csv(inputs.raw(name, ingest=False), raw[name], keep_whitespace=True)
    db = f"lending_{uuid.uuid4().hex[:8]}"
    out = run_batch(spark, BatchPaths(raw["customers"], raw["loans"], raw["repayments"],
                                      raw["delinquencies"], scratch_path(spark, "out"), db=db,
                                      write_parquet_score=True))
    assert set(out) >= {"customers", "customers_bad_data", "loans", "repayments", "delinquencies",
                        "delinquencies_bad_data", "delinquencies_public_records", "credit_score"}
    assert spark.table(f"{db}.loans").count() == Q.clean_loans(spark, sf_dir).count()
    cols = ["payment_history_pts", "defaulters_history_pts", "financial_health_pts", "credit_score", "n_rows"]
    written = spark.read.parquet(out["credit_score_parquet"])
    got = Counter(tuple(r) for r in written.select("member_id", *[F.col(c).cast("double") for c in cols]).collect())
    want = Counter(tuple(r) for r in Q.credit_score(spark, sf_dir).select("member_id", *cols).collect())
    assert got == want and sum(r[-1] for r in got) == 10107


def test_score_is_computed_once_for_csv_and_parquet(spark, sf_dir, monkeypatch):
    inputs = LendingInputs(spark, sf_dir)
    raw, csv_plans = {}, {}
    for name in ("customers", "loans", "repayments", "delinquencies"):
        raw[name] = scratch_path(spark, f"raw_{name}")
        files.write_csv(inputs.raw(name, ingest=False), raw[name], keep_whitespace=True)
    write = files.write_csv

    def seen(df, path, *args, **kwargs):
        csv_plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().optimizedPlan().toString()
        write(df, path, *args, **kwargs)
    monkeypatch.setattr(files, "write_csv", seen)
    out = run_batch(spark, BatchPaths(out_root=scratch_path(spark, "out"), db=f"lending_{uuid.uuid4().hex[:8]}",
                                      write_parquet_score=True, **raw))
    assert "Join" not in csv_plans["credit_score"] and "parquet" in csv_plans["credit_score"]
    copy = spark.read.parquet(out["credit_score_parquet"])
    text = spark.read.csv(out["credit_score"], header=True, schema=copy.schema)
    assert copy.exceptAll(text).count() == text.exceptAll(copy).count() == 0 < copy.count()


def test_writes_run_side_by_side(spark):
    met = threading.Barrier(2, timeout=60)
    spark.sparkContext.setLocalProperty("ledgerline.test", "submitter")
    told = []
    try:
        with files.Writes(spark) as writes:
            for _ in range(2):  # each waits for the other
                writes.submit(lambda: (met.wait(), told.append(spark.sparkContext.getLocalProperty("ledgerline.test"))))
    finally:
        spark.sparkContext.setLocalProperty("ledgerline.test", None)
    assert told == ["submitter"] * 2
    with pytest.raises(ZeroDivisionError):
        with files.Writes(spark) as writes:
            writes.submit(lambda: 1 / 0)


def test_bucketed_tables_join_without_shuffle(spark, sf_dir):
    from ledgerline.operators import score
    inputs = LendingInputs(spark, sf_dir)
    raw = {}
    for name in ("customers", "loans", "repayments", "delinquencies"):
        raw[name] = scratch_path(spark, f"raw_{name}")
        files.write_csv(inputs.raw(name, ingest=False), raw[name], keep_whitespace=True)
    db = f"lending_bucketed_{uuid.uuid4().hex[:8]}"
    run_batch(spark, BatchPaths(raw["customers"], raw["loans"], raw["repayments"], raw["delinquencies"],
                                scratch_path(spark, "out"), db=db, table_buckets=8))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = score.payment_points(spark.table(f"{db}.repayments"), spark.table(f"{db}.loans"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert j.count() == Q.payment_history_points(spark, sf_dir).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_command_line_entry(spark, sf_dir, capsys):
    from ledgerline.plans.batch import main
    inputs = LendingInputs(spark, sf_dir)
    raw = []
    for name in ("customers", "loans", "repayments", "delinquencies"):
        raw.append(scratch_path(spark, f"raw_{name}"))
        files.write_csv(inputs.raw(name, ingest=False), raw[-1], keep_whitespace=True)
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        main([*raw, scratch_path(spark, "cli_out"), f"cli_{uuid.uuid4().hex[:8]}", "--buckets", "4"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    scores = spark.read.csv(printed["credit_score"], header=True)
    assert scores.agg(F.sum("n_rows")).first()[0] == 10107
