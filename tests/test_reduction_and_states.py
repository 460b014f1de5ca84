"""Bloom reduction, mergeable profile states, observed profiles, mart refresh, catalog statistics."""

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import bloom, mart_refresh, observe, sketches
from ledgerline.operators.clean import CleanTables
from ledgerline.plans import queries as Q
from ledgerline.session import scratch_path
from ledgerline.sources import catalog, statistics
from ledgerline.sources.fixtures import LendingInputs

SIZES = ["0.001", "0.01"]


def tables(spark, size):
    inputs = LendingInputs(spark, f"/root/testdata/sf{size}")
    t = CleanTables(lambda name: inputs.raw(name, ingest=False))
    return {"customers": t.customers, "loans": t.loans, "repayments": t.repayments, "delinquencies": t.delinquencies,
            "delinquencies_public_records": t.public_records}


# -------------------------------------------------------------------- Bloom
@pytest.mark.parametrize("n,words", [(20_000, 1 << 12), (200_000, 1 << 15)])
def test_filter_passes_all_keys_and_few_others(spark, n, words):
    keys = spark.range(n).select(F.concat(F.lit("m"), "id").alias("k")).unionAll(spark.range(1).select(F.lit(None).alias("k")))
    inside = bloom.reduce_by(keys, keys, "k", words)
    assert inside.count() == n  # the NULL key does not pass
    others = spark.range(n).select(F.concat(F.lit("x"), "id").alias("k"))
    passed = bloom.reduce_by(others, keys, "k", words).count()
    bits_a_key = 64 * words / n
    assert passed / n < (0.06 if bits_a_key > 10 else 0.2), (passed, bits_a_key)
    assert bloom.key_filter(keys, "k", words).count() <= words


def test_empty_and_overfull_filters(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"))
    assert bloom.reduce_by(rows, rows.limit(0), "k").count() == 0
    assert bloom.reduce_by(rows, rows.filter("k < 4000"), "k", 4).filter("k < 4000").count() == 4000
    with pytest.raises(ValueError):
        spark.conf.set(bloom.WORDS_CONF, "0")
        try:
            bloom.filter_words(rows)
        finally:
            spark.conf.unset(bloom.WORDS_CONF)


def test_loans_are_reduced_before_their_shuffle(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Q.severe_delinquency_scores(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    probe = next(i for i, x in enumerate(lines) if "BroadcastHashJoin" in x and "_word" in x and "LeftSemi" in x)
    above = next(i for i in range(probe, 0, -1) if "Exchange hashpartitioning(loan_id" in lines[i])
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    assert depth(lines[above]) < depth(lines[probe])  # the probe lies below the exchange on loan_id


@pytest.mark.parametrize("size", SIZES)
def test_few_loans_reach_the_join_where_few_members_are_late(spark, size):
    t = tables(spark, size)
    severe = t["delinquencies"].filter("delinq_2yrs >= 6")
    exact = t["loans"].join(severe, "member_id", "left_semi").count()
    kept = bloom.reduce_by(t["loans"], severe, "member_id").count()
    assert 0 < exact <= kept <= exact + 0.06 * t["loans"].count()
    assert kept < 0.5 * t["loans"].count()


# ------------------------------------------------------------------- states
@pytest.mark.parametrize("size", SIZES)
def test_distinct_states_merge(spark, size):
    loans = tables(spark, size)["loans"]
    states = sketches.distinct_states(loans, "issue_date", ["member_id", "loan_id"])
    merged = {r.column: r.estimate for r in sketches.distinct_counts(states).collect()}
    for c, n in merged.items():
        exact = loans.select(c).distinct().count()
        assert abs(n - exact) <= sketches.ERROR * exact + 1
    middle = loans.approxQuantile("loan_amount", [0.5], 0)[0]
    halves = sketches.distinct_states(loans.withColumn("half", F.col("loan_amount") < middle), "half", ["loan_id"])
    one = sketches.distinct_counts(halves.filter("half")).first().estimate
    assert 0 < one < merged["loan_id"]


@pytest.mark.parametrize("size", SIZES)
def test_frequent_states_merge_within_the_error(spark, size):
    loans = tables(spark, size)["loans"].withColumn("part", F.spark_partition_id() + F.length("loan_id"))
    exact = {r[0]: r[1] for r in loans.groupBy("member_id").count().collect()}
    got = sketches.frequent_items(sketches.frequent_states(loans, "part", "member_id"), 20).collect()
    assert len(got) == 20 and all(r.n == exact[r.item] and r.max_error == 0 for r in got)
    assert sorted((r.n for r in got), reverse=True) == sorted(exact.values(), reverse=True)[:20]
    # with few tracked items counts are off by at most the stated error, and hot items are found
    hot = loans.select(F.when(F.col("loan_id").endswith("1") | F.col("loan_id").endswith("2"), "hot").otherwise(F.col("loan_id")).alias("x"), "part")
    rows = hot.count()
    true = hot.filter("x = 'hot'").count()
    small = sketches.frequent_items(sketches.frequent_states(hot, "part", "x", 64), 1, 64).first()
    assert small.item == "hot" and abs(small.n - true) <= small.max_error <= 3.5 * rows / 64 + 1


# ----------------------------------------------------------------- observed
def test_profiles_are_observed_by_the_write(spark, sf_dir):
    loans = LendingInputs(spark, sf_dir).raw("loans", ingest=False)
    seen = observe.observe(loans, "loans", {"small": F.col("funded_amount") < 5000, "null": F.col("loan_amount") > 10**9})
    seen.rows.write.parquet(scratch_path(spark, "observed"))
    got = {r.metric: r.n for r in observe.profile_rows(spark, [seen]).collect()}
    assert got == {"rows": loans.count(), "small": loans.filter("funded_amount < 5000").count(), "null": 0}
    with pytest.raises(ValueError):
        observe.observe(loans, "loans", {"rows": F.lit(True)})


# ------------------------------------------------------------- mart refresh
def stamp(spark, path):
    """Modification times of the mart's partition files."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for folder in fs.listStatus(base):
        name = folder.getPath().getName()
        if name.startswith(mart_refresh.PART):
            found[int(name.split("=")[1])] = sorted(f.getPath().getName() for f in fs.listStatus(folder.getPath()))
    return found


@pytest.mark.parametrize("size", SIZES)
def test_refresh_rewrites_touched_parts_only(spark, size):
    now = tables(spark, size)
    gone = now["customers"].orderBy("member_id").limit(1).select("member_id")
    path = scratch_path(spark, "mart")
    mart_refresh.build(now, path, 16)
    before = stamp(spark, path)
    later = now | {"customers": now["customers"].join(gone, "member_id", "left_anti")}
    touched = mart_refresh.refresh(spark, later, gone, path, 16)
    after = stamp(spark, path)
    assert len(touched) == 1
    assert {p for p in before if before[p] != after.get(p)} == set(touched)
    want = scratch_path(spark, "whole")
    mart_refresh.build(later, want, 16)
    a, b = mart_refresh.read(spark, path), mart_refresh.read(spark, want)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 < a.count()
    assert mart_refresh.refresh(spark, later, gone.limit(0), path, 16) == []


def test_refresh_removes_parts_left_empty(spark, sf_dir):
    now = tables(spark, "0.001")
    parts = 4096  # about one member each
    path = scratch_path(spark, "mart")
    mart_refresh.build(now, path, parts)
    rare = now["customers"].groupBy(mart_refresh.member_part(F.col("member_id"), parts).alias("p")).agg(
        F.count("*").alias("n"), F.min("member_id").alias("member_id")).filter("n = 1").select("member_id").limit(1)
    rare = spark.createDataFrame(rare.collect(), "member_id string")
    later = now | {"customers": now["customers"].join(rare, "member_id", "left_anti")}
    mart_refresh.refresh(spark, later, rare, path, parts)
    assert mart_refresh.read(spark, path).join(rare, "member_id").count() == 0


# --------------------------------------------------------------- statistics
def test_join_sides_follow_statistics(spark):
    """A wide CSV table is broadcast once the catalog knows how small its kept columns are."""
    db = f"stats_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, "wide")
    wide = spark.range(3000).select(F.col("id").cast("string").alias("member_id"), F.lit(7).alias("delinq_2yrs"),
                                    F.repeat(F.lit("x"), 500).alias("padding"))
    wide.write.option("header", True).csv(path)
    other = scratch_path(spark, "big")
    spark.range(200_000).select(F.col("id").cast("string").alias("member_id"), F.col("id").cast("string").alias("loan_id")).write.option(
        "header", True).csv(other)
    catalog.create_database(spark, db)
    catalog.create_external_table(spark, f"{db}.wide", schemas._struct(member_id="string", delinq_2yrs="integer", padding="string"), path)
    catalog.create_external_table(spark, f"{db}.big", schemas._struct(member_id="string", loan_id="string"), other)
    keys = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": str(200_000), "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    plan = lambda: spark.table(f"{db}.big").join(spark.table(f"{db}.wide").select("member_id", "delinq_2yrs"), "member_id")._jdf.queryExecution().executedPlan().toString()  # noqa: E731,E501
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert "SortMergeJoin" in plan()
        statistics.analyze(spark, db, {"wide": ["member_id", "delinq_2yrs"], "big": ["member_id"]})
        assert "BroadcastHashJoin" in plan() and "BuildRight" in plan()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert statistics.row_counts(spark, db, ["wide", "big"]) == {"wide": 3000, "big": 200_000}
    found = {r.column_name: r for r in statistics.column_statistics(spark, db, {"wide": ["member_id", "delinq_2yrs"]}).collect()}
    assert found["delinq_2yrs"].distinct_estimate == 1 and abs(found["member_id"].distinct_estimate - 3000) < 300
