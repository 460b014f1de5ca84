"""Keys that a later file repeats are taken back from the clean side."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators.quality import split_unique
from ledgerline.session import scratch_path
from ledgerline.sources import files
from ledgerline.sources.fixtures import RAW_SCHEMAS, LendingInputs
from ledgerline.streaming import duplicates as du

SCHEMA = schemas._struct(id="string", x="float", t="string")


@pytest.fixture
def arriving(spark):
    root = scratch_path(spark, "arriving")
    return lambda **kw: du.Arriving(SCHEMA, "id", f"{root}/source/*", f"{root}/state", **kw)


def arrive(spark, a, part, rows):
    files.write_csv(spark.createDataFrame(rows, SCHEMA), f"{a.source_dir[:-2]}/{part}")
    du.take_in(spark, a)


def sides(spark, a):
    return tuple(sorted((tuple(r) for r in side.drop("ingest_date").collect()), key=str) for side in du.split(spark, a))


def test_a_later_file_retracts(spark, arriving):
    a = arriving()
    arrive(spark, a, "p0", [("k1", 1.0, "a"), ("k2", 2.0, "b"), (None, 3.0, "n"), ("k4", 4.0, "d"), ("k4", 4.0, "d")])
    assert sides(spark, a) == ([("k1", 1.0, "a"), ("k2", 2.0, "b")], [("k4", 4.0, "d")] * 2)
    arrive(spark, a, "p1", [("k2", 2.5, "later"), ("k3", None, "c")])
    assert sides(spark, a) == ([("k1", 1.0, "a"), ("k3", None, "c")],
                               [("k2", 2.0, "b"), ("k2", 2.5, "later")] + [("k4", 4.0, "d")] * 2)
    arrive(spark, a, "p2", [("k2", 2.0, "b"), ("k4", 9.0, "x")])
    assert [len(s) for s in sides(spark, a)] == [2, 6]
    assert [(r.id, r.added, r.retracted) for r in du.retractions(spark, a).collect()] == [("k2", 0, 1)]


def test_equal_rows_count_once_where_asked(spark, arriving):
    a = arriving(distinct_rows=True, keep="x is not null")
    arrive(spark, a, "p0", [("k1", 1.0, "a"), ("k1", 1.0, "a"), ("k2", None, "no part")])
    arrive(spark, a, "p1", [("k1", 1.0, "a"), ("k2", 2.0, "b")])
    assert sides(spark, a) == ([("k1", 1.0, "a"), ("k2", 2.0, "b")], [])
    arrive(spark, a, "p2", [("k1", 1.0, None), ("k2", 2.0, "b")])
    assert sides(spark, a) == ([("k2", 2.0, "b")], [("k1", 1.0, "a"), ("k1", 1.0, None)])


def test_nothing_new_changes_nothing(spark, arriving):
    a = arriving()
    arrive(spark, a, "p0", [("k1", 1.0, "a"), ("k2", 2.0, "b")])
    before = sides(spark, a)
    du.take_in(spark, a)
    assert sides(spark, a) == before


def test_compaction_and_a_repeated_batch(spark, arriving):
    a = arriving()
    arrive(spark, a, "p0", [("k1", 1.0, "a"), ("k2", 2.0, "b")])
    arrive(spark, a, "p1", [("k2", 2.5, "c")])
    before = sides(spark, a)
    assert du.compact(spark, a) == 1
    assert sides(spark, a) == before
    arrive(spark, a, "p2", [("k1", 1.5, "d"), ("k3", 3.0, "e")])
    assert sides(spark, a)[0] == [("k3", 3.0, "e")]
    # a batch that runs again writes the same folder: states are not counted twice
    changed = spark.read.parquet(f"{a.root}/changes/batch=2")
    rows = [tuple(r) for r in changed.collect()]
    spark.createDataFrame(rows, changed.schema).write.mode("overwrite").parquet(f"{a.root}/changes/batch=2")
    assert sides(spark, a)[0] == [("k3", 3.0, "e")]
    # an unfinished compaction is not read
    spark.createDataFrame([], du.current_states(spark, a).schema).write.parquet(f"{a.root}/compacted/upto=9")
    jvm = spark.sparkContext._jvm
    success = jvm.org.apache.hadoop.fs.Path(f"{a.root}/compacted/upto=9/_SUCCESS")
    success.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(success, False)
    assert sides(spark, a)[0] == [("k3", 3.0, "e")]


def test_states_fold_before_the_shuffle(spark, arriving):
    """Rows of a hot key are combined where they are read."""
    a = arriving()
    batch = spark.createDataFrame([], a.arrived_schema)
    plan = du.key_states(batch, a)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_min" in plan and plan.index("partial_count") > plan.index("Exchange"), plan


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_arrivals_in_any_order_give_the_batch_split(spark, size):
    raw = LendingInputs(spark, f"/root/testdata/sf{size}").raw("delinquencies", ingest=False)
    want = split_unique(raw, "member_id")
    root = scratch_path(spark, "order")
    a = du.Arriving(RAW_SCHEMAS["delinquencies"], "member_id", f"{root}/source/*", f"{root}/state")
    for i, part in enumerate(raw.randomSplit([1.0, 2.0, 0.5], seed=3)):
        files.write_csv(part, f"{root}/source/p{i}", keep_whitespace=True)
        du.take_in(spark, a)
    got = du.split(spark, a)
    for mine, theirs in ((got.clean, want.clean), (got.bad, want.bad)):
        assert Counter(map(tuple, mine.drop("ingest_date").collect())) == Counter(map(tuple, theirs.collect()))
    assert got.clean.agg(F.count("ingest_date")).first()[0] == want.clean.count()
