"""Malformed CSV rows are told apart, with their reasons, in one scan."""

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.plans.batch import BatchPaths, run_batch
from ledgerline.session import scratch_path
from ledgerline.sources import files, malformed
from ledgerline.sources.fixtures import RAW_SCHEMAS, LendingInputs, malformed_lines

SCHEMA = schemas._struct(id="string", amount="float", n="integer", note="string")
LINES = ["a,1.5,2,fine", "b,oops,2,one", "c,oops,2.0,two", "d,1.5,2,long,extra,more", "e,1.5,2", "f,x,2", "g,,,",
         '"h","1,5",3,"quoted, text"', "i,NaN,7,nan is a float", ",,,", "", "j,1.5,99999999999,too large"]


@pytest.fixture(scope="module")
def checked(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(path)
    return malformed.read_checked(spark, path, SCHEMA, header=False)


def reasons(df):
    return {r.id: [tuple(x) for x in r._reasons] for r in df.select("id", malformed.REASONS).collect() if r._reasons}


EXPECTED = {"b": [("amount", "oops", "FLOAT")], "c": [("amount", "oops", "FLOAT"), ("n", "2.0", "INT")],
            "d": [(None, "extra", "too many cells")], "e": [(None, None, "too few cells")], "f": [("amount", "x", "FLOAT")],
            "h": [("amount", "1,5", "FLOAT")], "j": [("n", "99999999999", "INT")]}


def test_reasons(checked):
    assert reasons(checked) == EXPECTED


def test_reasons_do_not_depend_on_the_columns_selected(checked):
    """A scan parses only what a query needs; a filter on good rows needs everything."""
    good = [r.id for r in checked.filter(~malformed.is_malformed()).select("id").collect()]
    assert sorted(map(str, good)) == ["None", "a", "g", "i"]
    assert checked.filter(malformed.is_malformed()).select("note").count() == len(EXPECTED)


def test_divert_scans_once_and_keeps_every_row(spark, checked):
    sides = malformed.divert(checked, scratch_path(spark, "staged"))
    assert sides.good.columns == [f.name for f in SCHEMA.fields] + ["ingest_date"]
    assert sides.good.count() + sides.bad.count() == checked.count() == 11  # a blank line is no row
    assert reasons(sides.bad) == EXPECTED
    cells = malformed.malformed_cells(sides.bad, "id")
    assert cells.columns == ["id", "column", "cell", "expected", "record"]
    assert {r.record for r in cells.filter("id = 'd'").collect()} == {"d,1.5,2,long,extra,more"}
    counts = {(r["column"], r.expected): r.n for r in malformed.malformed_counts(sides.bad, "x").collect()}
    assert counts == {("amount", "FLOAT"): 4, ("n", "INT"): 2, (None, "too many cells"): 1, (None, "too few cells"): 1}
    # both sides come from the staged files, not from the CSV scan
    assert "FileScan csv" not in sides.good._jdf.queryExecution().executedPlan().toString()


def test_good_rows_are_those_of_a_plain_read(spark, checked):
    path = scratch_path(spark, "good")
    good = [x for x in LINES if x.split(",")[0] in ("a", "g", "i")]
    spark.createDataFrame([(x,) for x in good], "value string").write.text(path)
    plain = spark.read.csv(path, schema=SCHEMA)
    got = checked.filter(~malformed.is_malformed() & F.col("id").isNotNull()).drop("ingest_date", "_corrupt_record", "_reasons")
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_empty_file(spark):
    path = scratch_path(spark, "none")
    spark.createDataFrame([], "value string").write.text(path)
    sides = malformed.divert(malformed.read_checked(spark, path, SCHEMA, header=False), scratch_path(spark, "none_staged"))
    assert sides.good.count() == sides.bad.count() == 0


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_corrupt_count_equals_diverted_rows(spark, size):
    inputs = LendingInputs(spark, f"/root/testdata/sf{size}")
    for name, schema in RAW_SCHEMAS.items():
        raw = inputs.raw(name, ingest=False)
        path = scratch_path(spark, f"raw_{name}")
        malformed_lines(raw, name).write.text(path)
        sides = malformed.divert(malformed.read_checked(spark, path, schema, header=False), scratch_path(spark, f"staged_{name}"))
        n = files.corrupt_row_count(spark, path, schema, header=False).first()[0]
        assert n == sides.bad.count() > 0 and n + sides.good.count() == raw.count()


def test_batch_diverts_malformed_rows(spark, sf_dir):
    inputs = LendingInputs(spark, sf_dir)
    raw = {}
    for name in RAW_SCHEMAS:
        rows = inputs.raw(name, ingest=False)
        raw[name] = scratch_path(spark, f"raw_{name}")
        header = spark.createDataFrame([(",".join(rows.columns),)], "value string")
        lines = malformed_lines(rows, name)
        header.unionAll(lines).coalesce(1).write.text(raw[name])  # one file, its header first
    root = scratch_path(spark, "out")
    out = run_batch(spark, BatchPaths(out_root=root, db=f"lending_{root.split('/')[-2][:8]}", malformed="divert", **raw))
    for name in RAW_SCHEMAS:
        cells = spark.read.csv(out[f"{name}_malformed"], header=True)
        assert cells.count() > 0 and cells.filter("record is null").count() == 0
    # loans with a malformed amount are not among the cleaned ones
    bad = spark.read.csv(out["loans_malformed"], header=True).select(F.split("record", ",")[0].alias("loan_id"))
    assert spark.read.csv(out["loans"], header=True).join(bad, "loan_id").count() == 0
    with pytest.raises(ValueError):
        run_batch(spark, BatchPaths(out_root=root, malformed="drop", **raw))
