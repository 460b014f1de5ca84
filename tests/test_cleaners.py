"""Cleaner semantics on literal rows, including the reference traps."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException  # noqa: F401

from ledgerline import schemas
from ledgerline.operators import clean
from ledgerline.operators.quality import drop_missing, impute_floor_mean, split_unique, unique_rows


def test_split_unique_null_keys_in_neither(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    good, bad = split_unique(df, "k")
    assert sorted(r.v for r in good.collect()) == [3]
    assert sorted(r.v for r in bad.collect()) == [1, 2]


def test_split_unique_hot_key(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(8)
    good, bad = split_unique(df, "k")
    assert good.count() == 6000 and bad.count() == 3000
    # columns and order of the input are kept
    assert good.columns == ["k", "v"]


ODD = "k string, `a.b` string, n int, d date, s struct<x: int>, _rows long"


def test_unique_rows_whole_or_by_column(spark):
    """Both ways give the same rows, whatever the types and names of the columns."""
    rows = [("a", "x", 1, None, (1,), 5), ("b", None, None, None, None, None), ("c", "y", 2, None, (2,), 6), ("c", "y", 2, None, (2,), 6),
            (None, "z", 3, None, (3,), 7), ("", "", 0, None, (None,), 0)]
    df = spark.createDataFrame(rows, ODD).drop("_rows")
    got = [unique_rows(df, "k", whole) for whole in (False, True)]
    want = sorted(tuple(r)[:5] for r in rows if r[0] in ("a", "b", ""))
    for out in got:
        assert out.schema.names == df.schema.names
        assert sorted((r[0], r[1], r[2], r[3], None if r[4] is None else tuple(r[4])) for r in out.collect()) == want
    assert unique_rows(df.select("k"), "k", True).count() == 3
    assert unique_rows(df.limit(0), "k", True).count() == 0


@pytest.mark.parametrize("most_bytes", [None, 0])
def test_materialised_split_by_repeated_keys(spark, monkeypatch, most_bytes):
    """Few repeated keys: no row of either side is shuffled; many: a salted join. Both as without a cut."""
    from ledgerline.operators import quality
    if most_bytes is not None:
        monkeypatch.setattr(quality, "BROADCAST_BYTES", most_bytes)
    hot = [(float(i), "hot", f"h{i}") for i in range(40)]
    df = spark.createDataFrame([(1.0, "a", "x"), (2.0, "b", None), (2.0, "b", None), (None, None, "n"), (3.0, "c", "")] + hot,
                               "v double, k string, t string")
    old = spark.conf.get("spark.ledgerline.rowsPerTask", None)
    spark.conf.set("spark.ledgerline.rowsPerTask", "7")
    try:
        got = split_unique(df, "k", lambda d: d.checkpoint())
        for side, want in zip(got, split_unique(df, "k")):
            assert side.columns == df.columns
            assert sorted(map(str, side.collect())) == sorted(map(str, want.collect()))
            if most_bytes is None:
                assert "Exchange hashpartitioning" not in side._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.ledgerline.rowsPerTask") if old is None else spark.conf.set("spark.ledgerline.rowsPerTask", old)


def test_unique_rows_plans(spark, tmp_path):
    """By column: unused columns are not read. Whole: texts are one aggregate value; without texts groups are hashed."""
    spark.createDataFrame([("a", "x", "y", 1.0)], "k string, t string, u string, f float").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))

    def plan(out):
        return out._jdf.queryExecution().executedPlan().toString()

    scan = next(line for line in plan(unique_rows(df, "k").select("k", "t")).splitlines() if "FileScan" in line)
    assert "struct<k:string,t:string>" in scan
    whole = plan(unique_rows(df, "k", True))
    assert whole.count("first(struct(") == 2 and "first(t" not in whole  # partial and final
    assert "SortAggregate" not in plan(unique_rows(df.select("k", "f"), "k", True))


def test_drop_missing_drops_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x float")
    assert drop_missing(df, ["x"]).count() == 1


def test_impute_floor_mean(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "e int")
    got = sorted(r.e for r in impute_floor_mean(df, "e").collect())
    assert got == [1, 1, 2]
    assert impute_floor_mean(df, "e").schema["e"].dataType.simpleString() == "int"


def test_impute_without_values_fails(spark):
    df = spark.createDataFrame([(None,), (None,)], "e int")
    with pytest.raises(Exception):
        impute_floor_mean(df, "e").collect()


def _raw_customers(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_CUSTOMERS)


def _cust(mid, emp, income, state="CA"):
    return (mid, "t", emp, "RENT", income, state, "100xx", "US", "A", "A1", "Verified",
            1000, "Individual", None, None)


def test_clean_customers_modes(spark):
    rows = [_cust("m1", "5 years", "100", "California"), _cust("m1", "5 years", "100", "California"),
            _cust("m2", None, "200"), _cust("m3", "2 years", "300"), _cust("m3", "2 years", "301"),
            _cust("m4", "1 year", None), _cust("m4", "9 years", "400")]
    raw = _raw_customers(spark, rows)
    ref_clean, ref_bad = clean.clean_customers(raw, "reference")
    got = {r.member_id: (r.emp_length, r.address_state) for r in ref_clean.collect()}
    # exact duplicate survives once, NULL income row does not make m4 a duplicate,
    # reference mode keeps the unimputed emp_length and the long state name
    assert got == {"m1": (5, "California"), "m2": (None, "CA"), "m4": (9, "CA")}
    assert sorted(r.member_id for r in ref_bad.collect()) == ["m3", "m3"]
    int_clean, _ = clean.clean_customers(raw, "intended")
    got = {r.member_id: (r.emp_length, r.address_state) for r in int_clean.collect()}
    # mean of (5, 2, 2, 9) = 4.5 -> 4
    assert got == {"m1": (5, "NA"), "m2": (4, "CA"), "m4": (9, "CA")}


def test_payment_dates_modes(spark):
    df = spark.createDataFrame([("123.45", "Apr-2019"), ("Jan-2019", "77"), ("Jan-2019", None)],
                               "last_payment_date string, next_payment_date string")
    ref = [tuple(r) for r in clean.clean_payment_dates(df, "reference").collect()]
    assert ref == [(None, None), ("Jan-2019", "Jan-2019"), ("Jan-2019", "Jan-2019")]
    intended = [tuple(r) for r in clean.clean_payment_dates(df, "intended").collect()]
    assert intended == [(None, "Apr-2019"), ("Jan-2019", None), ("Jan-2019", None)]


def test_clean_repayments_fix_then_drop(spark):
    rows = [("l1", 5.0, 1.0, 1.0, 0.0, 1.0, "Jan-2019", "Feb-2019"),
            ("l2", 0.0, 1.0, 1.0, 0.0, 1.0, "Jan-2019", "Feb-2019"),
            ("l3", 5.0, 1.0, 1.0, 9.0, 1.0, "Jan-2019", "Feb-2019"),
            ("l4", None, 1.0, 1.0, 9.0, 1.0, "Jan-2019", "Feb-2019")]
    df = spark.createDataFrame(rows, schemas.RAW_REPAYMENTS)
    got = {r.loan_id: r.total_payment_received for r in clean.clean_repayments(df).collect()}
    assert got == {"l1": 7.0, "l3": 9.0}


def test_clean_delinquencies(spark):
    rows = [("m1", 2.0, 0.0, None, 1.0, 3.9, 0.0, None, None),
            ("m2", 0.0, 0.0, 1.0, None, None, 0.0, 0.5, None),
            ("m3", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, None, None),
            ("m4", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, None, None),
            ("m4", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, None, None)]
    out = clean.clean_delinquencies(spark.createDataFrame(rows, schemas.RAW_DELINQUENCIES))
    delinquents = {r.member_id: tuple(r)[1:] for r in out.delinquents.collect()}
    # m2 qualifies on the raw 0.5 months, which then truncates to 0
    assert delinquents == {"m1": (2, 0.0, None), "m2": (0, 0.0, 0)}
    records = {r.member_id: tuple(r)[1:] for r in out.public_records.collect()}
    assert records == {"m1": (0, 1, 3), "m2": (1, 0, 0), "m3": (0, 0, 0)}
    assert out.bad.count() == 2  # exact duplicates are quarantined, not merged


def test_hot_key_rows_are_spread(spark):
    """A duplicated key holding a third of the rows is spread over several tasks."""
    conf = {"spark.ledgerline.rowsPerTask": "1000",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = [("hot", i) for i in range(20000)] + [(f"k{i}", i) for i in range(40000)]
        df = spark.createDataFrame(rows, "k string, v int").repartition(8)
        clean_rows, bad = split_unique(df, "k")
        per_part = (bad.withColumn("pid", F.spark_partition_id())
                    .groupBy("pid").count().collect())
        assert sum(r["count"] for r in per_part) == 20000
        assert len(per_part) >= 6 and max(r["count"] for r in per_part) < 20000 / 3
        assert clean_rows.count() == 40000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
