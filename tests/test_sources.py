"""Readers: positional schema, corrupt cells, ingest time, invariants."""

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import clean
from ledgerline.session import scratch_path
from ledgerline.sources import files
from ledgerline.sources.fixtures import LendingInputs


def _write_text(spark, lines):
    path = scratch_path(spark, "text_csv")
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)
    return path


def test_positional_schema_and_corrupt_count(spark):
    header = "id,emp_title,emp_length,home,inc,st,zip,cty,g,sg,vs,LIMIT_COL,at,jinc,vsj"
    good = "m1,t,5 years,RENT,100,CA,1xx,US,A,A1,Verified,178050,Individual,,"
    bad = "m2,t,5 years,RENT,100,CA,1xx,US,A,A1,Verified,178050.0,Individual,,"
    path = _write_text(spark, [header, good, bad])
    df = files.read_customers(spark, path)
    rows = {r.member_id: r.total_high_credit_limit for r in df.collect()}
    # header names are ignored; the malformed INTEGER cell becomes NULL
    assert rows == {"m1": 178050, "m2": None}
    assert files.corrupt_row_count(spark, path, schemas.RAW_CUSTOMERS).first().corrupt_rows == 1


def test_ingest_time_constant_within_a_query(spark, sf_dir):
    raw = LendingInputs(spark, sf_dir).customers()
    assert raw.select("ingest_date").distinct().count() == 1
    # so whole-row DISTINCT still removes exact copies
    assert clean.customer_stages(raw).distinct.count() < raw.count()


def test_split_invariants(spark, sf_dir):
    raw = LendingInputs(spark, sf_dir).delinquencies()
    out = clean.clean_delinquencies(raw)
    unique = raw.join(out.bad.select("member_id").distinct(), "member_id", "left_anti") \
        .filter(F.col("member_id").isNotNull())
    assert out.filled.count() + out.bad.count() == raw.filter(F.col("member_id").isNotNull()).count()
    assert unique.count() == out.filled.count()
    assert out.filled.join(out.bad, "member_id").count() == 0


def test_csv_roundtrip_keeps_values(spark, sf_dir):
    loans = LendingInputs(spark, sf_dir).loans(ingest=False)
    path = scratch_path(spark, "loans_csv")
    files.write_csv(loans, path, keep_whitespace=True)
    back = files.read_loans(spark, path).drop("ingest_date")
    assert back.exceptAll(loans).count() == 0 and loans.exceptAll(back).count() == 0


def test_shuffle_partitions_scale_with_input(spark, sf_dir):
    from ledgerline.session import input_bytes, size_shuffle_partitions
    paths = [f"{sf_dir}/orders.parquet", f"{sf_dir}/customer.parquet"]
    assert input_bytes(spark, paths) > 0
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_adv = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        # a 1 KB target over these files asks for many partitions
        n = size_shuffle_partitions(spark, paths, target_bytes=1024)
        assert n >= input_bytes(spark, paths) // 1024
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
        # never below the configured count
        assert size_shuffle_partitions(spark, paths, target_bytes=1 << 40) == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old_adv)


def test_csv_timestamps_are_the_writers_own_and_constants_are_made_once(spark):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP'2024-01-02 03:04:05.678901'), (2, TIMESTAMP'1890-01-02 03:04:05'), "
                   "(3, NULL), (4, TIMESTAMP'0001-01-01 00:00:00') t(k, at)").coalesce(1)
    mine, plain = scratch_path(spark, "mine"), scratch_path(spark, "plain")
    files.write_csv(df, mine)
    df.write.option("header", True).csv(plain)
    assert [r.value for r in spark.read.text(mine).collect()] == [r.value for r in spark.read.text(plain).collect()]
    constant = files.csv_text(files.with_ingest_time(spark.range(3)))
    assert "date_format" not in constant._jdf.queryExecution().optimizedPlan().toString()
