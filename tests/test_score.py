"""Score grain, row counts and the per-loan variant."""

from collections import Counter

from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.operators import score
from ledgerline.operators.clean import published_customers


def _tables(spark):
    """A hot member m1 (many loans and repayments) plus two ordinary members."""
    loans, reps = [], []
    statuses = ["Fully Paid", "Current", "Charged Off"]
    for i in range(30):
        mid = "m1" if i < 24 else ("m2" if i < 28 else "m3")
        loans.append((f"l{i}", mid, 1000.0, 1000.0 + i % 3 * 100, 3, 5.0, 100.0, "2019-01-01",
                      statuses[i % 3], "car", "t", None))
        if i % 4 != 3:
            reps.append((f"l{i}", 10.0, 1.0, 0.0, 300.0 + i * 10, [50.0, 100.0, 140.0, 400.0][i % 4],
                         "Jan-2019", "Jan-2019", None))
    loans = spark.createDataFrame(loans, schemas.PUBLISHED_LOANS)
    reps = spark.createDataFrame(reps, schemas.PUBLISHED_REPAYMENTS)
    cust_rows = [("m1", "t", 5, "OWN", "1", "CA", "z", "US", "B", "B2", "V", 20000, "I", None, None),
                 ("m2", "t", 5, "OTHER", "1", "CA", "z", "US", "A", "A1", "V", 5000, "I", None, None),
                 ("m3", "t", 5, "RENT", "1", "CA", "z", "US", "C", "C5", "V", None, "I", None, None)]
    cust_schema = schemas.RAW_CUSTOMERS.fields[:]
    cust = spark.createDataFrame(cust_rows, "member_id string, emp_title string, emp_length int, "
                                 "home_ownership string, annual_income string, address_state string, "
                                 "address_zipcode string, address_country string, grade string, "
                                 "sub_grade string, verification_status string, "
                                 "total_high_credit_limit int, application_type string, "
                                 "join_annual_income string, verification_status_joint string")
    assert cust_schema  # raw schema available for reference
    cust = published_customers(cust)
    delinq = spark.createDataFrame([("m1", 0, 0.0, 5), ("m2", 3, 0.0, 1), ("m3", 1, 0.0, 0)],
                                   schemas.PUBLISHED_DELINQUENCIES)
    records = spark.createDataFrame([("m1", 0, 0, 0), ("m2", 6, None, 2), ("m3", 1, 1, 7)],
                                    schemas.PUBLISHED_PUBLIC_RECORDS)
    return reps, loans, records, delinq, cust


def _naive_score(reps, loans, records, delinq, cust):
    """The published join chain, written directly (pairs materialised)."""
    ph = score.payment_points(reps, loans).drop("loan_id")
    ldh = score.loan_history_points(ph, score.defaulter_points(records, delinq))
    fh = score.loan_health_points(loans, cust).drop("loan_id")
    joined = ldh.join(fh, "member_id")
    return joined.select("member_id", *score._score_exprs())


def _expanded(rows):
    return Counter({tuple(r)[:-1]: int(r.n_rows) for r in rows})


def test_factorized_score_equals_join_chain(spark):
    t = _tables(spark)
    fast = _expanded(score.credit_score(*t).collect())
    assert fast == Counter(map(tuple, _naive_score(*t).collect()))
    # m1: 18 repaid loans x 24 loans; m2 has NULL home points -> NULL scores
    assert sum(fast.values()) == 18 * 24 + 3 * 4 + 2 * 2
    assert all(r[4] is None for r in fast if r[0] == "m2")


def test_financial_health_points_grain(spark):
    points = score.financial_health_points(*_tables(spark))
    assert points.columns == ["member_id", *score.PAYMENT_PTS, *score.DEFAULTER_PTS, *score.HEALTH_PTS, "n_rows"]
    rows = points.collect()
    assert len({tuple(r)[:-1] for r in rows}) == len(rows)
    assert sum(r.n_rows for r in rows) == 18 * 24 + 3 * 4 + 2 * 2


def test_row_counts_beyond_bigint(spark, monkeypatch):
    """A member with 2 * 10^10 repaid loans of one kind and as many loans has 4 * 10^20 published rows."""
    side = spark.createDataFrame([("m1", 20_000_000_000)], "member_id string, n long")
    points = {c: F.lit(100) for c in [*score.PAYMENT_PTS, *score.DEFAULTER_PTS]}
    health = {c: F.lit(100).cast("decimal(12,2)") for c in score.HEALTH_PTS}
    monkeypatch.setattr(score, "_weighted_history", lambda *a: side.withColumns(points).withColumnRenamed("n", "_wl"))
    monkeypatch.setattr(score, "_weighted_health", lambda *a: side.withColumns(health).withColumnRenamed("n", "_wr"))
    (row,) = score.credit_score(None, None, None, None, None).collect()
    assert int(row.n_rows) == 4 * 10**20


def test_score_reads_loans_twice_and_groups_no_pairs(spark, tmp_path):
    """Once by loan and once by member (their counts share its shuffle); pairs of partial scores are final rows."""
    names = ["repayments", "loans", "records", "delinq", "customers"]
    for name, df in zip(names, _tables(spark)):
        df.write.parquet(f"{tmp_path}/{name}")
    df = score.credit_score(*[spark.read.parquet(f"{tmp_path}/{name}") for name in names])
    assert len(df.collect()) == df.distinct().count()
    ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("FileScan" in line and "/loans]" in line for line in ran.splitlines()) == 2, ran
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Aggregate")


def test_health_side_meets_customers_in_one_shuffle_of_members(spark, tmp_path):
    """Rows per amount are shuffled once more, by member alone: no counts, no salts, and none for the sums by member."""
    names = ["repayments", "loans", "records", "delinq", "customers"]
    for name, df in zip(names, _tables(spark)):
        df.write.parquet(f"{tmp_path}/{name}")
    t = [spark.read.parquet(f"{tmp_path}/{name}").hint("merge") for name in names]
    health = score._weighted_health(t[1], t[4]).groupBy("member_id").agg(F.sum("_wr"))
    plan = health._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3 and "_salt" not in plan and "Broadcast" not in plan, plan


def test_distinct_partial_scores_meet(spark):
    """Combinations of equal weighted parts are one row with all their published rows, nulls too."""
    reps, loans, records, delinq, cust = _tables(spark)
    twice = records.unionAll(records.filter("member_id = 'm1'")), delinq.unionAll(delinq.filter("member_id = 'm1'"))
    t = (reps, loans.unionAll(loans.limit(5)), *twice, cust.unionAll(cust.filter("member_id <> 'm3'")))
    rows = score.credit_score(*t).collect()
    assert _expanded(rows) == Counter(map(tuple, _naive_score(*t).collect()))
    assert len({tuple(r)[:-1] for r in rows}) == len(rows)


def _third_of_all_loans(spark, n=3000):
    """Loans and repayments of which member m1 holds a third, and their members."""
    owner = F.when(F.col("id") % 3 == 0, "m1").otherwise(F.concat(F.lit("x"), F.col("id")))
    loan = F.concat(F.lit("l"), F.col("id"))
    base = spark.range(0, n, numPartitions=8)
    loans = base.select(loan.alias("loan_id"), owner.alias("member_id"), F.lit(100.0).cast("float").alias("monthly_installment"),
                        (1000 + F.col("id") % 7).cast("float").alias("funded_amount"), F.lit("Current").alias("loan_status"))
    paid = base.select(loan.alias("loan_id"), F.lit(100.0).cast("float").alias("last_payment_amount"),
                       F.lit(900.0).cast("float").alias("total_payment_received"))
    members = base.select(owner.alias("member_id")).distinct()
    customers = members.select("member_id", F.lit("OWN").alias("home_ownership"), F.lit(9000.0).cast("float").alias("total_high_credit_limit"),
                               F.lit("A").alias("grade"), F.lit("A1").alias("sub_grade"))
    late = members.select("member_id", F.lit(1).alias("delinq_2yrs"))
    records = members.select("member_id", *[F.lit(0).alias(c) for c in ("pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")])
    return paid, loans, records, late, customers


def test_hot_member_is_spread(spark):
    """One member with a third of the loans: no task of the join holds much more than its share."""
    conf = {"spark.ledgerline.rowsPerTask": "50", "spark.sql.autoBroadcastJoinThreshold": "200",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        t = _third_of_all_loans(spark)
        per_loan = score.credit_score_per_loan(*t)
        sizes = [r["count"] for r in per_loan.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 3000 and max(sizes) < 2 * 3000 / 8
        wide = score.credit_score(*t)
        assert sum(int(r.n_rows) for r in wide.collect()) == 1000 * 1000 + 2000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_score_range_and_per_loan_grain(spark):
    t = _tables(spark)
    per_loan = score.credit_score_per_loan(*t)
    rows = per_loan.collect()
    assert len(rows) == per_loan.select("loan_id").distinct().count() == 23
    for r in rows:
        if r.credit_score is not None:
            assert 0 <= r.credit_score <= 2850
    top = per_loan.agg(F.max("credit_score")).first()[0]
    assert top is not None
