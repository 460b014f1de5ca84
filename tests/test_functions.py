"""Literal-row tests of the cleaning rules and point rules."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions import cleaning as fx
from ledgerline.functions import rules


def _one_col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_emp_length_years(spark):
    got = _one_col(spark, ["9 years", "10+ years", "< 1 year", "n/a", None], "string", fx.emp_length_years)
    assert got == [9, 10, 1, None, None]


def test_term_in_years(spark):
    assert _one_col(spark, [" 36 months", " 60 months", "30 months"], "string", fx.term_in_years) == [3, 5, 2]


def test_state_code(spark):
    assert _one_col(spark, ["CA", "California", None], "string", fx.state_code) == ["CA", "NA", None]


def test_standard_purpose(spark):
    got = _one_col(spark, ["car", "boat", "educational", None], "string", fx.standard_purpose)
    assert got == ["car", "other", "educational", "other"]


def test_null_if_numeric(spark):
    got = _one_col(spark, ["123.45", "77", "Apr-2019", "1.", None], "string", fx.null_if_numeric)
    assert got == [None, None, "Apr-2019", "1.", None]


def test_repaired_total(spark):
    rows = [(5.0, 1.0, 1.0, 0.0), (0.0, 1.0, 1.0, 0.0), (5.0, 1.0, 1.0, 9.0)]
    df = spark.createDataFrame(rows, "p float, i float, f float, t float")
    got = [r[0] for r in df.select(fx.repaired_total("p", "i", "f", "t")).collect()]
    assert got == [7.0, 0.0, 9.0]


def test_count_or_zero_truncates(spark):
    assert _one_col(spark, [2.9, None, 0.5], "float", fx.count_or_zero) == [2, 0, 0]


def test_home_points(spark):
    vals = ["OWN", "RENT", "MORTGAGE", "ANY", None, "OTHER", "UNKNOWN"]
    assert _one_col(spark, vals, "string", rules.home_points) == [800, 500, 250, 100, 100, None, 800]


def test_grade_points(spark):
    rows = [("A", "A2"), ("E", "E5"), ("F", "F3"), ("A", "B1"), ("B", None), ("A", "A1"), ("G", None)]
    df = spark.createDataFrame(rows, "g string, s string")
    got = [r[0] for r in df.select(rules.grade_points(F.col("g"), F.col("s"))).collect()]
    assert got == [Decimal("760.00"), Decimal("80.00"), Decimal("0.00"), None, None,
                   Decimal("800.00"), Decimal("0.00")]


def test_grade_table_generated_from_rule():
    table = rules.grade_table()
    assert len(table) == 25
    assert ("C", "C3", Decimal("450.0000")) in [(g, s, p.quantize(Decimal("0.0001"))) for g, s, p in table]


def test_count_band_points(spark):
    vals = [0, 2, 5, 6, None, -1]
    assert _one_col(spark, vals, "int", rules.public_record_points) == [800, 250, 100, 100, 100, None]
    assert _one_col(spark, vals, "int", rules.inquiry_points) == [800, 250, 100, 0, 0, None]
    assert _one_col(spark, vals, "int", rules.delinquency_points) == [800, 250, 100, 0, 0, None]


def test_loan_status_points(spark):
    vals = ["Fully Paid", "Current", "In Grace Period", "Late (16-30 days)", "Late (31-120 days)",
            "Charged Off", "Default", "Does not meet the credit policy. Status:Fully Paid", None]
    assert _one_col(spark, vals, "string", rules.loan_status_points) == [800, 500, 250, 100, 100, 0, 0, 800, 0]


def test_last_and_total_payment_points(spark):
    rows = [(5.0, 10.0), (10.0, 10.0), (15.0, 10.0), (15.5, 10.0), (4.9, 10.0), (None, 10.0)]
    df = spark.createDataFrame(rows, "p float, i float")
    got = [r[0] for r in df.select(rules.last_payment_points(F.col("p"), F.col("i"))).collect()]
    assert got == [100, 500, 650, 800, 0, 0]
    rows = [(50.0, 100.0), (49.0, 100.0), (0.0, 100.0), (None, 100.0), (-1.0, 100.0), (1.0, None)]
    df = spark.createDataFrame(rows, "t float, f float")
    got = [r[0] for r in df.select(rules.total_payment_points(F.col("t"), F.col("f"))).collect()]
    assert got == [650, 500, 0, 0, None, None]


def test_credit_limit_points(spark):
    rows = [(10.0, 100.0), (20.0, 100.0), (30.0, 100.0), (50.0, 100.0), (70.0, 100.0), (71.0, 100.0), (1.0, None)]
    df = spark.createDataFrame(rows, "f float, l float")
    got = [r[0] for r in df.select(rules.credit_limit_points(F.col("f"), F.col("l"))).collect()]
    assert got == [800, 650, 500, 250, 100, 0, 0]
