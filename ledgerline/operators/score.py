"""Credit score: payment history, defaulters history, financial health.

Inputs are the published tables (``clean.CleanTables`` or catalog tables).

Grain. The published score is at *member x repaid loan x loan* grain: payment
points are computed per repaid loan, then every loan of the member is joined
back on member_id, so a member with m repaid loans and n loans yields m*n
rows, all copies of at most a few hundred distinct ones. ``credit_score`` and
``financial_health_points`` return each distinct row once with the number of
published rows it stands for (``n_rows``, DECIMAL(38,0)): each side is collapsed
to its distinct point combinations per member with a row count (both bounded
by the rule tables, at most 20 and 36 rows per member) and only those meet.
No pairs of rows are ever formed, however many loans a member has.
``credit_score`` weighs each side before they meet, so only the distinct partial
scores of a member do, and what they give is distinct without another grouping.
``credit_score_per_loan`` is the one-row-per-loan form (repayment and loan
matched on loan_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.operators.bloom import reduce_by
from ledgerline.operators.skew import key_row_counts, skew_join

PAYMENT_PTS = ["last_payment_pts", "total_payment_pts"]
DEFAULTER_PTS = ["delinq_pts", "public_records_pts", "public_bankruptcies_pts", "enq_pts"]
HEALTH_PTS = ["loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts"]
#: Row counts multiply, so they outgrow BIGINT.
COUNT_TYPE = "decimal(38,0)"


# -------------------------------------------------------------- row rules
def _payment_exprs() -> list[Column]:
    return [
        rules.last_payment_points(F.col("last_payment_amount"), F.col("monthly_installment"))
             .alias("last_payment_pts"),
        rules.total_payment_points(F.col("total_payment_received"), F.col("funded_amount"))
             .alias("total_payment_pts"),
    ]


def _health_exprs() -> list[Column]:
    """loan_status_pts, home_pts, credit_limit_pts, grade_pts (in that order)."""
    return [
        rules.loan_status_points(F.col("loan_status")).alias("loan_status_pts"),
        rules.home_points(F.col("home_ownership")).alias("home_pts"),
        rules.credit_limit_points(F.col("funded_amount"), F.col("total_high_credit_limit"))
             .alias("credit_limit_pts"),
        rules.grade_points(F.col("grade"), F.col("sub_grade")).alias("grade_pts"),
    ]


def _part_exprs() -> tuple[Column, Column, Column]:
    """Weighted payment history, defaulters history and financial health."""
    return (rules.payment_history(*[F.col(c) for c in PAYMENT_PTS]),
            rules.defaulters_history(*[F.col(c) for c in DEFAULTER_PTS]),
            rules.financial_health(*[F.col(c) for c in HEALTH_PTS]))


def _score_exprs() -> list[Column]:
    ph, dh, fh = _part_exprs()
    return [ph.alias("payment_history_pts"), dh.alias("defaulters_history_pts"),
            fh.alias("financial_health_pts"), (ph + dh + fh).alias("credit_score")]


def _credit_profile(customers: DataFrame) -> DataFrame:
    return customers.select("member_id", "home_ownership", "total_high_credit_limit", "grade", "sub_grade")


# ------------------------------------------------------------- components
def payment_points(repayments: DataFrame, loans: DataFrame) -> DataFrame:
    """Repayment matched with its loan: (loan_id, member_id, 2 points)."""
    paid = repayments.select("loan_id", "last_payment_amount", "total_payment_received")
    owed = loans.select("loan_id", "member_id", "monthly_installment", "funded_amount")
    return paid.join(owed, "loan_id").select("loan_id", "member_id", *_payment_exprs())


def defaulter_points(public_records: DataFrame, delinquents: DataFrame) -> DataFrame:
    """Members present in both delinquency tables: (member_id, 4 points)."""
    late = delinquents.select("member_id", "delinq_2yrs")
    records = public_records.select("member_id", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")
    return records.join(late, "member_id").select(
        "member_id",
        rules.delinquency_points(F.col("delinq_2yrs")).alias("delinq_pts"),
        rules.public_record_points(F.col("pub_rec")).alias("public_records_pts"),
        rules.bankruptcy_points(F.col("pub_rec_bankruptcies")).alias("public_bankruptcies_pts"),
        rules.inquiry_points(F.col("inq_last_6mths")).alias("enq_pts"),
    )


def loan_history_points(payment: DataFrame, defaulters: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Payment points of delinquent members (one row per repaid loan).

    ``counts`` (member_id, _n) may give at least the rows of each member, which
    spares a second pass over the payment join.
    """
    return skew_join(payment, defaulters, "member_id", counts=counts).select("member_id", *PAYMENT_PTS, *DEFAULTER_PTS)


def loan_health_points(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Per loan: (loan_id, member_id, 4 financial-health points)."""
    held = loans.select("loan_id", "member_id", "loan_status", "funded_amount")
    return skew_join(held, _credit_profile(customers), "member_id").select("loan_id", "member_id", *_health_exprs())


# ------------------------------------------------------ weighted member sides
def loans_of_late_members(loans: DataFrame, delinquents: DataFrame) -> DataFrame:
    """Loans that may belong to a delinquent member: the others are dropped where they are scanned."""
    return reduce_by(loans, delinquents, "member_id")


def _weighted_history(repayments, loans, public_records, delinquents) -> DataFrame:
    """(member_id, 6 points, _wl): distinct payment/defaulter combinations."""
    pay = (payment_points(repayments, loans)
           .groupBy("member_id", *PAYMENT_PTS).agg(F.count(F.lit(1)).alias("_wl")))
    # few rows per member by now; all that follows is by member and needs no other shuffle of them
    return (pay.repartition("member_id").join(defaulter_points(public_records, delinquents), "member_id")
            .select("member_id", *PAYMENT_PTS, *DEFAULTER_PTS, "_wl"))


def _weighted_health(loans, customers) -> DataFrame:
    """(member_id, 4 points, _wr): financial-health combinations, to be summed by what a caller makes of them.

    Loans are pre-aggregated on (member, status points, amount) before the
    customer join, so a member has at most as many rows there as there are status
    points and amounts, however many loans: none is hot, the join needs no salt, and
    what follows by member needs no other shuffle. Loans are read once. Points of
    the customer alone are taken before the join.
    """
    per_amount = (loans
                  .filter(F.col("member_id").isNotNull())
                  .select("member_id", "funded_amount",
                          rules.loan_status_points(F.col("loan_status")).alias("loan_status_pts"))
                  .groupBy("member_id", "loan_status_pts", "funded_amount")
                  .agg(F.count(F.lit(1)).alias("_n")))
    _, home, limit, grade = _health_exprs()
    profile = customers.select("member_id", "total_high_credit_limit", home, grade)
    return per_amount.join(profile, "member_id").select(
        "member_id", "loan_status_pts", "home_pts", limit, "grade_pts", F.col("_n").alias("_wr"))


def _pair_count() -> Column:
    """Published rows of a pair of combinations; counts of 31 bits meet in a BIGINT, which is cheaper."""
    left, right = F.col("_wl"), F.col("_wr")
    wide = (left.cast(COUNT_TYPE) * right.cast(COUNT_TYPE)).cast(COUNT_TYPE)
    small = (left < 1 << 31) & (right < 1 << 31)
    return F.when(small, (left * right).cast(COUNT_TYPE)).otherwise(wide).alias("n_rows")


def _weighted_fanout(repayments, loans, public_records, delinquents, customers) -> DataFrame:
    left = _weighted_history(repayments, loans, public_records, delinquents)
    right = _weighted_health(loans, customers).groupBy("member_id", *HEALTH_PTS).agg(F.sum("_wr").alias("_wr"))
    return (left.join(right, "member_id")
            .select("member_id", *PAYMENT_PTS, *DEFAULTER_PTS, *HEALTH_PTS, _pair_count()))


# ------------------------------------------------------------------ results
def financial_health_points(repayments, loans, public_records, delinquents, customers) -> DataFrame:
    """All ten point columns, each distinct row of a member once, with ``n_rows``."""
    return _weighted_fanout(repayments, loans, public_records, delinquents, customers)


def credit_score(repayments, loans, public_records, delinquents, customers, reduce_loans: bool = False) -> DataFrame:
    """(member_id, payment_history_pts, defaulters_history_pts,
    financial_health_pts, credit_score, n_rows), one row per distinct score of a member.

    Weights: 20 % payment history, 45 % defaulters history, 35 % financial
    health; decimal arithmetic; NULL when any part is NULL. ``reduce_loans``
    probes a Bloom filter of the delinquent members before loans are shuffled:
    worth its extra scan of the (small) delinquency table where few members are late.
    """
    if reduce_loans:
        loans = loans_of_late_members(loans, delinquents)
    ph, dh, fh = _part_exprs()
    history = (_weighted_history(repayments, loans, public_records, delinquents)
               .groupBy("member_id", ph.alias("payment_history_pts"), dh.alias("defaulters_history_pts"))
               .agg(F.sum("_wl").alias("_wl")))
    health = (_weighted_health(loans, customers)
              .groupBy("member_id", fh.alias("financial_health_pts")).agg(F.sum("_wr").alias("_wr")))
    total = F.col("payment_history_pts") + F.col("defaulters_history_pts") + F.col("financial_health_pts")
    # the parts are distinct on each side and make up the score: each pair is a distinct row
    return (history.join(health, "member_id")
            .select("member_id", "payment_history_pts", "defaulters_history_pts", "financial_health_pts",
                    total.alias("credit_score"), _pair_count()))


def credit_score_per_loan(repayments, loans, public_records, delinquents, customers, reduce_loans: bool = False) -> DataFrame:
    """One row per repaid loan of a delinquent member; no member fan-out.

    Repayment and loan meet on loan_id; the member-grain tables (customer,
    delinquency points) join on member_id and share one partitioning, then
    meet the loans in one salted join.
    """
    if reduce_loans:
        loans = loans_of_late_members(loans, delinquents)
    paid = repayments.select("loan_id", "last_payment_amount", "total_payment_received")
    owed = loans.select("loan_id", "member_id", "monthly_installment", "funded_amount", "loan_status")
    members = _credit_profile(customers).join(defaulter_points(public_records, delinquents), "member_id")
    per_loan = skew_join(paid.join(owed, "loan_id"), members, "member_id", counts=key_row_counts(loans, "member_id"))
    pts = per_loan.select("loan_id", "member_id", *_payment_exprs(), *DEFAULTER_PTS, *_health_exprs())
    return pts.select("loan_id", "member_id", *_score_exprs())
