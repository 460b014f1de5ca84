"""Wide customer-loan mart: customers left-joined with their loans,
repayments, delinquency and public-record rows (35 columns).

Plan shape. The published definition is a chain of LEFT JOINs starting from
customers. Joined in that order, a member owning a third of all loans would
land in one task: a left outer join can only split its left side, and the
heavy side here is the right one (loans). The equivalent plan used here is

* loans LEFT JOIN repayments on loan_id (loan grain, no hot keys);
* customers LEFT JOIN delinquencies LEFT JOIN public records on member_id
  (customer grain, unique keys, one shared partitioning);
* the customer side LEFT JOIN the loan side on member_id and salt
  (``skew.salted``): a member with more loans than one task is to take is
  repeated once per salt, and the empty rows of repeats without loans are
  dropped (such a member has loans under other salts).

Each side is built once; loans are read once more for the counts per member.
It returns exactly the rows of the LEFT JOIN chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.skew import ROWS_PER_TASK, key_row_counts, salted

# ---- fixed values: mart columns in output order, grouped by source table ----
CUSTOMER_COLS = ["member_id", "emp_title", "emp_length", "home_ownership", "annual_income",
                 "address_state", "address_zipcode", "address_country", "grade", "sub_grade",
                 "verification_status", "total_high_credit_limit", "application_type",
                 "join_annual_income", "verification_status_joint"]
LOAN_COLS = ["loan_amount", "funded_amount", "loan_term_years", "interest_rate",
             "monthly_installment", "issue_date", "loan_status", "loan_purpose"]
REPAYMENT_COLS = ["total_principal_received", "total_interest_received",
                  "total_late_fee_received", "last_payment_date", "next_payment_date"]
DELINQUENCY_COLS = ["delinq_2yrs", "delinq_amnt", "mths_since_last_delinq"]
PUBLIC_RECORD_COLS = ["pub_rec", "pub_rec_bankruptcies", "inq_last_6mths"]
MART_COLUMNS = (["loan_id"] + CUSTOMER_COLS + LOAN_COLS + REPAYMENT_COLS
                + DELINQUENCY_COLS + PUBLIC_RECORD_COLS)
# ---- end of fixed values ----


def customer_loan_mart(customers: DataFrame, loans: DataFrame, repayments: DataFrame,
                       delinquents: DataFrame, public_records: DataFrame) -> DataFrame:
    loan_side = (loans.select("loan_id", "member_id", *LOAN_COLS)
                 .join(repayments.select("loan_id", *REPAYMENT_COLS), "loan_id", "left"))
    member_side = (customers.select(*CUSTOMER_COLS)
                   .join(delinquents.select("member_id", *DELINQUENCY_COLS), "member_id", "left")
                   .join(public_records.select("member_id", *PUBLIC_RECORD_COLS), "member_id", "left"))
    loan_rows, members = salted(loan_side.withColumn("_has_loan", F.lit(True)), member_side, "member_id",
                                counts=key_row_counts(loans, "member_id"))
    wide = members.join(loan_rows, ["member_id", "_salt"], "left")
    return wide.filter(F.col("_has_loan").isNotNull() | (F.col("_salts") == 1)).select(*MART_COLUMNS)


def mart_view_sql(db: str, view: str = "customers_loan_v", limit: int = ROWS_PER_TASK) -> str:
    """CREATE OR REPLACE VIEW over the published catalog tables.

    Same plan shape as ``customer_loan_mart``, written as SQL because a
    permanent view is stored as query text; ``limit`` is the rows per task.
    """
    member_cols = set(CUSTOMER_COLS + DELINQUENCY_COLS + PUBLIC_RECORD_COLS)
    joined = ", ".join(f"m.{c}" if c in member_cols else f"s.{c}" for c in MART_COLUMNS)
    loan = ", ".join(f"l.{c}" for c in LOAN_COLS)
    rep = ", ".join(f"r.{c}" for c in REPAYMENT_COLS)
    cust = ", ".join(f"c.{c}" for c in CUSTOMER_COLS)
    dq = ", ".join(f"d.{c}" for c in DELINQUENCY_COLS)
    pr = ", ".join(f"e.{c}" for c in PUBLIC_RECORD_COLS)
    return f"""
CREATE OR REPLACE VIEW {db}.{view} AS
WITH hot AS (
  SELECT member_id AS hot_id, CAST(ceil(COUNT(*) / {limit}) AS INT) AS salts
  FROM {db}.loans WHERE member_id IS NOT NULL GROUP BY member_id HAVING COUNT(*) > {limit}
), loan_side AS (
  SELECT /*+ BROADCAST(h) */ l.loan_id, l.member_id, {loan}, {rep}, TRUE AS has_loan,
    CAST(pmod(xxhash64(l.loan_id, l.member_id, spark_partition_id()), coalesce(h.salts, 1)) AS INT) AS salt
  FROM {db}.loans l LEFT JOIN {db}.repayments r ON l.loan_id = r.loan_id
  LEFT JOIN hot h ON l.member_id = h.hot_id
), member_side AS (
  SELECT /*+ BROADCAST(h) */ {cust}, {dq}, {pr}, coalesce(h.salts, 1) AS salts
  FROM {db}.customers c
  LEFT JOIN {db}.delinquencies d ON c.member_id = d.member_id
  LEFT JOIN {db}.delinquencies_public_records e ON c.member_id = e.member_id
  LEFT JOIN hot h ON c.member_id = h.hot_id
), members AS (
  SELECT *, explode(sequence(0, salts - 1)) AS salt FROM member_side
)
SELECT {joined}
FROM members m LEFT JOIN loan_side s ON s.member_id = m.member_id AND s.salt = m.salt
WHERE s.has_loan IS NOT NULL OR m.salts = 1
"""
