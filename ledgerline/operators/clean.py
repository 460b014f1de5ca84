"""The four cleaners, stage by stage.

``mode="reference"`` reproduces the published behaviour exactly; ``"intended"``
applies what the code comments describe where the two differ:

* customers: the published output is split from the emp_length-cast rows, so
  the mean imputation and state repair never reach it; intended mode splits
  the imputed, repaired rows.
* repayments: the published output copies the cleaned *last* payment date
  into both date columns; intended mode cleans each column from itself.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import cleaning as fx
from ledgerline.operators.quality import (Split, all_present, drop_missing, fill_zero_counts,
                                          impute_floor_mean, split_unique)

MODES = ("reference", "intended")
Cut = Callable[[DataFrame], DataFrame]

# ---- fixed values: required columns and count columns ----
LOAN_REQUIRED = ["loan_amount", "funded_amount", "loan_term_months", "interest_rate",
                 "monthly_installment", "issue_date", "loan_status", "loan_purpose",
                 "loan_title"]
REPAYMENT_REQUIRED = ["total_principal_received", "total_interest_received",
                      "total_late_fee_received", "total_payment_received"]
PUBLIC_RECORD_COUNTS = ["pub_rec", "pub_rec_bankruptcies", "inq_last_6mths"]
# ---- end of fixed values ----


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")


# ---------------------------------------------------------------- customers
class CustomerStages:
    """Customer cleaning stages, each built on first use."""

    def __init__(self, raw: DataFrame):
        self.raw = raw

    @cached_property
    def distinct(self) -> DataFrame:
        """Whole-row DISTINCT."""
        return self.raw.distinct()

    @cached_property
    def with_income(self) -> DataFrame:
        """annual_income present."""
        return self.distinct.filter(F.col("annual_income").isNotNull())

    @cached_property
    def emp_length_int(self) -> DataFrame:
        """emp_length text -> INT."""
        return self.with_income.withColumn("emp_length", fx.emp_length_years("emp_length"))

    @cached_property
    def imputed(self) -> DataFrame:
        """NULL emp_length -> floor(mean)."""
        return impute_floor_mean(self.emp_length_int, "emp_length")

    @cached_property
    def state_clean(self) -> DataFrame:
        """Long state names -> "NA"."""
        return self.imputed.withColumn("address_state", fx.state_code("address_state"))


def customer_stages(raw: DataFrame) -> CustomerStages:
    return CustomerStages(raw)


def clean_customers(raw: DataFrame, mode: str = "reference", cut: Cut | None = None) -> Split:
    """-> (clean, bad). Duplicated member_ids are quarantined in ``bad``."""
    _check_mode(mode)
    st = customer_stages(raw)
    base = st.emp_length_int if mode == "reference" else st.state_clean
    return split_unique(base, "member_id", cut)


# -------------------------------------------------------------------- loans
class LoanStages(NamedTuple):
    required: DataFrame
    term_years: DataFrame
    standardized: DataFrame


def loan_stages(raw: DataFrame) -> LoanStages:
    required = drop_missing(raw, LOAN_REQUIRED)
    years = {"loan_term_months": fx.term_in_years("loan_term_months").alias("loan_term_years")}
    term = required.select(*[years.get(c, F.col(c)) for c in required.columns])
    standardized = term.withColumn("loan_purpose", fx.standard_purpose("loan_purpose"))
    return LoanStages(required, term, standardized)


def clean_loans(raw: DataFrame) -> DataFrame:
    return loan_stages(raw).standardized


# --------------------------------------------------------------- repayments
class RepaymentStages(NamedTuple):
    required: DataFrame
    total_fixed: DataFrame
    nonzero: DataFrame
    dates: DataFrame


def clean_payment_dates(df: DataFrame, mode: str = "reference") -> DataFrame:
    _check_mode(mode)
    last = fx.null_if_numeric("last_payment_date")
    own_next = fx.null_if_numeric("next_payment_date")
    # the published output has the cleaned last date in both columns
    return df.withColumns({"last_payment_date": last,
                           "next_payment_date": own_next if mode == "intended" else last})


def repayment_stages(raw: DataFrame, mode: str = "reference") -> RepaymentStages:
    required = drop_missing(raw, REPAYMENT_REQUIRED)
    fixed = required.withColumn("total_payment_received", fx.repaired_total(
        "total_principal_received", "total_interest_received",
        "total_late_fee_received", "total_payment_received"))
    nonzero = fixed.filter(F.col("total_payment_received") != 0)
    return RepaymentStages(required, fixed, nonzero, clean_payment_dates(nonzero, mode))


def clean_repayments(raw: DataFrame, mode: str = "reference") -> DataFrame:
    return repayment_stages(raw, mode).dates


# ------------------------------------------------------------ delinquencies
class DelinquencyOutputs(NamedTuple):
    delinquents: DataFrame      # members with a delinquency signal (published)
    public_records: DataFrame   # per member record / bankruptcy / inquiry counts
    bad: DataFrame              # quarantined duplicate member_ids
    filled: DataFrame           # unique rows with all four counts filled


def has_delinquency_signal() -> Column:
    """Reads the filled two-year count and the raw FLOAT months."""
    return (F.col("delinq_2yrs") > 0) | (F.col("mths_since_last_delinq") > 0)


def clean_delinquencies(raw: DataFrame, cut: Cut | None = None) -> DelinquencyOutputs:
    unique, bad = split_unique(raw, "member_id", cut)
    processed = fill_zero_counts(unique, ["delinq_2yrs"])
    # the output truncates the months to INT after the filter
    delinquents = (processed
                   .filter(has_delinquency_signal())
                   .select("member_id", "delinq_2yrs", "delinq_amnt",
                           F.col("mths_since_last_delinq").cast("int").alias("mths_since_last_delinq")))
    filled = fill_zero_counts(processed, PUBLIC_RECORD_COUNTS)
    public_records = filled.select("member_id", *PUBLIC_RECORD_COUNTS)
    return DelinquencyOutputs(delinquents, public_records, bad, filled)


# ------------------------------------------------------------------ publish
def published_customers(clean: DataFrame) -> DataFrame:
    """Customers as the published table types them (text incomes -> FLOAT).

    ``try_cast`` matches a CSV re-read: a malformed cell becomes NULL.
    """
    return clean.withColumns({
        "annual_income": F.col("annual_income").try_cast("float"),
        "total_high_credit_limit": F.col("total_high_credit_limit").try_cast("float"),
        "join_annual_income": F.col("join_annual_income").try_cast("float"),
    })


class CleanTables:
    """The published tables of one run, each built on first use.

    Attributes: customers (published types), customers_bad, loans,
    repayments, delinquencies (delinquent members), public_records,
    delinquencies_bad.
    """

    def __init__(self, raw: Callable[[str], DataFrame], mode: str = "reference"):
        """``raw(name)`` returns the raw relation ``customers`` / ``loans`` /
        ``repayments`` / ``delinquencies``; it is called at most once each."""
        _check_mode(mode)
        self._get = raw
        self._cache: dict[str, DataFrame] = {}
        self.mode = mode

    def _raw(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._get(name)
        return self._cache[name]

    @cached_property
    def _customer_split(self) -> Split:
        return clean_customers(self._raw("customers"), self.mode)

    @cached_property
    def _delinquency_outputs(self) -> DelinquencyOutputs:
        return clean_delinquencies(self._raw("delinquencies"))

    @cached_property
    def customers(self) -> DataFrame:
        return published_customers(self._customer_split.clean)

    @cached_property
    def customers_bad(self) -> DataFrame:
        return self._customer_split.bad

    @cached_property
    def loans(self) -> DataFrame:
        return clean_loans(self._raw("loans"))

    @cached_property
    def repayments(self) -> DataFrame:
        return clean_repayments(self._raw("repayments"), self.mode)

    @cached_property
    def delinquencies(self) -> DataFrame:
        return self._delinquency_outputs.delinquents

    @cached_property
    def public_records(self) -> DataFrame:
        return self._delinquency_outputs.public_records

    @cached_property
    def delinquencies_bad(self) -> DataFrame:
        return self._delinquency_outputs.bad


# ------------------------------------------------------------- stage counts
def customer_counts(raw: DataFrame) -> DataFrame:
    """One row: customers_raw, customers_clean, customers_bad, in one pass.

    Equal rows fold into one with their number (the DISTINCT), those into one
    row per member, and the members are summed.
    """
    rows = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_n"))
    kept = F.col("annual_income").isNotNull() & F.col("member_id").isNotNull()
    members = rows.groupBy("member_id").agg(F.sum("_n").alias("_raw"), F.count_if(kept).alias("_kept"))
    return members.agg(_total("_raw", "customers_raw"), F.count_if(F.col("_kept") == 1).alias("customers_clean"),
                       _total(F.when(F.col("_kept") > 1, F.col("_kept")), "customers_bad"))


def delinquency_counts(raw: DataFrame) -> DataFrame:
    """One row: delinquencies_raw, delinquent_members, public_records, delinquencies_bad, in one pass."""
    signal = has_delinquency_signal()
    filled = raw.select("member_id", *[c for c in raw.columns if c == "mths_since_last_delinq"],
                        fx.count_or_zero("delinq_2yrs").alias("delinq_2yrs"))
    members = filled.groupBy("member_id").agg(F.count(F.lit(1)).alias("_n"), F.max(signal).alias("_signal"))
    known = F.col("member_id").isNotNull()
    single = known & (F.col("_n") == 1)
    return members.agg(_total("_n", "delinquencies_raw"), F.count_if(single & F.col("_signal")).alias("delinquent_members"),
                       F.count_if(single).alias("public_records"),
                       _total(F.when(known & (F.col("_n") > 1), F.col("_n")), "delinquencies_bad"))


def loan_counts(raw: DataFrame) -> DataFrame:
    """One row: loans_raw, loans_clean."""
    return raw.agg(F.count(F.lit(1)).alias("loans_raw"), F.count_if(all_present(raw, LOAN_REQUIRED)).alias("loans_clean"))


def repayment_counts(raw: DataFrame) -> DataFrame:
    """One row: repayments_raw, repayments_clean."""
    total = fx.repaired_total("total_principal_received", "total_interest_received", "total_late_fee_received",
                              "total_payment_received")
    return raw.agg(F.count(F.lit(1)).alias("repayments_raw"),
                   F.count_if(all_present(raw, REPAYMENT_REQUIRED) & (total != 0)).alias("repayments_clean"))


def _total(value: str | Column, name: str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(column), F.lit(0)).alias(name)
