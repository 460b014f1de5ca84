"""Cleaning rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: lending cleaning constants ----
VALID_LOAN_PURPOSES = (
    "debt_consolidation", "credit_card", "home_improvement", "other",
    "major_purchase", "medical", "small_business", "car", "vacation",
    "moving", "house", "wedding", "renewable_energy", "educational",
)
FALLBACK_PURPOSE = "other"
NUMERIC_TEXT = r"^\d+(\.\d+)?$"      # a date cell that holds only a number
NON_DIGITS = "[^0-9]"
TERM_SUFFIX = " months"
MAX_STATE_CODE_LENGTH = 2
UNKNOWN_STATE = "NA"
# ---- end of fixed values ----


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def emp_length_years(c: str | Column) -> Column:
    """"9 years" -> 9, "10+ years" -> 10, "< 1 year" -> 1, "n/a" -> NULL."""
    digits = F.regexp_replace(_c(c), NON_DIGITS, "")
    return F.nullif(digits, F.lit("")).cast("int")


def term_in_years(c: str | Column) -> Column:
    """" 36 months" -> 3: strip the unit, whole months / 12, truncated."""
    months = F.replace(_c(c), F.lit(TERM_SUFFIX), F.lit("")).cast("int")
    return (months / F.lit(12)).cast("int")


def state_code(c: str | Column) -> Column:
    """Names longer than a two-letter code become "NA"; NULL stays NULL."""
    c = _c(c)
    return F.when(F.length(c) > MAX_STATE_CODE_LENGTH, F.lit(UNKNOWN_STATE)).otherwise(c)


def standard_purpose(c: str | Column) -> Column:
    """Keep a known purpose, map anything else (and NULL) to "other"."""
    c = _c(c)
    return F.when(c.isin(*VALID_LOAN_PURPOSES), c).otherwise(F.lit(FALLBACK_PURPOSE))


def null_if_numeric(c: str | Column) -> Column:
    c = _c(c)
    return F.when(c.rlike(NUMERIC_TEXT), F.lit(None).cast("string")).otherwise(c)


def repaired_total(principal: str | Column, interest: str | Column,
                   late_fee: str | Column, total: str | Column) -> Column:
    """A zero total with non-zero principal is rebuilt from its parts."""
    p, i, f, t = _c(principal), _c(interest), _c(late_fee), _c(total)
    return F.when((p != 0) & (t == 0), p + i + f).otherwise(t)


def count_or_zero(c: str | Column) -> Column:
    """Float count -> integer (truncating), NULL -> 0."""
    return F.coalesce(_c(c).cast("int"), F.lit(0))
