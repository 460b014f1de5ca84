"""Credit-score rule tables compiled to searched CASE expressions.

Each rule table is data (thresholds, substrings, suffixes, grade bases);
``first_match`` turns an ordered list of (condition, points) into one
``CASE WHEN`` so the whole score stays inside whole-stage codegen. The first
true condition wins; without a default the result is NULL when none holds.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: point tiers, rule tables and weights ----
TIERS = {
    "unacceptable": 0,
    "very_bad": 100,
    "bad": 250,
    "good": 500,
    "very_good": 650,
    "excellent": 800,
}
# loan status: lower-cased status contains the text -> tier (first match wins)
LOAN_STATUS_RULES = [
    ("fully paid", "excellent"),
    ("current", "good"),
    ("in grace period", "bad"),
    ("late (16-30 days)", "very_bad"),
    ("late (31-120 days)", "very_bad"),
    ("charged off", "unacceptable"),
]
# home ownership: lower-cased value ends with the text -> tier; NULL -> very_bad
HOME_SUFFIX_RULES = [
    ("own", "excellent"),
    ("rent", "good"),
    ("mortgage", "bad"),
    ("any", "very_bad"),
]
# funded amount <= ratio * total high credit limit -> tier
CREDIT_LIMIT_RULES = [
    ("0.10", "excellent"),
    ("0.20", "very_good"),
    ("0.30", "good"),
    ("0.50", "bad"),
    ("0.70", "very_bad"),
]
# grade letter -> base tier; sub-grade number k=1..5 scales the base
GRADE_BASES = [("A", "excellent"), ("B", "very_good"), ("C", "good"), ("D", "bad"), ("E", "very_bad")]
SUB_GRADE_FACTORS = ["1.00", "0.95", "0.90", "0.85", "0.80"]
ZERO_GRADES = ("F", "G")
# count bands: 0 -> excellent, 1-2 -> bad, 3-5 -> very_bad, above 5 / NULL -> overflow tier
COUNT_BANDS = [(0, 0, "excellent"), (1, 2, "bad"), (3, 5, "very_bad")]
PAYMENT_HISTORY_WEIGHT = "0.20"
DEFAULTERS_HISTORY_WEIGHT = "0.45"
FINANCIAL_HEALTH_WEIGHT = "0.35"
# ---- end of fixed values ----


def tier(name: str) -> int:
    return TIERS[name]


def first_match(rules: list[tuple[Column, Column | int]], default=None) -> Column:
    """Searched CASE from ordered (condition, value) pairs."""
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v)

    (c0, v0), rest = rules[0], rules[1:]
    expr = reduce(lambda acc, cv: acc.when(cv[0], lit(cv[1])), rest, F.when(c0, lit(v0)))
    return expr if default is None else expr.otherwise(lit(default))


def _dbl(c: Column) -> Column:
    # FLOAT compared with a scaled FLOAT is evaluated in DOUBLE.
    return c.cast("double")


def last_payment_points(last_payment: Column, installment: Column) -> Column:
    p, i = _dbl(last_payment), _dbl(installment)
    return first_match([
        ((p >= i * 0.5) & (p < i), tier("very_bad")),
        (p == i, tier("good")),
        ((p > i) & (p <= i * 1.5), tier("very_good")),
        (p > i * 1.5, tier("excellent")),
    ], default=tier("unacceptable"))


def total_payment_points(total_received: Column, funded_amount: Column) -> Column:
    """No default: a negative total or a NULL funded amount gives NULL."""
    t, f = _dbl(total_received), _dbl(funded_amount)
    return first_match([
        (t >= f * 0.5, tier("very_good")),
        ((t < f * 0.5) & (t > 0), tier("good")),
        ((t == 0) | t.isNull(), tier("unacceptable")),
    ])


def count_band_points(count: Column, overflow_tier: str) -> Column:
    """Banded count; above the last band or NULL scores ``overflow_tier``.

    Negative counts match no band and give NULL.
    """
    rules = [(count.between(lo, hi), tier(t)) for lo, hi, t in COUNT_BANDS]
    rules.append(((count > COUNT_BANDS[-1][1]) | count.isNull(), tier(overflow_tier)))
    return first_match(rules)


def delinquency_points(delinq_2yrs: Column) -> Column:
    return count_band_points(delinq_2yrs, "unacceptable")


def public_record_points(pub_rec: Column) -> Column:
    return count_band_points(pub_rec, "very_bad")


def bankruptcy_points(pub_rec_bankruptcies: Column) -> Column:
    return count_band_points(pub_rec_bankruptcies, "very_bad")


def inquiry_points(inq_last_6mths: Column) -> Column:
    return count_band_points(inq_last_6mths, "unacceptable")


def loan_status_points(status: Column) -> Column:
    s = F.lower(status)
    return first_match([(s.contains(text), tier(t)) for text, t in LOAN_STATUS_RULES],
                       default=tier("unacceptable"))


def home_points(home_ownership: Column) -> Column:
    """No default: an unlisted value such as "OTHER" gives NULL."""
    h = F.lower(home_ownership)
    rules = [(h.endswith(suffix), tier(t)) for suffix, t in HOME_SUFFIX_RULES]
    last_cond, last_pts = rules[-1]
    rules[-1] = (last_cond | h.isNull(), last_pts)
    return first_match(rules)


def credit_limit_points(funded_amount: Column, credit_limit: Column) -> Column:
    f, lim = _dbl(funded_amount), _dbl(credit_limit)
    return first_match([(f <= lim * float(ratio), tier(t)) for ratio, t in CREDIT_LIMIT_RULES],
                       default=tier("unacceptable"))


def grade_table() -> list[tuple[str, str, Decimal]]:
    """(grade, sub_grade, points) generated from the bases and factors."""
    rows = []
    for letter, t in GRADE_BASES:
        for k, factor in enumerate(SUB_GRADE_FACTORS, start=1):
            rows.append((letter, f"{letter}{k}", Decimal(tier(t)) * Decimal(factor)))
    return rows


def grade_points(grade: Column, sub_grade: Column) -> Column:
    """Decimal points; F/G score 0, a mismatched or NULL sub-grade NULL.

    The 25 (sub-grade -> points) pairs are one constant map, so the rule is a
    single lookup instead of a 26-branch CASE; the sub-grade must start with
    the grade letter to count.
    """
    table = grade_table()
    lookup = F.map_from_arrays(F.array(*[F.lit(sg) for _, sg, _ in table]),
                               F.array(*[F.lit(str(p)) for _, _, p in table]).cast("array<decimal(12,2)>"))
    zero = decimal_lit(tier("unacceptable"), "decimal(12,2)")
    return (F.when(grade.isin(*ZERO_GRADES), zero)
             .when(F.substring(sub_grade, 1, 1) == grade, F.element_at(lookup, sub_grade)))


def decimal_lit(value: str | Decimal, dtype: str) -> Column:
    """Decimal constant built from its text (folded to a literal by Catalyst)."""
    return F.lit(str(value)).cast(dtype)


def _w(weight: str) -> Column:
    # a weight such as 0.20 is a DECIMAL(2,2) literal, as in SQL
    return decimal_lit(weight, "decimal(2,2)")


def payment_history(last_pts: Column, total_pts: Column) -> Column:
    return (last_pts + total_pts) * _w(PAYMENT_HISTORY_WEIGHT)


def defaulters_history(delinq_pts: Column, records_pts: Column,
                       bankruptcies_pts: Column, enq_pts: Column) -> Column:
    return (delinq_pts + records_pts + bankruptcies_pts + enq_pts) * _w(DEFAULTERS_HISTORY_WEIGHT)


def financial_health(status_pts: Column, home_pts: Column,
                     limit_pts: Column, grade_pts: Column) -> Column:
    return (status_pts + home_pts + limit_pts + grade_pts) * _w(FINANCIAL_HEALTH_WEIGHT)
