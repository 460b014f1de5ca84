"""Table and column statistics after publication, so join sides follow rows and widths.

Without them the planner knows a CSV table by the bytes of its files only, far
from the few columns a query keeps, and in the wrong unit for text. ``analyze``
has Spark count rows and, for the columns that joins and filters use, distinct
values, nulls and widths; with ``spark.sql.cbo.enabled`` sizes below joins are
estimated from them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Columns of the published tables that queries join, group or filter on.
KEY_COLUMNS = {
    "customers": ["member_id", "home_ownership", "grade", "sub_grade", "total_high_credit_limit"],
    "loans": ["loan_id", "member_id", "funded_amount", "monthly_installment", "loan_status"],
    "repayments": ["loan_id", "last_payment_amount", "total_payment_received"],
    "delinquencies": ["member_id", "delinq_2yrs"],
    "delinquencies_public_records": ["member_id", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths"],
}


def analyze(spark: SparkSession, db: str, columns: dict[str, list[str]] | None = None) -> None:
    """Row count and column statistics of the tables of ``db``; one scan a table."""
    for name, wanted in (columns or KEY_COLUMNS).items():
        listed = ", ".join(f"`{c}`" for c in wanted)
        spark.sql(f"ANALYZE TABLE {db}.{name} COMPUTE STATISTICS FOR COLUMNS {listed}")


def _described(spark: SparkSession, what: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {what}").collect()}


def row_counts(spark: SparkSession, db: str, names: list[str]) -> dict[str, int]:
    """Rows of each table as the catalog knows them (-1 where it was not analysed)."""
    found = {}
    for name in names:
        known = re.search(r"(\d+) rows", _described(spark, f"{db}.{name}").get("Statistics", ""))
        found[name] = int(known[1]) if known else -1
    return found


def column_statistics(spark: SparkSession, db: str, columns: dict[str, list[str]] | None = None) -> DataFrame:
    """(table_name, column_name, row_count, null_count, distinct_estimate), from the catalog alone."""
    wanted = columns or KEY_COLUMNS
    rows = row_counts(spark, db, list(wanted))
    out = []
    for name, listed in wanted.items():
        for c in listed:
            known = _described(spark, f"{db}.{name} `{c}`")
            out.append((name, c, rows[name], int(known["num_nulls"]), int(known["distinct_count"])))
    return spark.createDataFrame(out, "table_name string, column_name string, row_count long, null_count long, distinct_estimate long")
