"""Derive the four raw lending relations from the driver tables.

The upstream lending CSVs are not available, so every raw relation is a
deterministic function of the driver tables (``customer``, ``nation``,
``region``, ``orders``); its size grows linearly with them. Every driver row
contributes: duplicated customers and delinquencies are emitted by a
generator (``explode``) in the same single scan, not by re-reading a subset.
The column recipes follow FIXTURES.md §4 and plant each data-quality trap
the cleaners must handle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas

DRIVER_TABLES = ("customer", "nation", "region", "orders")


_READS: dict[tuple, DataFrame] = {}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table; the DataFrame is reused per session so
    the file listing and footer are resolved once, not once per query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), spark.sparkContext.applicationId, path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def _s(c: Column) -> Column:
    return c.cast("string")


def _copies(*conditions_and_versions: tuple[Column | None, int]) -> Column:
    """Array of ``v`` versions to emit for a row; NULL entries are dropped.

    ``(None, 0)`` always emits version 0; ``(cond, v)`` emits ``v`` when cond.
    """
    items = [F.lit(v) if cond is None else F.when(cond, F.lit(v))
             for cond, v in conditions_and_versions]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def derive_customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    k = F.col("k")
    geo = (nation.join(region, nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", F.col("n_name").alias("nat"), F.col("r_name").alias("reg")))
    base = (customer.join(geo, customer.c_nationkey == geo.n_nationkey)
            .select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), "nat", "reg"))
    # exact copy when k % 41 == 0; conflicting copy (income + 1) when k % 37 == 0
    dirty = base.withColumn("v", F.explode(_copies((None, 0), (k % 41 == 0, 0), (k % 37 == 0, 1))))
    grade = F.substring(F.lit("ABCDEFG"), (k % 7).cast("int") + 1, 1)
    emp_mod = k % 13
    home = k % 6
    return dirty.select(
        F.when(k % 211 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("m"), _s(k))).alias("member_id"),
        F.col("seg").alias("emp_title"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
         .when(emp_mod == 0, "n/a").when(emp_mod == 1, "< 1 year").when(emp_mod == 12, "10+ years")
         .otherwise(F.concat(_s(emp_mod), F.lit(" years"))).alias("emp_length"),
        F.when(home == 0, "OWN").when(home == 1, "RENT").when(home == 2, "MORTGAGE")
         .when(home == 3, "ANY").when(home == 4, "OTHER").alias("home_ownership"),
        F.when(k % 19 == 0, F.lit(None).cast("string"))
         .otherwise(_s(F.lit(30000) + (k % 900) * 100 + F.col("v"))).alias("annual_income"),
        F.when(k % 23 == 0, F.col("nat")).otherwise(F.substring("nat", 1, 2)).alias("address_state"),
        F.concat(_s(F.lit(100) + k % 900), F.lit("xx")).alias("address_zipcode"),
        F.col("reg").alias("address_country"),
        grade.alias("grade"),
        F.when(k % 29 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(grade, _s(k % 5 + 1))).alias("sub_grade"),
        F.when(k % 2 == 0, "Verified").otherwise("Not Verified").alias("verification_status"),
        F.when(k % 31 == 0, F.lit(None).cast("int"))
         .otherwise(((k % 50) * 20000 + 1000).cast("int")).alias("total_high_credit_limit"),
        F.when(k % 9 == 0, "Joint App").otherwise("Individual").alias("application_type"),
        F.when(k % 9 == 0, _s(F.lit(60000) + k)).alias("join_annual_income"),
        F.when(k % 9 == 0, "Verified").alias("verification_status_joint"),
    )


def derive_loans(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    amount = ((k % 400) * 100 + 1000).cast("float")
    status = k % 9
    purpose = k % 5
    return orders.select(
        F.concat(F.lit("l"), _s(k)).alias("loan_id"),
        F.concat(F.lit("m"), _s(F.col("o_custkey"))).alias("member_id"),
        F.when(k % 97 == 0, F.lit(None).cast("float")).otherwise(amount).alias("loan_amount"),
        amount.alias("funded_amount"),
        F.when(k % 2 == 0, " 36 months").otherwise(" 60 months").alias("loan_term_months"),
        (F.lit(5) + k % 20).cast("float").alias("interest_rate"),
        ((k % 400) * 2 + 20).cast("float").alias("monthly_installment"),
        _s(F.to_date("o_orderdate")).alias("issue_date"),
        F.when(status == 0, "Fully Paid").when(status == 1, "Current")
         .when(status == 2, "In Grace Period").when(status == 3, "Late (16-30 days)")
         .when(status == 4, "Late (31-120 days)").when(status == 5, "Charged Off")
         .when(status == 6, "Default")
         .when(status == 7, "Does not meet the credit policy. Status:Fully Paid").alias("loan_status"),
        F.when(purpose == 0, "car").when(purpose == 1, "credit_card").when(purpose == 2, "boat")
         .when(purpose == 3, "debt_consolidation").otherwise("other").alias("loan_purpose"),
        F.when(k % 101 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("loan_title"),
    )


def derive_repayments(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    inst = (k % 400) * 2 + 20
    m6 = k % 6
    return orders.select(
        F.concat(F.lit("l"), _s(k)).alias("loan_id"),
        F.when(k % 89 == 0, F.lit(None).cast("float"))
         .otherwise(((k % 300) * 10).cast("float")).alias("total_principal_received"),
        (k % 50).cast("float").alias("total_interest_received"),
        (k % 3).cast("float").alias("total_late_fee_received"),
        F.when(k % 11 == 0, F.lit(0).cast("float"))
         .otherwise(((k % 300) * 200 + k % 50).cast("float")).alias("total_payment_received"),
        F.when(m6 == 0, (inst * 0.25).cast("float")).when(m6 == 1, (inst * 0.5).cast("float"))
         .when(m6 == 2, inst.cast("float")).when(m6 == 3, (inst * 1.5).cast("float"))
         .when(m6 == 4, (inst * 4).cast("float")).alias("last_payment_amount"),
        F.when(k % 53 == 0, "123.45").when(k % 7 == 0, F.lit(None).cast("string"))
         .otherwise(_s(F.to_date("o_orderdate"))).alias("last_payment_date"),
        F.when(k % 59 == 0, "77").otherwise("Apr-2019").alias("next_payment_date"),
    )


def derive_delinquencies(customer: DataFrame) -> DataFrame:
    k = F.col("k")
    d = (customer.select(F.col("c_custkey").alias("k"))
         .withColumn("v", F.explode(_copies((None, 0), (k % 43 == 0, 1)))))

    def count_col(mod: int, name: str) -> Column:
        return F.when(k % mod == mod - 1, F.lit(None).cast("float")).otherwise((k % mod).cast("float")).alias(name)

    return d.select(
        F.concat(F.lit("m"), _s(k)).alias("member_id"),
        count_col(8, "delinq_2yrs"),
        (k % 4 * 250 + F.col("v")).cast("float").alias("delinq_amnt"),
        count_col(9, "pub_rec"),
        count_col(10, "pub_rec_bankruptcies"),
        count_col(11, "inq_last_6mths"),
        (k % 5).cast("float").alias("total_rec_late_fee"),
        F.when(k % 3 == 0, F.lit(None).cast("float"))
         .otherwise((k % 84 + 0.5).cast("float")).alias("mths_since_last_delinq"),
        F.lit(None).cast("float").alias("mths_since_last_record"),
    )


#: Cells that do not parse as their column's type.
BAD_FLOAT, BAD_INT = "12,5oo", "178050.0"


def malformed_lines(raw: DataFrame, name: str) -> DataFrame:
    """CSV lines (one column ``value``, no header) of a raw relation with malformed rows among them.

    Every row is there; a number taken from its key chooses which get a cell
    that does not parse, a cell too many, or no last cell.
    """
    number = {"customers": F.substring("address_zipcode", 1, 3), "loans": F.substring("loan_id", 2, 20),
              "repayments": F.substring("loan_id", 2, 20), "delinquencies": F.substring("member_id", 2, 20)}[name]
    k = number.cast("long")
    typed = [f for f in raw.schema.fields if f.dataType.simpleString() != "string"]
    planted = {f.name: F.when(k % (83 + 2 * i) == 0, BAD_INT if f.dataType.simpleString() == "int" else BAD_FLOAT)
               .otherwise(_s(F.col(f.name))) for i, f in enumerate(typed)}
    cells = [planted.get(c, F.col(c)).alias(c) for c in raw.columns]
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    whole, short = F.to_csv(F.struct(*cells), options), F.to_csv(F.struct(*cells[:-1]), options)
    return raw.select(F.when(k % 127 == 0, F.concat(whole, F.lit(",surplus"))).when(k % 131 == 0, short)
                      .otherwise(whole).alias("value"))


class LendingInputs:
    """Raw lending relations of one scale-factor directory (lazy DataFrames)."""

    def __init__(self, spark: SparkSession, sf_dir: str, ingest_ts: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.ingest_ts = ingest_ts
        self._plans: dict[tuple[str, bool], DataFrame] = {}

    def _t(self, name: str) -> DataFrame:
        return read_driver_table(self.spark, self.sf_dir, name)

    def _ingest(self, df: DataFrame) -> DataFrame:
        from ledgerline.sources.files import with_ingest_time
        return with_ingest_time(df, self.ingest_ts)

    def customers(self, ingest: bool = True) -> DataFrame:
        df = derive_customers(self._t("customer"), self._t("nation"), self._t("region"))
        return self._ingest(df) if ingest else df

    def loans(self, ingest: bool = True) -> DataFrame:
        df = derive_loans(self._t("orders"))
        return self._ingest(df) if ingest else df

    def repayments(self, ingest: bool = True) -> DataFrame:
        df = derive_repayments(self._t("orders"))
        return self._ingest(df) if ingest else df

    def delinquencies(self, ingest: bool = True) -> DataFrame:
        df = derive_delinquencies(self._t("customer"))
        return self._ingest(df) if ingest else df

    def raw(self, name: str, ingest: bool = True) -> DataFrame:
        """The raw relation's plan, built once per instance (DataFrames are
        immutable; each execution still scans and derives everything)."""
        if (name, ingest) not in self._plans:
            self._plans[(name, ingest)] = getattr(self, name)(ingest)
        return self._plans[(name, ingest)]


RAW_SCHEMAS = {
    "customers": schemas.RAW_CUSTOMERS,
    "loans": schemas.RAW_LOANS,
    "repayments": schemas.RAW_REPAYMENTS,
    "delinquencies": schemas.RAW_DELINQUENCIES,
}
