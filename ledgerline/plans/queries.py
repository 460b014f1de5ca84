"""Registry of checked queries: one callable per operator key.

Every query derives the raw lending relations from the driver tables of
``sf_dir`` (so its work grows with them), applies one operator or cleaner
stage, and returns the whole result. ``ingest_date`` (query start time) is
dropped from compared outputs; decimal scores are returned as DOUBLE.
I/O queries write to a fresh folder below the shared checkpoint folder and
return the re-read result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import cleaning as fx
from ledgerline.functions import rules
from ledgerline.operators import clean, mart, mart_refresh, observe, profile, score, sketches
from ledgerline.operators.quality import split_unique
from ledgerline.operators.skew import key_row_counts, rows_per_task
from ledgerline.plans.batch import BatchPaths, materialise, run_batch
from ledgerline.session import scratch_path
from ledgerline.sources import catalog, files, malformed, statistics
from ledgerline.sources.fixtures import RAW_SCHEMAS, LendingInputs, malformed_lines
from ledgerline.sources.publication import Publication
from ledgerline.streaming import duplicates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCORE_DOUBLE = ["payment_history_pts", "defaulters_history_pts", "financial_health_pts", "credit_score", "n_rows"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _drop(df: DataFrame) -> DataFrame:
    return df.drop(schemas.INGEST_COLUMN)


def _as_double(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols if c in df.columns})


# Plan memo: building a DataFrame costs Python->JVM analysis per operator
# (about 2 s for a score query), so the raw-relation and cleaned-table plans
# are built once per session and input folder. Only plans are shared, never
# data: every execution scans the inputs and computes everything again.
_PLANS: dict[tuple, object] = {}


def _memo(spark, *key, build):
    k = (id(spark), spark.sparkContext.applicationId, *key)
    if k not in _PLANS:
        _PLANS[k] = build()
    return _PLANS[k]


def _inputs(spark, sf_dir) -> LendingInputs:
    return _memo(spark, "inputs", sf_dir, build=lambda: LendingInputs(spark, sf_dir))


def _tables(spark, sf_dir, mode="reference") -> clean.CleanTables:
    return _memo(spark, "tables", sf_dir, mode,
                 build=lambda: clean.CleanTables(lambda name: _inputs(spark, sf_dir).raw(name), mode))


def _score_args(t: clean.CleanTables):
    return t.repayments, t.loans, t.public_records, t.delinquencies, t.customers


def _publish_catalog(spark, sf_dir, names=tuple(schemas.PUBLISHED)) -> str:
    """Write cleaned tables as CSV and register external tables."""
    tables = {
        "customers": lambda t: t.customers, "loans": lambda t: t.loans, "repayments": lambda t: t.repayments,
        "delinquencies": lambda t: t.delinquencies, "delinquencies_public_records": lambda t: t.public_records}
    chosen = {name: tables[name](_tables(spark, sf_dir)) for name in names}
    db = f"lending_{uuid.uuid4().hex[:12]}"
    root = scratch_path(spark, db)
    catalog.create_database(spark, db, f"{root}/_warehouse")
    catalog.publish(spark, chosen, db, root, fmt="csv")
    return db


def _catalog_tables(spark, db) -> dict[str, DataFrame]:
    return {name: spark.table(f"{db}.{name}") for name in schemas.PUBLISHED}


# ------------------------------------------------------------------ sources
def _scan_roundtrip(spark, sf_dir, name) -> DataFrame:
    raw = _inputs(spark, sf_dir).raw(name, ingest=False)
    path = scratch_path(spark, f"raw_{name}")
    files.write_csv(raw, path, keep_whitespace=True)
    return _drop(files.read_csv(spark, path, RAW_SCHEMAS[name]))


@query
def scan_customers(spark, sf_dir):
    return _scan_roundtrip(spark, sf_dir, "customers")


@query
def scan_loans(spark, sf_dir):
    return _scan_roundtrip(spark, sf_dir, "loans")


@query
def scan_loans_ingest_time(spark, sf_dir):
    """A scan with the ingest time pinned, so that the column can be compared (as text)."""
    path = scratch_path(spark, "raw_loans")
    files.write_csv(_inputs(spark, sf_dir).raw("loans", ingest=False), path, keep_whitespace=True)
    loans = files.read_loans(spark, path, ingest_ts="2024-01-02 03:04:05")
    return loans.withColumn("ingest_date", F.date_format("ingest_date", "yyyy-MM-dd HH:mm:ss"))


@query
def scan_repayments(spark, sf_dir):
    return _scan_roundtrip(spark, sf_dir, "repayments")


@query
def scan_delinquencies(spark, sf_dir):
    return _scan_roundtrip(spark, sf_dir, "delinquencies")


def _export_with_upstream_headers(spark, sf_dir) -> str:
    raw = _inputs(spark, sf_dir).customers(ingest=False)
    back = {v: k for k, v in schemas.RAW_CUSTOMER_HEADER_RENAMES.items()}
    path = scratch_path(spark, "raw_customers_export")
    files.write_csv(raw.withColumnsRenamed(back), path, keep_whitespace=True)
    return path


@query
def scan_inferred(spark, sf_dir):
    return files.read_csv_inferred(spark, _export_with_upstream_headers(spark, sf_dir))


@query
def rename_raw_columns(spark, sf_dir):
    return files.rename_raw_customer_columns(scan_inferred(spark, sf_dir))


@query
def scan_external_table(spark, sf_dir):
    db = _publish_catalog(spark, sf_dir, ["loans"])
    return _drop(spark.table(f"{db}.loans"))


# -------------------------------------------------------------------- sinks
@query
def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "repayments_csv")
    files.write_csv(_tables(spark, sf_dir).repayments, path)
    return _drop(files.read_csv(spark, path, schemas.PUBLISHED_REPAYMENTS, ingest=False))


@query
def sink_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "credit_score_parquet")
    scores = score.credit_score(*_score_args(_tables(spark, sf_dir)))
    files.write_parquet(scores, path)
    return _as_double(spark.read.parquet(path), SCORE_DOUBLE)


@query
def customers_loan_view(spark, sf_dir):
    db = _publish_catalog(spark, sf_dir)
    catalog.create_view(spark, mart.mart_view_sql(db, limit=rows_per_task(spark.table(f"{db}.loans"))))
    return spark.table(f"{db}.customers_loan_v")


@query
def customers_loan_table(spark, sf_dir):
    db = _publish_catalog(spark, sf_dir)
    t = _catalog_tables(spark, db)
    wide = mart.customer_loan_mart(t["customers"], t["loans"], t["repayments"],
                                   t["delinquencies"], t["delinquencies_public_records"])
    catalog.create_table_as(spark, wide, f"{db}.customers_loan_t")
    return spark.table(f"{db}.customers_loan_t")


# ---------------------------------------------------------------- customers
def _cust(spark, sf_dir) -> clean.CustomerStages:
    return clean.customer_stages(_inputs(spark, sf_dir).raw("customers"))


@query
def customers_distinct(spark, sf_dir):
    return _drop(_cust(spark, sf_dir).distinct)


@query
def customers_income_filter(spark, sf_dir):
    return _drop(_cust(spark, sf_dir).with_income)


@query
def emp_length_int(spark, sf_dir):
    return _cust(spark, sf_dir).emp_length_int.select("member_id", "emp_length")


@query
def avg_emp_length(spark, sf_dir):
    emp = _cust(spark, sf_dir).emp_length_int
    return emp.agg(F.floor(F.avg("emp_length")).alias("avg_emp_length"))


@query
def emp_length_imputed(spark, sf_dir):
    return _cust(spark, sf_dir).imputed.select("member_id", "emp_length")


@query
def address_state_clean(spark, sf_dir):
    return _cust(spark, sf_dir).state_clean.select("member_id", "address_state")


@query
def customers_unique_rows(spark, sf_dir):
    return _drop(split_unique(_cust(spark, sf_dir).emp_length_int, "member_id").clean)


@query
def customers_bad_rows(spark, sf_dir):
    return _drop(clean.clean_customers(_inputs(spark, sf_dir).raw("customers"), "reference").bad)


@query
def clean_customers_reference(spark, sf_dir):
    return _drop(clean.clean_customers(_inputs(spark, sf_dir).raw("customers"), "reference").clean)


@query
def clean_customers_intended(spark, sf_dir):
    return _drop(clean.clean_customers(_inputs(spark, sf_dir).raw("customers"), "intended").clean)


# -------------------------------------------------------------------- loans
def _loans(spark, sf_dir) -> clean.LoanStages:
    return clean.loan_stages(_inputs(spark, sf_dir).raw("loans"))


@query
def loans_required_fields(spark, sf_dir):
    return _drop(_loans(spark, sf_dir).required)


@query
def loan_term_years(spark, sf_dir):
    return _drop(_loans(spark, sf_dir).term_years)


@query
def loan_purpose_standardized(spark, sf_dir):
    return _loans(spark, sf_dir).standardized.select("loan_id", "loan_purpose")


@query
def clean_loans(spark, sf_dir):
    return _drop(clean.clean_loans(_inputs(spark, sf_dir).raw("loans")))


# --------------------------------------------------------------- repayments
def _rep(spark, sf_dir, mode="reference") -> clean.RepaymentStages:
    return clean.repayment_stages(_inputs(spark, sf_dir).raw("repayments"), mode)


@query
def repayments_required_fields(spark, sf_dir):
    return _drop(_rep(spark, sf_dir).required)


@query
def repayments_total_fixed(spark, sf_dir):
    return _drop(_rep(spark, sf_dir).total_fixed)


@query
def repayments_nonzero(spark, sf_dir):
    return _drop(_rep(spark, sf_dir).nonzero)


@query
def repayment_dates_reference(spark, sf_dir):
    return _drop(_rep(spark, sf_dir, "reference").dates)


@query
def repayment_dates_intended(spark, sf_dir):
    return _drop(_rep(spark, sf_dir, "intended").dates)


@query
def clean_repayments(spark, sf_dir):
    return _drop(clean.clean_repayments(_inputs(spark, sf_dir).raw("repayments")))


# ------------------------------------------------------------ delinquencies
def _delinq(spark, sf_dir) -> clean.DelinquencyOutputs:
    return clean.clean_delinquencies(_inputs(spark, sf_dir).raw("delinquencies"))


@query
def delinquencies_unique_rows(spark, sf_dir):
    return _drop(split_unique(_inputs(spark, sf_dir).raw("delinquencies"), "member_id").clean)


@query
def delinquencies_bad_rows(spark, sf_dir):
    return _drop(_delinq(spark, sf_dir).bad)


@query
def delinquency_counts_filled(spark, sf_dir):
    return _drop(_delinq(spark, sf_dir).filled)


@query
def delinquent_members(spark, sf_dir):
    return _delinq(spark, sf_dir).delinquents


@query
def public_records(spark, sf_dir):
    return _delinq(spark, sf_dir).public_records


# -------------------------------------------------------------- point rules
@query
def last_payment_points(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return score.payment_points(t.repayments, t.loans).select("loan_id", "member_id", "last_payment_pts")


@query
def total_payment_points(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return score.payment_points(t.repayments, t.loans).select("loan_id", "member_id", "total_payment_pts")


@query
def payment_history_points(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return score.payment_points(t.repayments, t.loans).select("member_id", *score.PAYMENT_PTS)


@query
def delinquency_points(spark, sf_dir):
    d = _delinq(spark, sf_dir).delinquents
    return d.select("member_id", "delinq_2yrs", rules.delinquency_points(F.col("delinq_2yrs")).alias("delinq_pts"))


@query
def public_record_points(spark, sf_dir):
    p = _delinq(spark, sf_dir).public_records
    return p.select("member_id", "pub_rec", rules.public_record_points(F.col("pub_rec")).alias("public_records_pts"))


@query
def bankruptcy_points(spark, sf_dir):
    p = _delinq(spark, sf_dir).public_records
    return p.select("member_id", "pub_rec_bankruptcies",
                    rules.bankruptcy_points(F.col("pub_rec_bankruptcies")).alias("public_bankruptcies_pts"))


@query
def inquiry_points(spark, sf_dir):
    p = _delinq(spark, sf_dir).public_records
    return p.select("member_id", "inq_last_6mths", rules.inquiry_points(F.col("inq_last_6mths")).alias("enq_pts"))


@query
def loan_status_points(spark, sf_dir):
    l = _tables(spark, sf_dir).loans
    return l.select("loan_id", "loan_status", rules.loan_status_points(F.col("loan_status")).alias("loan_status_pts"))


@query
def home_ownership_points(spark, sf_dir):
    c = _tables(spark, sf_dir).customers
    return c.select("member_id", "home_ownership", rules.home_points(F.col("home_ownership")).alias("home_pts"))


@query
def credit_limit_points(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return score.loan_health_points(t.loans, t.customers).select("loan_id", "member_id", "credit_limit_pts")


@query
def grade_points(spark, sf_dir):
    c = _tables(spark, sf_dir).customers
    return c.select("member_id", "grade", "sub_grade",
                    rules.grade_points(F.col("grade"), F.col("sub_grade")).cast("double").alias("grade_pts"))


# ------------------------------------------------------------------- scores
@query
def loan_history_points(spark, sf_dir):
    t = _tables(spark, sf_dir)
    pay = score.payment_points(t.repayments, t.loans)
    return score.loan_history_points(pay, score.defaulter_points(t.public_records, t.delinquencies),
                                     key_row_counts(t.loans, "member_id"))


@query
def financial_health_points(spark, sf_dir):
    return _as_double(score.financial_health_points(*_score_args(_tables(spark, sf_dir))), ["grade_pts", "n_rows"])


@query
def credit_score(spark, sf_dir):
    return _as_double(score.credit_score(*_score_args(_tables(spark, sf_dir))), SCORE_DOUBLE)


@query
def credit_score_per_loan(spark, sf_dir):
    return _as_double(score.credit_score_per_loan(*_score_args(_tables(spark, sf_dir))), SCORE_DOUBLE)


@query
def credit_score_reduced_loans(spark, sf_dir):
    """The same score with loans probed against a filter of late members before their shuffle."""
    return _as_double(score.credit_score(*_score_args(_tables(spark, sf_dir)), reduce_loans=True), SCORE_DOUBLE)


@query
def severe_delinquency_scores(spark, sf_dir):
    """Per-loan scores of the few members with six or more late payments in two years."""
    t = _tables(spark, sf_dir)
    severe = t.delinquencies.filter("delinq_2yrs >= 6")
    scores = score.credit_score_per_loan(t.repayments, t.loans, t.public_records, severe, t.customers, reduce_loans=True)
    return _as_double(scores, SCORE_DOUBLE)


# ----------------------------------------------------------------- profiles
@query
def profile_emp_length_digits(spark, sf_dir):
    c = _cust(spark, sf_dir).with_income
    return c.select(F.regexp_replace("emp_length", fx.NON_DIGITS, "").alias("emp_length"))


@query
def profile_distinct_emp_length(spark, sf_dir):
    return profile.distinct_values(_cust(spark, sf_dir).with_income, "emp_length")


@query
def profile_distinct_state(spark, sf_dir):
    return profile.distinct_values(_cust(spark, sf_dir).imputed, "address_state")


@query
def profile_long_state(spark, sf_dir):
    c = _cust(spark, sf_dir).imputed
    return profile.count_values(c, "address_state", F.length("address_state") > 2, "long_state")


@query
def profile_duplicate_members(spark, sf_dir):
    return profile.frequency(_cust(spark, sf_dir).state_clean, "member_id")


@query
def top_duplicate_members(spark, sf_dir):
    return profile.top_k(_cust(spark, sf_dir).state_clean, "member_id", 5)


@query
def bottom_last_payment_dates(spark, sf_dir):
    return profile.bottom_k(_rep(spark, sf_dir).nonzero, "last_payment_date", 178)


@query
def profile_null_loan_amount(spark, sf_dir):
    l = _inputs(spark, sf_dir).raw("loans")
    return profile.count_rows(l, F.col("loan_amount").isNull(), "null_loan_amount")


@query
def profile_loan_purpose_raw(spark, sf_dir):
    return profile.frequency(_loans(spark, sf_dir).term_years, "loan_purpose")


@query
def profile_loan_purpose_clean(spark, sf_dir):
    return profile.frequency(_loans(spark, sf_dir).standardized, "loan_purpose")


@query
def profile_loan_members(spark, sf_dir):
    return profile.frequency(_loans(spark, sf_dir).standardized, "member_id")


@query
def profile_null_principal(spark, sf_dir):
    r = _inputs(spark, sf_dir).raw("repayments")
    return profile.count_rows(r, F.col("total_principal_received").isNull(), "null_principal")


@query
def profile_zero_payment(spark, sf_dir):
    r = _rep(spark, sf_dir).required
    return profile.count_rows(r, F.col("total_payment_received") == 0, "zero_payment")


@query
def profile_zero_payment_with_principal(spark, sf_dir):
    r = _rep(spark, sf_dir).required
    cond = (F.col("total_payment_received") == 0) & (F.col("total_principal_received") != 0)
    return profile.count_rows(r, cond, "zero_payment_with_principal")


@query
def profile_last_payment_date(spark, sf_dir):
    return profile.frequency(_rep(spark, sf_dir).nonzero, "last_payment_date", descending=False)


@query
def profile_delinquency_members(spark, sf_dir):
    return profile.frequency(_inputs(spark, sf_dir).raw("delinquencies"), "member_id")


@query
def profile_null_delinq(spark, sf_dir):
    f = _delinq(spark, sf_dir).filled
    return profile.count_rows(f, F.col("delinq_2yrs").isNull(), "null_delinq")


@query
def row_counts(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    per_loan = score.credit_score_per_loan(*_score_args(_tables(spark, sf_dir)))
    return profile.row_counts([
        clean.customer_counts(i.raw("customers")), clean.loan_counts(i.raw("loans")),
        clean.repayment_counts(i.raw("repayments")), clean.delinquency_counts(i.raw("delinquencies")),
        profile.count_rows(per_loan, None, "credit_score_per_loan")])


@query
def preview_rows(spark, sf_dir):
    return _drop(profile.preview(_tables(spark, sf_dir).loans, 20, ["loan_id"]))


# -------------------------------------------------------------------- batch
def _export_raw(spark, sf_dir) -> dict[str, str]:
    """The four raw relations as CSV exports, written side by side."""
    raw = {name: scratch_path(spark, f"raw_{name}") for name in RAW_SCHEMAS}
    with files.Writes(spark) as writes:
        for name, path in raw.items():
            writes.submit(files.write_csv, _inputs(spark, sf_dir).raw(name, ingest=False), path, keep_whitespace=True)
    return raw


def _batch(spark, sf_dir, runs: int) -> dict[str, str]:
    """The whole job over raw CSV exports, ``runs`` times into the same database and folder."""
    raw = _export_raw(spark, sf_dir)
    db = f"lending_{uuid.uuid4().hex[:12]}"
    root = scratch_path(spark, db)
    catalog.create_database(spark, db, f"{root}/_warehouse")
    for _ in range(runs):
        out = run_batch(spark, BatchPaths(out_root=root, db=db, write_parquet_score=True, **raw))
    return out


@query
def batch_credit_score(spark, sf_dir):
    """Run twice: the second run drops, replaces and overwrites what the first made."""
    return _as_double(spark.read.parquet(_batch(spark, sf_dir, 2)["credit_score_parquet"]), SCORE_DOUBLE)


@query
def batch_customers_bad_data(spark, sf_dir):
    path = _batch(spark, sf_dir, 1)["customers_bad_data"]
    bad = [f for f in schemas.RAW_CUSTOMERS.fields if f.name != "emp_length"]
    columns = {f.name: f.dataType for f in bad} | {"emp_length": schemas.PUBLISHED_CUSTOMERS["emp_length"].dataType}
    written = spark.read.csv(path, header=True)
    return written.select(*[F.col(f.name).cast(columns[f.name]) for f in schemas.RAW_CUSTOMERS.fields])


# ------------------------------------------------- profiles kept as states
@query
def daily_distinct_counts(spark, sf_dir):
    """Distinct members, purposes and issue dates of all loans from states kept per issue date."""
    loans = _tables(spark, sf_dir).loans
    states = sketches.distinct_states(loans, "issue_date", ["member_id", "loan_purpose", "loan_title"])
    path = scratch_path(spark, "distinct_states")
    states.write.partitionBy("column").parquet(path)
    estimated = sketches.distinct_counts(spark.read.parquet(path))
    exact = loans.select(*[F.count_distinct(c).alias(c) for c in ("member_id", "loan_purpose", "loan_title")])
    exact = exact.unpivot([], list(exact.columns), "column", "exact")
    near = F.abs(F.col("estimate") - F.col("exact")) <= sketches.ERROR * F.col("exact") + 1
    return estimated.join(exact, "column").select("column", "exact", near.alias("within_error"))


@query
def frequent_payment_dates(spark, sf_dir):
    """The most frequent last payment dates, from states kept per part and merged; counts are exact here
    because fewer dates occur than a state tracks, which ``max_error`` (0) tells."""
    paid = _tables(spark, sf_dir).repayments
    part = F.pmod(F.xxhash64("loan_id"), F.lit(7)).cast("int")
    path = scratch_path(spark, "frequent_states")
    sketches.frequent_states(paid.withColumn("part", part), "part", "last_payment_date").write.parquet(path)
    return sketches.frequent_items(spark.read.parquet(path), 10_000).filter("item is not null")


@query
def observed_batch_profiles(spark, sf_dir):
    """All filtered counts of a run, observed while its outputs are written: no scan of their own."""
    t = _inputs(spark, sf_dir)
    root = scratch_path(spark, "observed")
    loans = observe.observe(t.raw("loans"), "loans", {"null_loan_amount": F.col("loan_amount").isNull()})
    required = clean.repayment_stages(t.raw("repayments")).required
    zero = F.col("total_payment_received") == 0
    paid = observe.observe(required, "repayments", {
        "zero_payment": zero, "zero_payment_with_principal": zero & (F.col("total_principal_received") != 0)})
    for name, observed in (("loans", loans), ("repayments", paid)):
        observed.rows.write.parquet(f"{root}/{name}")
    return observe.profile_rows(spark, [loans, paid])


# ------------------------------------------------- mart refresh, statistics
@query
def customers_loan_refreshed(spark, sf_dir):
    """The mart built before some loans and delinquencies changed, then refreshed for the members concerned."""
    t = _tables(spark, sf_dir)
    now = {"customers": t.customers, "loans": t.loans, "repayments": t.repayments, "delinquencies": t.delinquencies,
           "delinquencies_public_records": t.public_records}
    number = F.substring("member_id", 2, 20).cast("long")
    late = number % 50 == 7  # their loans had another status, their delinquencies were not yet known
    before = now | {"loans": t.loans.withColumn("loan_status", F.when(late, "Issued").otherwise(F.col("loan_status"))),
                    "delinquencies": t.delinquencies.filter(~late)}
    path = scratch_path(spark, "customers_loan")
    mart_refresh.build(before, path)
    mart_refresh.refresh(spark, now, t.customers.filter(late).select("member_id"), path)
    return mart_refresh.read(spark, path)


@query
def published_statistics(spark, sf_dir):
    """Row and null counts of the published tables' key columns as the catalog has them after publication."""
    db = _publish_catalog(spark, sf_dir)
    statistics.analyze(spark, db)
    return statistics.column_statistics(spark, db).drop("distinct_estimate")


# ---------------------------------------------------------- malformed cells
def _diverted(spark, sf_dir, name) -> malformed.Diverted:
    """A raw relation with malformed rows among it, read once and split."""
    path, staging = scratch_path(spark, f"raw_{name}"), scratch_path(spark, f"staged_{name}")
    malformed_lines(_inputs(spark, sf_dir).raw(name, ingest=False), name).write.text(path)
    return malformed.divert(malformed.read_checked(spark, path, RAW_SCHEMAS[name], header=False), staging)


@query
def malformed_loan_cells(spark, sf_dir):
    return malformed.malformed_cells(_diverted(spark, sf_dir, "loans").bad, "loan_id").drop("record")


@query
def loans_well_formed(spark, sf_dir):
    return _drop(_diverted(spark, sf_dir, "loans").good)


@query
def malformed_counts(spark, sf_dir):
    """Reasons of all four raw relations with the number of rows that have them."""
    counts = [malformed.malformed_counts(_diverted(spark, sf_dir, name).bad, name) for name in RAW_SCHEMAS]
    return counts[0].unionAll(counts[1]).unionAll(counts[2]).unionAll(counts[3])


@query
def corrupt_row_counts(spark, sf_dir):
    """Rows of each raw relation whose malformed cells a plain read turns into NULL."""
    out = None
    for name in RAW_SCHEMAS:
        path = scratch_path(spark, f"raw_{name}")
        malformed_lines(_inputs(spark, sf_dir).raw(name, ingest=False), name).write.text(path)
        one = files.corrupt_row_count(spark, path, RAW_SCHEMAS[name], header=False).select(F.lit(name).alias("relation"), "corrupt_rows")
        out = one if out is None else out.unionAll(one)
    return out


# ------------------------------------------------------- atomic publication
def _atomic_batches(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Published customers as readers see them after a run and a failed second one, and after a third."""
    raw = _export_raw(spark, sf_dir)
    db = f"lending_{uuid.uuid4().hex[:12]}"
    root = scratch_path(spark, db)
    catalog.create_database(spark, db, f"{root}/_warehouse")
    run_batch(spark, BatchPaths(out_root=root, db=db, atomic=True, **raw))
    failing = Publication(spark, db, root).begin()
    intended = clean.clean_customers(files.read_customers(spark, raw["customers"]), "intended", materialise).clean
    files.write_csv(intended, f"{failing.folder}/cleaned/customers")
    failing.stage("customers", schemas.PUBLISHED_CUSTOMERS, f"{failing.folder}/cleaned/customers")
    # its next sink was never written: nothing of the run may become visible
    failing.stage("loans", schemas.PUBLISHED_LOANS, f"{failing.folder}/cleaned/loans")
    try:
        failing.commit()
    except RuntimeError:
        before = spark.table(f"{db}.customers")
    run_batch(spark, BatchPaths(out_root=root, db=db, atomic=True, mode="intended", **raw))
    return before, spark.table(f"{db}.customers")


@query
def atomic_publication_customers(spark, sf_dir):
    before, after = _atomic_batches(spark, sf_dir)
    return _drop(before.withColumn("seen", F.lit("after a failed run")).unionByName(
        after.withColumn("seen", F.lit("after the next run"))))


# ------------------------------------------------- duplicates across files
ARRIVALS = 3


def _taken_in(spark, sf_dir, name: str, number, distinct_rows: bool = False, keep: str = "true") -> duplicates.Arriving:
    """A raw relation that arrives in three parts, each taken in before the next one comes."""
    raw = _inputs(spark, sf_dir).raw(name, ingest=False)
    root = scratch_path(spark, f"arriving_{name}")
    a = duplicates.Arriving(RAW_SCHEMAS[name], "member_id", f"{root}/source/*", f"{root}/state", distinct_rows, keep)
    for part in range(ARRIVALS):
        files.write_csv(raw.filter(number % ARRIVALS == part), f"{root}/source/part{part}", keep_whitespace=True)
        duplicates.take_in(spark, a)
    return a


def _arriving_delinquencies(spark, sf_dir) -> duplicates.Arriving:
    # the two versions of a member's row come in different parts
    number = F.substring("member_id", 2, 20).cast("long") + F.col("delinq_amnt").cast("int") % 250
    return _taken_in(spark, sf_dir, "delinquencies", number)


@query
def arriving_delinquencies_split(spark, sf_dir):
    clean_rows, bad = duplicates.split(spark, _arriving_delinquencies(spark, sf_dir))
    return _drop(clean_rows.withColumn("side", F.lit("clean")).unionByName(bad.withColumn("side", F.lit("bad"))))


@query
def arriving_delinquency_retractions(spark, sf_dir):
    return duplicates.retractions(spark, _arriving_delinquencies(spark, sf_dir))


@query
def arriving_customers_split(spark, sf_dir):
    """Equal rows count once; rows without income take no part."""
    version = F.coalesce(F.substring("annual_income", -2, 2).cast("int"), F.lit(0))
    number = version + F.substring("address_zipcode", 1, 3).cast("int")
    a = _taken_in(spark, sf_dir, "customers", number, distinct_rows=True, keep="annual_income IS NOT NULL")
    clean_rows, bad = duplicates.split(spark, a)
    both = clean_rows.withColumn("side", F.lit("clean")).unionByName(bad.withColumn("side", F.lit("bad")))
    return _drop(both.withColumn("emp_length", fx.emp_length_years("emp_length")))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit_score(spark, sf_dir)

