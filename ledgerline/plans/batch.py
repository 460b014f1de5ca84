"""The whole batch job: raw CSV -> cleaned outputs -> catalog tables -> score.

Stages
------
1. Read the four raw CSV inputs with their schemas (+ ingest time).
2. Clean. Where one lineage feeds several sinks (customers: clean + bad;
   delinquencies: delinquents + public records + bad) the shared input is
   cut with a reliable ``checkpoint()`` into the cluster's checkpoint folder,
   so it is computed once and a lost executor does not replay the scan.
3. Write eight CSV outputs (header, overwrite) below ``out_root/cleaned``. They
   do not depend on one another, so they are written side by side.
4. Register five external tables over them in database ``db`` (or, with
   ``table_buckets``, Parquet tables bucketed on their join keys).
5. Create or replace the 35-column customer-loan view over the tables.
6. Score from the catalog tables and write ``out_root/processed/credit_score``
   as CSV (and Parquet when asked: first, and the CSV from it, so the score is
   computed once and no CSV is parsed for the copy).

Everything runs as Spark jobs; the driver only issues DDL and returns the
paths of the outputs. A second run over the same database replaces everything:
table by table in place, or, with ``atomic``, all tables in one step after the
last output is written (``sources.publication``).

With ``malformed="divert"`` raw rows with a cell that does not parse leave for a
bad-row sink with their reasons before step 2 (``sources.malformed``); by default
such cells read as NULL, as published.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerline import schemas
from ledgerline.operators import clean, mart, score
from ledgerline.session import shared_dir
from ledgerline.sources import catalog, files, malformed
from ledgerline.sources.publication import Publication, Run

MALFORMED = ("null", "divert")


@dataclass
class BatchPaths:
    customers: str
    loans: str
    repayments: str
    delinquencies: str
    out_root: str
    db: str = "lending"
    mode: str = "reference"
    write_parquet_score: bool = False
    ingest_ts: str | None = None
    # 0: CSV external tables (as published by the reference). >0: Parquet
    # tables bucketed on the join keys with this many buckets, so the score's
    # loan_id join runs without a shuffle.
    table_buckets: int = 0
    # True: each run writes below out_root/runs/<run id> and its tables are
    # published together; not with table_buckets.
    atomic: bool = False
    malformed: str = "null"
    outputs: dict[str, str] = field(default_factory=dict)


def materialise(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (lineage cut)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _read_raw(spark: SparkSession, p: BatchPaths, root: str, sink: Callable[[str, DataFrame], None], name: str) -> DataFrame:
    """A raw relation; malformed rows read as NULL cells or leave for ``<name>_malformed``."""
    path = getattr(p, name)
    if p.malformed == "null":
        return getattr(files, f"read_{name}")(spark, path, p.ingest_ts)
    sides = malformed.divert(malformed.read_checked(spark, path, RAW[name], p.ingest_ts), f"{root}/staged/{name}")
    sink(f"{name}_malformed", malformed.malformed_cells(sides.bad))
    return sides.good


RAW = {"customers": schemas.RAW_CUSTOMERS, "loans": schemas.RAW_LOANS, "repayments": schemas.RAW_REPAYMENTS,
       "delinquencies": schemas.RAW_DELINQUENCIES}


def run_batch(spark: SparkSession, p: BatchPaths) -> dict[str, str]:
    """Run the job; returns {output name: path}."""
    if p.malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {MALFORMED}, got {p.malformed!r}")
    if p.atomic and p.table_buckets:
        raise ValueError("bucketed tables are replaced one by one: not with atomic")
    run = Publication(spark, p.db, p.out_root).begin() if p.atomic else None
    root = run.folder if run else p.out_root.rstrip("/")
    out: dict[str, str] = {}

    with files.Writes(spark) as writes:
        def sink(name: str, df: DataFrame) -> None:
            out[name] = f"{root}/cleaned/{name}"
            writes.submit(files.write_csv, df, out[name])

        def raw(name: str) -> DataFrame:
            return _read_raw(spark, p, root, sink, name)

        # the largest first: the cuts below run beside them
        sink("loans", clean.clean_loans(raw("loans")))
        sink("repayments", clean.clean_repayments(raw("repayments"), p.mode))
        customers, customers_bad = clean.clean_customers(raw("customers"), p.mode, materialise)
        sink("customers", customers)
        sink("customers_bad_data", customers_bad)
        late = clean.clean_delinquencies(raw("delinquencies"), materialise)
        sink("delinquencies", late.delinquents)
        sink("delinquencies_bad_data", late.bad)
        sink("delinquencies_public_records", late.public_records)

    t = _tables(spark, p, root, out, run)
    scores = score.credit_score(t["repayments"], t["loans"], t["delinquencies_public_records"],
                                t["delinquencies"], t["customers"])
    processed = f"{root}/processed"
    written = scores
    out["credit_score"] = f"{processed}/credit_score"
    if p.write_parquet_score:
        out["credit_score_parquet"] = f"{processed}/credit_score_parquet"
        files.write_parquet(scores, out["credit_score_parquet"])
        written = spark.read.schema(scores.schema).parquet(out["credit_score_parquet"])
    files.write_csv(written, out["credit_score"])
    if run:
        run.stage("credit_score", scores.schema, out["credit_score"])
        run.commit()
        catalog.create_view(spark, mart.mart_view_sql(p.db))
    p.outputs = out
    return out


def _tables(spark: SparkSession, p: BatchPaths, root: str, out: dict[str, str], run: Run | None) -> dict[str, DataFrame]:
    """The five cleaned tables as the score reads them: staged (atomic), or registered in the catalog."""
    if run:
        for name in schemas.PUBLISHED:
            run.stage(name, schemas.PUBLISHED[name], out[name])
        return {name: run.table(name) for name in schemas.PUBLISHED}
    catalog.create_database(spark, p.db)
    if p.table_buckets > 0:
        csv_tables = {name: spark.read.csv(out[name], header=True, schema=schemas.PUBLISHED[name])
                      for name in schemas.PUBLISHED}
        n = p.table_buckets
        catalog.publish_bucketed(spark, csv_tables, p.db, f"{root}/tables", {
            "loans": ("loan_id", n), "repayments": ("loan_id", n),
            "customers": ("member_id", n), "delinquencies": ("member_id", n),
            "delinquencies_public_records": ("member_id", n)})
    else:
        for name in schemas.PUBLISHED:
            catalog.create_external_table(spark, f"{p.db}.{name}", schemas.PUBLISHED[name], out[name])
    catalog.create_view(spark, mart.mart_view_sql(p.db))
    return {name: spark.table(f"{p.db}.{name}") for name in schemas.PUBLISHED}


def main(argv: list[str] | None = None) -> None:
    """Command-line entry (see README): four raw CSV paths and an output root."""
    import argparse

    from ledgerline.session import build_session, size_shuffle_partitions
    ap = argparse.ArgumentParser(prog="python -m ledgerline.plans.batch")
    for name in ("customers", "loans", "repayments", "delinquencies", "out_root"):
        ap.add_argument(name)
    ap.add_argument("db", nargs="?", default="lending")
    ap.add_argument("--mode", choices=clean.MODES, default="reference")
    ap.add_argument("--buckets", type=int, default=0,
                    help="publish bucketed Parquet tables with this many buckets (0: CSV tables)")
    ap.add_argument("--parquet-score", action="store_true", help="also write the score as Parquet")
    ap.add_argument("--atomic", action="store_true", help="publish all tables of the run in one step")
    ap.add_argument("--malformed", choices=MALFORMED, default="null",
                    help="what becomes of raw rows with cells that do not parse")
    a = ap.parse_args(argv)
    spark = build_session()
    paths = BatchPaths(a.customers, a.loans, a.repayments, a.delinquencies, a.out_root, db=a.db,
                       mode=a.mode, write_parquet_score=a.parquet_score, table_buckets=a.buckets,
                       atomic=a.atomic, malformed=a.malformed)
    size_shuffle_partitions(spark, [paths.customers, paths.loans, paths.repayments, paths.delinquencies])
    for name, path in run_batch(spark, paths).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
