"""Row-local cleaners on a file stream give the batch result, incrementally."""

from collections import Counter

from ledgerline.plans import queries as Q
from ledgerline.session import scratch_path
from ledgerline.sources import files
from ledgerline.sources.fixtures import LendingInputs
from ledgerline.streaming.ingest import start_cleaning


def test_stream_cleans_loans_incrementally(spark, sf_dir):
    raw = LendingInputs(spark, sf_dir).loans(ingest=False)
    src, sink, ckpt = (scratch_path(spark, n) for n in ("src", "sink", "ckpt"))
    first, second = raw.randomSplit([0.5, 0.5], seed=7)
    files.write_csv(first, f"{src}/part1", keep_whitespace=True)
    q = start_cleaning(spark, "loans", f"{src}/*", sink, ckpt)
    q.awaitTermination()
    n1 = spark.read.parquet(sink).count()
    files.write_csv(second, f"{src}/part2", keep_whitespace=True)
    q = start_cleaning(spark, "loans", f"{src}/*", sink, ckpt)
    q.awaitTermination()
    got = spark.read.parquet(sink).drop("ingest_date")
    want = Q.clean_loans(spark, sf_dir)
    assert 0 < n1 < got.count()
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_stream_cleans_repayments(spark, sf_dir):
    raw = LendingInputs(spark, sf_dir).repayments(ingest=False)
    src, sink, ckpt = (scratch_path(spark, n) for n in ("src", "sink", "ckpt"))
    files.write_csv(raw, src, keep_whitespace=True)
    start_cleaning(spark, "repayments", src, sink, ckpt).awaitTermination()
    got = spark.read.parquet(sink).drop("ingest_date")
    want = Q.clean_repayments(spark, sf_dir)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_restart_goes_on_where_it_ended(spark, sf_dir):
    raw = LendingInputs(spark, sf_dir).loans(ingest=False)
    src, sink, ckpt = (scratch_path(spark, n) for n in ("src", "sink", "ckpt"))
    files.write_csv(raw, src, keep_whitespace=True)
    for _ in range(2):
        start_cleaning(spark, "loans", src, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == Q.clean_loans(spark, sf_dir).count()
