import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from ledgerline.llm import queries, sharding


@settings(max_examples=60, deadline=None)
@given(n=st.integers(1, 5000), seed=st.integers(0, 2**63))
def test_permutation_is_one_to_one_and_invertible(n, seed):
    x = np.arange(n)
    y = sharding.permute(x, n, seed)
    assert sorted(y) == list(range(n))
    assert (sharding.permute(y, n, seed, inverse=True) == x).all()


def test_place_and_row_agree():
    for row in (0, 1, 999, 54_321):
        shard, slot = sharding.place(row, 100_000, 16, 5)
        assert sharding.row_at(shard, slot, 100_000, 16, 5) == row


def test_shuffle_is_not_the_identity():
    y = sharding.permute(np.arange(10_000), 10_000, 17)
    assert abs(np.corrcoef(np.arange(10_000), y)[0, 1]) < 0.05


def test_query_law(spark, sf_dir):
    rows = queries.op10_feistel_sharding(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    by = {}
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_partitions_do_not_matter(spark, make_docs):
    docs = make_docs([(i, f"text {i % 7}", "s") for i in range(300)])
    a = sharding.shard_rows(docs.repartition(3), 8).select("doc_id", "shard", "slot").collect()
    b = sharding.shard_rows(docs.repartition(11), 8).select("doc_id", "shard", "slot").collect()
    assert sorted(a) == sorted(b)


@pytest.mark.parametrize("n", [0, 1, 2, 17, 40])
def test_edges(spark, make_docs, n):
    rows = [(None if i % 3 == 0 else 5, None if i % 2 else "", "s", 9) for i in range(n)]
    out = sharding.shard_rows(make_docs(rows, ", shard int"), 16).collect()
    places = sorted((r.shard, r.slot) for r in out)
    assert places == sorted((p % 16, p // 16) for p in range(n))


def test_no_shards(make_docs):
    with pytest.raises(ValueError):
        sharding.shard_rows(make_docs([(1, "a", "s")]), 0)
