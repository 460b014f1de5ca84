import random

import numpy as np
import brute
from hypothesis import given, settings
from hypothesis import strategies as st
from ledgerline.llm import fm_decontam, queries


def texts(spark, sf_dir, name, key):
    return [(r[key], r["text"]) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]


def test_query_against_plain_search(spark, sf_dir):
    got = sorted(tuple(r) for r in queries.op3_fm_decontamination(spark, sf_dir).collect())
    want = sorted(brute.decontamination(texts(spark, sf_dir, "documents", "doc_id"), texts(spark, sf_dir, "benchmark", "item_id")))
    assert got == want and any(r[5] for r in got)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(symbols):
    text = np.array([*symbols, 0])
    barriers = np.cumsum(text == 0)
    key = [(0, int(b)) if s == 0 else (1, int(s)) for s, b in zip(text, barriers)]
    assert fm_decontam.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: key[i:])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=6), max_size=8))
def test_search_and_locate(symbols, patterns):
    text = np.array([*symbols, 0])
    index = fm_decontam.FMIndex(text, 3)
    wide = np.zeros((len(patterns), 6), dtype=np.int64)
    for i, p in enumerate(patterns):
        wide[i, 6 - len(p):] = p
    low, high = index.search(wide, np.array([len(p) for p in patterns], dtype=np.int64))
    for i, p in enumerate(patterns):
        want = [j for j in range(len(text)) if text[j:j + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(low[i], high[i])).tolist()) == want


def edge_tables(spark, make_docs):
    rng = random.Random(3)
    w = [f"w{i}" for i in range(40)]
    item = " ".join(w[:20])
    items = [(1, item), (2, item.upper()), (10, "short item"), (None, "w1 w2 w3"), (3, None), (4, " .,- "), (5, "été naïf"),
             (1, " ".join(w[20:34]))]
    filler = " ".join(rng.choice(w) for _ in range(40_000))
    docs = [(1, item), (1, item), (None, f"a {item} b"), (2, None), (3, ""), (4, "!!! ..."), (5, "Short, ITEM!"), (6, "short x item"),
            (7, "ÉTÉ naïf"), (8, "été--naïf"), (9, filler + " " + " ".join(w[20:34])), (10, item + " " + item),
            (11, " ".join(["x"] * 259) + " " + " ".join(w[2:15])), (12, " ".join(["x"] * 247) + " " + " ".join(w[2:15]))]
    return (docs, items, make_docs([(i, t, "s", "a") for i, t in docs], ", n_hit string"),
            spark.createDataFrame(items, "item_id long, text string"))


def test_edges(spark, make_docs, save):
    docs, items, doc_df, item_df = edge_tables(spark, make_docs)
    got = [tuple(r) for r in queries.op3_fm_decontamination(spark, save(documents=doc_df, benchmark=item_df)).collect()]
    assert sorted(got, key=repr) == sorted(brute.decontamination(docs, items), key=repr)
    flags = {r[0]: r[5] for r in got}
    assert not flags[11] and flags[12]


def test_many_blocks_and_shards(spark, make_docs):
    docs, items, doc_df, item_df = edge_tables(spark, make_docs)
    whole = fm_decontam.scan(spark, doc_df.coalesce(1), item_df)
    split = fm_decontam.scan(spark, doc_df.coalesce(1), item_df, block_bytes=1, shard_words=30)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, split.collect()))


def test_stage_keeps_clean_rows_as_they_are(spark, make_docs):
    _, _, doc_df, item_df = edge_tables(spark, make_docs)
    kept = fm_decontam.decontaminate(spark, doc_df, item_df)
    assert kept.columns == doc_df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6, 7, 9, 11]  # 7: É stays, only A-Z is lowered


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert fm_decontam.decontaminate(spark, make_docs([(1, "a b", "s")]), none).count() == 1
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert fm_decontam.scan(spark, make_docs([]), items).count() == 0


def test_clean_text():
    assert fm_decontam.clean_text("A b, c! d é.", [1, 3]) == "A  d é."[:2] + "! d é."
    assert fm_decontam.clean_text("x y", []) == "x y" and fm_decontam.clean_text(None, [0, 1]) is None


def test_ten_blocks_run_one_pass_at_a_time(spark, make_docs):
    """No plan holds two passes, and the blocks together find what one block does."""
    docs, items, df, bench = edge_tables(spark, make_docs)
    more = [(100 + i, f"extra item {i} " + " ".join(f"w{(i * 3 + k) % 40}" for k in range(15))) for i in range(10)]
    bench = bench.unionByName(spark.createDataFrame(more, "item_id long, text string").select(*bench.columns))
    assert len(list(fm_decontam.item_blocks(bench, "item_id", "text", 64))) >= 10
    split = fm_decontam.verdicts(fm_decontam.scan(spark, df, bench, block_bytes=64))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    columns = ["doc_id", "n_words", "n_hit", "n_items", "contaminated"]
    whole = fm_decontam.verdicts(fm_decontam.scan(spark, df, bench))
    rows = lambda x: sorted(map(str, x.select(*columns).collect()))
    assert rows(split) == rows(whole)


def test_blocks_are_measured_in_bytes(spark):
    bench = spark.createDataFrame([(i, "é" * 10) for i in range(4)], "item_id long, text string")
    assert [len(b) for b in fm_decontam.item_blocks(bench, "item_id", "text", 40)] == [2, 2]
