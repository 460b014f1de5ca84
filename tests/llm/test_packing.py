import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from ledgerline.llm import packing, queries


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 70), st.data())
def test_best_fit_decreasing(width, data):
    lengths = data.draw(st.lists(st.integers(1, width), max_size=60))
    rows = packing.best_fit_decreasing(lengths, width)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    space = []  # plain search over all rows
    for n in sorted(lengths, reverse=True):
        fits = [s for s in space if s >= n]
        if fits:
            space[space.index(min(fits))] -= n
        else:
            space.append(width - n)
    assert sorted(width - sum(lengths[i] for i in r) for r in rows) == sorted(space)


def check_rows(rows, docs, width):
    coder = packing.tokenizer(packing.load_vocabulary())
    pieces = {}
    for r in rows:
        ids, positions = np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["positions"], "<i4")
        ends = r["cu_seqlens"]
        assert len(ids) == len(positions) == width and ends[0] == 0 and ends == sorted(set(ends)) and ends[-1] <= width
        assert len(ends) == len(r["doc_ids"]) + 1 == len(r["pieces"]) + 1
        assert (ids[ends[-1]:] == packing.PAD_ID).all()
        for a, b, doc, piece in zip(ends, ends[1:], r["doc_ids"], r["pieces"]):
            assert positions[a:b].tolist() == list(range(b - a))
            pieces.setdefault(doc, []).append((piece, ids[a:b].tolist()))
    got = []
    for doc, found in pieces.items():
        ids = [i for _, part in sorted(found) for i in part]
        assert doc is None or ids.count(packing.END_ID) == sum(d == doc for d, _ in docs)
        if [p for p, _ in sorted(found)] == list(range(len(found))):
            got.append((doc, coder.decode(ids[:-1])))
    return got


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = queries.op9_token_packing(spark, sf_dir).collect()
    assert sorted(check_rows(rows, docs, packing.WIDTH)) == sorted(docs)
    used = sum(r.cu_seqlens[-1] for r in rows)
    assert used / (len(rows) * packing.WIDTH) > 0.97


def test_edges(spark, make_docs):
    docs = [(1, None), (2, ""), (3, "word " * 5000), (4, "é😀 <|endoftext|>"), (5, "x" * 20_000), (6, " \n"), (8, "a" + " " * 1_500_000 + "b"),
            (9, "\n" * 900_000)]
    df = make_docs([(i, t, "s", 1) for i, t in docs], ", ids int").coalesce(1)
    rows = packing.pack(spark, df, width=64, block_ids=1000).collect()
    assert sorted(check_rows(rows, docs, 64)) == sorted((i, t or "") for i, t in docs)
    again = packing.pack(spark, df, width=64, block_ids=1000).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_repeats_and_missing_ids(spark, make_docs):
    rows = packing.pack(spark, make_docs([(None, "a b", "s"), (7, "a b", "s"), (7, "a b", "s")]).coalesce(1), width=8).collect()
    assert sorted((d is None, d) for r in rows for d in r.doc_ids) == [(False, 7), (False, 7), (True, None)]


def test_empty(spark, make_docs):
    assert packing.pack(spark, make_docs([])).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark, make_docs([]), width=0)


def test_long_white_space_has_the_ids_of_the_uncut_text():
    coder, n = packing.tokenizer(packing.load_vocabulary()), packing.MAX_SPACE_RUN
    for space in (" ", "\n", " \n", "　", "\t "):
        for size in (n - 1, n, n + 1, 2 * n + 3):
            run = (space * size)[:size]
            for text in (f"a{run}b", f"{run}b", f"a {run}", run, f"a{run}, b{run}\x1c1"):
                assert packing.encode(coder, text).tolist() == coder.encode(text, disallowed_special=()), (space, size)
