import random
import time

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import minhash as mh

DOC = "doc_id long, text string, source string, node long, bucket string, root string, first string"


def shingles(text, width=4):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, percent=80):
    """(doc_id, n_shingles, component) of each row: every pair that shares a shingle is compared in full."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    lists = {}
    for i, s in enumerate(sets):
        for g in s:
            lists.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        tally = {}
        for g in s:
            for j in lists[g]:
                if j < i:
                    tally[j] = tally.get(j, 0) + 1
        for j, shared in tally.items():
            if 100 * shared >= percent * (len(s) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def found(df, **kw):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in mh.near_duplicates(df, **kw).collect()), key=str)


def changed(rng, words, share):
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    fresh = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    out, passage = [], fresh(120)
    for _ in range(20):  # near copies around the limit, and of copies
        base = fresh(rng.randrange(30, 300))
        out += [" ".join(base)] + [changed(rng, base, rng.choice([0.005, 0.02, 0.04, 0.06])) for _ in range(6)]
    chain = fresh(100)  # neighbours are alike, the ends are not
    for k in range(12):
        out.append(" ".join(chain[k * 6:k * 6 + 60]))
    out += [" ".join(passage + fresh(rng.randrange(20, 200))) for _ in range(60)]  # share a passage only
    out += ["one two three", "One TWO three", "one two", "x", "x", None, "", " \n", None, "É a b c d", "é a b c d"]
    out += [" ".join(fresh(5))] * 30 + ["long " * 3000, " ".join(fresh(20_000))]
    table = [(i * 7 % 1009, t) for i, t in enumerate(out)]
    return table + [table[0], table[5], (None, out[3]), (None, "nobody else has this text"), (None, None)]


def test_components_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(i, t, "s", 1, "b", "r", "f") for i, t in rows], DOC).repartition(5)
    assert found(df) == brute(rows)


def test_other_parameters(spark, rows):
    df = spark.createDataFrame(rows, "k long, body string")
    assert found(df, percent=95, key="k", text="body") == brute(rows, 95)
    with pytest.raises(ValueError):
        mh.near_duplicates(df, percent=70)


def test_empty_table_and_no_words(spark):
    df = spark.createDataFrame([(3, None), (4, ""), (5, "\t")], "doc_id long, text string")
    assert found(df) == [(3, 0, 3), (4, 0, 4), (5, 0, 5)]
    assert found(df.limit(0)) == []


def test_mixed_hot_buckets_in_blocks(spark, monkeypatch, rows):
    """Buckets larger than a block are dealt out and lose no link."""
    monkeypatch.setattr(mh, "BLOCK", 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)


def test_star_misses_are_found_across(spark):
    """Two groups whose members meet the smallest node of a bucket below the limit still meet each other."""
    rng = random.Random(11)
    base = [f"b{rng.randrange(3000)}" for _ in range(200)]
    docs = [(i, changed(rng, base, 0.035)) for i in range(60)]  # similarities on both sides of the limit
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    for similarity in (0.3, 0.8, 0.95):
        agree = []
        for _ in range(40):
            values = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
            both = int(1000 * similarity)
            rest = (1000 - both) // 2
            a, b = values[:both + rest], np.concatenate([values[:both], values[both + rest:]])
            agree.append((mh.signature(a) == mh.signature(b)).mean())
        assert abs(np.mean(agree) - similarity) < 0.02


def test_signatures_of_many_sets_at_once(monkeypatch):
    """Blocks hold many sets, and parts of one; each row is the plain minimum of every hash function over its set."""
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 1 << 64, n, dtype=np.uint64) for n in (1, 2, 9, 40, 1, 1, 16, 8, 3)]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    a, b = mh._coefficients()
    plain = np.array([(s[:, None] * a + b).min(axis=0) for s in sets])
    for block in (1, 8, 81, 1 << 15):
        monkeypatch.setattr(mh, "HASH_BLOCK", block)
        assert (mh.minima(np.concatenate(sets), starts) == plain).all()
        assert all((mh.signature(s) == row).all() for s, row in zip(sets, plain, strict=True))
    assert mh.minima(np.empty(0, dtype=np.uint64), np.array([0])).shape == (0, mh.HASHES)


def test_signatures_cost_by_shingles_not_by_texts():
    values = np.random.default_rng(5).integers(0, 1 << 64, 200_000, dtype=np.uint64)

    def seconds(starts):
        took = []
        for _ in range(3):
            began = time.process_time()
            mh.minima(values, starts)
            took.append(time.process_time() - began)
        return min(took)

    # calls of numpy for each set and function would take over ten times as long
    assert seconds(np.arange(0, 200_001, 100)) < 5 * seconds(np.array([0, 200_000]))


def test_rows_without_words_beside_others():
    """Their size and sums are 0, bands and signature null; the rows around them keep their own."""
    texts = [None, "a b c d e", "", " ", "x", None]
    values, starts = mh.shingle_sets(pa.array(texts), 4)
    ours = [mh.signature(values[starts[i]:starts[i + 1]]) for i in (1, 4)]
    table = pa.table({"doc_id": list(range(6)), "text_hash": list(range(6)), "text": texts})
    rows = [r for out in mh.signed_batches(iter(table.to_batches()), 4) for r in out.to_pylist()]
    assert [r["n_shingles"] for r in rows] == [0, 2, 0, 0, 1, 0]
    assert [r["sum_a"] == 0 and r["bands"] is None and r["signature"] is None for r in rows] == [True, False, True, True, False, True]
    for row, least in zip((rows[1], rows[4]), ours, strict=True):
        assert row["bands"] == mh.buckets(least)[0].tolist()
        assert row["signature"] == mh._mix(least).astype(np.uint8).tobytes()


def test_sets_are_those_of_words():
    texts = ["a b c d e a b c d", "a", None, " a  b\tc\x0bD ", "ab c", "a bc"]
    values, starts = mh.shingle_sets(pa.array(texts), 4)
    assert np.diff(starts).tolist() == [5, 1, 0, 1, 1, 1]
    assert len(np.unique(values)) == 8  # "a b c d" twice
    texts = ["x y z"] * 3 + ["X y Z"]
    assert len(np.unique(mh.shingle_sets(pa.array(texts), 4)[0])) == 1


def test_query_equals_brute_force(spark, sf_dir):
    from ledgerline.llm.queries import queries
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries()["op11_minhash_near_dedup"](spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and not all(r.kept for r in got)
