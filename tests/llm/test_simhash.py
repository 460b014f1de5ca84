import itertools
import random

import pytest
from ledgerline.llm import queries, simhash

import brute


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_position_sets_meet_every_five():
    sets = [set(s) for s in simhash.position_sets()]
    assert len(sets) == 14 and all(len(s) == 4 for s in sets)
    assert all(any(s <= set(five) for s in sets) for five in itertools.combinations(range(8), 5))


def test_query_against_all_pairs(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(queries.op5_simhash_near_dedup(spark, sf_dir)) == sorted(brute.near_groups(docs))


def test_links_are_whole(spark):
    rng = random.Random(4)
    values = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        values.add(base)
        for _ in range(12):
            v = base
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << b
            values.add(v)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    want = {tuple(sorted((signed[a], signed[b]))) for a, b in itertools.combinations(values, 2)
            if (a ^ b).bit_count() <= 3}
    assert {tuple(r) for r in simhash.links(df, 3).collect()} == want


def test_components_of_a_long_chain(spark):
    nodes = list(range(400))
    random.Random(1).shuffle(nodes)
    edges = [tuple(sorted(e)) for e in zip(nodes, nodes[1:])] + [(1000, 1001), (1000, 1002)]
    found = dict(tuple(r) for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert found == {n: 0 for n in range(1, 400)} | {1001: 1000, 1002: 1000}


def edge_rows():
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return [(7, None), (3, ""), (9, " \t\n"), (None, "one two three four"), (4, "ONE two\tthree four"), (4, "one two three four"),
            (None, None), (11, "é É"), (12, "É é"), (20, long), (21, long), (20, long)]


def test_edges(spark, make_docs, save):
    rows = edge_rows()
    docs = make_docs([(i, t, "s", 1) for i, t in rows], ", fp int")
    sf_dir = save(documents=docs)
    order = lambda x: sorted(x, key=repr)
    out = [tuple(r) for r in queries.op5_simhash_near_dedup(spark, sf_dir).collect()]
    assert order(out) == order(brute.near_groups(rows))


def test_keep_one(spark, make_docs):
    rows = edge_rows()
    docs = make_docs([(i, t, "s", 1) for i, t in rows], ", fp int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text and r.text[:3]) for r in kept.collect()) == sorted(
        [(3, ""), (4, next(r.text for r in kept.collect() if r.doc_id == 4)[:3]), (11, "é É"), (12, "É é"), (20, "w0 ")])


def test_only_missing_ids(make_docs):
    kept = simhash.keep_one(make_docs([(None, "a b c d", "s"), (None, "a b c d", "s"), (None, "x y z", "t")]))
    assert sorted(r.text for r in kept.collect()) == ["a b c d", "x y z"]


def test_empty(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.keep_one(make_docs([])).count() == 0


def test_distance_bound(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def groups_of(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    found = {}
    for x in parent:
        found.setdefault(root(x), set()).add(x)
    return sorted(map(sorted, found.values()))


@pytest.mark.parametrize("block", [4, 1024])
def test_ties_connect_what_links_connect(spark, monkeypatch, block):
    """Dense clusters, and many fingerprints that share four bytes: the same components, few rows."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(6)
    values = {rng.getrandbits(64) for _ in range(100)}
    for _ in range(4):
        base = rng.getrandbits(64)
        for _ in range(60):
            v = base
            for b in rng.sample(range(64), rng.randint(0, 2)):
                v ^= 1 << b
            values.add(v)
    values |= {0xABCDEF12 << 32 | rng.getrandbits(12) for _ in range(150)}
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long").repartition(4)
    all_pairs = [(signed(a), signed(b)) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3]
    tied = [tuple(r) for r in simhash.ties(df, 3).collect()]
    assert set(map(tuple, map(sorted, tied))) <= set(map(tuple, map(sorted, all_pairs)))
    assert groups_of(tied) == groups_of(all_pairs)
    if block == 1024:
        assert len(tied) < len(all_pairs) / 3


def test_hot_list_grows_with_its_members(spark):
    """Distinct fingerprints that share four bytes: a fifth byte cuts the list, so work does not grow with its square."""
    import time
    took = []
    for n in (20_000, 40_000):
        rng = random.Random(n)
        rows = [(signed(0x12345678 << 32 | v),) for v in rng.sample(range(1 << 32), n)]
        df = spark.createDataFrame(rows, "fp long").cache()
        df.count()
        start = time.perf_counter()
        simhash.ties(df, 3).count()
        took.append(time.perf_counter() - start)
        df.unpersist()
    assert took[1] < 3 * took[0] + 2


def test_keys_of_any_type(spark, make_docs):
    docs = make_docs([(1, "a b c d", "s"), (2, "a b c d", "s"), (3, "x y z", "t")]).selectExpr("concat('k', doc_id) as id", "text", "source")
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, key="id").collect()}
    assert groups == {"k1": "k1", "k2": "k1", "k3": "k3"}
    assert sorted(r.id for r in simhash.keep_one(docs, key="id").collect()) == ["k1", "k3"]
