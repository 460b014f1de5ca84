import hashlib
import math
from collections import Counter, defaultdict

import pytest
from ledgerline.llm import mixing, queries

from brute import space_words


def brute(rows, target=mixing.TARGET_ENTROPY, repeats=mixing.MAX_REPEATS, budget=None, seed=29):
    """(doc_id, source, copies, tokens, block, position) over (doc_id, text, source) rows, by trying every exponent."""
    units = Counter((d, hashlib.md5(t.encode()).hexdigest() if t is not None else "null", s) for d, t, s in rows)
    size = {(d, hashlib.md5(t.encode()).hexdigest() if t is not None else "null", s): len(space_words(t)) for d, t, s in rows}
    total = defaultdict(int)
    for u, n in units.items():
        total[u[2]] += n * size[u]
    live = {s: n for s, n in total.items() if n}
    exponent = 1.0
    if len(live) > 1:
        whole = sum(live.values())

        def entropy(a):
            w = [(n / whole) ** a for n in live.values()]
            return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

        steps = [i / mixing.GRID for i in range(mixing.GRID + 1)]
        wide = max((a for a in steps if entropy(a) >= target * math.log(len(live)) - 1e-9), default=0)
        low = min((a for a in steps if (max(live.values()) / min(live.values())) ** (1 - a) <= repeats + 1e-9), default=1)
        exponent = max(wide, low)
    power = sum(n ** exponent for n in live.values())
    whole = budget if budget is not None else max((n ** (1 - exponent) for n in live.values()), default=1) * power
    out = []
    for source, tokens in total.items():
        mine = [u for u in units if u[2] == source]
        quota = math.floor(round(tokens ** exponent / power * whole, 3) + 0.0005) if tokens else 0
        for block in range(math.ceil(quota / tokens) if tokens else 1):
            used, position = block * tokens, 0
            for u in sorted(mine, key=lambda u: hashlib.md5(f"{seed}/{block}/{'null' if u[0] is None else u[0]}/{u[1]}".encode()).hexdigest()):
                if not tokens or used < quota or (block + 1) * tokens <= quota:
                    out.append((u[0], source, units[u], units[u] * size[u], block, position))
                used += units[u] * size[u]
                position += units[u]
    return sorted(out, key=repr), exponent


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "source", "copies", "tokens", "block", "position").collect()), key=repr)


def rows_of(spark, sf_dir):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_query(spark, sf_dir):
    assert got(queries.op1_temperature_mixing(spark, sf_dir)) == brute(rows_of(spark, sf_dir))[0]


def skewed():
    sizes = {"big": 120, "mid": 30, "small": 11, None: 4}
    rows = [(i, " ".join(["w"] * (1 + i % 7)), s) for s, n in sizes.items() for i in range(n)]
    return rows + [(None, None, "silent"), (5, "", "silent"), (900, None, "small"), (3, "w w w w", "mid"), (3, "w w w w", "mid"), (901, "é é", "big")]


@pytest.mark.parametrize("options", [{}, {"max_repeats": 2.0}, {"max_repeats": 50.0}, {"max_repeats": 50.0, "target_entropy": 0.7},
                                     {"budget_tokens": 100}, {"budget_tokens": 0}, {"target_entropy": 1.0, "max_repeats": 1e9}])
def test_skewed_sources(make_docs, options):
    rows = skewed()
    docs = make_docs([(*r, 1) for r in rows], ", tokens int")
    names = {"max_repeats": "repeats", "target_entropy": "target", "budget_tokens": "budget"}
    want, _ = brute(rows, **{names[k]: v for k, v in options.items()})
    assert got(mixing.mix(docs, **options)) == want


def test_targets_are_met(make_docs):
    rows = skewed()
    out = got(mixing.mix(make_docs(rows), max_repeats=3.0))
    have, laid = Counter(), Counter()
    for _, t, s in rows:
        have[s] += len(space_words(t))
    for _, s, _, tokens, _, _ in out:
        laid[s] += tokens
    assert all(have[s] <= laid[s] <= 3 * have[s] + 7 for s in have if have[s])
    assert {d for d, _, _ in rows} == {r[0] for r in out}


def test_documents_are_repeated(make_docs):
    rows = skewed()
    docs = make_docs([(*r, 1) for r in rows], ", tokens int")
    out = mixing.mixed_documents(docs, max_repeats=2.0)
    assert out.columns == docs.columns
    want = Counter()
    for d, s, copies, _, _, _ in brute(rows, repeats=2.0)[0]:
        want[(d, s)] += copies
    assert Counter((r.doc_id, r.source) for r in out.collect()) == want


def test_small_tables(make_docs):
    assert mixing.mix(make_docs([])).count() == 0 and mixing.mixed_documents(make_docs([])).count() == 0
    assert got(mixing.mix(make_docs([(1, "a b", "s")]))) == [(1, "s", 1, 2, 0, 0)]
    assert mixing.mixed_documents(make_docs([(1, None, None), (2, "", None)])).count() == 2


def test_every_source_once_at_any_size(spark):
    """Budgets of sources far beyond the exactness of doubles' products."""
    rows = [(f"s{i}", 1, 10**14 + 7_919 * i * i + 1) for i in range(200)] + [("big", 1, 9 * 10**15 + 1)]
    totals = spark.createDataFrame(rows, "source string, docs long, tokens long")
    for exponent in (0.3, 0.55, 0.7):
        assert mixing.target_budgets(totals, exponent).filter("budget < tokens").count() == 0
