"""The whole pipeline against plain Python, stage after stage."""

import itertools
import random
import re
import unicodedata
from collections import Counter

import brute
import corpus_pipeline
import pytest
from ledgerline.llm import line_quality as lq
from ledgerline.llm.common import cut
from test_mixing import brute as plain_mix

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def line_fails(line):
    words = brute.space_words(line)
    if not words:
        return False
    visible = sum(map(len, words))
    gone = lambda pattern: re.sub(pattern, "", line, flags=re.ASCII)
    bare = ["".join(c for c in w if unicodedata.category(c)[0] in "LN").lower() for w in words]
    marks = sum(w in lq.MENU_SEPARATORS for w in words)
    return (len(line) - len(gone(lq.ODD_MARKS)) > lq.MAX_ODD_MARKS * visible
            or (len(words) < lq.FRAGMENT_WORDS and not re.search(lq.LINE_END, line, re.ASCII))
            or (marks >= lq.MIN_SEPARATORS and marks * lq.WORDS_PER_SEPARATOR >= len(words))
            or any(any(w in entries for w in bare) and all(w in entries + beside for w in bare if w) for entries, beside in lq.MENUS.values())
            or (len(words) <= lq.NOTICE_WORDS and bool(re.search(lq.NOTICE, line, re.ASCII)))
            or sum(len(list(g)) * len(w) for w, g in ((w, list(g)) for w, g in itertools.groupby(words)) if len(g) > 2)
            > lq.MAX_STUTTER * visible)


def quality(rows):
    out = []
    for doc, text, source in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if not line_fails(x)]
        lost = sum(sum(map(len, brute.space_words(x))) for x in lines if line_fails(x))
        base = brute.quality_base(text)
        if not base[-1] and lost <= lq.MAX_LOST * base[1]:
            out.append((doc, text if len(stay) == len(lines) else "\n".join(stay), source))
    return out


def dedup(rows):
    groups = {}
    for (doc, text, source), (_, _, component) in zip(rows, brute.near_groups([r[:2] for r in rows])):
        if doc == component:
            groups.setdefault(component, (doc, text, source))
    return list(groups.values())


def clean(rows, items):
    flagged = {r[0] for r in brute.decontamination([r[:2] for r in rows], items) if r[-1]}
    return [r for r in rows if r[0] not in flagged]


def mixed(rows):
    times = Counter(r[0] for r in plain_mix(rows, repeats=corpus_pipeline.MAX_REPEATS)[0])
    return [r for r in rows for _ in range(times[r[0]])]


def plain(rows, items):
    return mixed(clean(dedup(quality(rows)), items))


def check(out, rows, items):
    want = plain(rows, items)
    assert Counter((r.doc_id, r.text, r.source) for r in out) == Counter(want)
    assert all(r.n_chars == len(r.text) for r in out)
    places = sorted((r.shard, r.slot) for r in out)
    assert places == sorted((p % 16, p // 16) for p in range(len(out)))


def test_run(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    df = corpus_pipeline.run(spark, sf_dir)
    assert df.columns == [*COLUMNS, "shard", "slot"]
    check(df.collect(), docs, items)


_rng = random.Random(5)
_WORDS = ["".join(_rng.choices("abcdefghilmnoprstu", k=_rng.randint(2, 9))) for _ in range(500)]
PROSE = [" ".join(_rng.choices(_WORDS, k=40)).capitalize() + "." for _ in range(24)]


def planted():
    rows = [(i, PROSE[i] + " " + PROSE[-1 - i], f"s{i % 3}") for i in range(8)]
    rows += [(100 + i, rows[2][1], "s0") for i in range(20)]                        # copies of document 2
    rows += [(200, "Home | News | Top\nHome | News | About\n" + rows[3][1], "s0")]
    rows += [(300, "Menu | Home | News | About\n" + PROSE[20] + " " + PROSE[9], "s1")]
    rows += [(400, "Question: " + BENCH + " " + PROSE[10], "s1"), (401, " ".join(BENCH.split()[:12]) + ". " + PROSE[11] + PROSE[12], "s1")]
    rows += [(500, None, "s1"), (501, "", None), (502, "### *** $$$ " * 20, "s2"), (503, "few words", "s2"), (None, PROSE[13] + " " + PROSE[14], None)]
    return rows


BENCH = "Which of the seven lakes of the northern valley has the deepest water and the oldest harbour of all?"


def test_planted_cases(spark, make_docs, save):
    rows = planted()
    docs = make_docs([(*r, 7) for r in rows], ", shard int")
    items = [(1, BENCH), (2, "not there at all")]
    sf_dir = save(documents=docs, benchmark=spark.createDataFrame(items, "item_id long, text string"))
    out = corpus_pipeline.run(spark, sf_dir).collect()
    named = [r for r in rows if r[0] is not None]
    ids = {r.doc_id for r in out}
    assert set(range(8)) <= ids and None in ids                                # clean documents stay
    assert not ids & {100, 101, 119, 200, 400, 500, 501, 502, 503} and 401 in ids
    assert {r.text.split("\n")[0] for r in out if r.doc_id == 300} == {PROSE[20] + " " + PROSE[9]}
    assert {r[0] for r in plain(named, items)} == ids - {None}


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_empty_and_awkward_tables(spark, make_docs, save, stage):
    _, run = corpus_pipeline.STAGES[stage]
    items = spark.createDataFrame([(1, BENCH)], "item_id long, text string")
    sf_dir = save(benchmark=items)
    assert run(spark, make_docs([]), sf_dir).count() == 0
    rows = [(None, None, None, 1, None), (None, None, None, 1, None), (1, "", "s", None, "x"), (1, "", "s", None, "x"), (2, "w " * 50_000, "s", 3, "x")]
    clashing = cut(make_docs(rows, ", fp int, n_words string"), "clashing")
    out = run(spark, clashing, sf_dir)
    assert [c for c in out.columns if c not in ("shard", "slot")] == clashing.columns
    out.collect()


#: Names that the stages use inside, in other spellings too.
INTERNAL = ["_found", "kept", "clean_text", "n_words", "lost_chars", "base_failed", "_id", "_HASH", "_nth", "_copy", "_times",
            "_d", "_h", "_s", "row_number", "_n", "_permuted", "_bucket", "_inside", "_start", "_row_hash", "_order", "fp",
            "component_id", "keeper", "text_hash", "Copies", "tokens", "block", "items", "spans", "c0", "C3", "_keep_id"]


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_return_every_column(spark, make_docs, save, stage):
    _, run = corpus_pipeline.STAGES[stage]
    sf_dir = save(benchmark=spark.createDataFrame([(1, BENCH)], "item_id long, text string"))
    rows = [(i, PROSE[i] + " " + PROSE[-1 - i], "s", *(f"{i}/{c}" for c in INTERNAL)) for i in range(6)]
    docs = cut(make_docs(rows, "".join(f", `{c}` string" for c in INTERNAL)), "named")
    out = run(spark, docs, sf_dir)
    assert [c for c in out.columns if c not in ("shard", "slot")] == docs.columns
    got = sorted(tuple(r[c] for c in docs.columns) for r in out.collect())
    assert got == sorted(map(tuple, docs.collect()))
