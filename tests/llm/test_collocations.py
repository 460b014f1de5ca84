import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import collocations as co


def pieces(text):
    for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
        words = re.findall(r"[^ \t]+", piece)
        if words:
            yield words


def brute_counts(rows):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            total[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    return counts, total


def brute(rows, min_count=30, contained=80, top=2000):
    counts, total = brute_counts(rows)
    out = []
    for lang, f in counts.items():
        most = Counter()
        for p, a in f.items():
            if len(p) > 2 and a >= min_count:
                for size in range(2, len(p)):
                    for i in range(len(p) - size + 1):
                        most[p[i:i + size]] = max(most[p[i:i + size]], a)
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < min_count or (p in most and 100 * most[p] >= contained * a):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def mined(df, **kw):
    return sorted(tuple(r) for r in co.mine(df, **kw).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(6000)]
    passage = "it is a truth universally acknowledged that a rich man wants a wife"
    out = []
    for i in range(300):
        text = ""
        for _ in range(rng.randrange(1, 8)):
            at, n = rng.randrange(5900), rng.randrange(1, 30)
            text += " ".join(words[at:at + n]) + rng.choice([".", ",", " ; ", "\n", "!", "?\x0b", ":\r\n", "\t"])
            if rng.random() < 0.2:
                text += " " + passage.upper() + rng.choice([" ", ". "])
        out.append((text, ["en", "fr", None][i % 3]))
    out += [("new york new york new york", "en")] * 40 + [("Ünder Über", "de")] * 31 + [("ünder über", "de")]
    return out + [(None, "en"), ("", "fr"), (" .,; ", None), ("a " * 5000, "en"), ("a", "xx"), ("only here once", "xx")]


SCHEMA = "text string, lang string, phrase string, n long, head string, node string"


def test_phrases_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, "p", 1, "h", "n") for r in rows], SCHEMA).repartition(7)
    assert mined(df) == brute(rows)
    assert len(brute(rows)) > 50


@pytest.mark.parametrize("min_count,contained,top", [(2, 80, 2000), (5, 50, 10), (300, 100, 5)])
def test_parameters(spark, rows, min_count, contained, top):
    df = spark.createDataFrame(rows, "text string, lang string")
    assert mined(df, min_count=min_count, contained=contained, top=top) == brute(rows, min_count, contained, top)


def test_full_sketch_changes_nothing(spark, monkeypatch, rows):
    """With so few counters that nearly every pair seems frequent, nothing is cut and the result is the same."""
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    expected = brute(rows)
    assert mined(df, sketch_bits=16) == expected
    monkeypatch.setattr(co, "sketch", lambda rows, min_count, bits, pairs=None: np.full(1 << (bits - 3), 255, dtype=np.uint8))
    assert mined(df) == expected


def test_counts_come_from_flow(spark, rows):
    """Counts of one to four words and of all words, each language apart."""
    df = spark.createDataFrame(rows, "text string, lang string")
    counts, total = brute_counts(rows)
    expected = {(lang, " ".join(p)): n for lang, f in counts.items() for p, n in f.items() if n >= 10}
    expected |= {(lang, None): n for lang, n in total.items()}
    assert {(r.lang, r.phrase): r.n for r in co.phrase_counts(df, min_count=10).collect()} == expected


def test_sketch_never_undercounts(spark):
    rng = random.Random(2)
    rows = [(" ".join(f"v{min(30, int(rng.paretovariate(0.8)))}" for _ in range(50)), rng.choice("ab")) for _ in range(60)]
    df = spark.createDataFrame(rows, "text string, lang string").select("lang", "text").repartition(4)
    bits = co.sketch(df, 5)
    longer = co.sketch(df, 5, pairs=spark.sparkContext.broadcast(bits))
    assert bits.nbytes * 8 == longer.nbytes * 8 == 1 << co.SKETCH_BITS
    places = co.Places(pa.array([lang for _, lang in rows]), pa.array([t for t, _ in rows]))
    counts = Counter((lang, *text.split()[i:i + k]) for text, lang in rows for k in range(1, 5) for i in range(51 - k))
    frequent = [co._is_set(b, at) for b, at in zip((bits, bits, longer, longer), places.counters(co.SKETCH_BITS), strict=True)]
    names = [places.words[int(w)].as_py() for w in places.ids]
    room = places.room(places.joined)
    seen = Counter()
    for i, lang in enumerate(places.lang):
        for k in range(room[i]):
            phrase = (places.langs[int(lang)].as_py(), *names[i:i + k + 1])
            pairs_pass = all(counts[(phrase[0], *names[j:j + 2])] >= 5 for j in range(i, i + k))
            # no collisions among so few; longer ones are counted where all pairs pass only
            assert frequent[k][i] == (counts[phrase] >= 5 and (k < 2 or pairs_pass))
            seen[k, bool(frequent[k][i])] += 1
    assert all(seen[k, known] for k in (1, 2, 3) for known in (True, False))


def test_unary_paths(spark):
    passage = "one two three four five six seven eight nine"
    other = "two three four zero"
    counts = co.phrase_counts(spark.createDataFrame([(passage, "en")] * 30 + [(other, "en")] * 5, "text string, lang string"), min_count=5)
    got = defaultdict(list)
    for r in sorted(co.paths(counts).collect(), key=lambda r: (r.path, r.place)):
        got[r.path].append((r.place, r.phrase.split()[-1], r.n))
    # "two three four" has two edges out, so paths end and begin there
    assert dict(got) == {"one two three four": [(0, "four", 30)], "two three four zero": [(0, "zero", 5)],
                         "two three four five": [(0, "five", 30), (1, "six", 30), (2, "seven", 30), (3, "eight", 30), (4, "nine", 30)]}
    nodes = {r.node for r in co.unary_nodes(counts).collect()}
    assert nodes == {"three four five", "four five six", "five six seven", "six seven eight"}


def test_unary_cycle_ends(spark):
    counts = spark.createDataFrame([("en", p, 9) for p in ("a b c d", "b c d a", "c d a b", "d a b c", "a b c", "b c d", "c d a", "d a b")],
                                   "lang string, phrase string, n long")
    assert sorted((r.path, r.place) for r in co.paths(counts).collect()) == [
        ("a b c d", 0), ("b c d a", 0), ("c d a b", 0), ("d a b c", 0)]


def test_empty_table(spark):
    df = spark.createDataFrame([(None, "en"), ("", None), (" . ", "en")], "text string, lang string")
    assert mined(df) == [] and mined(df.limit(0)) == []


def test_query_equals_brute_force(spark, sf_dir):
    from ledgerline.llm.queries import queries
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang").collect()]
    got = queries()["op12_phrase_collocations"](spark, sf_dir).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(tuple(r) for r in got) == brute(rows)
