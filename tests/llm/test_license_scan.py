import math
import os
from collections import Counter

from ledgerline.llm import license_scan as ls
from ledgerline.llm import queries


def brute(rows):
    """(doc_id, path, license, origin, path of the licence, cosine): every line, window and text against every template."""
    total = len(rows)
    seen = Counter(w for _, _, t in rows for w in set(ls.words_of(t)))
    idf = lambda w: 1 + math.log((1 + total) / (1 + seen[w]))
    full = ls.full_texts()
    templates = [(name, ls.words_of(t)) for name, texts in sorted(ls.TEMPLATES.items()) for t in texts]
    norms = {}

    def vector(words):
        return {w: n * idf(w) for w, n in Counter(words).items()}

    vectors = [vector(w) for _, w in templates]
    fulls = [(name, words, vector(words)) for name, words in full.items()]

    def cosine(a, b):
        dot = sum(x * b[w] for w, x in a.items() if w in b)
        for v in (a, b):
            norms[id(v)] = math.sqrt(sum(x * x for x in v.values()))
        return dot and dot / (norms[id(a)] * norms[id(b)])

    def share(words, b):
        return sum(x * x for w, x in b.items() if w in words) / sum(x * x for x in b.values())

    def windows(words, t):
        """Windows of a template's length whose words hold enough of its weight to reach the limit at all."""
        size, b = len(templates[t][1]), vectors[t]
        least, held, holds = 0.999 * ls.NOTICE_COSINE ** 2 * sum(x * x for x in b.values()), Counter(), 0.0
        for i, w in enumerate(words):
            held[w] += 1
            holds += b.get(w, 0.0) ** 2 if held[w] == 1 else 0.0
            if i >= size:
                gone = words[i - size]
                held[gone] -= 1
                holds -= b.get(gone, 0.0) ** 2 if not held[gone] else 0.0
            if holds >= least and (i >= size - 1 or i == len(words) - 1):
                yield max(0, i - size + 1), size

    judged = []
    for _, path, text in rows:
        lines = [ls.words_of(x) for x in (text or "").split("\n")]
        words = [w for line in lines for w in line]
        joined, line_units, file_units = " ".join(words), [], []

        def name(t, found, joined=joined):
            return ls.named(templates[t][0], " ".join(templates[t][1]), found, joined)

        for line in lines:
            for t, b in enumerate(vectors):
                if c := cosine(vector(line), b):
                    line_units.append((c, ls.NOTICE_COSINE, t, name(t, line) if c >= ls.NOTICE_COSINE else None))
        for t, b in enumerate(vectors):
            for at, size in windows(words, t):
                c = cosine(vector(words[at:at + size]), b)
                if c >= ls.NOTICE_COSINE:
                    line_units.append((c, ls.NOTICE_COSINE, t, name(t, words[max(0, at - ls.MARGIN):at + size + ls.MARGIN])))
        whole = vector(words)
        for t, b in enumerate(vectors):
            if c := cosine(whole, b):
                found = name(t, words) if c >= ls.FILE_COSINE and share(whole, b) >= ls.COVERAGE else None
                file_units.append((c, ls.FILE_COSINE, t, None if found == ls.UNKNOWN and c < ls.NOTICE_COSINE else found))
        for k, (licence, found, b) in enumerate(fulls):
            c = cosine(whole, b)
            if c >= ls.FULL_COSINE:
                wording = " ".join(found[:ls.HEAD_WORDS])
                file_units.append((c, ls.FULL_COSINE, len(templates) + k, ls.named(licence, wording, words[:ls.HEAD_WORDS], joined, True)))

        def best(units):
            top = max(((ls.rank_of(x) if round(c, 6) >= least else -1, round(c, 6), -t, x or "") for c, least, t, x in units),
                      default=(-1, 0.0, 0, ""))
            return (top[3] or None) if top[0] >= 0 else None, top[1]

        judged.append((*best(line_units), *best(file_units)))
    folder = lambda p: p.rpartition("/")[0]
    held = {}
    for (_, path, _), (_, _, name, whole) in zip(rows, judged, strict=True):
        if name and path is not None and whole >= ls.FILE_COSINE:
            held.setdefault(folder(path), []).append((-whole, path, name))
    out = []
    for (doc, path, _), (line, line_cosine, name, whole) in zip(rows, judged, strict=True):
        own, top = (name if whole >= ls.WHOLE_COSINE and name else line or name), max(line_cosine, whole)
        if own:
            out.append((doc, path, own, "notice", path, top))
            continue
        at = None if path is None else folder(path)
        while at is not None and at not in held:
            at = folder(at) if at else None
        given = min(held[at]) if at is not None else None
        out.append((doc, path, given and given[2], "inherited" if given else "none", given and given[1], top))
    return out


def got(df):
    return sorted(((r.doc_id, r.path, r.license, r.origin, r.license_path, r.cosine) for r in df.collect()), key=repr)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", queries.document_path().alias("path"), "text").collect()
    found = got(queries.op4_license_scan(spark, sf_dir))
    assert found == sorted(brute([tuple(r) for r in rows]), key=repr)
    notices = {"Apache": "Apache-2.0", "GNU": "GPL-3.0", "CC BY-NC": "CC-BY-NC-4.0", "MIT License": "MIT"}
    for doc, _, name, origin, *_ in found:
        text = next(r.text for r in rows if r.doc_id == doc)
        want = [v for k, v in notices.items() if k in text and "icense" in text]
        assert (origin == "notice" and name == want[0]) if want else origin != "notice"


def test_tree(spark):
    mit, gpl = ls.TEMPLATES["MIT"][0], ls.TEMPLATES["GPL-3.0"][0]
    prose = "the water was cold and we sat by the shore for hours until the moon came up over the far hills " * 3
    rows = [(1, "a/LICENSE", mit), (2, "a/b/c/x.txt", prose), (3, "a/b/COPYING", gpl), (4, "a/x.txt", prose), (5, "x.txt", prose),
            (6, "ab/x.txt", prose), (7, "a/b/y.txt", f"{prose}\n# {mit}\n{prose}"), (8, None, prose), (9, None, mit), (10, "a/b/c", None),
            (10, "a/b/c", None), (None, "/a/b", ""), (12, "a/b/ALSO", gpl), (13, "a/b//c/d", prose), (14, "a/b/c/" + "d/" * 40 + "e", prose)]
    found = got(ls.scan(spark, spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, path string, text string, license string")))
    plain = [r for r in rows if r[0] != 13]
    assert [f for f in found if f[0] != 13] == sorted(brute(rows)[:13] + brute(rows)[14:], key=repr) and len(plain) == len(rows) - 1
    by = {f[0]: f[2:5] for f in found}
    assert by[2] == ("GPL-3.0", "inherited", "a/b/ALSO") and by[4] == ("MIT", "inherited", "a/LICENSE")
    assert by[5] == by[6] == (None, "none", None) and by[7] == ("MIT", "notice", "a/b/y.txt") and by[13][0] == "GPL-3.0"


def test_root_directory_and_long_text(spark):
    rows = [(1, "LICENSE", ls.TEMPLATES["MIT"][0]), (2, "deep/er/x", "word " * 100_000), (3, "/abs/x", "word")]
    found = {f[0]: f[2:4] for f in got(ls.scan(spark, spark.createDataFrame(rows, "doc_id long, path string, text string")))}
    assert found[2] == found[3] == ("MIT", "inherited")


def test_empty(spark):
    assert ls.scan(spark, spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


def test_notice_inside_other_text(spark):
    prose = "the water was cold and we sat by the shore for hours until the moon came up over the far hills " * 4
    texts = [f"{prose}{ls.TEMPLATES[name][0]} {prose}" for name in ("MIT", "Apache-2.0", "GPL-3.0")]
    texts += ["// Copyright 2020 Foo Bar Inc. Released under the MIT License.", prose]
    rows = [(i, f"d{i}/x", t) for i, t in enumerate(texts)] + [(9, "e/x", f"{prose} zebra{i}") for i in range(30)]
    found = {r.doc_id: (r.license, r.origin, r.cosine) for r in
             ls.scan(spark, spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert [found[i][:2] for i in range(5)] == [
        ("MIT", "notice"), ("Apache-2.0", "notice"), ("GPL-3.0", "notice"), ("MIT", "notice"), (None, "none")]
    assert [found[i][2] for i in range(4)] == [1.0] * 4


def test_all_words_weigh_by_their_frequency(spark, monkeypatch):
    """Exact cosines of lines and whole texts, with all weights sent to the tasks and with most by the join."""
    texts = ["released mit xa xb xb", "license xa", "xa xb", "this license xa xc", None, "xa released under", "xa"] + ["xa xd"] * 5
    seen = Counter(w for t in texts for w in set(ls.words_of(t)))

    def vector(text):
        return {w: n * (1 + math.log((1 + len(texts)) / (1 + seen[w]))) for w, n in Counter(ls.words_of(text)).items()}

    def cosine(a, b):
        dot = sum(a[w] * b[w] for w in a.keys() & b.keys())
        return dot and dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    want = [round(max(cosine(vector(x), vector(t)) for ts in ls.TEMPLATES.values() for t in ts), 6) for x in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "'p/' || doc_id path", "text")
    for common in (1 << 14, 1):
        monkeypatch.setattr(ls, "COMMON_WORDS", common)
        got = {r.doc_id: r.cosine for r in ls.scan(spark, df, notice_cosine=0.99, file_cosine=0.99).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_other_licences_and_versions(spark):
    cases = {"This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
             "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
             "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "unknown",
             "This work is licensed under a Creative Commons Attribution 3.0 International License.": "unknown",
             "SPDX-License-Identifier: ISC": "ISC", "SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0",
             "SPDX-License-Identifier: EUPL-1.2": "unknown", "SPDX-License-Identifier: MIT": "MIT",
             "SPDX-License-Identifier: LGPL-2.1-only": "LGPL-2.1"}
    prose = "the water was cold and we sat by the shore for hours until the moon came up over the far hills"
    rows = [(i, f"n{i}/x", t) for i, t in enumerate(cases)] + [(99, "p/x", f"{prose} {i}") for i in range(1000)]
    found = {r.doc_id: r.license for r in ls.scan(spark, spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert {t: found[i] for i, t in enumerate(cases)} == cases


def test_whole_licence_files(spark):
    folder = os.path.join(os.path.dirname(ls.__file__), "licenses")
    texts = {f.removesuffix(".txt"): open(os.path.join(folder, f), encoding="utf-8").read() for f in sorted(os.listdir(folder))}
    affero = texts["GPL-3.0"].replace("GENERAL PUBLIC", "AFFERO GENERAL PUBLIC").replace("General Public", "Affero General Public")
    given = [*texts.items(), ("AGPL-3.0", affero)]
    prose = "the water was cold and we sat by the shore for hours until the moon came up over the far hills"
    rows = [(i, f"n{i}/LICENSE", t) for i, (_, t) in enumerate(given)] + [(100 + i, f"n{i}/src/x", prose) for i in range(len(given))]
    found = {r.doc_id: (r.license, r.origin) for r in
             ls.scan(spark, spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert [found[i] for i in range(len(given))] == [(n, "notice") for n, _ in given]
    assert [found[100 + i] for i in range(len(given))] == [(n, "inherited") for n, _ in given]


def test_short_texts_that_share_a_few_words(spark):
    """A few words of a template are no licence, and nothing is inherited from them."""
    prose = "the water was cold and we sat by the shore for hours until the moon came up over the far hills"
    texts = ["free of charge", "without restriction", "The Apache helicopter was licensed by the state in version 2.0",
             "version 2.0", "MIT", "the general public", "this software is free", "under the terms of the", "Released under the MIT License."]
    rows = [(i, f"d{i}/LICENSE", t) for i, t in enumerate(texts)] + [(100 + i, f"d{i}/src/x", f"{prose} {i}") for i in range(len(texts))]
    rows += [(1000 + i, f"z/{i}", f"{prose} of the charge free to deal in version {i}") for i in range(200)]
    found = got(ls.scan(spark, spark.createDataFrame(rows, "doc_id long, path string, text string")))
    assert found == sorted(brute(rows), key=repr)
    by = {f[0]: f[2:4] for f in found}
    assert all(by[i] == by[100 + i] == (None, "none") for i in range(len(texts) - 1))
    assert by[len(texts) - 1] == ("MIT", "notice") and by[100 + len(texts) - 1] == ("MIT", "inherited")


def test_open_words_go_out_once_a_row(spark, monkeypatch):
    """Words without weights in the tasks: the same result, each distinct word of a row sent once."""
    prose = "the water was cold and we sat by the shore for hours until the moon came up over the far hills of the"
    rows = [(i, f"d{i % 3}/x{i}", "\n".join(f"{prose} rare{i}a{k} rare{i}b" for k in range(4)) + f"\n{ls.TEMPLATES['MIT'][0]} rare{i}b")
            for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    want = sorted(brute(rows), key=repr)
    for common in (1, 8, 1 << 20):
        monkeypatch.setattr(ls, "COMMON_WORDS", common)
        assert got(ls.scan(spark, df)) == want


def test_clashing_and_missing_columns(spark):
    rows = [(1, "a/x", ls.TEMPLATES["MIT"][0], "u", 3, "w"), (1, "a/x", ls.TEMPLATES["MIT"][0], "u", 3, "w"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, units string, row int, weights string")
    assert [f[:4] for f in got(ls.scan(spark, df))] == [(1, "a/x", "MIT", "notice")] * 2 + [(None, None, None, "none")]
