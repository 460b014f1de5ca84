"""Licence of every file: its own notice, or that of the nearest directory above.

1. Texts are compared with licence templates by the cosine of sparse TF-IDF
   vectors over words. Each line of a file is compared, each window of a
   template's length that slides over the whole text (a notice inside other
   text), and the file as a whole (a licence file; it must also hold words that make
   up ``COVERAGE`` of the template's squared weight, so that a few shared words of a short text
   are no licence). Document frequencies of all words are counted over all
   documents. Lines and files of a slice of texts are scored as sparse products in
   numpy where they are, with the frequencies of the template words and the
   ``COMMON_WORDS`` commonest words (a sorted array of word hashes, 12 MB for a million words);
   only lines, windows and texts that can still be the best of their file keep their
   other words open. The distinct open words of a row go to a join with the
   frequencies once, and come back as one row. The cosine returned is the best
   of these; windows below the notice limit are left out of it.
2. A file close to a template as a whole is the licence file of its directory.
   Directories are made distinct, spread out to their ancestors (one row per
   level) and joined by path with the directories that have a licence file;
   the deepest match is the nearest. Files then take their directory's licence.

3. A licence is named by its version or identifier: near a template of another
   version or variant, the licence that the text names counts, or ``unknown``
   if it names none of the known ones.

Defined cases: null and empty texts have no notice; a null path has no
directory and inherits nothing; a path with no slash lies in the root
directory ""; equal scores go to the template that is first by name, of several
licence files in a directory the best, then first by path, counts; repeated
rows are judged alike; an empty table gives an empty result; input columns
named like an output column are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from importlib import resources

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import cut
from ledgerline.llm.wordlists import slices

#: Least cosine of a line that is a licence notice, and of a whole text that is a licence file.
NOTICE_COSINE = 0.6
FILE_COSINE = 0.35
#: Least cosine with a full licence text, and that of a whole text whose licence goes before notices inside it.
FULL_COSINE = 0.8
WHOLE_COSINE = 0.9
#: A notice of a licence that is not known.
UNKNOWN = "unknown"
#: Least share of a template's squared weight whose words a whole text must hold.
COVERAGE = 0.5
#: Words whose weights go to every task (others by a join), and distinct words that a task counts before it passes them on.
COMMON_WORDS = 1 << 20
SEED = 42
FLUSH_WORDS = 1 << 20

#: Wording of licence notices and licences, by SPDX identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License.",
        "SPDX-License-Identifier: Apache-2.0"),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later"),
    "BSD-2-Clause": (
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC0-1.0": (
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0"),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
        "SPDX-License-Identifier: GPL-2.0-only"),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later"),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC"),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later"),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0"),
}

_GNU = r"public license(?: (?!version\b|v\b|v?\d)\S+){0,12}? (?:version |v )?v?"
_CC = r"\b(?:cc|creative commons)(?: license)? (?:attribution|by)"
_FOUR = r" (?:version |v )?v?4(?:\.0)?(?!\S)"
#: What names a licence and its version in a text's words; other versions and variants do not match.
NAMES: dict[str, re.Pattern] = {name: re.compile(rule) for name, rule in {
    "AGPL-3.0": rf"\baffero general {_GNU}3(?:\.0)?(?!\S)|\bagpl ?(?:version |v )?v?3(?:\.0)?(?!\S)",
    "Apache-2.0": r"\bapache (?:software )?(?:license )?(?:version |v )?v?2(?:\.0)?(?!\S)",
    "BSD-2-Clause": r"\bbsd (?:license )?2 clause|\b2 clause bsd|\bsimplified bsd",
    "BSD-3-Clause": r"\bbsd (?:license )?3 clause|\b3 clause bsd|\b(?:new|modified) bsd",
    "CC-BY-4.0": _CC + _FOUR,
    "CC-BY-NC-4.0": rf"{_CC} (?:nc|non ?commercial){_FOUR}",
    "CC-BY-SA-4.0": rf"{_CC} (?:sa|share ?alike){_FOUR}",
    "CC0-1.0": r"\bcc0(?: (?:version |v )?v?1(?:\.0)?)?(?! (?:version |v )?v?\d)(?!\S)",
    "GPL-1.0": rf"(?<!lesser )(?<!library )(?<!affero )\bgeneral {_GNU}1(?:\.0)?(?!\S)|\bgpl ?(?:version |v )?v?1(?:\.0)?(?!\S)",
    "GPL-2.0": rf"(?<!lesser )(?<!library )(?<!affero )\bgeneral {_GNU}2(?:\.0)?(?!\S)|\bgpl ?(?:version |v )?v?2(?:\.0)?(?!\S)",
    "GPL-3.0": rf"(?<!lesser )(?<!library )(?<!affero )\bgeneral {_GNU}3(?:\.0)?(?!\S)|\bgpl ?(?:version |v )?v?3(?:\.0)?(?!\S)",
    "ISC": r"\bisc license|\blicense identifier isc(?!\S)",
    "LGPL-2.0": rf"\b(?:lesser|library) general {_GNU}2(?:\.0)?(?!\S)|\blgpl ?(?:version |v )?v?2(?:\.0)?(?!\S)",
    "LGPL-2.1": rf"\b(?:lesser|library) general {_GNU}2\.1(?!\S)|\blgpl ?(?:version |v )?v?2\.1(?!\S)",
    "LGPL-3.0": rf"\b(?:lesser|library) general {_GNU}3(?:\.0)?(?!\S)|\blgpl ?(?:version |v )?v?3(?:\.0)?(?!\S)",
    "MIT": r"\bmit license|\b(?:license identifier|licensed under|under the) mit(?! \d)(?!\S)",
    "MPL-1.1": r"\bmozilla public license (?:version |v )?v?1\.1(?!\S)|\bmpl (?:version |v )?v?1\.1(?!\S)",
    "MPL-2.0": r"\bmozilla public license (?:version |v )?v?2(?:\.0)?(?!\S)|\bmpl (?:version |v )?v?2(?:\.0)?(?!\S)",
}.items()}
#: Licences whose full text need not name them, words of a full text that do, and words around a window that may.
UNNAMED_TEXTS = {"BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT"}
HEAD_WORDS = 100
MARGIN = 3

_LICENCE = re.compile(r"\blicen[cs]es?(?!\S)")
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*|[^\W_a-z0-9A-Z]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def template_words() -> list[str]:
    return sorted({w for texts in TEMPLATES.values() for t in texts for w in words_of(t)})


def known_words(full: dict[str, list[str]]) -> list[str]:
    return sorted({*template_words(), *(w for found in full.values() for w in found)})


def full_texts() -> dict[str, list[str]]:
    """Words of the full licence texts in ``licenses``, by SPDX identifier."""
    folder = resources.files(__package__) / "licenses"
    return {f.name.removesuffix(".txt"): words_of(f.read_text(encoding="utf-8"))
            for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}


def named(template: str, wording: str, words: list[str], whole: str, full: bool = False) -> str | None:
    """The licence that a text near a template names.

    Wording without a name (as MIT's permission) stands for its template. Where
    a name is due, another licence's name gives that licence, and none gives
    ``UNKNOWN`` if a licence is spoken of (a full text needs no name).
    """
    if template.startswith("BSD") and "redistributions in binary form" in whole:
        return "BSD-3-Clause" if "neither the name" in whole else "BSD-2-Clause"
    rule, text = NAMES.get(template), " ".join(words)
    if rule is None or not rule.search(wording) or rule.search(text) or (full and template in UNNAMED_TEXTS):
        return template
    others = [name for name, r in NAMES.items() if r.search(text)]
    if len(others) == 1:
        return others[0]
    # A licence is spoken of by the noun; "was licensed by the state" names none.
    return template if full and not others else UNKNOWN if _LICENCE.search(text) else None


def rank_of(license: str | None) -> int:
    return -1 if license is None else 0 if license == UNKNOWN else 1


def document_frequencies(df: DataFrame, text: str) -> DataFrame:
    """(word, n): documents that have the word, for every word; "" has the number of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([*seen], pa.string()), pa.array([*seen.values()], pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for start, count in slices(batch.column(0)):
                found = [words_of(x.as_py()) for x in batch.column(0).slice(start, count)]
                coded = pa.array([w for words in found for w in words], pa.string()).dictionary_encode()
                row = np.repeat(np.arange(count), [len(words) for words in found])
                once = np.unique(row * max(1, len(coded.dictionary)) + np.asarray(coded.indices)) % max(1, len(coded.dictionary))
                documents = np.bincount(once, minlength=len(coded.dictionary)).tolist()
                seen.update(dict(zip(coded.dictionary.to_pylist(), documents, strict=True)))
                seen[""] += count
                if len(seen) >= FLUSH_WORDS:
                    yield flush()
                    seen.clear()
        if seen:
            yield flush()

    counted = df.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return cut(counted, "license_words")


def weight(total: int, n: int) -> float:
    """Weight of a word that ``n`` of ``total`` documents have."""
    return 1 + math.log((1 + total) / (1 + n))


class Weights:
    """Weights of the template words and of the commonest words; other words are open."""

    def __init__(self, total: int, known: dict[str, int], hashes: np.ndarray, counts: np.ndarray):
        self.total, self.hashes, self.counts = total, hashes, counts
        self.known = {w: weight(total, n) for w, n in known.items()}
        self.cache: dict[str, float | None] = {}

    def of(self, words: list[str]) -> np.ndarray:
        """Weight of each word, NaN for an open one."""
        out = np.full(len(words), np.nan)
        if len(self.hashes):
            found = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), SEED) for w in words], dtype=np.uint64)
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            held = self.hashes[at] == found
            out[held] = 1 + np.log((1 + self.total) / (1.0 + self.counts[at[held]]))
        for i, w in enumerate(words):
            if w in self.known:
                out[i] = self.known[w]
        return out

    def get(self, word: str) -> float | None:
        if word not in self.cache:
            if len(self.cache) >= FLUSH_WORDS:
                self.cache.clear()
            value = self.of([word])[0]
            self.cache[word] = None if np.isnan(value) else float(value)
        return self.cache[word]


@dataclass(frozen=True)
class Unit:
    """A line, window or whole text against a template, but for the weights of ``words``."""
    low: float
    high: float
    template: int
    dot: float
    square: float
    words: tuple[str, ...]
    counts: tuple[int, ...]
    license: str | None = None


class Scorer:
    """Cosines between a text and the templates.

    ``weights`` knows the template words and the commonest words; every other
    word is in 1 to ``rest`` documents. A cosine with such words lies between two
    bounds; what cannot be the best of its text is left out here, the rest gets
    its exact weights by a join.
    """

    def __init__(self, weights: Weights, rest: int, notice_cosine: float, file_cosine: float, full: dict[str, list[str]]):
        total = weights.total
        self.weights = weights
        self.idf = weights.known
        self.light, self.heavy = weight(total, max(1, rest)), weight(total, 1)
        self.least, self.least_file = notice_cosine, file_cosine
        self.templates: list[str] = []
        self.wordings: list[str] = []
        self.vectors: list[dict[str, float]] = []
        self.sizes: list[int] = []
        self.having: dict[str, list[tuple[int, float]]] = {}
        self.anchors: dict[str, list[int]] = {}
        for name, texts in sorted(TEMPLATES.items()):
            for t in texts:
                self._add(name, words_of(t))
        self.full: list[tuple[int, list[tuple[str, float]]]] = []
        for name, found in full.items():
            weights = {w: n * self.idf[w] for w, n in Counter(found).items()}
            norm = math.sqrt(sum(x * x for x in weights.values()))
            self.full.append((len(self.templates), sorted(((w, x / norm) for w, x in weights.items()), key=lambda p: (-p[1], p[0]))))
            self.templates.append(name)
            self.wordings.append(" ".join(found[:HEAD_WORDS]))
        self._sparse()

    def _add(self, name: str, found: list[str]) -> None:
        at, weights = len(self.templates), {w: n * self.idf[w] for w, n in Counter(found).items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        vector = {w: x / norm for w, x in weights.items()}
        for w, x in vector.items():
            self.having.setdefault(w, []).append((at, x))
        self.templates.append(name)
        self.vectors.append(vector)
        self.sizes.append(len(found))
        self.wordings.append(" ".join(found))
        # A cosine is at most the root of the squares of the template's words that are present: without
        # one of its heaviest words (the anchors) a window cannot reach the limit.
        left = 1.0
        for w, x in sorted(vector.items(), key=lambda p: (-p[1], p[0])):
            if left < self.least * self.least - 1e-6:
                break
            self.anchors.setdefault(w, []).append(at)
            left -= x * x

    def near(self, counts: Counter, only: int | None = None) -> list[Unit]:
        """The units of a text's words, one per template with a common word (or of one template)."""
        dots: dict[int, float] = {}
        square, words = 0.0, []
        for w, n in counts.items():
            idf = self.weights.get(w)
            if idf is None:
                words.append(w)
                continue
            square += n * n * idf * idf
            for template, x in self.having.get(w, ()):
                if only is None or template == only:
                    dots[template] = dots.get(template, 0.0) + n * idf * x
        words.sort()
        numbers = tuple(counts[w] for w in words)
        open_square = sum(n * n for n in numbers)
        lower = math.sqrt(square + open_square * self.heavy ** 2)
        upper = math.sqrt(square + open_square * self.light ** 2)
        return [Unit(d / lower, d / upper, t, d, square, tuple(words), numbers) for t, d in dots.items()]

    def windows(self, words: list[str]) -> Iterator[tuple[Unit, list[str]]]:
        """Units of the windows of template length, at any place of the text, that can reach the limit; and the words there."""
        places: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            for t in self.anchors.get(w, ()):
                places.setdefault(t, []).append(i)
        for t, hits in places.items():
            size = self.sizes[t]
            last = max(0, len(words) - size)
            begin, end = -1, -2
            for i in [*hits, None]:
                first = None if i is None else max(0, i - size + 1)
                if first is not None and first <= end + 1 and begin >= 0:
                    end = min(i, last)
                    continue
                if begin >= 0:
                    for at in self._slide(words, t, begin, end):
                        around = words[max(0, at - MARGIN):at + size + MARGIN]
                        yield from ((u, around) for u in self.near(Counter(words[at:at + size]), t) if u.high >= self.least - 1e-6)
                if first is not None:
                    begin, end = first, min(i, last)

    def _at_least(self, word: str) -> float:
        found = self.weights.get(word)
        return self.light if found is None else found

    def _slide(self, words: list[str], t: int, begin: int, end: int) -> Iterator[int]:
        """Starts from ``begin`` to ``end`` of windows that can reach the limit."""
        vector, size = self.vectors[t], self.sizes[t]
        held: dict[str, int] = {}
        dot = square = 0.0
        limit = self.least * self.least * (1 - 1e-6)
        for i in range(begin, min(len(words), end + size)):
            w = words[i]
            idf, n = self._at_least(w), held.get(w, 0)
            held[w] = n + 1
            dot += idf * vector.get(w, 0.0)
            square += (2 * n + 1) * idf * idf
            if i - begin >= size:
                w = words[i - size]
                idf, n = self._at_least(w), held[w]
                held[w] = n - 1
                dot -= idf * vector.get(w, 0.0)
                square -= (2 * n - 1) * idf * idf
            at = i - size + 1
            if (at >= begin or i == len(words) - 1) and dot > 0 and dot * dot >= limit * square:
                yield max(at, begin)

    def full_near(self, counts: Counter) -> list[Unit]:
        """Units against the full licence texts that can reach their limit."""
        out = []
        for t, vector in self.full:
            missing, dot = 1 - FULL_COSINE * FULL_COSINE + 1e-6, 0.0
            for w, x in vector:
                if n := counts.get(w, 0):
                    dot += n * self.idf[w] * x
                    continue
                missing -= x * x
                if missing < 0:
                    break
            else:
                out.append((t, dot))
        if not out:
            return []
        weights = {w: self.weights.get(w) for w in counts}
        words = sorted(w for w in counts if weights[w] is None)
        numbers = tuple(counts[w] for w in words)
        square = sum((n * weights[w]) ** 2 for w, n in counts.items() if weights[w] is not None)
        rest = sum(n * n for n in numbers)
        units = [Unit(d / math.sqrt(square + rest * self.heavy ** 2), d / math.sqrt(square + rest * self.light ** 2), t, d, square,
                      tuple(words), numbers) for t, d in out]
        return [u for u in units if u.high >= FULL_COSINE - 1e-6]

    def _sparse(self) -> None:
        """Template words as a sparse matrix: number of each word, and its templates with their weights."""
        self.columns = {w: k for k, w in enumerate(self.having)}
        entries = [self.having[w] for w in self.columns]
        self.begin = np.concatenate([[0], np.cumsum([len(e) for e in entries])])
        self.at_template = np.array([t for e in entries for t, _ in e], dtype=np.int64)
        self.at_weight = np.array([x for e in entries for _, x in e])

    def _products(self, group: np.ndarray, groups: int, word: np.ndarray, words: int, idf: np.ndarray, column: np.ndarray) -> Products:
        """Sparse products of groups of words (lines or texts) with all templates; ``word`` numbers are below ``words``."""
        key, counts = np.unique(group * max(1, words) + word, return_counts=True)
        g, w = np.divmod(key, max(1, words))
        n = counts * np.nan_to_num(idf[w])
        square = np.bincount(g, n * n, minlength=groups)
        open_ = np.isnan(idf[w])
        open_square = np.bincount(g[open_], (counts[open_] * counts[open_]).astype(float), minlength=groups)
        own = np.flatnonzero(column[w] >= 0)
        first = self.begin[column[w[own]]]
        many = self.begin[column[w[own]] + 1] - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        cell = np.repeat(g[own], many) * len(self.vectors) + self.at_template[at]
        shape = (groups, len(self.vectors))
        dot = np.bincount(cell, np.repeat(n[own], many) * self.at_weight[at], minlength=shape[0] * shape[1]).reshape(shape)
        covered = np.bincount(cell, self.at_weight[at] ** 2, minlength=shape[0] * shape[1]).reshape(shape)
        return Products(dot, covered, square, open_square, self.light, self.heavy, g, w, counts, open_)

    def scan(self, texts: list[str | None]) -> Iterator[tuple[list[Unit], list[Unit]]]:
        """For each text: units that may be the best line or window, and those that may be the best for the whole text."""
        by_line = [[words_of(line) for line in (text or "").split("\n")] for text in texts]
        flat = [w for lines in by_line for line in lines for w in line]
        coded = pa.array(flat, pa.string()).dictionary_encode()
        names = coded.dictionary.to_pylist()
        word = np.asarray(coded.indices, dtype=np.int64)
        idf = self.weights.of(names)
        column = np.array([self.columns.get(w, -1) for w in names], dtype=np.int64)
        line_of = np.repeat(np.arange(sum(map(len, by_line))), [len(line) for lines in by_line for line in lines])
        first_line = np.concatenate([[0], np.cumsum([len(lines) for lines in by_line])])
        row_of = np.repeat(np.arange(len(texts)), [sum(map(len, lines)) for lines in by_line])
        lines_at = self._products(line_of, int(first_line[-1]), word, len(names), idf, column)
        texts_at = self._products(row_of, len(texts), word, len(names), idf, column)
        for i, lines in enumerate(by_line):
            yield self._scan_text(lines, lines_at, slice(int(first_line[i]), int(first_line[i + 1])), texts_at, i, names)

    def _scan_text(self, lines: list[list[str]], at: Products, own: slice, texts: Products, i: int,
                   names: list[str]) -> tuple[list[Unit], list[Unit]]:
        words = [w for line in lines for w in line]
        whole = Counter(words)
        joined = None

        def judged(unit: Unit, least: float, found: list[str], full: bool = False) -> Unit:
            nonlocal joined
            if unit.high < least - 1e-6:
                return unit
            if joined is None:
                joined = " ".join(words)
            name = named(self.templates[unit.template], self.wordings[unit.template], found, joined, full)
            return replace(unit, license=name)

        high, file_high = at.high[own], texts.high[i]
        # Whatever is below its limit counts only if it may give the row's cosine.
        floor = max(at.low[own].max(initial=0.0), texts.low[i].max(initial=0.0)) - 1e-6
        notices: list[Unit] = []
        for line, t in zip(*np.nonzero((high > 0) & (high >= min(floor, self.least - 1e-6))), strict=True):
            unit = at.unit(own.start + int(line), int(t), names)
            notices.append(judged(unit, self.least, lines[line]))
        notices = best_of(notices)
        if not self.anchors.keys().isdisjoint(whole):
            for unit, around in self.windows(words):
                notices = best_of([*notices, judged(unit, self.least, around)])
        files: list[Unit] = []
        for t in np.flatnonzero((file_high > 0) & (file_high >= min(floor, self.least_file - 1e-6))).tolist():
            unit = texts.unit(i, t, names)
            if texts.covered[i, t] >= COVERAGE:
                unit = judged(unit, self.least_file, words)
            # A whole text that names no known licence is an unknown one only if it is as close as a notice.
            files.append(replace(unit, license=None) if unit.license == UNKNOWN and unit.high < self.least else unit)
        files = best_of(files + [judged(u, FULL_COSINE, words[:HEAD_WORDS], True) for u in self.full_near(whole)])
        floor = max((u.low for u in notices + files), default=0.0) - 1e-6
        return ([u for u in notices if u.high >= min(floor, self.least - 1e-6)],
                [u for u in files if u.high >= min(floor, self.least_file - 1e-6)])


class Products:
    """Dot products of groups with templates, their bounds, and the open words of each group."""

    def __init__(self, dot, covered, square, open_square, light, heavy, group, word, counts, open_):
        self.dot, self.covered, self.square = dot, covered, square
        lower, upper = (np.sqrt(square + open_square * w ** 2)[:, None] for w in (heavy, light))
        with np.errstate(invalid="ignore", divide="ignore"):
            self.low, self.high = (np.where(dot > 0, dot / norm, 0.0) for norm in (lower, upper))
        self.word, self.counts = word[open_], counts[open_]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(group[open_], minlength=len(square)))])

    def unit(self, group: int, template: int, names: list[str]) -> Unit:
        own = slice(int(self.ends[group]), int(self.ends[group + 1]))
        found = sorted(zip([names[w] for w in self.word[own].tolist()], self.counts[own].tolist(), strict=True))
        return Unit(float(self.low[group, template]), float(self.high[group, template]), template, float(self.dot[group, template]),
                    float(self.square[group]), tuple(w for w, _ in found), tuple(n for _, n in found))


def best_of(units: list[Unit]) -> list[Unit]:
    """Without the units that are worse than another of their rank whatever their open words weigh."""
    floors: dict[int, float] = {}
    for u in units:
        rank = rank_of(u.license)
        floors[rank] = max(floors.get(rank, 0.0), u.low - 1e-6)
    return sorted({u for u in units if u.high >= floors[rank_of(u.license)]},
                  key=lambda u: (-u.low, u.template, u.words, u.counts, u.dot, u.license or ""))


UNIT_FIELDS = {"kind": (T.StringType(), pa.string()), "license": (T.StringType(), pa.string()), "rank": (T.IntegerType(), pa.int32()),
               "least": (T.DoubleType(), pa.float64()), "template": (T.IntegerType(), pa.int32()), "dot": (T.DoubleType(), pa.float64()),
               "square": (T.DoubleType(), pa.float64()), "at": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
               "counts": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))}
UNITS_ARROW = pa.list_(pa.struct([(name, arrow) for name, (_, arrow) in UNIT_FIELDS.items()]))
UNIT_ROWS = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("path", T.StringType()),
    T.StructField("open", T.ArrayType(T.StringType())),
    T.StructField("units", T.ArrayType(T.StructType([T.StructField(name, kind) for name, (kind, _) in UNIT_FIELDS.items()])))])


def common_words(frequencies: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes and counts of the commonest words, and the most documents that any other word is in.

    At most ``COMMON_WORDS`` pairs of 8 and 4 bytes reach the driver and the tasks.
    """
    top = frequencies.filter("word <> ''").select(F.xxhash64("word").alias("h"), "n").orderBy(F.desc("n"), "h").limit(COMMON_WORDS)
    held = top.toArrow()
    hashes = held.column("h").to_numpy().view(np.uint64)
    counts = np.minimum(held.column("n").to_numpy(), 0xFFFFFFFF).astype(np.uint32)
    order = np.argsort(hashes)
    return hashes[order], counts[order], int(counts.min()) if len(counts) == COMMON_WORDS else 0


def score(spark: SparkSession, df: DataFrame, key: str, path: str, text: str, notice_cosine: float,
          file_cosine: float) -> DataFrame:
    """(doc_id, path, line_license, line_cosine, file_license, file_cosine) of every row.

    Of two cosines below their limits only the larger is worked out; the other may be 0.
    """
    full = full_texts()
    frequencies = document_frequencies(df, text)
    counted = {r["word"]: r["n"] for r in frequencies.filter(F.col("word").isin(["", *known_words(full)])).collect()}
    total = counted.pop("", 0)
    known = {w: counted.get(w, 0) for w in known_words(full)}
    hashes, numbers, rest = common_words(frequencies)
    table: Broadcast = spark.sparkContext.broadcast((hashes, numbers))  # 12 bytes a word
    rows = df.select(F.col(key).cast("long").alias("doc_id"), F.col(path).alias("path"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Weights(total, known, *table.value), rest, notice_cosine, file_cosine, full)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start, count in slices(batch.column(2)):
                part = batch.slice(start, count)
                opened, units = [], []
                for line_units, file_units in scorer.scan(part.column(2).to_pylist()):
                    words = sorted({w for u in line_units + file_units for w in u.words})
                    place = {w: k for k, w in enumerate(words)}
                    opened.append(words)
                    units.append([
                        {"kind": kind, "license": u.license, "rank": rank_of(u.license), "template": u.template,
                         "least": notice_cosine if kind == "line" else FULL_COSINE if u.template >= len(scorer.vectors) else file_cosine,
                         "dot": u.dot, "square": u.square, "at": [place[w] for w in u.words], "counts": u.counts}
                        for kind, found in (("line", line_units), ("file", file_units)) for u in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(number, number + count), pa.int64()), part.column(0), part.column(1),
                     pa.array(opened, pa.list_(pa.string())), pa.array(units, UNITS_ARROW)], names=UNIT_ROWS.names)
                number += count

    files = cut(rows.mapInArrow(run, UNIT_ROWS), "license_units")
    # Each open word of a row goes out once and comes back as its weight, in the row's order.
    sent = files.select("row", F.posexplode("open").alias("at", "word"))
    idf = 1 + F.log(F.lit(1.0 + total) / (1 + F.col("n")))
    met = sent.join(frequencies, "word").select("row", "at", idf.alias("idf"))
    weights = met.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "idf"))).alias("weights"))
    held = files.join(weights, "row", "left")

    def judged(u):
        open_square = F.aggregate(F.arrays_zip(u["at"], u["counts"]), F.lit(0.0), lambda total, x: total + F.pow(
            x["counts"] * F.get(F.col("weights"), x["at"])["idf"], F.lit(2)))
        # Rounded, so that ties are ties; named licences go before others, equal scores to the first template.
        cosine = F.round(u["dot"] / F.sqrt(u["square"] + open_square), 6)
        return F.transform(F.array(cosine), lambda c: F.struct(
            u["kind"].alias("kind"), F.when(c >= u["least"], u["rank"]).otherwise(-1).alias("rank"), c.alias("cosine"),
            (-u["template"]).alias("first"), u["license"].alias("license")))[0]

    # Bound once: what follows refers to the judged units several times.
    scored = held.select("doc_id", "path", F.explode(F.array(F.transform("units", judged))).alias("found"))

    def top(kind: str):
        return F.array_max(F.filter("found", lambda x: x["kind"] == kind))

    best = {kind: top(kind) for kind in ("line", "file")}
    return scored.select("doc_id", "path", *[c for kind, one in best.items() for c in (
        F.when(one["rank"] >= 0, one["license"]).alias(f"{kind}_license"), F.coalesce(one["cosine"], F.lit(0.0)).alias(f"{kind}_cosine"))])


def directory(path):
    """Everything before the last slash ("" for a path without one)."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, r"/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def ancestors(path):
    """A directory and all above it, as structs of depth and path; the root directory has depth 0."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    lead = F.when(path.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    return F.transform(F.sequence(F.lit(0), F.size(parts)),
                       lambda n: F.struct(n.alias("depth"), F.concat(F.when(n > 0, lead).otherwise(F.lit("")), F.array_join(F.slice(parts, 1, n), "/")).alias("dir")))


def nearest_licenses(files: DataFrame) -> DataFrame:
    """(dir, license, license_path) for every directory of ``files`` with a licence file in it or above."""
    own = files.filter("file_license is not null and file_cosine >= file_threshold").groupBy(directory(F.col("path")).alias("dir")).agg(
        F.min(F.struct((-F.col("file_cosine")).alias("worse"), F.col("path").alias("license_path"),
                       F.col("file_license").alias("license"))).alias("best"))
    held = cut(own.select(F.col("dir").alias("held"), "best.license", "best.license_path"), "license_dirs")
    dirs = files.select(directory(F.col("path")).alias("dir")).filter("dir is not null").distinct()
    up = dirs.select("dir", F.explode(ancestors(F.col("dir"))).alias("up")).select("dir", "up.depth", F.col("up.dir").alias("above"))
    met = up.join(held, up["above"] == held["held"])
    return met.groupBy("dir").agg(F.max(F.struct("depth", "license", "license_path")).alias("n")).select(
        "dir", "n.license", "n.license_path")


def scan(spark: SparkSession, df: DataFrame, key: str = "doc_id", path: str = "path", text: str = "text",
         notice_cosine: float = NOTICE_COSINE, file_cosine: float = FILE_COSINE) -> DataFrame:
    """(doc_id, path, license, origin, cosine, license_path): one row per input row.

    ``origin`` is ``notice``, ``inherited`` or ``none``; ``license_path`` names
    the file that gave the licence.
    """
    files = cut(score(spark, df, key, path, text, notice_cosine, file_cosine).withColumn("file_threshold", F.lit(file_cosine)), "license_scores")
    near = cut(nearest_licenses(files).withColumnsRenamed({"dir": "near_dir", "license": "near_license",
                                                           "license_path": "near_path"}), "license_near")
    rows = files.withColumn("dir", directory(F.col("path"))).join(near, F.col("dir") == near["near_dir"], "left")
    # A licence text as a whole goes before the notices inside it.
    own = F.coalesce(F.when(F.col("file_cosine") >= WHOLE_COSINE, F.col("file_license")), "line_license", "file_license")
    return rows.select(
        "doc_id", "path", F.coalesce(own, "near_license").alias("license"),
        F.when(own.isNotNull(), "notice").when(F.col("near_license").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.greatest("line_cosine", "file_cosine").alias("cosine"),
        F.when(own.isNotNull(), F.col("path")).otherwise(F.col("near_path")).alias("license_path"))
