"""Plain versions of the contracts, over lists of rows; slow and simple on purpose."""

import hashlib
import re
from collections import Counter

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def space_words(text):
    return [w for w in SPACE.split(text or "") if w]


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


def decontamination(docs, items, window=13):
    """doc rows (doc_id, text), item rows (item_id, text)."""
    phrases = {}
    for item, text in items:
        w = item_words(text)
        if item is None or not w:
            continue
        size = min(window, len(w))
        for i in range(len(w) - size + 1):
            phrases.setdefault(tuple(w[i:i + size]), set()).add(item)
    sizes = sorted({len(p) for p in phrases})
    out = []
    for doc_id, text in docs:
        w = item_words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (owners := phrases.get(tuple(w[i:i + size]))):
                    found |= owners
                    hit.update(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def simhash(text, shingle=3):
    w = space_words(lower_ascii(text))
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < shingle else [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs, shingle=3, max_bits=3):
    """(doc_id, fingerprint hex, component id) by comparing every pair."""
    prints = [simhash(t, shingle) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(d, f"{p:016x}", least.get(root(i))) for i, ((d, _), p) in enumerate(zip(docs, prints))]


def quality_base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = space_words(text)
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if runs[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if space_words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))
