"""Main text of HTML pages by a recurrent block labeller.

A page is cut into blocks: runs of text between block-level tags, with inline
markup removed. Each block becomes a vector of its tag path (tags, classes,
ids and roles of its ancestors, hashed), its words (all of them, hashed) and a
few proportions. A bidirectional LSTM in numpy reads the blocks of the whole
page in order and labels each as main text or not, so a block is judged by
what stands before and after it.

The model is trained here, on pages of a generator that wraps invented words
in common page layouts and so knows every label; the number of training pages
is a parameter, the seed is fixed, and training takes seconds on the driver.
Two sets of weights are trained: one on layouts whose tags or class words name
their parts, one on plain layouts (bare ``div``, ``table``, ``section`` or body,
classes that say nothing), where tags, links, words and order have to do. A page is read by
that of its kind. The weights (about 200 KB) are broadcast. Pages are labelled
where they are: no shuffle, and memory in proportion to a batch of pages.

Defined cases: null and empty html give an empty text; markup cut off at any
place is read as far as it goes; a page without a main block gives an empty
text; repeated rows are labelled alike; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ------------------------------------------------------------------ blocks
#: Elements that begin a block, that hold no content, and whose content is not markup.
BLOCK_TAGS = frozenset(
    "html head body title address article aside blockquote button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option optgroup p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript iframe textarea".split())
#: Elements whose content is shown in place of the element or not at all: left out where they are closed, else read on.
EMBEDDED_TAGS = frozenset("template object svg canvas audio video".split())
#: A start tag of the first kind ends an open element of the second, up to one of the third.
IMPLIED_END = {"li": ({"li"}, {"ul", "ol", "menu"}), "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}),
               "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "dt": ({"dt", "dd"}, {"dl"}),
               "dd": ({"dt", "dd"}, {"dl"}), "body": ({"head"}, {"html"})}

#: Elements nested deeper count as neighbours, as browsers do.
MAX_DEPTH = 512

_TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<decl>[!?])[^>]*>?|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"""
                  r"""(?P<attrs>(?:=\s*+"[^"]*"|=\s*+'[^']*'|[^>=]++|=)*+)(?P<end>>|\Z)|(?P<loose>/?[a-zA-Z][^>]*)(?:>|\Z))""", re.DOTALL)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)


_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.IGNORECASE) for name in RAW_TAGS}
_EDGE = {name: re.compile(rf"<(?P<close>/)?{name}\b[^>]*>?", re.IGNORECASE) for name in EMBEDDED_TAGS}


@dataclass
class Block:
    path: tuple[str, ...]
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0

    @cached_property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _marks(tag: str, attrs: str) -> str:
    """A path element: the tag and the words of its class, id and role."""
    found = [v for m in _NAMED.finditer(attrs) for v in re.split(r"[^a-zA-Z]+", m[2] or m[3] or m[4] or "") if v]
    return " ".join([tag, *("." + v.lower() for v in found)])


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, those of white space only left out."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    deep: list[str] = []  # names of the open elements beyond MAX_DEPTH, all of them inside those of the stack
    held: Counter = Counter()
    unclosed: dict[str, int] = {}  # embedded elements known to have no end tag before a place
    now = Block(())
    links = 0

    def turn() -> None:
        nonlocal now
        if now.parts and "".join(now.parts).strip():
            out.append(now)
        now = Block(())

    def put(text: str) -> None:
        if text:
            if not now.parts:
                now.path = tuple(marks for _, marks in stack)
            decoded = entities.unescape(text) if "&" in text else text
            now.parts.append(decoded)
            now.link_chars += len(decoded) if links else 0

    at = 0
    while at < len(page):
        less = page.find("<", at)
        if less < 0:
            put(page[at:])
            break
        put(page[at:less])
        found = _TAG.match(page, less)
        if not found:
            put("<")
            at = less + 1
            continue
        at = found.end()
        name = (found["name"] or "").lower()
        if not name or (found["end"] == "" and at == len(page)):
            continue  # comment, declaration, or a tag the page ends in
        attrs, closing = found["attrs"] or "", bool(found["close"])
        if name in RAW_TAGS and not closing:
            # HTML knows no script that closes itself: a slash at the end of the tag changes nothing
            stop = _END[name].search(page, at)
            at = stop.end() if stop else len(page)
        elif name in EMBEDDED_TAGS and not closing:
            # a further start before the end tag belongs to another element: this one was never closed
            stop = None if attrs.rstrip().endswith("/") or at < unclosed.get(name, 0) else _EDGE[name].search(page, at)
            if stop and stop["close"]:
                at = stop.end()
            elif stop:
                unclosed[name] = stop.start()
            else:
                unclosed[name] = len(page)
        elif name == "a":
            links = 0 if closing else 1
        elif name == "br":
            put(" ")
        elif name in BLOCK_TAGS:
            if closing:
                if held[name]:
                    while (last := deep.pop()) != name:
                        held[last] -= 1
                    held[name] -= 1
                elif any(t == name for t, _ in stack):
                    while stack.pop()[0] != name:
                        pass
                    deep.clear()
                    held.clear()
            else:
                ends, barrier = IMPLIED_END.get(name, (set(), set()))
                if stack and stack[-1][0] == "p":
                    stack.pop()
                for i in range(len(stack) - 1, -1, -1) if ends else ():
                    if stack[i][0] in barrier:
                        break
                    if stack[i][0] in ends:
                        del stack[i:]
                        break
                if name not in VOID_TAGS and len(stack) < MAX_DEPTH:
                    stack.append((name, _marks(name, attrs)))
                    deep.clear()  # an implied end made room: what lay inside is closed
                    held.clear()
                elif name not in VOID_TAGS:
                    deep.append(name)
                    held[name] += 1
            links = 0
            turn()
    turn()
    return out


# ---------------------------------------------------------------- features
PATH_DIMS, WORD_DIMS, OTHER_DIMS = 128, 64, 6
DIMS = PATH_DIMS + WORD_DIMS + OTHER_DIMS


def _slot(word: str, dims: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return (h >> 1) % dims, 1.0 if h & 1 else -1.0


@lru_cache(maxsize=4096)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(PATH_DIMS, dtype=np.float32)
    for element in path:
        for mark in element.split(" "):
            for salt in ("a", "b"):
                at, sign = _slot(salt + mark, PATH_DIMS)
                v[at] += sign
    for salt in ("c", "d"):  # the innermost element once more, as such
        at, sign = _slot(salt + (path[-1].split(" ")[0] if path else ""), PATH_DIMS)
        v[at] += sign
    return np.clip(v, -2, 2)


_PLACE_WEIGHTS = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def _word_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Signed hashed counts of the words of each text, and their number; all words of a page hashed at once."""
    raw = np.frombuffer(("\n".join(texts) + "\n").lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = raw > 0x20
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    counts = np.zeros((len(texts), WORD_DIMS), dtype=np.float32)
    if not len(starts):
        return counts, np.zeros(len(texts), dtype=np.int64)
    places = np.arange(len(raw)) - np.repeat(np.append(0, starts), np.diff(np.concatenate(([0], starts, [len(raw)]))))
    hashes = np.add.reduceat(np.where(inside, raw, 0) * _PLACE_WEIGHTS[places % 64], starts)
    hashes ^= hashes >> np.uint64(29)
    owner = np.cumsum(raw == 0x0A)[starts]
    slots = owner * WORD_DIMS + ((hashes >> np.uint64(8)) % np.uint64(WORD_DIMS)).astype(np.int64)
    signs = np.where(hashes & np.uint64(1), 1.0, -1.0)
    counts += np.bincount(slots, weights=signs, minlength=counts.size).reshape(counts.shape)
    return counts, np.bincount(owner, minlength=len(texts))


def features(page: list[Block]) -> np.ndarray:
    """One row per block."""
    texts = [b.text for b in page]
    counts, words = _word_counts(texts)
    path = np.array([_path_vector(b.path) for b in page])
    counts /= np.maximum(1, np.linalg.norm(counts, axis=1))[:, None]
    other = np.array([(min(1.0, b.link_chars / max(1, len(t))), t[-1:] in ".!?…”\"", bool(b.path) and b.path[-1][0] == "h")
                      for b, t in zip(page, texts, strict=True)], dtype=np.float32)
    place = np.arange(len(page), dtype=np.float32) / len(page)
    return np.concatenate([path, counts, np.minimum(1, np.log1p(words) / 6)[:, None], other, place[:, None],
                           np.full((len(page), 1), 1 / len(page))], axis=1).astype(np.float32)


# -------------------------------------------------------------------- model
HIDDEN = 16
Weights = dict[str, np.ndarray]


def new_weights(rng: np.random.Generator, dims: int = DIMS, hidden: int = HIDDEN) -> Weights:
    w: Weights = {}
    for way in ("f", "b"):
        w[way + "x"] = rng.normal(0, dims ** -0.5, (dims, 4 * hidden)).astype(np.float32)
        w[way + "h"] = rng.normal(0, hidden ** -0.5, (hidden, 4 * hidden)).astype(np.float32)
        w[way + "0"] = np.repeat([0, 1, 0, 0], hidden).astype(np.float32)  # gates: in, forget, out, new
    w["out"] = rng.normal(0, 0.3, 2 * hidden).astype(np.float32)
    w["out0"] = np.zeros(1, dtype=np.float32)
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x: np.ndarray, mask: np.ndarray, w: Weights, way: str, keep: list | None = None) -> np.ndarray:
    """States of one direction over x (time, page, dims); masked steps leave the state as it is."""
    steps, pages, _ = x.shape
    hidden = len(w[way + "h"])
    given = x @ w[way + "x"] + w[way + "0"]
    h = np.zeros((pages, hidden), dtype=x.dtype)
    c = np.zeros_like(h)
    out = np.zeros((steps, pages, hidden), dtype=x.dtype)
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        gates = given[t] + h @ w[way + "h"]
        go = _sigmoid(gates[:, :3 * hidden])
        i, f, o = go[:, :hidden], go[:, hidden:2 * hidden], go[:, 2 * hidden:]
        g = np.tanh(gates[:, 3 * hidden:])
        m = mask[t][:, None]
        new = f * c + i * g
        if keep is not None:
            keep.append((t, i, f, o, g, c, new, h))
        c = np.where(m, new, c)
        h = np.where(m, o * np.tanh(new), h)
        out[t] = h
    return out


def logits(x: np.ndarray, mask: np.ndarray, w: Weights) -> np.ndarray:
    both = np.concatenate([_run(x, mask, w, "f"), _run(x, mask, w, "b")], axis=2)
    return both @ w["out"] + w["out0"]


def loss_and_gradients(x: np.ndarray, mask: np.ndarray, y: np.ndarray, w: Weights) -> tuple[float, Weights]:
    """Mean cross entropy over the blocks and its gradients (back-propagation through time)."""
    hidden = len(w["fh"])
    kept: dict[str, list] = {"f": [], "b": []}
    out = {way: _run(x, mask, w, way, kept[way]) for way in "fb"}
    both = np.concatenate([out["f"], out["b"]], axis=2)
    z = both @ w["out"] + w["out0"]
    n = mask.sum()
    loss = float((np.logaddexp(0, z) - y * z)[mask].sum() / n)
    dz = np.where(mask, _sigmoid(z) - y, 0).astype(x.dtype) / n
    grads = {"out": np.einsum("tp,tph->h", dz, both), "out0": np.array([dz.sum()], dtype=x.dtype)}
    dboth = dz[..., None] * w["out"]
    for way, part in (("f", dboth[..., :hidden]), ("b", dboth[..., hidden:])):
        dgiven = np.zeros((*x.shape[:2], 4 * hidden), dtype=x.dtype)
        dwh = np.zeros_like(w[way + "h"])
        dh = np.zeros((x.shape[1], hidden), dtype=x.dtype)
        dc = np.zeros_like(dh)
        for t, i, f, o, g, c_old, c_new, h_old in reversed(kept[way]):
            m = mask[t][:, None]
            dh = dh + part[t]
            th = np.tanh(c_new)
            do = dh * th
            dnew = dc + dh * o * (1 - th * th)
            dgates = np.concatenate([dnew * g * i * (1 - i), dnew * c_old * f * (1 - f), do * o * (1 - o), dnew * i * (1 - g * g)], axis=1)
            dgates = np.where(m, dgates, 0)
            dgiven[t] = dgates
            dwh += h_old.T @ dgates
            dh = np.where(m, dgates @ w[way + "h"].T, dh)
            dc = np.where(m, dnew * f, dc)
        grads[way + "h"] = dwh
        grads[way + "x"] = np.einsum("tpd,tpg->dg", x, dgiven, optimize=True)
        grads[way + "0"] = dgiven.sum(axis=(0, 1))
    return loss, grads


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), pages[0].shape[1]), dtype=np.float32)
    mask = np.zeros((steps, len(pages)), dtype=bool)
    for i, p in enumerate(pages):
        x[:len(p), i], mask[:len(p), i] = p, True
    return x, mask


# ----------------------------------------------------------- training pages
TRAIN_PAGES = 1500
EPOCHS = 8
#: Share of training pages whose words are hidden, so that paths and neighbours have to do.
NO_WORDS = 0.5
SEED = 7
#: How common layouts name their parts.
NOISE = {
    "header": (["header", "div.header", "div.masthead", "div.topbar", "div.site-header", "div#header"], "header"),
    "nav": (["nav", "div.nav", "div.menu", "ul.menu", "div.navbar", "div.breadcrumb", "div.navigation", "div#nav", "ol.breadcrumbs"], "links"),
    "ad": (["div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsored", "div.promo", "section.ad-slot", "div#ad", "aside.ad"], "prose"),
    "notice": (["div.cookie-notice", "div.notice", "div.cookie-banner", "div.consent", "div.alert", "section.gdpr", "div.popup", "div#notice",
                "div.banner", "div.cookies", "dialog.modal"], "prose"),
    "sidebar": (["aside", "div.sidebar", "div.widget", "section.related", "div.related-posts", "div#sidebar", "div.rail", "aside.sidebar"], "mixed"),
    "form": (["form", "form.search", "form.newsletter", "form.login", "form.subscribe", "div.newsletter", "div.signup"], "form"),
    "share": (["div.share", "div.social", "ul.share", "div.tags", "div.pagination"], "links"),
    "comments": (["section.comments", "div.comments", "div#comments", "ol.comment-list", "div.comment", "section.discussion", "div.replies",
                  "div.reader-comments", "section#comments", "div.comment-thread"], "comments"),
    "footer": (["footer", "div.footer", "div#footer", "div.site-footer", "div.copyright", "div.bottom"], "footer"),
}
#: Marks of layouts that say nothing of the content.
PLAIN_MARKS = ["col", "row", "page", "wrap", "inner", "box", "block", "grid", "cell", "container", "left", "right", "center", "outer",
               "layout", "view", "panel", "frame", "area"]
MAIN = ["article", "article.post", "main", "div.content", "div.article", "div.post", "div.entry-content", "div.article-body", "div.story",
        "section.content", "div#content", "div#main", "div.main", "div.post-body", "div.text"]


class _Pages:
    """Invented pages with a label per block."""

    def __init__(self, seed: int, plain: bool = False):
        self.rng, self.plain = random.Random(seed), plain

    def word(self) -> str:
        kind = self.rng.choice(["abcdefghilmnorstu", "eeaiounrstléèàç", "enrstäöüßdhgi", "aeorsnñóílc"])
        w = "".join(self.rng.choices(kind, k=self.rng.randint(1, 9)))
        w += self.rng.choices(["", ",", ".", "###", "!!", "&amp;"], [30, 3, 2, 0.5, 0.5, 0.5])[0]
        return w.upper() if self.rng.random() < 0.03 else w

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high)))

    def prose(self, long: bool = True) -> str:
        value = self.words(1 if self.rng.random() < 0.2 else 3, self.rng.choice([12, 90, 300]) if long else 25).capitalize()
        if self.rng.random() < 0.15:  # shouted, or decorated with marks
            value = value.upper() if self.rng.random() < 0.5 else value.replace(" ", self.rng.choice(["*** ", " | ", "!! ", "$$$ "]))
        return value + self.rng.choice([".", ".", ".", "", "!"])

    def element(self, name: str, inside: list) -> list:
        tag, mark, value = re.fullmatch(r"([a-z]+)(?:([.#])(.+))?", name).groups()
        attr = f' {"class" if mark == "." else "id"}="{value}"' if mark else ""
        return [f"<{tag}{attr}>", *inside, f"</{tag}>"]

    def text(self, tag: str, value: str, label: bool) -> list:
        return [f"<{tag}>", (value, label), f"</{tag}>"] if tag else [(value, label)]

    def noise(self, kind: str) -> list:
        r = self.rng
        name, style = r.choice(NOISE[kind][0]), NOISE[kind][1]
        inside: list = []
        if style == "links" or (style == "mixed" and r.random() < 0.6):
            rows = [["<li>", "<a href='/x'>", (self.words(1, 3), False), "</a>", "</li>"] for _ in range(r.randint(2, 8))]
            inside += ["<ul>", *sum(rows, []), "</ul>"] if r.random() < 0.7 else sum(([*x[1:4], " "] for x in rows), [])
        if style == "prose" or (style == "mixed" and r.random() < 0.7):
            inside += self.text(r.choice(["", "p", "p", "span", "h3"]), self.prose(r.random() < 0.3), False)
        if style == "header":
            inside += self.text(r.choice(["h1", "h2", "div", "p", ""]), self.words(1, 6), False)
            inside += self.noise("nav") if r.random() < 0.5 else []
        if style == "form":
            inside += [*self.text("label", self.words(1, 4), False), "<input type='text'>", *self.text("button", self.words(1, 2), False)]
        if style == "comments":
            inside += self.text("h3", self.words(1, 3), False) if r.random() < 0.5 else []
            for _ in range(r.randint(1, 5)):
                inside += self.element(r.choice(["div.comment", "li", "article.comment", "div", "p"]),
                                       self.text(r.choice(["p", ""]), self.prose(r.random() < 0.5), False))
        if style == "footer":
            inside += self.text(r.choice(["p", "", ""]), "&copy; " + self.words(1, 3) + " &middot; " + self.prose(False), False)
            inside += self.noise("nav") if r.random() < 0.2 else []
        return self.element(name, inside)

    def main(self) -> list:
        r = self.rng
        name = r.choice(MAIN)
        out = self.element(name, self.main_inside(["ad", "share", "sidebar", "form", "notice", "comments"]))
        return self.element("main", out) if name.startswith("article") and r.random() < 0.3 else out

    def plain_box(self, inside: list) -> list:
        """A part of a layout whose marks, if any, say nothing."""
        r = self.rng
        tag = r.choice(["div", "div", "div", "section", "center", ""])
        if not tag:
            return inside
        word = r.choice(PLAIN_MARKS) if r.random() < 0.7 else "".join(r.choices("abcdefghiklmnoprstu", k=r.randint(2, 8)))
        attr = r.choice(["", "", f' class="{word}"', f' id="{word}"', f' class="{word}-{r.randint(1, 12)}"'])
        return [f"<{tag}{attr}>", *inside, f"</{tag}>"]

    def plain_body(self) -> list:
        """Links, main text, links and a footer, told apart by tags, links, words and order alone."""
        r = self.rng

        def links() -> list:
            rows = [["<a href='/x'>", (self.words(1, 3), False), "</a>"] for _ in range(r.randint(2, 8))]
            if r.random() < 0.5:
                return ["<ul>", *sum((["<li>", *x, "</li>"] for x in rows), []), "</ul>"]
            return self.element(r.choice(["p", "div"]), sum(([*x, r.choice([" ", " | "])] for x in rows), []))

        def footer() -> list:
            said = r.choice(["&copy; ", "Copyright ", "&copy; 20" + str(r.randint(10, 29)) + " "]) + self.words(1, 5)
            return self.text(r.choice(["p", "div", "small", ""]), said, False)

        top = links() if r.random() < 0.75 else []
        side = links() if r.random() < 0.3 else []
        bottom = (links() if r.random() < 0.3 else []) + (footer() if r.random() < 0.8 else [])
        main = self.main_inside([])
        if r.random() < 0.25:  # a table of one row
            cells = [x for x in ([top, main, side] if r.random() < 0.5 else [main, top + side]) if x]
            table = ["<table>", "<tr>", *sum((["<td>", *x, "</td>"] for x in cells), []), "</tr>", "</table>"]
            return table + (self.plain_box(bottom) if bottom else [])
        return sum((self.plain_box(x) for x in (top, main, side, bottom) if x), [])

    def main_inside(self, noise: list[str]) -> list:
        r = self.rng
        inside = self.text("h1", self.words(2, 12), True) if r.random() < 0.85 else []
        for _ in range(r.choice([1, 2, 3, 5, 8, 14])):
            kind = r.random()
            if kind < 0.72:
                value = self.prose()
                inside += r.choice([["<p>", (value, True), "</p>"], ["<p>", (value, True), "</p>"], ["<p><b>", (value, True), "<br>"],
                                    ["<p>", (value, True)], ["<p>", (self.words(2, 9), True), " <b>", (self.word(), True), "</b> ", (value, True), "</p>"],
                                    ["<div>", (value, True), "</div>"]])
            elif kind < 0.8:
                inside += self.text(r.choice(["h2", "h3"]), self.words(1, 7), True)
            elif kind < 0.87:
                inside += ["<ul>", *sum((self.text("li", self.prose(False), True) for _ in range(r.randint(2, 5))), []), "</ul>"]
            elif kind < 0.92:
                inside += self.text(r.choice(["blockquote", "pre", "figcaption", "td"]), self.prose(False), True)
            elif noise:
                inside += self.noise(r.choice(noise))
            else:
                inside += self.text("p", self.prose(), True)
        return inside

    def page(self) -> tuple[str, list[bool]]:
        """Markup and the label of each of its blocks."""
        r = self.rng
        if self.plain:
            return self.labelled(self.plain_body())
        before = [k for k in ("header", "nav", "notice", "ad", "form", "sidebar") if r.random() < 0.45]
        after = [k for k in ("share", "comments", "ad", "sidebar", "form", "notice", "footer") if r.random() < (0.8 if k == "footer" else 0.35)]
        r.shuffle(before)
        body = sum((self.noise(k) for k in before), []) + (self.main() if r.random() < 0.97 else []) + sum((self.noise(k) for k in after), [])
        if r.random() < 0.3:
            body = self.element(r.choice(["div.wrapper", "div.container", "div.page", "div#wrap"]), body)
        return self.labelled(body)

    def labelled(self, body: list) -> tuple[str, list[bool]]:
        r = self.rng
        parts = ["<!DOCTYPE html><html><head><title>", (self.words(2, 8), False), "</title><style>p{}</style></head><body>", *body,
                 *([] if r.random() < 0.2 else ["</body></html>"])]
        # Every text is marked with its label while the page is cut into blocks.
        marked = "".join(p if isinstance(p, str) else f"{p[0]}{chr(0xE000 + p[1])}" for p in parts)
        found = blocks(marked)
        return re.sub("[]", "", marked), ["" in b.text for b in found]


@lru_cache(maxsize=4)
def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = SEED, plain: bool = False) -> Weights:
    """Weights after Adam on generated pages, of marked or of plain layouts; the same on every call."""
    source = _Pages(seed, plain)
    data = []
    while len(data) < pages:
        markup, labels = source.page()
        found = blocks(markup)
        if found and len(found) == len(labels):
            data.append((features(found), np.array(labels, dtype=np.float32)))
    rng = np.random.default_rng(seed)
    w = new_weights(rng)
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    for epoch in range(epochs):
        order = sorted(rng.permutation(len(data)), key=lambda i: len(data[i][0]) // 8)
        groups = [order[i:i + 20] for i in range(0, len(order), 20)]
        for g in rng.permutation(len(groups)):
            x, mask = padded([data[i][0] for i in groups[g]])
            x[:, rng.random(x.shape[1]) < NO_WORDS, PATH_DIMS:PATH_DIMS + WORD_DIMS] = 0
            y = np.zeros(mask.shape, dtype=np.float32)
            for column, i in enumerate(groups[g]):
                y[:len(data[i][1]), column] = data[i][1]
            _, grads = loss_and_gradients(x, mask, y, w)
            step += 1
            rate = 0.02 * (1 - epoch / epochs)
            for k, grad in grads.items():
                grad = np.clip(grad, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.99 * v[k] + 0.01 * grad * grad
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return w


# ----------------------------------------------------------------- labelling
#: Blocks (pages times their longest) that one pass of the model takes, unless a single page has more.
CELLS = 1 << 14


def label(pages: list[list[Block]], w: Weights) -> list[np.ndarray]:
    """True for each main block of each page; pages of similar length go through the model together."""
    out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
    todo = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    while todo:
        longest = len(pages[todo[-1]])
        group, todo = todo[-max(1, CELLS // longest):], todo[:-max(1, CELLS // longest)]
        x, mask = padded([features(pages[i]) for i in group])
        main = logits(x, mask, w) > 0
        for column, i in enumerate(group):
            out[i] = main[:len(pages[i]), column]
    return out


#: Tags and class, id or role words that name a part of a page, from the layouts above.
KNOWN_MARKS = frozenset(
    mark for name in [*MAIN, *(n for names, _ in NOISE.values() for n in names)] for tag, *words in [re.split(r"[.#-]", name)]
    for mark in [*([tag] if tag in ("article", "main", "nav", "header", "footer", "aside", "form", "dialog") else []), *(f".{w}" for w in words)])


def is_marked(page: list[Block]) -> bool:
    """Whether any block lies in an element whose tag or marks name a part of a page."""
    return any(not KNOWN_MARKS.isdisjoint(element.split(" ")) for b in page for element in b.path)


def models(pages: int = TRAIN_PAGES) -> tuple[Weights, Weights]:
    """Weights for pages with known marks, and for pages without any."""
    return train(pages), train(pages, plain=True)


def main_texts(markup: list[str | None], w: Weights | tuple[Weights, Weights]) -> list[str]:
    """Main texts, labelled by one model or by that of each page's kind (marked, plain)."""
    pages = [blocks(m or "") for m in markup]
    marks: list = [None] * len(pages)
    if isinstance(w, tuple):
        kinds = [[i for i, p in enumerate(pages) if is_marked(p)], [i for i, p in enumerate(pages) if not is_marked(p)]]
    else:
        kinds, w = [list(range(len(pages)))], (w,)
    for own, weights in zip(kinds, w, strict=True):
        for i, found in zip(own, label([pages[i] for i in own], weights), strict=True):
            marks[i] = found
    return [" ".join(b.text for b, main in zip(page, found, strict=True) if main) for page, found in zip(pages, marks, strict=True)]


def extract(spark: SparkSession, df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
            training_pages: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text): the main text of every page."""
    weights = spark.sparkContext.broadcast(models(training_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = main_texts(part.column(2).to_pylist(), weights.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 names=["page_id", "url", "text"])

    rows = df.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
