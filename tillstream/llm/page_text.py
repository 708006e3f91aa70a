"""Main text of web pages: a recurrent block labeller.

A page is read as its leaf blocks in order. Each block is a vector of hashed tag-path parts, hashed words and a
few ratios; a bidirectional LSTM in numpy reads the whole sequence and labels every block as article or not, so
each decision sees the document on both sides. The network is trained here on generated pages.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.common import from_texts

PATH, WORDS, RATIOS = 96, 32, 8
HIDDEN = 16
PAGES, EPOCHS, BATCH, RATE = 1500, 12, 30, 0.01
SEED = 11

_START = re.compile(r"<(?:(/?)([a-zA-Z][\w:-]*)|!--|[!?/])")
_USUAL = re.compile(r"<(/?)([a-zA-Z][\w:-]*+)([^<>\"']*+(?:\"[^<>\"]*+\"[^<>\"']*+)*+)>")  # reads up to the next mark at most
_UNQUOTED = re.compile(r"[^<>\"']*")
_UNBROKEN = re.compile(r"[^<>]*>")
# Elements whose content is no text of the page, up to their end tag (fixed values).
_RAW = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in "script style noscript template svg select textarea title iframe".split()}
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
# Elements inside a block of text; all others begin and end blocks.
_INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
              "strong sub sup time tt u var wbr".split())
_EMPTY = set("area base br col embed hr img input link meta source track wbr".split())
_CLOSED_BY = {"p": {"p", "div", "ul", "ol", "table", "section", "article", "aside", "header", "footer", "nav", "form", "main", "pre",
                    "blockquote", "h1", "h2", "h3", "h4", "h5", "h6", "figure", "hr", "dl"},
              "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
              "option": {"option"}}
_NEAR = 6  # open elements that make up a path


@dataclass
class Block:
    """Text of a leaf block, its path (name and attribute words of the nearest open elements) and how much of it is in links."""

    text: str
    path: list[str]
    linked: int


class _Marks:
    """Marks of a page, each place of which is read a fixed number of times, however broken the marks are."""

    def __init__(self, page: str):
        self.page = page
        self.unclosed: set[int] = set()  # opening quotes from which no tag end is reached
        self.missing: set[str] = set()  # characters that do not come any more

    def find(self, char: str, at: int) -> int:
        found = -1 if char in self.missing else self.page.find(char, at)
        if found < 0:
            self.missing.add(char)
        return found

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` of a tag, outside of quotes; -1 if another ``<`` or the end of the page comes first."""
        quotes = []
        while True:
            at = _UNQUOTED.match(self.page, at).end()
            char = self.page[at:at + 1]
            if char == ">":
                return at
            close = -1 if char in ("<", "") or at in self.unclosed else self.find(char, at + 1)
            if char in ('"', "'"):
                quotes.append(at)
            if close < 0:
                self.unclosed.update(quotes)
                return -1
            at = close + 1

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, end, whether an end tag, name, attributes); the name of anything but a tag is empty."""
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            if (m := _USUAL.match(page, start)) and (m[1] or m[2].lower() not in _RAW):
                at = m.end()
                yield start, at, bool(m[1]), m[2].lower(), m[3]
                continue
            at = start + 1
            m = _START.match(page, start)
            if not m:
                continue
            tag = (m[2] or "").lower()
            if m[0] == "<!--":
                end = page.find("-->", m.end())
                at = end + 3 if end >= 0 else len(page)
                yield start, at, False, "", ""
                continue
            end = self.tag_end(m.end()) if tag else self.find(">", m.end())
            attributes = page[m.end():end] if tag else ""
            if end < 0 and tag in _RAW and not m[1]:
                end = self.find(">", m.end())
            elif end < 0 and tag:  # quotes that do not close, or the next mark comes first
                broken = _UNBROKEN.match(page, m.end())
                end, tag = broken.end() - 1 if broken else self.find(">", m.end()) if m[1] else -1, ""
            if end < 0:
                continue
            at = end + 1
            if tag in _RAW and not m[1]:
                close = _RAW[tag].search(page, at)
                at, tag = close.end() if close else len(page), ""
            yield start, at, bool(m[1]), tag, attributes


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order. Broken markup is read as far as it goes; nothing is cut."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    places: dict[str, list[int]] = {}  # of the open elements of each name
    parts: list[str] = []
    linked = links = 0

    def close() -> None:
        nonlocal parts, linked
        text = _SPACE.sub(" ", unescape("".join(parts))).strip() if parts else ""
        if text:
            out.append(Block(text, [name for _, name in stack[-_NEAR:]], linked))
        parts, linked = [], 0

    def leave(depth: int) -> None:
        for name, _ in stack[depth:]:
            places[name].pop()
        del stack[depth:]

    at = 0
    page = page or ""
    for start, end, ends, tag, attributes in _Marks(page):
        if start > at:
            parts.append(page[at:start])
            linked += (start - at) * (links > 0)
        at = end
        if not tag:
            continue
        if tag in _INLINE:
            links = max(0, links + (-1 if ends else 1)) if tag == "a" else links
            if tag == "br":
                parts.append(" ")
            continue
        close()
        links = 0
        if ends:
            if places.get(tag):
                leave(places[tag][-1])
            continue
        while stack and tag in _CLOSED_BY.get(stack[-1][0], ()):
            leave(len(stack) - 1)
        if tag not in _EMPTY:
            named = " ".join(f"{a.lower()} {v}" for a, v in _NAMES.findall(attributes)) if attributes else ""
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, f"{tag} {named}".strip()))
    parts.append(page[at:])
    close()
    return out


class _Slots(dict):
    """Slot and sign of a string by its hash: ``slot`` or ``size + slot``; kept, as words and paths come again."""

    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = zlib.crc32(word.strip(".,;:!?()|#*$%&").lower().encode("utf-8", "replace"))
        self[word] = h % self.size + self.size * (h >> 16 & 1)
        return self[word]


_path_slots, _word_slots = _Slots(PATH), _Slots(WORDS)
_known_paths: dict[tuple, np.ndarray] = {}


def _path_vector(near: tuple[str, ...]) -> np.ndarray:
    """Hashed names of the nearest open elements; nearer ones count more."""
    if near not in _known_paths:
        if len(_known_paths) > 50_000:
            _known_paths.clear()
        out = np.zeros(2 * PATH, dtype=np.float32)
        for up, element in enumerate(near):
            for part in _PART.findall(element.lower()):
                out[_path_slots[part]] += 1 / (1 + 0.2 * up)
        _known_paths[near] = out[:PATH] - out[PATH:]
    return _known_paths[near]


def block_vectors(own: list[Block]) -> np.ndarray:
    """One row per block: tag-path parts, words, ratios and place."""
    texts = [b.text.split() for b in own]
    counts = np.array([len(t) for t in texts])
    slots = np.fromiter((_word_slots[w] for t in texts for w in t), dtype=np.int64, count=counts.sum())
    words = np.bincount(np.repeat(np.arange(len(own)) * 2 * WORDS, counts) + slots, minlength=2 * WORDS * len(own)).reshape(-1, 2, WORDS)
    words = np.clip((words[:, 0] - words[:, 1]) / (2 * np.sqrt(counts))[:, None], -1, 1)
    sizes = np.array([len(b.text) for b in own])
    marks = np.array([b.text.count(".") + b.text.count(",") + b.text.count(";") for b in own])
    place = np.arange(len(own))
    ratios = (np.log1p(sizes) / 8, np.log1p(counts) / 6, np.minimum(1, [b.linked for b in own] / sizes), np.minimum(1, marks / sizes * 10),
              np.array([b.text[-1] in ".!?:\"" for b in own]), place / len(own), 1 / (1 + place), 1 / (len(own) - place))
    paths = np.stack([_path_vector(tuple(b.path[:-_NEAR - 1:-1])) for b in own])
    return np.concatenate((paths, words, np.stack(ratios, axis=1)), axis=1).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Labeller:
    """Bidirectional LSTM: input and recurrent weights and bias per direction, and the logistic output."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = SEED) -> Labeller:
        r, n = np.random.default_rng(seed), PATH + WORDS + RATIOS
        w = {}
        for d in "fb":
            w |= {f"in_{d}": r.normal(0, n ** -0.5, (n, 4 * HIDDEN)), f"re_{d}": r.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN)),
                  f"bias_{d}": np.concatenate((np.ones(HIDDEN), np.zeros(3 * HIDDEN)))}
        w |= {"out": r.normal(0, 0.2, 2 * HIDDEN), "offset": np.zeros(1)}
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states of one direction over padded pages (page, block, input); padding keeps the state."""
        n, steps, _ = x.shape
        ahead = x @ self.weights[f"in_{d}"] + self.weights[f"bias_{d}"]
        h = c = np.zeros((n, HIDDEN), dtype=np.float32)
        states, kept = np.zeros((n, steps, HIDDEN), dtype=np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = ahead[:, t] + h @ self.weights[f"re_{d}"]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            f, i, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t, None]
            new = f * c + i * g
            wide = np.tanh(new)
            kept.append((t, h, c, f, i, o, g, wide, m))
            h, c = m * (o * wide) + (1 - m) * h, m * new + (1 - m) * c
            states[:, t] = h
        return states, kept

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, d)[0] for d in "fb"], axis=2)
        return _sigmoid(both @ self.weights["out"] + self.weights["offset"][0])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Back-propagation through time of the mean log loss."""
        w, runs = self.weights, {d: self._run(x, mask, d) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        error = (_sigmoid(both @ w["out"] + w["offset"][0]) - y) * mask / mask.sum()
        grads = {"out": np.einsum("nt,nth->h", error, both), "offset": np.array([error.sum()])}
        for k, d in enumerate("fb"):
            above = error[:, :, None] * w["out"][k * HIDDEN:(k + 1) * HIDDEN]
            dh = dc = np.zeros((len(x), HIDDEN), dtype=np.float32)
            dahead, drecurrent = np.zeros((*x.shape[:2], 4 * HIDDEN), dtype=np.float32), np.zeros_like(w[f"re_{d}"])
            for t, h, c, f, i, o, g, wide, m in reversed(runs[d][1]):
                dh = dh + above[:, t]
                through, stay = dh * m, dh * (1 - m)
                dnew = through * o * (1 - wide ** 2) + dc * m
                dz = np.concatenate((dnew * c * f * (1 - f), dnew * g * i * (1 - i), through * wide * o * (1 - o), dnew * i * (1 - g ** 2)), axis=1)
                dahead[:, t] = dz
                drecurrent += h.T @ dz
                dh, dc = dz @ w[f"re_{d}"].T + stay, dnew * f + dc * (1 - m)
            flat = dahead.reshape(-1, 4 * HIDDEN)
            grads |= {f"in_{d}": x.reshape(-1, x.shape[2]).T @ flat, f"re_{d}": drecurrent, f"bias_{d}": flat.sum(axis=0)}
        return grads

    def keep(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which blocks are article text. Pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while order:
            taken = [order.pop() for _ in range(max(1, min(len(order), 4000 // len(pages[order[-1]]))))]
            p = self.probabilities(*_padded([block_vectors(pages[i]) for i in taken]))
            for row, i in enumerate(taken):
                out[i] = p[row, :len(pages[i])] >= 0.5
        return out


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((len(rows), steps, rows[0].shape[1]), dtype=np.float32), np.zeros((len(rows), steps), dtype=np.float32)
    for i, r in enumerate(rows):
        x[i, :len(r)], mask[i, :len(r)] = r, 1
    return x, mask


# Words that site parts are named by or show (fixed values).
_PARTS = {
    "menu": ("nav ul.menu div.navbar div#menu ul.nav div.breadcrumbs".split(), "home about contact products news blog login menu start".split()),
    "header": ("header div.header div#masthead div.topbar".split(), "welcome search login subscribe".split()),
    "footer": ("footer div.footer div#footer div.site-footer div.copyright".split(), "© copyright rights reserved privacy terms imprint".split()),
    "sidebar": ("aside div.sidebar div#sidebar div.widget div.related section.related div.recommended".split(), "related popular recent more also tags".split()),
    "notice": ("div.notice div.cookie-banner div#cookie-notice div.alert div.consent div.newsletter".split(), "cookies accept consent privacy newsletter subscribe agree".split()),
    "advert": ("div.ad div.ads div.advert div.sponsored div.banner div.promo ins.adsbygoogle".split(), "advertisement sponsored buy offer sale".split()),
    "form": ("form div.search form.signup form.login".split(), "name email password submit send search".split()),
    "comments": ("div.comments section#comments div#comments ol.comment-list section.comments div.reader-comments ul.comments div.responses".split(),
                 "comment reply says posted comments anonymous".split()),
    "share": ("div.share div.social ul.share-buttons".split(), "share tweet facebook print email".split()),
}
_MAIN = "article article.post main main#content div.content div#content div.article-body section.post div.entry-content div.story td.text div".split()
_TEXT = "p p p p p p h1 h2 h3 li blockquote pre td dd".split()
_AFTER = ("footer", "comments", "sidebar", "share", "notice", "advert", "form")


class _Pages:
    """Made-up pages as blocks with labels: parts of a site around and inside an article of pseudo words."""

    def __init__(self, seed: int = SEED):
        self.r = random.Random(seed)
        self.odd = lambda t, n: t

    def words(self, n: int) -> str:
        r = self.r
        syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de ue ch ie ei sch un ich ge qu ai é ó ü".split()
        text = " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) + ("," if r.random() < 0.08 else "") for _ in range(n))
        return self.odd(text.capitalize() + r.choice([".", ".", "", "!", "?"]), n)

    def style(self) -> None:
        """Junk is text too: some pages are all repeats, capitals, symbols or rows of a table."""
        r = self.r
        mark = r.choice(["!! ", "*** ", " | ", "### "])
        self.odd = r.choice([lambda t, n: " ".join([t.split()[0]] * n), lambda t, n: t.upper(), lambda t, n: t.replace(" ", mark),
                             lambda t, n: t.replace(" ", mark)]) if r.random() < 0.25 else lambda t, n: t

    def path(self, spec: str) -> str:
        tag, _, named = re.match(r"(\w+)([.#]?)(.*)", spec).groups()
        kind = "class" if "." in spec else "id"
        return f"{tag} {kind} {named}" if named else tag

    def part(self, kind: str, above: list[str]) -> list[tuple[Block, int]]:
        r, (specs, shown) = self.r, _PARTS[kind]
        path = [*above, self.path(r.choice(specs))]
        out = []
        for _ in range(r.randint(2, 9) if kind in ("menu", "sidebar", "share", "comments") else r.randint(1, 3)):
            prose = kind in ("comments", "advert", "notice", "sidebar") and r.random() < 0.7
            text = self.words(r.randint(3, 60)) if prose else " ".join(r.choice([r.choice(shown), self.words(1)]) for _ in range(r.randint(1, 4)))
            inner = r.choice([["ul", "li"], ["li"], ["div"], ["p"], ["div class comment", "p"] if kind == "comments" else [], []])
            link = len(text) if kind in ("menu", "share") or (not prose and r.random() < 0.4) else 0
            out.append((Block(text, [*path, *inner], link), 0))
        return out

    def page(self) -> list[tuple[Block, int]]:
        r = self.r
        above = ["html", "body", *([] if r.random() < 0.5 else [self.path(r.choice(["div.container", "div#page", "div.wrapper", "table"]))])]
        spec = r.choice(_MAIN)
        main = [*above, self.path(spec)]
        out = []
        for kind in r.sample(["menu", "header", "advert", "notice", "sidebar", "form"], r.randint(1, 4)):
            out += self.part(kind, above)
        self.style()
        body = [(Block(self.words(r.randint(2, 12)), [*main, *(["header"] if r.random() < 0.1 else []), r.choice(["h1", "h1", "h2"])], 0), 1)]
        for _ in range(r.choice([1, 1, 2, 3, 5, 12, 25, 40])):
            tag = r.choice(_TEXT)
            text = self.words(r.choice([1, 2, 5, 15, 40, 90]))
            inner = [] if spec == "div" and r.random() < 0.3 else {"li": [r.choice(["ul", "ol"]), "li"], "td": ["table", "tr", "td"], "dd": ["dl", "dd"]}.get(tag, [tag])
            body.append((Block(text, [*main, *inner], r.choice([0, 0, 0, len(text) // 4])), 1))
        self.odd = lambda t, n: t
        for kind in r.sample(["advert", "share", "comments", "sidebar", "form", "notice"], r.choice([0, 0, 1, 2])):
            at = len(body) if kind in ("comments", "share") else r.randint(1, len(body))
            body[at:at] = self.part(kind, main)
        out += body
        for kind in r.sample(_AFTER, r.randint(1, 4)):
            out += self.part(kind, above)
        return out


def train_labeller(pages: int = PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """Fit the network on ``pages`` generated pages (Adam); the seed fixes pages, start and order."""
    made, net, random_order, step = _Pages(seed), Labeller.fresh(seed), np.random.default_rng(seed), 0
    data = []
    for _ in range(pages):
        own = made.page()
        data.append((block_vectors([b for b, _ in own]), np.array([y for _, y in own], dtype=np.float32)))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.weights.items()}
    for _ in range(epochs):
        near = sorted(range(len(data)), key=lambda i: len(data[i][1]) + 5 * random_order.random())
        batches = [near[i:i + BATCH] for i in range(0, len(near), BATCH)]
        for b in random_order.permutation(len(batches)):
            x, mask = _padded([data[i][0] for i in batches[b]])
            y = np.zeros(mask.shape, dtype=np.float32)
            for row, i in enumerate(batches[b]):
                y[row, :len(data[i][1])] = data[i][1]
            step += 1
            rate = RATE * (1 - step / (epochs * len(batches) + 1))
            for k, g in net.gradients(x, mask, y).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g ** 2 - v)
                net.weights[k] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def extract_text(pages: DataFrame, net: Labeller, html: str = "html") -> DataFrame:
    """``pages`` with ``html`` replaced by ``text``: the blocks labelled as article, in page order, joined by newlines.

    Character references are decoded and white space in a block becomes one space. Null or empty html, and pages
    without an article block, give an empty text. Rows are read one by one; other columns do not pass through Python, and a
    column named ``text`` (in any case) is replaced.
    """
    def extract(markup: list) -> list[tuple]:
        own = [blocks(p) for p in markup]
        return [("\n".join(b.text for b, yes in zip(bs, keep) if yes),) for bs, keep in zip(own, net.keep(own))] if own else []

    source = pages.withColumn("_html", F.col(html)).drop(html, "text")
    return source.withColumn("text", from_texts(F.col("_html"), lambda: extract, "text string")["text"]).drop("_html")
