"""Secret scans: fixed patterns and a linear-chain conditional random field.

Every token of a text is tagged B (a secret begins), I (it goes on) or O; a line end is a token too. A tag depends on
the token's shape, its neighbours, the part between white space it belongs to, the key words before it and on the file
it stands in. The best sequence of the whole text is found by Viterbi. A bound on what a stretch of B and I can gain
over O shows which tokens are O in the best sequence, whatever the others are; the stretches between them are decoded.
"""

from __future__ import annotations

import heapq
import json
import math
import random
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.common import from_texts, stored

KINDS = ["assign", "access", "hex", "crf"]
TAGS = ["B", "I", "O"]
SAMPLE_RUNS = 6000  # bound of the runs taken from the corpus for training
GENERATED_RUNS = 4000
LONGEST_RUN = 24  # tokens of a run taken for training
FEATURES = 1 << 12
EPOCHS, RATE = 80, 0.1

# Patterns of the base kinds (fixed values).
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

_PART = re.compile(r"\S+|\n")
_TOKEN = re.compile(r"[\w+/-]+(?:\.+[\w+/-]+)*|=+|\s|\S")
_PIECE = re.compile(r"\S[^\n]{0,150}\S*")  # of a line, taken for training
_KEY_WORD = re.compile(r"pass|pwd|secret|token|key|auth|bearer|cred|private", re.I)
_PREFIX = re.compile(r"AKIA|ASIA|gh[pousr]_|sk[-_]|pk[-_]|xox[abprs]-|eyJ|AIza|glpat-|SG\.")
_TELLING = re.compile(_KEY_WORD.pattern + r"|[0-9]", re.I)
_EDGES = "\"'`,.;:()[]{}<>!?"
_KINDS_BEFORE, _MIXES = 5, 64  # kinds of a part before a token; mixes of characters of a part
_WORD = re.compile(r"([^\w+/-]*)([^\W\d_]{2,})([^\w+/-]*)")  # a part with one token, which has letters only
_HEX_WORD = re.compile(r"[A-Fa-f]+")
_LATIN = re.compile(r"[a-z]+")
_ENTROPIES = [2, 2.5, 3, 3.5, 4, 4.5]
_CACHED = 500_000  # parts and tokens whose scores a process keeps


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then in the order of the kinds."""
    found = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _bucket(x: float, *limits: float) -> int:
    return sum(x >= limit for limit in limits)


def _entropy(token: str) -> int:
    n, kinds = len(token), set(token)
    if len(kinds) < 4:
        return 0
    repeats = sum(k * math.log2(k) for k in map(token.count, kinds) if k > 1) if len(kinds) < n else 0
    return bisect_right(_ENTROPIES, math.log2(n) - repeats / n + 1e-9)


class _Cases(dict):
    """What the case of a letter is."""

    def __missing__(self, letter: str) -> int:
        self[letter] = letter.islower() + 2 * letter.isupper() + 4 * letter.istitle()
        return self[letter]


_case = _Cases().__getitem__


def _token_features(token: str) -> list[str]:
    n = len(token)
    kinds = "".join(sorted({"d" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "p" for c in token}))
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:])) / n
    hexed = re.fullmatch(r"[0-9a-fA-F]+", token) is not None
    words = max(map(len, _LATIN.findall(token.lower())), default=0)
    return [f"len{_bucket(n, 8, 12, 16, 20, 24, 32, 48)}", f"kinds{kinds}", f"changes{_bucket(changes, .05, .15, .3, .45)}",
            f"entropy{_entropy(token)}", f"hex{hexed}{_bucket(n, 16, 32)}",
            f"word{_bucket(words, 3, 5, 7, 10)}", f"prefix{bool(_PREFIX.match(token))}", f"dots{_bucket(token.count('.'), 1, 2, 3)}",
            f"dashes{_bucket(token.count('-'), 1, 2, 4)}", f"slash{_bucket(token.count('/'), 1, 2)}"]


def _file_features(text: str) -> list[str]:
    """What kind of file a text is, from the whole of it."""
    n = max(1, len(text))
    return [f"file={_bucket(text.count('=') / n, .001, .01)}", f"braces{_bucket(text.count('{') / n, .0005, .005)}",
            f"size{_bucket(n, 200, 2000, 20000)}"]


def _part_kind(part: str) -> int:
    """What a part is to those after it: text, key word, key word with a mark, marks, line end."""
    if part == "\n":
        return 4
    if not any(map(str.isalnum, part)):
        return 3
    if _KEY_WORD.search(part):
        return 2 if part.rstrip("\"'`")[-1:] in ("=", ":", ">") else 1
    return 0


def _part_rows(part: str) -> tuple[list[tuple[int, int]], list[list[str]], list[bool], int]:
    """Tokens of a part (text between white space, or a line end): places, features, whether inside its edges, mix of the part."""
    lead, core = len(part) - len(part.lstrip(_EDGES)), part.strip(_EDGES)
    inner = core[1:] if not core.isupper() else ""
    mix = (any(map(str.islower, core)) + 2 * any(map(str.isupper, inner)) + 4 * any(map(str.isdigit, core))
           + 8 * any(not c.isalnum() and c not in "-_./" for c in core) + 16 * _bucket(len(core), 6, 10, 16))
    places, rows, inside, named, assigned, quote = [], [], [], False, False, ""
    for m in _TOKEN.finditer(part):
        token, (start, end) = m[0], m.span()
        before, after = part[start - 1:start] if start else "", part[end:end + 1]
        where = f"{named}{assigned}{bool(quote)}"
        row = _token_features(token) if token[0].isalnum() or len(token) > 1 else [f"sign{token}"]
        own = _KEY_WORD.search(token) is not None
        rows.append([*row, f"key{own}{after in ('=', ':') and after}", f"in{where}", f"in{where}{mix}", f"mix{mix}", f"previous{'' if before.isalnum() else before}",
                     f"next{'' if after.isalnum() else after}", f"place{not start}{not after}", f"equals{token[0] == '='}{not after}"])
        places.append((start, end))
        inside.append(lead <= start and end <= lead + len(core))
        named, assigned = named or own, (assigned or named and token[0] in "=:") and not own
        if token in "\"'`":
            quote = "" if quote == token else token
    return places, rows, inside, mix


def _around(inside: bool, last: int, before: int, mix: int) -> list[str]:
    """Features of the parts before a token's part, by their kinds."""
    return [f"before{inside}{last}", f"before{inside}{last}{before}", f"before{inside}{last}{before}mix{mix}", f"before{inside}{last}mix{mix % 16}"]


def token_rows(text: str, about: list[str] | None = None) -> tuple[list[tuple[int, int]], list[list[str]]]:
    """Places and features of all tokens of a text."""
    about = _file_features(text) if about is None else about
    places, rows, last, before = [], [], 4, 4
    for m in _PART.finditer(text):
        at, own, inside, mix = _part_rows(m[0])
        places += [(m.start() + s, m.start() + e) for s, e in at]
        rows += [[*r, *_around(i, last, before, mix), *about] for r, i in zip(own, inside)]
        last, before = _part_kind(m[0]), last
    return places, rows


@lru_cache(maxsize=100_000)
def _number(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % FEATURES


def _numbers(rows: list[list[str]]) -> list[list[int]]:
    return [list(map(_number, row)) for row in rows]


def _viterbi(scores: np.ndarray, first: np.ndarray, step: np.ndarray, last: np.ndarray | None = None) -> list[int]:
    """The best tag sequence; I only after B or I. Ties go to the later tag, so to O."""
    best, back = first + scores[0], []
    best[1] = -np.inf
    for s in scores[1:]:
        ways = best[:, None] + step[:3]
        ways[2, 1] = -np.inf
        back.append(2 - ways[::-1].argmax(axis=0))
        best = ways.max(axis=0) + s
    best = best if last is None else best + last
    tags = [2 - int(best[::-1].argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


@dataclass
class Chain:
    """Weights of the field: (feature, tag) and (tag before, tag); row 3 of the second is the start of a run."""

    emit: np.ndarray
    step: np.ndarray
    _scan: "_Scan | None" = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {"emit": self.emit, "step": self.step, "_scan": None}

    def score(self, features: list[str]) -> np.ndarray:
        return self.emit[_numbers([features])[0]].sum(axis=0)

    def tags(self, rows: list[list[str]]) -> list[int]:
        """The best tag sequence of a run (Viterbi)."""
        return _viterbi(np.array([self.score(row) for row in rows]), self.step[3], self.step)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """Secrets that the field finds in a whole text."""
        self._scan = self._scan or _scan_with(self.emit.tobytes(), self.step.tobytes())
        return self._scan.spans(text)


class _Known(dict):
    """Numbers of parts; a new part is learned."""

    def __init__(self, learn: Callable[[str], int]):
        super().__init__()
        self.learn = learn

    def __missing__(self, part: str) -> int:
        self[part] = at = self.learn(part)
        return at


class _Scan:
    """Decodes whole texts; scores of parts are computed once and kept."""

    def __init__(self, chain: Chain):
        self.chain = chain
        step = chain.step
        self.inner = max(step[0, 0], step[0, 1], step[1, 0], step[1, 1]) - step[2, 2]
        begin = max(step[2, 0] - step[2, 2], step[3, 0] - step[3, 2])
        self.rest = begin + max(step[0, 2] - step[2, 2], step[1, 2] - step[2, 2], 0) - self.inner
        kinds = range(_KINDS_BEFORE)
        self.around = np.array([[[[chain.score(_around(i, last, before, mix)) for mix in range(_MIXES)] for before in kinds] for last in kinds]
                                for i in (False, True)])
        self.clear()

    def clear(self) -> None:
        self.known, self.words, self.rows, self.n_parts, self.n_tokens = _Known(self.learn), {}, {}, 0, 0
        self.parts = np.zeros((1024, 4), dtype=np.int64)  # kind, mix, first token, number of tokens
        self.scores, self.inside = np.zeros((1024, 3)), np.zeros(1024, dtype=np.int64)

    def learn(self, part: str) -> int:
        """Number of a part. Words that agree in all that their features are made of share one."""
        word = _WORD.fullmatch(part)
        if word and word[2].isalpha() and not _KEY_WORD.search(part):
            letters = word[2]
            n = len(letters)
            plain = letters.isascii() and letters.islower()
            cases = (1, 1) if plain else (_case(letters[0]), frozenset(map(_case, letters[1:])))
            latin = n if plain else max(map(len, _LATIN.findall(letters.lower())), default=0)
            like = (word[1], word[3], cases, min(n, 48), min(latin, 10), _entropy(letters), _HEX_WORD.fullmatch(letters) is None,
                    not plain and _PREFIX.match(letters) is not None)
            if like in self.words:
                return self.words[like]
            self.words[like] = self.n_parts
        _, rows, inside, mix = _part_rows(part)
        at, n, end = self.n_parts, self.n_tokens, self.n_tokens + len(rows)
        self.n_parts += 1
        if at == len(self.parts):
            self.parts = np.concatenate((self.parts, np.zeros_like(self.parts)))
        while end > len(self.scores):
            self.scores, self.inside = (np.concatenate((x, np.zeros_like(x))) for x in (self.scores, self.inside))
        self.parts[at] = _part_kind(part), mix, n, len(rows)
        for i, row in enumerate(map(tuple, rows)):
            if (score := self.rows.get(row)) is None:
                score = self.rows[row] = self.chain.score(row)
            self.scores[n + i] = score
        self.inside[n:end] = inside
        self.n_tokens = end
        return at

    def token_scores(self, text: str) -> np.ndarray:
        """Scores of the tags of all tokens of a text."""
        parts = _PART.findall(text)
        if max(self.n_tokens, len(self.rows), len(self.words)) > _CACHED:
            self.clear()
        elif len(self.known) > _CACHED:
            self.known.clear()  # most come back by the words they are like
        ids = np.fromiter(map(self.known.__getitem__, parts), dtype=np.int64, count=len(parts))
        kind, mix, first, n = self.parts[ids].T
        ends = np.cumsum(n)
        at = np.repeat(first - ends + n, n) + np.arange(ends[-1])
        kinds = np.concatenate(([4, 4], kind))
        own = ((self.inside[at] * _KINDS_BEFORE + np.repeat(kinds[1:-1], n)) * _KINDS_BEFORE + np.repeat(kinds[:-2], n)) * _MIXES + np.repeat(mix, n)
        return self.scores[at] + self.around.reshape(-1, 3)[own] + self.chain.score(_file_features(text))

    def tags(self, text: str) -> list[tuple[int, list[int]]]:
        """(first token, tags) of the stretches of a text that may hold other tags than O; all else is O.

        A stretch of B and I gains at most the sum of its gains and ``rest`` over O in its place, so a token in
        no stretch with a sum above ``-rest`` is O in the best sequence.
        """
        if not text or text.isspace():
            return []
        scores, step = self.token_scores(text), self.chain.step
        gain = np.maximum(scores[:, 0], scores[:, 1]) - scores[:, 2] + self.inner
        up = np.cumsum(gain)
        ahead = up - np.minimum.accumulate(np.concatenate(([0], up[:-1])))
        behind = np.maximum.accumulate(up[::-1])[::-1] - up
        open_ = np.flatnonzero(ahead + behind + self.rest >= -1e-6)
        out = []
        for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1) if len(open_) else []:
            low, high = int(run[0]), int(run[-1]) + 1
            out.append((low, _viterbi(scores[low:high], step[2] if low else step[3], step, step[:3, 2] if high < len(scores) else None)))
        return out

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        found = [(low, tags) for low, tags in self.tags(text) if min(tags) < 2]
        if not found:
            return []
        places = [(m.start() + t.start(), m.start() + t.end()) for m in _PART.finditer(text) for t in _TOKEN.finditer(m[0])]
        out = []
        for low, tags in found:
            for (start, end), tag in zip(places[low:], tags):
                if tag == 0:
                    out.append(("crf", start, end))
                elif tag == 1:
                    out[-1] = ("crf", out[-1][1], end)
        return out


@lru_cache(maxsize=1)
def _scan_with(emit: bytes, step: bytes) -> _Scan:
    """A worker process keeps the scores from task to task."""
    return _Scan(Chain(np.frombuffer(emit).reshape(-1, 3), np.frombuffer(step).reshape(-1, 3)))


def train_chain(runs: list[tuple[list[list[int]], list[int]]], epochs: int = EPOCHS) -> Chain:
    """Maximum likelihood with forward-backward, all runs at once, by AdaGrad with a small penalty."""
    chain = Chain(np.zeros((FEATURES, 3)), np.zeros((4, 3)))
    runs = sorted((r for r in runs if r[1]), key=lambda r: -len(r[1]))
    if not runs:
        return chain
    # tokens of equal features are scored once
    kinds: dict[tuple, int] = {}
    ids = [[kinds.setdefault(tuple(sorted(row)), len(kinds)) for row in rows] for rows, _ in runs]
    width = max(map(len, kinds))
    index = np.full((len(kinds), width), FEATURES, dtype=np.int64)
    for k, i in kinds.items():
        index[i, :len(k)] = k
    lengths = np.array([len(r) for r in ids])
    live = [int((lengths > t).sum()) for t in range(lengths[0])]  # runs with a token t are the first ones
    steps = [(np.array([r[t] for r in ids[:n]]), np.array([tags[t] for _, tags in runs[:n]])) for t, n in enumerate(live)]
    total, hot = len(runs), np.eye(3)
    squares = [np.full_like(chain.emit, 1e-6), np.full_like(chain.step, 1e-6)]
    for _ in range(epochs):
        emit, step = -1e-4 * chain.emit, -1e-4 * chain.step
        scores = np.vstack((chain.emit, np.zeros((1, 3))))[index].sum(axis=1)
        shares = np.exp(scores - scores.max(axis=1, keepdims=True))
        start, move = np.exp(chain.step[3]), np.exp(chain.step[:3])
        forward = []
        for t, (own, _) in enumerate(steps):
            f = (forward[-1][:len(own)] @ move if t else start) * shares[own]
            forward.append(f / f.sum(axis=1, keepdims=True))
        push, backward = np.zeros((len(kinds), 3)), None
        for t in range(len(steps) - 1, -1, -1):
            own, tags = steps[t]
            b = np.ones((len(own), 3))
            if t + 1 < len(steps):
                later = shares[steps[t + 1][0]] * backward
                n = len(later)
                pair = forward[t][:n, :, None] * move[None] * later[:, None, :]
                pair /= pair.sum(axis=(1, 2), keepdims=True)
                step[:3] += (hot[tags[:n]].T @ hot[steps[t + 1][1]] - pair.sum(axis=0)) / total
                b[:n] = later @ move.T
                b[:n] /= b[:n].sum(axis=1, keepdims=True)
            backward = b
            p = forward[t] * b
            left = hot[tags] - p / p.sum(axis=1, keepdims=True)
            for k in range(3):
                push[:, k] += np.bincount(own, left[:, k], minlength=len(kinds))
            if not t:
                step[3] += left.sum(axis=0) / total
        flat = index.ravel()
        for k in range(3):
            emit[:, k] += np.bincount(flat, np.repeat(push[:, k], width), minlength=FEATURES + 1)[:FEATURES] / total
        for w, g, s in zip((chain.emit, chain.step), (emit, step), squares):
            s += g ** 2
            w += RATE * g / np.sqrt(s)
    return chain


def tagged_runs(text: str, secrets: list[tuple[int, int]], about: list[str] | None = None) -> list[tuple[list[list[int]], list[int]]]:
    """All tokens of a text with the tags that known secret places give them, in runs of at most ``LONGEST_RUN`` tokens."""
    places, rows = token_rows(text, about)
    tags, last = [], None
    for start, end in places:
        inside = next((s for s in secrets if start < s[1] and s[0] < end), None)
        tags.append(2 if inside is None else 1 if inside == last else 0)
        last = inside
    cuts, at = [], 0
    while at < len(tags):
        end = at + LONGEST_RUN
        while at < end < len(tags) and tags[end] == 1:  # no run begins inside a secret
            end -= 1
        cuts.append((at, end if end > at else at + LONGEST_RUN))
        at = cuts[-1][1]
    numbers = _numbers(rows)
    return [(numbers[a:b], tags[a:b]) for a, b in cuts if tags[a] != 1]


def generated_runs(n: int = GENERATED_RUNS, seed: int = 5) -> list[tuple[list[list[int]], list[int]]]:
    """Made-up lines with secrets of several forms, and with mails, links, dates, names and numbers that are none."""
    r = random.Random(seed)
    low, alnum = "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    b64, letters = alnum + "+/", alnum[:52]

    def some(chars: str, least: int, most: int) -> str:
        return "".join(r.choice(chars) for _ in range(r.randint(least, most)))

    def word() -> str:
        return some(low, 2, 9)

    def secret() -> str:
        """One that shows by its own form."""
        return r.choice([lambda: some("0123456789abcdef", 16, 64), lambda: some(alnum, 16, 44), lambda: some(b64, 24, 60) + "=" * r.randint(0, 2),
                         lambda: "ghp_" + some(alnum, 30, 36), lambda: "sk-" + some(alnum, 24, 48), lambda: "AKIA" + some(alnum.upper(), 16, 16),
                         lambda: f"xoxb-{some('0123456789', 10, 12)}-{some(alnum, 20, 24)}",
                         lambda: f"eyJ{some(alnum, 12, 30)}.eyJ{some(alnum, 20, 40)}.{some(alnum + '-_', 30, 43)}"])()

    def chosen() -> str:
        """A password, which shows by the key word before it."""
        return r.choice([lambda: word() + str(r.randint(0, 9999)), lambda: "-".join(word() for _ in range(r.randint(3, 6))), lambda: some(letters, 12, 40),
                         lambda: some(alnum + "!#$%&*+-?@^_", 8, 20) + some(alnum, 1, 3), lambda: some(alnum, 6, 16),
                         lambda: f"{word().capitalize()}{r.randint(0, 99)}{r.choice('!#$%&*?@^')}{some(alnum, 1, 4)}",
                         lambda: f"{word()}{r.choice('!#$%&*@^')}{word()}{r.randint(0, 999)}", lambda: some("0123456789", 6, 12)])()

    def plain() -> str:
        return r.choice([lambda: f"{word()}.{word()}{r.randint(1, 99)}", lambda: f"https://{word()}.example/{word()}/{r.randint(1, 99999)}",
                         lambda: f"20{r.randint(10, 29)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}", lambda: f"{word()}_{word()}_{r.randint(1, 20)}.txt",
                         lambda: f"v{r.randint(1, 9)}.{r.randint(0, 30)}.{r.randint(0, 9)}-{word()}", lambda: f"{word().capitalize()}{word()}{r.randint(1, 2030)}",
                         lambda: f"ISO-{r.randint(1000, 99999)}-{r.randint(1, 9)}", lambda: f"{word().upper()}-{r.randint(10000, 999999)}",
                         lambda: f"{r.randint(1, 999)}{word()}{word()}", lambda: f"{word()}-{word()}-{r.randint(1, 9)}",
                         lambda: f"{word()}.{word()}@{word()}.example", lambda: f"{word()}{r.randint(1, 99)}@{word()}.example", lambda: str(r.randint(0, 10 ** r.randint(1, 7))),
                         lambda: f"20{r.randint(10, 29)}-{r.randint(10, 12)}-{r.randint(10, 28)}", lambda: f"({word()}, {word()})", lambda: f"{r.choice(low)}{r.randint(0, 10 ** 6)}",
                         lambda: f"{word()}:", lambda: f"{word()}={r.randint(0, 999)}", lambda: f"{word()}='{word()}'", lambda: word().capitalize() + word().capitalize(),
                         lambda: f"{r.randint(1, 99)}%", lambda: f"${r.randint(1, 999)}.{r.randint(10, 99)}", lambda: f"{r.randint(1, 12)}:{r.randint(10, 59)}", lambda: word().upper()])()

    keys = ["password", "api_key", "token", "secret", "auth_token", "client_secret", "Authorization: Bearer", "Bearer", "bearer", "pwd", "private_key", "access_key",
            "passwd", "Password", "db_password", "DB_PASS", "SECRET_KEY", "API_TOKEN", "pass", "credentials"]
    spoken = ["password", "passwords", "token", "tokens", "secret", "key", "keys", "keyboard", "monkey", "author", "authors", "passage", "private", "passed", "credit", "credentials"]
    marks = ["=", ": ", " = ", ":", "= ", " : ", " => "]
    out = []
    while len(out) < n:
        words = [r.choice([word, word, word, word, word, lambda: word().capitalize(), lambda: word() + r.choice(",.;:"), lambda: r.choice(spoken), plain])()
                 for _ in range(r.randint(0, 16))]
        at = r.randint(0, len(words))
        about = [f"file={r.randrange(3)}", f"braces{r.randrange(3)}", f"size{r.randrange(4)}"]
        lines = [" ", " ", " ", "\n"]
        head = r.choice(lines).join(words[:at]) + (r.choice(lines) if at else "")
        if (case := r.random()) < 0.55:
            key = r.choice(keys)
            if case < 0.15:
                own, lead = secret(), ""
            else:
                own = secret() if case < 0.3 else chosen()
                lead = key + (" " if key.lower().endswith("bearer") else r.choice(marks))
            quote = r.choice(["", "", '"', "'"]) if lead else ""
            head = (head + lead if not quote or r.random() < 0.8 else f"{head}{quote}{lead.rstrip()[:-1] or lead}{quote}: ") + quote
            text = head + own + quote + r.choice(["", " ", ", ", ";", "\n"][not words[at:] and 2:] if quote else [" ", "\n"]) + " ".join(words[at:])
            out += tagged_runs(text, [(len(head), len(head) + len(own))], about)
        else:
            if case < 0.7:  # a key word of which nothing secret follows
                head += r.choice(keys + spoken).split()[0] + r.choice([" is ", " for ", " of ", " ", ", ", ". ", ": the ", " and ", " was ", "? "])
            out += tagged_runs(head + plain() + " " + " ".join(words[at:]), [], about)
    return out[:n]


def _known_places(text: str) -> list[tuple[int, int]]:
    """Places of the secrets themselves that the fixed patterns find: of an assignment its value."""
    return [m.span(2) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8] + [s[1:] for s in base_spans(text) if s[0] != "assign"]


def _teaches(text: str, known: list[tuple[int, int]]) -> bool:
    """Whether a text may be learned from: what looks like a secret that the fixed patterns do not know teaches nothing."""
    rest = text
    for start, end in known:
        rest = rest[:start] + " " * (end - start) + rest[end:]
    if known:
        rest = _ASSIGN.sub(" ", re.sub(_KEY_WORD.pattern + r"[\w\"' ]*[:=]\s*[\"']?\s", " ", rest, flags=re.I))
    return not (_KEY_WORD.search(rest) or any(_PREFIX.match(m[0]) for m in _TOKEN.finditer(rest)))


def learn_secrets(docs: DataFrame, sample: int = SAMPLE_RUNS) -> Chain:
    """Train on generated runs and on at most ``sample`` runs of the corpus, tagged by the fixed patterns.

    Pieces of lines with a known prefix or a key word whose secret no fixed pattern marks are left out. Half of the
    pieces hold a key word or a digit. They are those with the smallest hash, so the sample is the same in every run.
    """
    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[bool, dict[int, str]] = {True: {}, False: {}}
        worst = {True: 2 ** 63, False: 2 ** 63}
        for f in frames:
            for text in f.text:
                about = json.dumps(_file_features(text))
                for piece in _PIECE.findall(text):
                    h = xxhash.xxh3_64_intdigest(piece.encode("utf-8", "replace")) >> 1
                    if h >= max(worst.values()):
                        continue
                    telling = _TELLING.search(piece) is not None
                    if h < worst[telling] and _teaches(piece[:4000], _known_places(piece[:4000])):
                        own = best[telling]
                        own[h] = min(own.get(h, (about, piece[:4000])), (about, piece[:4000]))
                        if len(own) > sample:
                            own = best[telling] = {k: own[k] for k in heapq.nsmallest(sample // 2, own)}
                            worst[telling] = max(own)
        rows = [(t, h, *v) for t, own in best.items() for h, v in own.items()]
        yield pd.DataFrame(rows, columns=["telling", "h", "about", "piece"])

    texts = docs.select("text").where("text is not null")
    found = texts.mapInPandas(pieces, "telling boolean, h long, about string, piece string").groupBy("telling", "h", "piece").agg(F.min("about").alias("about"))
    found = stored(found, "secret-pieces")  # both halves are read from one pass over the texts
    runs = generated_runs()
    for telling in (True, False):
        for r in found.where(F.col("telling") == telling).orderBy("h", "piece").limit(sample // 2).collect():
            runs += tagged_runs(r["piece"], _known_places(r["piece"]), json.loads(r["about"]))[:1]
    return train_chain(runs)


def find_secrets(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with ``secret_spans``, an array of (kind, start, end) in code points, by start, then kind.

    Spans of the fixed patterns stay as they are; the field adds what it finds outside of them. Null or empty
    text has no spans. Rows are scanned one by one; other columns do not pass through Python, and a column named
    ``secret_spans`` (in any case) is replaced.
    """
    def scan(texts: list) -> list[tuple]:
        return [([{"kind": k, "start": s, "end": e} for k, s, e in all_spans(t or "", chain)],) for t in texts]

    found = from_texts(F.col(text), lambda: scan, "secret_spans array<struct<kind:string,start:bigint,end:bigint>>")
    return docs.drop("secret_spans").withColumn("secret_spans", found["secret_spans"])


def mask_secrets(docs: DataFrame, chain: Chain, text: str = "text", mask: str = "<secret>") -> DataFrame:
    """``docs`` with every span of :func:`find_secrets` in ``text`` replaced by ``mask``; null text stays null."""
    def blank(texts: list) -> list[tuple]:
        return [(None if t is None else _masked(t, all_spans(t, chain), mask),) for t in texts]

    return docs.withColumn(text, from_texts(F.col(text), lambda: blank, "masked string")["masked"])


def _masked(text: str, spans: list[tuple[str, int, int]], mask: str) -> str:
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def all_spans(text: str, chain: Chain) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, and what the field finds outside of them."""
    base = base_spans(text)
    more = []
    for kind, start, end in chain.spans(text):
        for _, low, high in base:  # by start
            if low < end and start < high:
                if start < low:
                    more.append((kind, start, low))
                start = max(start, high)
        if start < end:
            more.append((kind, start, end))
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))
