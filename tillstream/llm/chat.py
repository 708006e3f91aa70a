"""Chat formatting in budgeted windows.

Turns become text with a marked template. Prefix sums of turn tokens choose turn-aligned spans: a window is
closed when the next turn would pass the budget. Each window repeats the system turn and a limited history
before its own turns; repeated turns are context only, so every assistant text is a target exactly once.
Control strings inside texts are escaped, and :func:`read_windows` gets the turns back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

BUDGET = 1024  # tokens of a window
HISTORY = 128  # of these, tokens of repeated turns
OPEN, CLOSE = "### ", "</turn>\n"
TARGET = "assistant"

WINDOW_FIELDS = "conv_id string, window int, formatted string, turns array<struct<begin:int,end:int,repeated:boolean,target:boolean>>"

_TOKEN = re.compile(r"\w+|[^\w\s]")
_TURN = re.compile(r"### (.*?):\n(.*?)</turn>\n", re.S)
_ESCAPES = {"\\": "\\\\", "#": "\\h", "</turn>": "\\t", ":": "\\c", "\n": "\\n"}
_PLAIN = {v[1]: k for k, v in _ESCAPES.items()}


def escape_text(text: str) -> str:
    """Text without any control string: a backslash, ``###`` and the end mark become two-character codes."""
    return text.replace("\\", "\\\\").replace("###", "\\h\\h\\h").replace("</turn>", "\\t")


def escape_role(role: str) -> str:
    return re.sub(r"</turn>|[\\#:\n]", lambda m: _ESCAPES[m[0]], role)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text)


def count_tokens(text: str) -> int:
    """Words and punctuation marks: the unit of the budget."""
    return sum(1 for _ in _TOKEN.finditer(text)) + 2  # two for the template


@dataclass
class _Window:
    """Turns (role, text, tokens) of one window: system turn, repeated history, own turns."""

    system: tuple | None = None
    history: list[tuple] = field(default_factory=list)
    own: list[tuple] = field(default_factory=list)

    @property
    def tokens(self) -> int:
        return (self.system[2] if self.system else 0) + sum(t[2] for t in (*self.history, *self.own))


def render(window: _Window) -> tuple[str, list[tuple]]:
    """Formatted text and, for each turn, where its escaped text lies, if it is a repeat, and if it is a target."""
    out, turns, at = [], [], 0
    repeated = [window.system] * (window.system is not None) + window.history
    for n, (role, text, _) in enumerate([*repeated, *window.own]):
        head, body = f"{OPEN}{escape_role(role)}:\n", escape_text(text)
        begin = at + len(head)
        again = n < len(repeated)
        turns.append((begin, begin + len(body), again, not again and role == TARGET))
        out += [head, body, CLOSE]
        at = begin + len(body) + len(CLOSE)
    return "".join(out), turns


def _windows(turns: Iterator[tuple], budget: int, history: int) -> Iterator[tuple]:
    """(conv_id, window, formatted, turns) from (conv_id, role, text) rows that come conversation by conversation."""
    conv, number, window = None, 0, _Window()
    for conv_id, role, text in turns:
        turn = (role, text, count_tokens(text))
        if window.own and conv_id != conv:
            yield (conv, number, *render(window))
            number, window = 0, _Window()
        elif window.own and window.tokens + turn[2] > budget:
            yield (conv, number, *render(window))
            first = window.own[0] if number == 0 and window.own[0][0] == "system" else None
            system, past, room = window.system or first, [], history
            for t in reversed([*window.history, *window.own]):
                room -= t[2]
                if room < 0 or t is first:
                    break
                past.insert(0, t)
            number, window = number + 1, _Window(system, past)
            while window.history and window.tokens + turn[2] > budget:
                window.history.pop(0)
        conv = conv_id
        window.own.append(turn)
    if window.own:
        yield (conv, number, *render(window))


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of all conversations: (conv_id, window, formatted, turns with the places of their escaped texts).

    ``conversations`` has (conv_id, turn, role, text); other columns are not read. Turns go by number, and by
    role and text where numbers are equal or null; null role or text is empty; repeated rows are turns of their
    own; rows without conv_id form one conversation. A turn over the budget gets a window of its own, whole.
    Turns stream through a task in order: no task holds more than a window, and windows of one conversation
    come one after the other, which :func:`read_windows` relies on.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for f in frames for row in zip(f.conv_id, f.role, f.text))
        batch, size = [], 0
        for row in _windows(rows, budget, history):
            batch.append(row)
            size += len(row[2])
            if size > 4_000_000:
                yield _frame(batch)
                batch, size = [], 0
        if batch:
            yield _frame(batch)

    def _frame(batch: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(batch, columns=["conv_id", "window", "formatted", "turns"])
        out["turns"] = [[dict(zip(("begin", "end", "repeated", "target"), t)) for t in ts] for ts in out["turns"]]
        return out

    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    # Numbers pass as text, since pandas turns a column of numbers with a null in it into doubles.
    windows = ordered.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(run, WINDOW_FIELDS)
    return windows.withColumn("conv_id", F.col("conv_id").cast("long"))


def read_windows(windows: DataFrame) -> DataFrame:
    """What the formatted windows hold, one row per conversation; takes the output of :func:`format_windows` as it is.

    n_turns and turns_sha256 come from parsing the template, the loss columns from the target spans. Texts are
    hashed as they pass, so a conversation of any length takes little memory.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, rows, state = None, [], None
        for f in frames:
            for key, text, turns in zip(f.conv_id, f.formatted, f.turns):
                if state is None or key != conv:
                    rows += [] if state is None else [_closed(conv, state)]
                    conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for turn, at in zip(_TURN.finditer(text), turns, strict=True):
                    body = unescape(turn[2])
                    if not at["repeated"]:
                        state[0] += 1
                        state[1].update(f"{unescape(turn[1])}\n{body}\n".encode())
                    if at["target"]:
                        loss = unescape(text[at["begin"]:at["end"]])
                        state[2] += len(loss)
                        state[3].update(loss.encode())
                state[4] += len(text)
            if len(rows) >= 5000:
                yield _frame(rows)
                rows = []
        rows += [] if state is None else [_closed(conv, state)]
        if rows:
            yield _frame(rows)

    def _closed(conv, state) -> tuple:
        return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names)

    read = windows.withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(
        run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return read.withColumn("conv_id", F.col("conv_id").cast("long"))
