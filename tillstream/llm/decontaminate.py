"""Benchmark decontamination by templates.

Texts become templates: numbers, names and units are replaced by typed placeholders, all other words are kept in
lower case and punctuation is left out. Windows of a template are hashed; windows of documents join windows of
benchmark items. The values that stood in the slots of matching windows are compared per alignment: windows with the
item's own values always count, and others if each name and unit stands for what it mostly stands for there. Numbers may
fall together or apart, as they do in a question with other numbers. An item of which no window has enough words
is looked for by windows with its values.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.common import FORGET

WINDOW = 8
MIN_WORDS = 5  # words of a window that are no placeholders (of a shorter item: at least 3)
MIN_COVERAGE = 0.4  # of an item's windows, found in a document
FILTER_BITS = 22  # size of the filter that keeps other windows of documents from being shuffled

# Units that follow a number (fixed values).
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers g kg mg lb lbs oz ton tons "
    "gram grams kilogram kilograms pound pounds ounce ounces l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr "
    "hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents mph kph kmh degrees celsius fahrenheit".split())

_TOKEN = re.compile(r"\d+(?:[.,:]\d+)*|[^\W\d_]+")
_MUL = np.uint64(0x9E3779B97F4A7C15)
_NUMBER, _NAME, _UNIT = np.uint64(1), np.uint64(2), np.uint64(3)


class _Codes(dict):
    """Code of a token: a hash of the word, or the placeholder of a number or a name."""

    def __missing__(self, token: str) -> int:
        if len(self) > 300_000:
            self.clear()
        if token[0].isdigit():
            code = 1
        elif len(token) > 1 and token[0].isupper() and token[1:].islower():
            code = 2
        else:
            code = max(4, xxhash.xxh3_64_intdigest(token.lower().encode("utf-8", "replace")))
        self[token] = code
        return code


_codes = _Codes()


def template(text: str | None) -> tuple[list[str], np.ndarray]:
    """Tokens of a text and their codes."""
    tokens = _TOKEN.findall(text or "")
    codes = np.fromiter((_codes[t] for t in tokens), dtype=np.uint64, count=len(tokens))
    for i in np.flatnonzero(codes[:-1] == _NUMBER):
        if tokens[i + 1].lower() in UNITS:
            codes[i + 1] = _UNIT
    return tokens, codes


def window_hashes(codes: np.ndarray, width: int = WINDOW, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the windows with enough words. A template shorter than a window has none here."""
    if len(codes) < width:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    n = len(codes) - width + 1
    words = np.concatenate(([0], np.cumsum(codes > _UNIT)))
    out = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        out = (out ^ (out >> np.uint64(29))) * _MUL + codes[i:n + i]
    out = (out ^ (out >> np.uint64(32))) * _MUL
    at = np.flatnonzero(words[width:] - words[:-width] >= least)
    return at, out[at].view(np.int64)


def _slots(tokens: list[str], codes: np.ndarray, at: int, width: int) -> list[str]:
    return [tokens[i].lower() for i in range(at, at + width) if codes[i] <= _UNIT]


@lru_cache(maxsize=300_000)
def _value_code(value: str) -> int:
    return max(4, xxhash.xxh3_64_intdigest(value.lower().encode("utf-8", "replace")))


FORGET += [_codes.clear, _value_code.cache_clear]


def _rows(key, tokens, codes, width, least, keep=None) -> list[tuple]:
    """Windows of a text. A width below zero stands for windows with the values of their slots, however few their words."""
    if exact := width < 0:
        filled = codes.copy()
        for i in np.flatnonzero(codes <= _UNIT):
            filled[i] = _value_code(tokens[i])
        at, hashes = window_hashes(filled, -width, 0)
    else:
        at, hashes = window_hashes(codes, width, least)
    if keep is not None:
        chosen = keep[_bucket(hashes)]
        at, hashes = at[chosen], hashes[chosen]
    if exact and -width < WINDOW:  # an item's only window: one place is enough
        hashes, first = np.unique(hashes, return_index=True)
        at = at[first]
    return [(key, int(p), int(h), width, _slots(tokens, codes, p, abs(width))) for p, h in zip(at, hashes)]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def benchmark_windows(benchmark: DataFrame, min_tokens: int = 1) -> DataFrame:
    """(item_id, item_pos, hash, width, item_slots); an item shorter than a window is one window of its own width.

    Items without a window of enough words have windows with their values, under the negative width.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for item, text in zip(f.item_id, f.text):
                tokens, codes = template(text)
                short = len(codes) < WINDOW
                width = len(codes) if short else WINDOW
                if len(codes) >= max(1, min_tokens):
                    rows += _rows(item, tokens, codes, width, 3 if short else MIN_WORDS) or _rows(item, tokens, codes, -width, 0)
            yield pd.DataFrame(rows, columns=["item_id", "item_pos", "hash", "width", "item_slots"])

    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null").distinct()
    return rows.mapInPandas(run, "item_id long, item_pos int, hash long, width int, item_slots array<string>")


def document_windows(docs: DataFrame, keep: np.ndarray, widths: list[int]) -> DataFrame:
    """(doc_id, doc_pos, hash, width, doc_slots) of the windows whose hash the filter knows, from whole texts."""
    packed = np.packbits(keep)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.unpackbits(packed).astype(bool)
        for f in frames:
            rows = []
            for doc, text in zip(f.doc_id, f.text):
                tokens, codes = template(text)
                for width in widths:
                    rows += _rows(doc, tokens, codes, width, 3 if width < WINDOW else MIN_WORDS, known)
            yield pd.DataFrame(rows, columns=["doc_id", "doc_pos", "hash", "width", "doc_slots"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
    return rows.mapInPandas(run, "doc_id long, doc_pos long, hash long, width int, doc_slots array<string>")


def _fitting(aligned: DataFrame) -> DataFrame:
    """(doc_id, item_id, place, changed) of the windows of alignments (doc_id, item_id, windows) that count.

    Windows with the item's own values always do. Of the others, those do not in which a name or unit stands for
    something else than in most windows of the alignment.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for doc, item, windows in zip(f.doc_id, f.item_id, f.windows):
                pairs = [(int(w["item_pos"]), list(zip(w["item_slots"], w["doc_slots"]))) for w in windows]
                votes = Counter(p for _, own in pairs for p in set(own) if not p[0][0].isdigit())
                stands: dict[str, str] = {}
                for (a, b), _ in sorted(votes.items(), key=lambda v: (-v[1], v[0][0] != v[0][1], v[0])):
                    stands.setdefault(a, b)
                fit = [(place, own) for place, own in pairs if all(a == b or a[0].isdigit() or stands[a] == b for a, b in own)]
                changed = any(a != b for _, own in fit for a, b in own)
                rows += [(doc, item, place, changed) for place in {p for p, _ in fit}]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "place", "changed"])

    return aligned.mapInPandas(run, "doc_id long, item_id long, place int, changed boolean")


def _filter(items: DataFrame) -> np.ndarray:
    """Which buckets of hashes the items have: bits, put together on the cluster, 64 to a row."""
    bucket = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    words = items.select(bucket.alias("b")).groupBy(F.shiftright("b", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits")).collect()  # 2**16 rows at most
    bits = np.zeros(1 << FILTER_BITS - 6, dtype="<i8")
    bits[[r["word"] for r in words]] = [r["bits"] for r in words]
    return np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)


def find_contamination(docs: DataFrame, benchmark: DataFrame, min_coverage: float = MIN_COVERAGE, min_item_tokens: int = 1) -> DataFrame:
    """(doc_id, item_id, n_windows, n_found, coverage, changed_slots): documents that hold a benchmark item.

    A document holds an item when at least ``min_coverage`` of the item's windows occur in it with
    fitting slots; slots are compared per alignment, so the same question with two sets of values counts.
    ``changed_slots`` says that values differ from the item's in every alignment. Items with at least ``min_item_tokens`` tokens are looked for; by
    default every item with a token is, so an item that is one word ("hi") or one number is held by each document with it.
    Null or empty texts hold nothing; rows without doc_id or item_id are left out; rows repeated with one doc_id
    are one document; repeated items are found once each. An empty table on either side gives no rows.
    """
    items = benchmark_windows(benchmark, min_item_tokens)
    widths = [r["width"] for r in items.select("width").distinct().collect()]  # sixteen at most
    keep = _filter(items)
    met = document_windows(docs, keep, sorted(widths)).join(items, ["hash", "width"])
    aligned = met.groupBy("doc_id", "item_id", (F.col("doc_pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set(F.struct("item_pos", "item_slots", "doc_slots")).alias("windows"))  # as many as the item has windows, for each text of a doc_id
    found = _fitting(aligned).groupBy("doc_id", "item_id", "place").agg(F.min("changed").alias("changed")).groupBy("doc_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_found"), F.min("changed").alias("changed_slots"))
    sizes = items.groupBy("item_id").agg(F.count_distinct("item_pos").alias("n_windows"))
    return found.join(sizes, "item_id").withColumn("coverage", F.col("n_found") / F.col("n_windows")).where(
        F.col("coverage") >= min_coverage).select("doc_id", "item_id", "n_windows", "n_found", "coverage", "changed_slots")
