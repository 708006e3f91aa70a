"""Best-fit packing by exact-complement hashing.

Only the number of pieces of each length matters for a plan, and there are at most ``capacity`` lengths,
so the plan is made on the driver from that histogram, whatever the number of documents. It is a list of
patterns (lengths that share a sequence) with the number of times each is used. The pieces are then
numbered within their length, on the cluster, and look up the pattern their number falls into.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.common import kept, number_within

CAPACITY = 4096
END = 1
JOINED_WORDS = 256  # words encoded in one call: few enough to stay in the processor's cache
CACHED_BYTES = 160_000_000  # of words and ids kept by one task

# How this vocabulary splits a word, and the same for words of printable ASCII and the letters of Latin-1 in lower case.
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
LATIN_WORD = re.compile("[!-@\\[-~ß-öø-ÿ]+")
LATIN_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long, ids binary"


class _Stock:
    """Pieces left per length, and which lengths are left as bits of one number, forwards and mirrored."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = [0] * (capacity + 1)
        self.capacity, self.bits, self.mirror = capacity, 0, 0
        for length, n in counts.items():
            self.add(length, n)

    def add(self, length: int, n: int) -> None:
        had = self.left[length] > 0
        self.left[length] += n
        if had != (self.left[length] > 0):
            self.bits ^= 1 << length
            self.mirror ^= 1 << (self.capacity - length)

    def longest(self, most: int) -> int:
        """The longest length left that is at most ``most``; 0 if there is none."""
        return max(0, (self.bits & ((2 << most) - 1)).bit_length() - 1)

    def pair(self, gap: int) -> list[int]:
        """Two lengths left that sum to ``gap``, the longest possible first, or nothing."""
        fits = self.bits & (self.mirror >> (self.capacity - gap)) & ((1 << gap) - 1)
        if gap % 2 == 0 and self.left[gap // 2] == 1:
            fits &= ~(1 << gap // 2)
        long = fits.bit_length() - 1
        return [long, gap - long] if fits else []

    def complement(self, gap: int) -> list[int]:
        """One, two or three lengths left that fill ``gap`` exactly, or nothing."""
        if self.left[gap] > 0:
            return [gap]
        if two := self.pair(gap):
            return two
        first = self.longest(gap - 2) if gap > 2 else 0
        while first:
            self.add(first, -1)
            two = self.pair(gap - first)
            self.add(first, 1)
            if two:
                return [first, *two]
            first = self.longest(first - 1)
        return []


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of one sequence, times used) until all counts are used up.

    Starts with the longest piece left, looks for an exact complement of the gap, and otherwise places
    the longest piece that fits and goes on with the smaller gap. A pattern is used as often as the counts
    allow, so each uses up a length (all but fewer than it takes) and the number of patterns depends on ``capacity`` alone.
    """
    stock = _Stock(counts, capacity)
    patterns = []
    while stock.bits:
        pattern, gap = [stock.longest(capacity)], capacity - stock.longest(capacity)
        stock.add(pattern[0], -1)
        while gap > 0:
            fitting = stock.longest(gap)
            more = fitting and (stock.complement(gap) or [fitting])
            if not more:
                break
            for x in more:
                stock.add(x, -1)
                gap -= x
            pattern += more
        taken = Counter(pattern)
        times = 1 + min(stock.left[x] // n for x, n in taken.items())
        for x, n in taken.items():
            stock.add(x, -(times - 1) * n)
        patterns.append((pattern, times))
    return patterns


def plan_ranges(patterns: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """Patterns as ranges: pieces of ``length`` numbered from ``low`` on go to sequences from ``first`` on, at ``offset``."""
    used: Counter = Counter()
    rows, first = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], first, offset))
            used[length] += times
            offset += length
        first += times
    rows.sort()
    return dict(zip(("length", "low", "first", "offset"), np.array(rows, dtype=np.int64).reshape(-1, 4).T))


class _Encoder:
    """Token ids as bytes, by words that are encoded once and kept.

    No other token of this vocabulary reaches over ASCII white space, and it has no upper case. Texts that hold
    the literal of an added token go whole through the default encoder. Its normaliser leaves lower-case words of Latin-1
    as they are, so these are split here and only their parts, which many words share, are given to its merges.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.size = Tokenizer.from_file(path), {}, 0
        self.literals = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merges, splitter = self.tokenizer.model, self.tokenizer.pre_tokenizer
        with open(path, encoding="utf-8") as f:
            steps = (json.load(f).get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.latin = [(x["type"], x.get("pattern"), x.get("add_prefix_space")) for x in steps] == [
            ("Split", {"Regex": SPLIT}, None), ("ByteLevel", None, False)]
        self.bytes = {c: splitter.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7} if self.latin else {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        lower = [t.lower() for t in texts]
        special = {i for i, t in enumerate(lower) if any(x in t for x in self.literals)}
        words = [[] if i in special else t.encode().lower().split() for i, t in enumerate(texts)]
        if self.size > CACHED_BYTES:  # words of the present texts stay: the common ones are among them
            self.known = {w: self.known[w] for w in set(chain.from_iterable(words)).intersection(self.known)}
            self.size = sum(len(w) + len(ids) + 200 for w, ids in self.known.items())
        known, others = self.known, []
        for w in set(chain.from_iterable(words)).difference(known):
            text = w.decode()
            if not (self.latin and LATIN_WORD.fullmatch(text)):
                others.append(w)
            elif len(parts := LATIN_PARTS.findall(text)) == 1:
                self._part(w, text)
            else:
                known[w] = ids = b"".join([self._part(x.encode(), x) for x in parts])
                self.size += len(w) + len(ids) + 200
        for at in range(0, len(others), JOINED_WORDS):
            some = others[at:at + JOINED_WORDS]
            for w, ids in zip(some, self._words(some)):
                known[w] = ids
                self.size += len(w) + len(ids) + 200
        out = [b"".join(map(known.__getitem__, ws)) for ws in words]
        for i in special:
            out[i] = array("I", self.tokenizer.encode(texts[i], add_special_tokens=False).ids).tobytes()
        return out

    def _part(self, word: bytes, text: str) -> bytes:
        """Ids of a word that is not split, which may be a part of others."""
        ids = self.known.get(word)
        if ids is None:
            merged = self.merges.tokenize(text if text.isascii() else text.translate(self.bytes))
            ids = self.known[word] = array("I", [t.id for t in merged]).tobytes()
            self.size += len(word) + len(ids) + 200
        return ids

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. They are encoded in one call, joined by spaces, and told apart by where their tokens begin."""
        texts = [w.decode() for w in words]
        encoded = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        begins = np.fromiter((o[0] for o in encoded.offsets), dtype=np.int64, count=len(encoded.ids))
        ends = 4 * np.searchsorted(begins, starts[1:])
        ids = array("I", encoded.ids).tobytes()
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _encoder(path: str) -> _Encoder:
    return kept(_Encoder, path)  # a worker process keeps its words from task to task


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END,
                     with_ids: bool = True) -> DataFrame:
    """Every document as pieces of at most ``capacity`` ids: its ids and one end id, cut only where longer."""

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, stop, width = _encoder(tokenizer_path), np.array([end], dtype="<u4").tobytes(), 4 * capacity
        for frame in frames:
            for at in range(0, len(frame), 500):
                part = frame.iloc[at:at + 500]
                rows = []
                for doc_id, ids in zip(part.doc_id, encode(part.text.fillna("").tolist())):
                    ids += stop
                    for n, start in enumerate(range(0, len(ids), width)):
                        own = ids[start:start + width]
                        rows.append((doc_id, n, start // 4, len(own) // 4, zlib.crc32(own), own if with_ids else None))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    # As text, since pandas turns a column of numbers with a null in it into doubles.
    found = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text").mapInPandas(pieces, PIECES)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END,
                   with_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text; more columns are not read) into few sequences of at most ``capacity`` ids.

    Returns (doc_id, piece, start, length, ids_crc32, sequence_id, offset), and ``ids`` (little-endian
    unsigned 32 bit) ``with_ids``. Null or empty text is the end id alone; repeated rows and rows without
    doc_id are packed like others; longer documents are cut, never dropped. No rows give no rows.
    """
    found = tokenized_pieces(docs, tokenizer_path, capacity, end, with_ids)
    numbered = number_within(found if with_ids else found.drop("ids"), ["length"], "_number")
    numbered = numbered.withColumn("doc_id", F.col("doc_id").cast("string"))
    counts = {r["length"]: r["n"] for r in numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges = plan_ranges(plan_patterns(counts, capacity))
    kept = [c for c in numbered.columns if c != "_number"]

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts = (ranges["length"] << 48) + ranges["low"]
        for frame in frames:
            number = frame["_number"].to_numpy(dtype=np.int64)
            at = np.searchsorted(starts, (frame["length"].to_numpy(dtype=np.int64) << 48) + number, side="right") - 1
            out = frame[kept].copy()
            out["sequence_id"] = ranges["first"][at] + number - ranges["low"][at]
            out["offset"] = ranges["offset"][at]
            yield out

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.select(*kept).schema)
    placed = numbered.mapInPandas(place, f"{fields}, sequence_id long, offset long")
    return placed.withColumn("doc_id", F.col("doc_id").cast("long"))


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves from ``pack_documents(..., with_ids=True)``: (sequence_id, ids as bytes, n_pieces)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most ``capacity`` pieces
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.size("p").alias("n_pieces"))
