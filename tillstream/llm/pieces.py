"""SentencePiece encoding and decoding for models of the merge type.

A text's encoding is the only sequence of tokens whose neighbours are all compatible: merging the text of two
neighbours anew gives these two again. So tokens are tried from the longest match down, a position from which
no token goes on is marked in a bitfield and never entered again, and the search goes one token back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"  # fixed value: how the models write a space
CACHED_WORDS = 1 << 19  # encoded words kept per process
CACHED_PAIRS = 1 << 19  # checked neighbours kept per process
CACHED_CHARS = 48  # longer words are encoded each time they occur
ROWS = 256  # texts encoded before their ids are handed on

RESULT = "ids array<int>, decoded string"


class _Words(dict):
    """Encoded words; a word that is missing is encoded, and kept if it is short."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.encode(word)
        if len(word) <= CACHED_CHARS:
            self[word] = ids
        return ids

    def shrink(self) -> None:
        """Drop the older half once there are too many."""
        if len(self) > CACHED_WORDS:
            for word in list(self)[:len(self) - CACHED_WORDS // 2]:
                del self[word]


def _cutter(pieces: list[str]):
    """Function that cuts a normalised text where no merge can cross, as no piece holds both sides.

    Space marks begin a word, characters that occur in no longer piece stand alone, and letters part from other
    characters, unless some piece of the model says otherwise; then the text is one word.
    """
    def kind(c: str) -> int:
        return 0 if c == SPACE else 1 if c.isalpha() else 2

    joined = sorted({c for piece in pieces if len(piece) > 1 for c in piece} - {SPACE})
    steps = {(kind(x), kind(y)) for piece in pieces for x, y in zip(piece, piece[1:])}
    if not joined or steps & {(1, 0), (2, 0)}:
        return re.compile("(?s:.+)").findall
    classes = [joined] if steps & {(1, 2), (2, 1)} else [[c for c in joined if kind(c) == k] for k in (1, 2)]
    words = "|".join(f"{SPACE}*[{''.join(map(re.escape, c))}]+" for c in classes if c)
    return re.compile(f"{words}|{SPACE}+|(?s:.)").findall


class PieceEncoder:
    """Encoder of one model. ``merged`` is the plain merge loop; ``tokens`` finds the same by backtracking."""

    def __init__(self, model: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids, self.scores, self.bytes = {}, {}, {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif sp.is_unused(i):
                raise ValueError("models with unused pieces are split anew after merging; they are not supported")
            elif not sp.is_control(i) and not sp.is_unknown(i):
                self.ids[piece], self.scores[piece] = i, sp.get_score(i)
        self.unknown = sp.unk_id()
        self.matcher = ahocorasick.Automaton()  # over reversed pieces: what ends at a place there begins at it in the text
        self.shorter: dict[str, str] = {}  # the next shorter match at the same place; the last one is a single character
        for piece in self.ids:
            self.matcher.add_word(piece[::-1], piece)
            if len(piece) > 1:
                self.shorter[piece] = next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.ids), piece[0])
        self.matcher.make_automaton()
        self.cut = _cutter(list(self.ids))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known = _Words(self.encode_word)

    def merged(self, text: str) -> list[str]:
        """Tokens by merging: of all neighbours that form a piece the one with the best score, then the leftmost, until none is left."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging ``left`` and ``right`` written together gives just these two (``left`` may be empty)."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = found = self.merged(left + right) == ([left, right] if left else [right])
        return found

    def tokens(self, text: str) -> list[str]:
        """Tokens of a text by backtracking over its matches, longest first."""
        n, shorter, pairs = len(text), self.shorter, self.pairs
        longest = dict(reversed(list(self.matcher.iter(text[::-1]))))  # of equal places the first, longest match stays
        failed, marked = bytearray((n >> 3) + 1), False  # one bit for each position
        found: list[str] = []
        at, last, token = 0, "", longest.get(n - 1) or text[:1]
        while at < n:
            while token is not None:
                end = at + len(token)
                if not (marked and failed[end >> 3] >> (end & 7) & 1):
                    fits = pairs.get((last, token))
                    if fits or fits is None and self.compatible(last, token):
                        break
                token = shorter.get(token)
            else:
                failed[at >> 3] |= 1 << (at & 7)
                marked = True
                token = found.pop()
                at -= len(token)
                last, token = found[-1] if found else "", shorter.get(token)
                continue
            found.append(token)
            at, last = end, token
            token = longest.get(n - 1 - at) or text[at:at + 1]
        return found

    def encode_word(self, word: str) -> tuple[int, ...]:
        tokens, ids = self.tokens(word), self.ids
        if all(t in ids for t in tokens):
            return tuple([ids[t] for t in tokens])
        unknown = self.bytes and (lambda t: [self.bytes[b] for b in t.encode()]) or (lambda t: [self.unknown])
        return tuple(chain.from_iterable([ids[t]] if t in ids else unknown(t) for t in tokens))

    def encode(self, text: str) -> list[int]:
        ids = list(chain.from_iterable(map(self.known.__getitem__, self.cut(self.library.normalize(text)))))
        self.known.shrink()
        if not self.bytes:  # unknown characters in a row are one token
            ids = [i for k, i in enumerate(ids) if i != self.unknown or k == 0 or ids[k - 1] != i]
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


_ENCODERS: dict[bytes, PieceEncoder] = {}


def encoder(model: bytes) -> PieceEncoder:
    """The encoder of a model, made once per process."""
    if model not in _ENCODERS:
        _ENCODERS[model] = PieceEncoder(model)
    return _ENCODERS[model]


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """``docs`` with two more columns: ``ids``, the ids of the whole ``text`` without begin and end, and ``decoded``, their text.

    Null text is empty; an empty text has no ids and decodes to the empty text. Only the text passes through Python, so other
    columns, ids beyond 2**53 and repeated rows stay as they are; columns named ``ids`` or ``decoded`` (in any case) are replaced.
    A character that is no piece becomes its bytes, or the unknown id where the model has no bytes. The model file (some
    hundred KB) goes to the tasks with the function. Memory: a batch of texts, the ids of ``ROWS`` of them, and the bounded caches.
    """
    model = Path(model_file).read_bytes()

    @F.pandas_udf(RESULT)
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(model)
        for texts in batches:
            for first in range(0, max(1, len(texts)), ROWS):
                ids = [own.encode(t) for t in texts.iloc[first:first + ROWS]]
                yield pd.DataFrame({"ids": [np.array(i, dtype=np.int32) for i in ids], "decoded": [own.decode(i) if i else "" for i in ids]})

    kept = docs.drop("ids", "decoded")
    return (
        kept.withColumn("_pieces", encoded(F.coalesce(F.col("text"), F.lit(""))))
        .withColumns({"ids": F.col("_pieces.ids"), "decoded": F.col("_pieces.decoded")}).drop("_pieces")
    )
