"""Language identification with hyperdimensional profiles.

Letters have random +1/-1 vectors. A trigram is bound from the vectors of its letters, each permuted by its
place (a roll) and multiplied; a text is the bundle (sum) of its trigrams. The prototype of a language bundles
the texts of that language, and a text gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.common import from_texts, kept

DIMENSIONS = 512
LETTERS = 1024  # code 0 is everything that is no letter; letters beyond 768 share the upper codes
UNDETERMINED = "und"
LOW, SHARE = 0.01, 0.25  # a text like no learned language scores below this share of a low quantile of labelled rows
MIN_ROWS = 100  # labelled rows that give a quantile
_BLOCK = 2048  # trigrams bound at once


def _letter_codes() -> np.ndarray:
    """Code of every code point: 0 for anything but letters."""
    codes = np.zeros(0x110000, dtype=np.int64)
    for c in range(0x110000):
        if chr(c).isalpha():
            codes[c] = c if c < 768 else 768 + c % 256
    return codes


class Encoder:
    """Texts as bundles of trigram vectors; the letter vectors follow from the seed."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 7):
        letters = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), (LETTERS, dimensions))
        self.places = [np.ascontiguousarray(np.roll(letters, 2 - n, axis=1)) for n in range(3)]
        self.codes, self.dimensions = _letter_codes(), dimensions

    def trigrams(self, text: str) -> np.ndarray:
        """Trigram numbers of a text: lower case, runs of non-letters as one mark. Empty if there is no letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        codes = self.codes[points]
        if not codes.any():
            return np.empty(0, dtype=np.int64)
        codes = np.concatenate(([0], codes, [0]))
        codes = codes[np.concatenate(([True], (codes[1:] | codes[:-1]) != 0))]
        return (codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:]

    def bundle(self, text: str) -> np.ndarray | None:
        """The vector of a whole text, of length one; None without a letter."""
        grams, counts = np.unique(self.trigrams(text), return_counts=True)
        if not grams.size:
            return None
        out = np.zeros(self.dimensions, dtype=np.float32)
        for at in range(0, grams.size, _BLOCK):
            g = grams[at:at + _BLOCK]
            bound = self.places[0][g // LETTERS ** 2] * self.places[1][g // LETTERS % LETTERS] * self.places[2][g % LETTERS]
            out += counts[at:at + _BLOCK].astype(np.float32) @ bound.astype(np.float32)
        norm = np.linalg.norm(out)
        return out / norm if norm else out


def _encoder(dimensions: int) -> Encoder:
    return kept(Encoder, dimensions)


@dataclass(frozen=True)
class Profiles:
    """Learned prototypes, one row per language, of length one, after their common part was taken off."""

    languages: list[str]
    prototypes: np.ndarray
    common: np.ndarray


def learn_profiles(labelled: DataFrame, dimensions: int = DIMENSIONS) -> Profiles:
    """Prototypes from all rows of ``labelled`` (text, lang); rows without text, letter or lang teach nothing.

    Every task sums the vectors per language, and the sums are added on the cluster: what reaches the driver
    is one vector per language. The part that all prototypes share (punctuation and word ends, common
    letters) says nothing about a language and is subtracted.
    """
    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, sums = _encoder(dimensions), {}
        for f in frames:
            for text, lang in zip(f.text, f.lang):
                if (v := encode.bundle(text)) is not None:
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        yield pd.DataFrame([(k, v) for k, v in sums.items()], columns=["lang", "vector"])

    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    parts = rows.mapInPandas(partial, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("lang").collect()
    vectors = np.array([[e["x"] for e in r["v"]] for r in found], dtype=np.float64).reshape(len(found), dimensions)
    if not len(found):
        return Profiles([], np.zeros((0, dimensions), np.float32), np.zeros(dimensions, np.float32))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    common = vectors.mean(axis=0) if len(found) > 1 else np.zeros(dimensions)
    centred = vectors - common
    centred /= np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)
    return Profiles([r["lang"] for r in found], centred.astype(np.float32), common.astype(np.float32))


def _size_band(text: str) -> Column:
    """Texts up to twice as long share a band."""
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1)))).cast("int")


def score_limits(scored: DataFrame, text: str = "text", low: float = LOW, share: float = SHARE, min_rows: int = MIN_ROWS) -> dict[int, float]:
    """The least score of a text in one of the learned languages, by size band, from labelled rows.

    ``scored`` are rows of :func:`predict_language` with their own ``lang``. A limit is ``share`` of the ``low`` quantile of the
    scores of the labelled rows of a band, so it follows what texts of that size reach. A band with fewer than ``min_rows``
    of them takes the limit of the next shorter band, and 0 if there is none: short texts stay rather than go.
    """
    known = scored.where("lang is not null").where(F.col("lang_pred") != UNDETERMINED)
    rows = known.groupBy(_size_band(text).alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("score", low, 10_000).alias("low")).collect()  # 32 bands at most
    own = {r["band"]: share * r["low"] for r in rows if r["n"] >= min_rows}
    limits, last = {}, 0.0
    for band in range(32):
        last = limits[band] = own.get(band, last)
    return limits


def known_language(limits: dict[int, float], text: str = "text") -> Column:
    """Whether a row of :func:`predict_language` is in a learned language."""
    by_band = F.create_map(*(F.lit(x) for pair in limits.items() for x in pair))
    return (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= by_band[_size_band(text)])


def predict_language(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (cosine with the prototype, 0 to 1), from the whole text alone.

    Null text and text without a letter: ``und``, score 0; the same when nothing was learned. Of equal cosines
    the first language by name wins. Rows are judged one by one; other columns do not pass through Python, and columns
    named ``lang_pred`` or ``score`` (in any case) are replaced.
    """
    def judge():
        encode = _encoder(profiles.prototypes.shape[1])

        def score(texts: list) -> list[tuple]:
            found = []
            for t in texts:
                v = None if t is None or not profiles.languages else encode.bundle(t)
                if v is None:
                    found.append((UNDETERMINED, 0.0))
                    continue
                v = v - profiles.common * float(v @ profiles.common) / max(float(profiles.common @ profiles.common), 1e-9)
                cosines = profiles.prototypes @ v / max(float(np.linalg.norm(v)), 1e-9)
                best = int(cosines.argmax())
                found.append((profiles.languages[best], float(min(1.0, max(0.0, cosines[best])))))
            return found

        return score

    judged = docs.drop("lang_pred", "score").withColumn("_of_text", from_texts(F.col(text), judge, "lang_pred string, score double"))
    return judged.withColumns({n: F.col(f"_of_text.{n}") for n in ("lang_pred", "score")}).drop("_of_text")
