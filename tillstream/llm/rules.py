"""Quality rules: a table of thresholds compiled into Spark projections, without user functions.

Measures are column expressions over the words and lines of a text; :data:`RULES` says which measure must
lie in which range, and :func:`verdict` turns the table into one boolean expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.common import WORD_BREAK

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\f\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

# Common words of the covered languages (fixed values).
STOP_WORDS = ("the of and to in a is that it for on with as was are be this by or an at from not have "
              "der die das und ist ein eine nicht zu den von mit auf für sich im dem des "
              "le la les de et un une est que pour dans en du au sur pas qui avec "
              "el los las y es por con para del se no su una lo como más").split()

# (measure, lowest, highest): a text passes when the measure lies in the range, limits included; None is open.
RULES: list[tuple[str, float | None, float | None]] = [
    ("mean_word_chars", 2.0, 15.0),
    ("symbols_per_word", None, 0.25),
    ("letters_per_char", 0.5, None),
    ("stop_word_share", 0.02, None),
    ("dup_line_share", None, 0.5),
    ("capital_share", None, 0.5),
]


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _repeated_places(ranked: str) -> Column:
    """First words of the windows that occur more than once: equal neighbours among the sorted (window, place)."""
    rows = F.col(ranked)
    last = F.size(rows) - 1

    def same(i: Column, step: int) -> Column:
        return rows[F.greatest(F.least(i + step, last), F.lit(0))]["w"]

    twice = F.filter(rows, lambda x, i: ((i > 0) & (same(i, -1) == x["w"])) | ((i < last) & (same(i, 1) == x["w"])))
    return F.sort_array(F.transform(twice, lambda x: x["i"]))


def stop_word_forms() -> list[str]:
    """Stop words in the forms they take in a sentence."""
    return sorted({f + end for w in STOP_WORDS for f in (w, w.capitalize(), w.upper()) for end in ("", ",", ".")})


def _is_stop_word(word_hash: Column) -> Column:
    """Found by the word hashes that the windows need anyway."""
    return word_hash.isin([F.xxhash64(F.lit(f)) for f in stop_word_forms()])


def verdict(rules: list[tuple[str, float | None, float | None]]) -> Column:
    """The table as one expression: true when every measure lies in its range."""
    tests = [F.col(m) >= low for m, low, _ in rules if low is not None]
    tests += [F.col(m) <= high for m, _, high in rules if high is not None]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def rule_measures(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, counts and ratios) of every row, from whole texts. Null text has no words and no lines.

    Each select makes what the next one uses more than once and drops what is no longer needed.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"), body.alias("_text"),
        F.filter(F.split(body, WORD_BREAK), lambda w: w != "").alias("_words"),
        F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0).alias("_lines"))
    solid = F.translate("_text", SPACE, "")
    rows = rows.select(
        "_key", F.size("_words").cast("long").alias("n_words"),
        F.length(solid).cast("long").alias("word_chars"), _count(F.col("_text"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").alias("_n_lines"),
        F.length(F.regexp_replace(solid, "\\P{L}+", "")).alias("_letters"),
        F.length(F.regexp_replace(solid, "\\P{Lu}+", "")).alias("_capitals"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    words = F.col("n_words")
    rows = rows.select(
        F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        _share(F.col("word_chars"), words).alias("mean_word_chars"),
        _share(F.col("n_symbols"), words).alias("symbols_per_word"),
        _share(F.col("_letters"), F.col("word_chars")).alias("letters_per_char"),
        _share(F.size(F.filter("_hashes", _is_stop_word)), words).alias("stop_word_share"),
        _share(F.col("n_dup_lines"), F.col("_n_lines")).alias("dup_line_share"),
        _share(F.col("_capitals"), F.col("_letters")).alias("capital_share"),
        F.when(words >= WINDOW, F.transform(
            F.sequence(F.lit(0), words.cast("int") - WINDOW),
            lambda i: F.xxhash64(*[F.col("_hashes")[i + n] for n in range(WINDOW)]))).alias("_windows"))
    scalars = [c for c in rows.columns if c != "_windows"]
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.select(*scalars, F.when(repeats, F.sort_array(F.transform(
        "_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))).alias("_ranked"))
    rows = rows.select(*scalars, F.when(F.col("_ranked").isNotNull(), _repeated_places("_ranked")).alias("_places"))
    places = F.col("_places")
    covered = F.aggregate(
        F.transform(places, lambda p, i: F.when(i == 0, F.lit(WINDOW)).otherwise(
            F.least(F.lit(WINDOW), p - places[F.greatest(i - 1, F.lit(0))]))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(*scalars, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def apply_rules(docs: DataFrame, rules: list[tuple[str, float | None, float | None]] | None = None,
                text: str = "text", key: str = "doc_id") -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every row of ``docs``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words lie in repeated 8-word windows; so null
    and empty texts fail. ``kept`` is the verdict of the table for the rest. Rows are judged one by one,
    so repeated rows get equal results; columns other than key and text are not read.
    """
    words = F.col("n_words")
    failed = (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * words)
    rows = rule_measures(docs, text, key).withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & verdict(RULES if rules is None else rules))
