"""Prefix trie, SentencePiece codes and source divergence against plain Python, with every awkward case."""

import collections
import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from tests.check_oracle import compare, connect  # noqa: E402
from tests.conftest import TESTDATA  # noqa: E402
from tillstream.llm import divergence, pieces, prefix_trie  # noqa: E402
from tillstream.llm.queries import QUERIES  # noqa: E402
from tillstream.session import settings  # noqa: E402

BIG = 2 ** 53
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# ---- conversation prefix trie -------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, node long, Depth int, place long, parent string"


def talks(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, "x") for r in rows], TURNS)


def trie(rows):
    """The trie by plain lists; turns with one number must not differ."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members = collections.defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = own.get(c - c % 20, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, d == len(path)))
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * words
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c, e in sorted(m) if e)
        out.append((min(m)[0], len(k), min(members[k[:-1]])[0] if k else None, len(m), children[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got_trie(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def many_talks(r):
    rows = []
    for c in [*range(60), BIG + 1, BIG + 3]:
        if c % 20 == 0 and r.random() < 0.3:
            continue
        for t in range(r.randrange(0, 7)):
            rows.append((c, r.choice([t, t, 2 * t]), r.choice("ua"), r.choice(["", "one", "a b\tc", "ü 日本 x"])))
    seen, out = set(), []
    for row in rows:  # one text for a number
        if row[:2] not in seen:
            seen.add(row[:2])
            out.append(row)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_equals_plain_lists(spark, seed, monkeypatch):
    r = random.Random(seed)
    rows = many_talks(r) + [(7, None, "u", "first"), (8, 90, None, None), (8, 91, "", ""), (None, 1, "u", "no number"), (None, 2, None, None)]
    rows += [(9, 50, "u", "said twice"), (9, 50, "u", "said twice")]
    r.shuffle(rows)
    if seed == 2:  # a sketch of few counters: many prefixes only look shared
        monkeypatch.setattr(prefix_trie, "SKETCH_BITS", (5, 5))
    if seed == 3:  # all keys are hot, lists are hashed in many parts
        monkeypatch.setattr(prefix_trie, "HOT_ROWS", 3)
        monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    assert got_trie(prefix_trie.prefix_trie(talks(spark, rows))) == trie(rows)


def test_trie_of_copies_and_one_long_conversation(spark):
    long = [(1000, t, "u", f"turn {t % 50}") for t in range(900)]
    rows = long + [(1001, *x[1:]) for x in long[:700]] + [(c, t, "u", "same words here") for c in range(200, 320) for t in range(3)]
    with settings(spark, {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.enabled": "false",
                          "spark.sql.execution.arrow.maxRecordsPerBatch": "64"}):
        assert got_trie(prefix_trie.prefix_trie(talks(spark, rows))) == trie(rows)


def test_trie_without_conversations_and_without_turns(spark):
    assert got_trie(prefix_trie.prefix_trie(talks(spark, []))) == []
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)  # its only turn goes, and nothing replaces it
    assert got_trie(prefix_trie.prefix_trie(talks(spark, [(c, 0, "u", "gone")]))) == trie([(c, 0, "u", "gone")])


def test_running_sums_over_pieces(spark):
    r = random.Random(5)
    rows = [(r.choice([1, 1, 1, 2, 3]), i, r.randrange(-2 ** 62, 2 ** 62)) for i in range(500)]
    odd = 0x9E3779B97F4A7C15
    with settings(spark, {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.enabled": "false",
                          "spark.sql.execution.arrow.maxRecordsPerBatch": "17"}):
        df = spark.createDataFrame(rows, "g long, i long, x long").repartition(3)
        got = {(q.g, q.i): (q._place, q.x_before % 2 ** 64, q.x_upto % 2 ** 64, q._last) for q in prefix_trie.running(df, "g", ["i"], {"x": odd}).collect()}
    want = {}
    for g in {q[0] for q in rows}:
        total, own = 0, sorted(q for q in rows if q[0] == g)
        for n, (_, i, x) in enumerate(own, 1):
            before, total = total, (total + x * pow(odd, n, 2 ** 64)) % 2 ** 64
            want[g, i] = (n, before, total, n == len(own))
    assert got == want


# ---- SentencePiece ------------------------------------------------------------------------------

PARTS = [" ", "  ", "▁", "a", "b", "the", "ing", "\n", "日本", "😀", "\u0000", "é", "é", "0", "00", " " * 17, "=" * 9, "<s>", "ﬁ", "\t", "'", "word", "."]


@pytest.fixture(scope="module")
def encoder():
    return pieces.PieceEncoder(Path(MODEL).read_bytes())


def test_pieces_equal_the_library(encoder):
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(PARTS) for _ in range(r.randrange(40)))
        assert encoder.encode(text) == encoder.library.encode(text)
    for text in ("a" * 30_000, " " * 20_000, "ab" * 20_000, "日" * 3000, "x y" * 9000):
        assert encoder.encode(text) == encoder.library.encode(text)


def test_backtracking_equals_merging(encoder):
    r = random.Random(2)
    words = ["".join(r.choice("aeinstrh▁.,") for _ in range(r.randrange(1, 25))) for _ in range(3000)]
    back = 0
    for word in words:
        tokens = encoder.tokens(word)
        assert tokens == encoder.merged(word)
        greedy, at = [], 0
        while at < len(word):
            token = next(word[at:at + k] for k in range(len(word) - at, 0, -1) if word[at:at + k] in encoder.ids or k == 1)
            greedy.append(token)
            at += len(token)
        back += greedy != tokens
    assert back > 100  # the longest match is often wrong


def test_words_drop_out_of_the_cache(encoder, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 10)
    monkeypatch.setattr(pieces, "CACHED_PAIRS", 10)
    text = " ".join(f"word{i}" for i in range(200))
    assert encoder.encode(text) == encoder.library.encode(text) == encoder.encode(text)
    assert len(encoder.known) <= 10 and len(encoder.pairs) <= 10


def test_piece_columns(spark, encoder):
    rows = [(BIG + 1, "a b"), (None, "ü 😀"), (BIG + 3, None), (4, ""), (4, ""), (5, " \n"), (6, "long " * 50_000)]
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], "doc_id long, text string, IDS string, `a ``b` int")
    got = pieces.encode_documents(df, MODEL)
    assert got.columns == ["doc_id", "text", "a `b", "ids", "decoded"]
    assert sorted(((q.doc_id, q.text, q.ids, q.decoded) for q in got.collect()), key=str) == sorted(
        ((i, t, encoder.library.encode(t or ""), encoder.library.decode(encoder.library.encode(t or ""))) for i, t in rows), key=str)
    assert pieces.encode_documents(df.limit(0), MODEL).collect() == []


def test_op12_equals_the_library_on_the_whole_table(spark, encoder):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect():
        ids = encoder.library.encode(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(encoder.library.decode(ids))))
    assert sorted(map(tuple, QUERIES["op12_pieces"](spark, TESTDATA).collect())) == sorted(want)


# ---- source divergence --------------------------------------------------------------------------

def term_list(text):
    return [t.decode() for t in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower())]


def audit(rows, least=10, top=10):
    count, found, total = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.Counter()
    groups = {(lang or "", source or "") for _, lang, source in rows}
    for text, lang, source in rows:
        terms = term_list(text)
        count[lang or "", source or ""].update(terms)
        found[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in found[lang].items() if n >= least]
        v, sources = len(kept), sorted(g[1] for g in groups if g[0] == lang)

        def p(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // (n + 2 * v) for t in kept}

        whole = p(sum((count[lang, s] for s in sources), collections.Counter()))
        own = {s: p(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((own[s][t] - own[o][t]) ** 2 // (own[s][t] + own[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [((own[s][t] - whole[t]) ** 2 // (own[s][t] + whole[t]), t) for t in kept
                     if count[lang, s][t] and own[s][t] > whole[t]]
            for part, found_, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found_, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, n) for n, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


def documents(r, n):
    texts = [" ".join(r.choice(["The", "the", "ÉTÉ", "été", "x", "abcdefgh", "abcdefghi", "abcdefghij", "日本", "no-3-one", f"w{r.randrange(40)}x"])
                      for _ in range(r.randrange(30))) for _ in range(n)]
    return [(t, r.choice(["en", "de", "", None]), r.choice(["s1", "s1", "s1", "s2", "s3", "", None, "ß"])) for t in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_plain_counts(spark, seed, monkeypatch):
    rows = documents(random.Random(seed), 250) + [(None, "en", "s4"), ("", "xx", "only"), ("a b", "yy", "s1"), (None, "yy", "s2"), ("long " * 9000, "en", "s2")]
    if seed == 2:  # two sources in a tile, small blocks and shards
        for name, value in (("TILE", 2), ("BLOCK", 4), ("SHARD_BYTES", 300), ("HELD_ROWS", 20)):
            monkeypatch.setattr(divergence, name, value)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, N long, term string")
    got = divergence.audit_sources(df)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audit(rows)


def test_audit_of_nothing(spark):
    assert divergence.audit_sources(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


@pytest.mark.parametrize("leaf", [3, 1 << 18])
def test_pointer_sort(monkeypatch, leaf):
    monkeypatch.setattr(divergence, "LEAF", leaf)
    r = random.Random(3)
    parts = ["a", "B", "é", " ", "-", "abcdefgh", "abcdefghi", "日本"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(200)] + ["", "-", "z" * 5000, "z" * 5000]
    groups = np.sort(np.array([r.randrange(4) for _ in texts]))
    n, docs = collections.Counter(), collections.Counter()
    for text, g in zip(texts, groups.tolist()):
        n.update((g, t) for t in term_list(text))
        docs.update((g, t) for t in set(term_list(text)))
    for shift in (0, 5):  # also a slice of a longer Arrow array
        got = divergence.shard_counts(pa.array(["x"] * shift + texts)[shift:], groups).to_pylist()
        assert len(got) == len(n)
        assert {(q["group"], q["term"]): (q["n"], q["docs"]) for q in got} == {k: (n[k], docs[k]) for k in n}


def test_smoothed_shares_of_large_counts(spark):
    row = spark.range(1).select(divergence.smoothed(F.lit(10 ** 15), F.lit(3 * 10 ** 15), F.lit(7)).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (10 ** 15 + 2) // (3 * 10 ** 15 + 14)


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_divergence"])
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(TESTDATA), TESTDATA, name) is None
