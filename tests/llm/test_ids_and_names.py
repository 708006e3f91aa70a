"""Ids beyond 2**53 beside a null, columns with clashing and odd names, and empty tables, in all operators on texts."""

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from tillstream.llm import chat, common, decontaminate, jaccard, langid, packing, page_text, quality, rules, secret_scan, shards  # noqa: E402

LOW, HIGH = 2 ** 53 + 1, 2 ** 53 + 3
TEXTS = {LOW: "one two three four five six seven", None: None, HIGH: "password = abcd1234efgh and more text here"}
SCHEMA = "doc_id long, text string, `Score` int, `lang_PRED` int, `Secret_Spans` int, `a b` int, `c``d` int"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in TEXTS.items()], SCHEMA).coalesce(1)


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(i, t, lang, "s", len(t)) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    return langid.learn_profiles(docs), quality.learn_quality(docs, labels), secret_scan.learn_secrets(docs)


def ids(df, name="doc_id"):
    return sorted((r[0] for r in df.select(name).distinct().collect()), key=str)


WANT = sorted([LOW, None, HIGH], key=str)


def test_ids_stay_whole(spark, odd, learned):
    profiles, network, chain = learned
    assert ids(langid.predict_language(odd, profiles)) == WANT
    assert ids(quality.score_quality(odd, network)) == WANT
    assert ids(secret_scan.find_secrets(odd, chain)) == WANT
    assert ids(secret_scan.mask_secrets(odd, chain)) == WANT
    assert ids(packing.pack_documents(odd, TOKENIZER)) == WANT
    assert ids(shards.shard_documents(odd, 8)) == WANT
    assert ids(rules.apply_rules(odd)) == WANT
    found = jaccard.jaccard_components(odd.unionByName(odd))
    assert ids(found) == WANT and ids(found, "component_id") == WANT
    talks = odd.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), "text")
    assert ids(chat.read_windows(chat.format_windows(talks)), "conv_id") == WANT
    pages = odd.withColumnsRenamed({"doc_id": "page_id", "text": "html"}).withColumn("TEXT", F.lit(1))
    got = page_text.extract_text(pages, page_text.train_labeller(4, 1))
    assert ids(got, "page_id") == WANT and got.columns[-1] == "text"


def test_columns_with_clashing_and_odd_names(odd, learned):
    profiles, network, chain = learned
    assert langid.predict_language(odd, profiles).columns == ["doc_id", "text", "Secret_Spans", "a b", "c`d", "lang_pred", "score"]
    assert quality.score_quality(odd, network).columns == ["doc_id", "text", "lang_PRED", "Secret_Spans", "a b", "c`d", "score"]
    spans = secret_scan.find_secrets(odd, chain)
    assert spans.columns == ["doc_id", "text", "Score", "lang_PRED", "a b", "c`d", "secret_spans"]
    row = spans.where(F.col("doc_id") == HIGH).first()
    assert [(s.kind, s.start) for s in row.secret_spans][:1] == [("assign", 0)] and row["c`d"] == 5
    masked = {r.doc_id: r.text for r in secret_scan.mask_secrets(odd, chain).collect()}
    assert masked[None] is None and "abcd1234" not in masked[HIGH] and masked[LOW] == TEXTS[LOW]


def test_empty_tables(spark, odd, learned):
    profiles, network, chain = learned
    none = odd.limit(0)
    for found in (langid.predict_language(none, profiles), quality.score_quality(none, network), secret_scan.find_secrets(none, chain),
                  packing.pack_documents(none, TOKENIZER), shards.shard_documents(none, 8), rules.apply_rules(none),
                  jaccard.jaccard_components(none)):
        assert found.collect() == []


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert dict(corpus_pipeline.STAGES)[name](spark, spark.createDataFrame([], DOCS), str(tmp_path)).collect() == []


def test_leak_and_pack_stages(spark, tmp_path):
    item = "If a train leaves the old station at nine and travels sixty miles each hour how far will it be by noon on that day"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(LOW, f"before it {item} and after it", "en", "s", 1), (HIGH, "a clean text about something else entirely", "en", "s", 1),
            (None, "no number", "en", "s", 1), (5, None, "en", "s", None), (5, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = corpus_pipeline.benchmark_leaks(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [HIGH, None, 5, 5]))
    packed = corpus_pipeline.pack(spark, kept, str(tmp_path)).collect()
    assert sorted(map(str, (r.doc_id for r in packed))) == sorted(map(str, [HIGH, None, 5, 5]))
    assert len({r.sequence_id for r in packed}) == 1 and sorted(r.offset for r in packed)[0] == 0


def test_words_encoded_together_equal_words_alone():
    encode = packing._Encoder(TOKENIZER)
    words = ["héllo", "ß", "İstanbul".lower(), "日本語", "a", "x" * 300, "don't", "12,5", "́e", "😀😀", "​", "#*", "ﬁ"]
    together = encode._words([w.encode() for w in words])
    assert together == [encode._words([w.encode()])[0] for w in words] and encode._words([]) == []


def test_a_worker_keeps_what_one_operator_needs():
    """A worker process outlives a stage: words of `pack` and tables of the leak search must not stay while another stage runs."""
    decontaminate.template("some Words of 12 texts")
    words = packing._encoder(TOKENIZER)
    assert packing._encoder(TOKENIZER) is words and not decontaminate._codes
    decontaminate._value_code("12")
    langid._encoder(16)
    assert not decontaminate._value_code.cache_info().currsize
    assert packing._encoder(TOKENIZER) is not words


def test_pipeline_passes_few_texts_at_once(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("seen", lambda s, docs, path: (seen.append(int(s.conf.get(name))), docs)[1])])
    before = spark.conf.get(name)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1 and 0 < seen[0] <= 2000 and spark.conf.get(name) == before


def test_words_split_here_equal_words_of_the_tokenizer():
    """A word is split by us only where that gives what the tokenizer gives, and its parts are shared by other words."""
    import itertools

    from tokenizers import Tokenizer

    encode, whole = packing._Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    parts = ["straße", "été", "don't", "we'll", "a1b22", "c++", "'s", "'tis", "''", "$$$", "~", "x÷y", "µ", "ŉ", "É", "\x01", "\x7f", "é", "²", "0", "日"]
    words = ["".join(x) for x in itertools.product(parts, parts)]
    got = encode([*words, " ".join(words)])
    want = [np.array(whole.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes() for w in words]
    assert got == [*want, b"".join(want)]
    before = len(encode.known)
    assert encode(["été$$$$ $$$$été"]) and len(encode.known) == before + 3  # two words and one new part


def test_tables_of_other_operators_go_before_the_join():
    words = packing._encoder(TOKENIZER)
    common.forget_kept()
    assert not common._KEPT and packing._encoder(TOKENIZER) is not words
