"""Repetition, language and toxicity."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import language, repetition, toxicity
from shelfmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def repeats_by_comparison(words):
    out = [0] * len(words)
    for i in range(len(words)):
        for j in range(len(words)):
            k = 0
            while i != j and max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


def test_longest_repeats_equal_comparison():
    draw = random.Random(1)
    for _ in range(150):
        texts = [[draw.randrange(3) for _ in range(draw.randrange(25))] for _ in range(draw.randrange(1, 5))]
        words = np.array([w for t in texts for w in t], np.int64)
        starts = np.cumsum([0] + [len(t) for t in texts])
        found = repetition.longest_repeats(words, starts)
        assert list(found) == [x for t in texts for x in repeats_by_comparison(t)]


def measured_plainly(text, least=10):
    words = text.encode().split()
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    longest = repeats_by_comparison(words)
    covered = {i + k for i, n in enumerate(longest) if n >= least for k in range(n)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    chars = sum(c not in " \t\n\x0b\x0c\r" for c in text)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), chars, symbols, len(lines) - len(set(lines)), len(inside), len(covered), max(longest, default=0)


def test_measures_equal_a_plain_count(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000").limit(150)
    extra = spark.createDataFrame([(-1, "a\x85b c d\x1ce " * 5), (-2, "x y z\nx y z\n\n \nq")], "doc_id long, text string")
    rows = repetition.with_repetition(docs.select("doc_id", "text").union(extra)).collect()
    for r in rows:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_covered, r.longest_repeat)
        assert found == measured_plainly(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_repetition_judges_spans_not_single_words(spark):
    draw = random.Random(2)
    fresh = [f"w{draw.randrange(10**9)}" for _ in range(400)]
    texts = [" ".join(fresh), " ".join(fresh[:300] + fresh[:60]), " ".join(fresh[:150] * 2), " ".join(fresh * 3)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    kept = {r.doc_id: (r.kept, r.longest_repeat) for r in repetition.with_repetition(rows).collect()}
    assert kept == {0: (True, 0), 1: (True, 60), 2: (False, 150), 3: (False, 800)}


def test_each_limit_rejects_texts_that_pass_the_base_rules(spark):
    fresh = [f"u{i}" for i in range(2000)]
    # 8 x 25 of 500 words in short repeats; 2 x 120 of 1200 words in one long repeat; below both limits
    scattered = [w for i in range(4) for w in fresh[25 * i : 25 * i + 25] * 2 + fresh[200 + 75 * i : 275 + 75 * i]]
    texts = [scattered, fresh[:1080] + fresh[:120], fresh[:1100] + fresh[:100]]
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id int, text string")
    found = {r.doc_id: r for r in repetition.with_repetition(rows).collect()}
    assert not any(r.base_failed for r in found.values())
    assert [(found[i].n_covered, found[i].longest_repeat, found[i].kept) for i in range(3)] == [
        (200, 25, False), (240, 120, False), (200, 100, True)]


def test_language_of_held_out_texts(spark):
    rows = QUERIES["op3_language"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.93 * len(held)
    sure = [r for r in held if not r.rejected]
    assert sum(r.lang_pred == r.lang for r in sure) >= 0.97 * len(sure) and len(sure) > 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_samples_take_different_texts_whole(spark):
    texts = [f"copied {i} ends" for i in range(20)] * 100
    rows = [(None, "en", t) for t in texts] + [(None, "ru", "ж" * 2000 + f" {i:04} " + "ж" * 2000) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    samples = language.learn_samples(docs, 160, 96 << 10)
    assert sorted(samples["en"].decode().split("\n")) == sorted(set(texts))
    parts = samples["ru"].decode().split("\n")
    assert sorted(p.strip("ж") for p in parts) == [f" {i:04} " for i in range(160)]
    assert 90 << 10 < len(samples["ru"]) <= 96 << 10


def test_toxicity_of_held_out_texts(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    known = docs.join(labels, "doc_id")
    model = toxicity.train(known.select(docs.columns), labels)
    rows = toxicity.with_toxicity(known, model).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    caught = sum(r.predicted and r.toxic for r in held)
    assert caught >= 0.85 * sum(r.toxic for r in held) and caught >= 0.85 * sum(r.predicted for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_nothing_is_learned_from_the_held_out_fold(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + "bad" * (i % 2)) for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    used = {r.doc_id for r in toxicity.training_sample(docs, labels, 500).collect()}
    assert used == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert toxicity.training_sample(docs, labels, 10).count() == 20
    one_class = labels.where("toxic = 0")
    assert toxicity.with_toxicity(docs, toxicity.train(docs, one_class)).where("score > 0.3").count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_edges(spark, edges, nothing, empty):
    docs = nothing if empty else edges
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 0), (1, None)], "doc_id long, toxic int")
    scored = toxicity.with_toxicity(docs, toxicity.train(docs, labels))
    spoken = language.identify_language(docs)
    judged = repetition.with_repetition(docs)
    for out in (scored, spoken, judged):
        assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
    if not empty:
        by_id = {r.doc_id: r for r in spoken.collect()}
        assert [by_id[i].lang_pred for i in (3, 4, 5, 7)] == ["und"] * 4 and by_id[1].lang_pred == "en"
        assert all(r.score is not None for r in scored.collect())
        assert {r.doc_id for r in judged.where("NOT base_failed").collect()} == set()
