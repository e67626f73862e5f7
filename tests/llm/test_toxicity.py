"""Toxicity: feature rule, defined cases, held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from casefile.llm import toxicity as X

S = X.Settings(rows_per_class=300, epochs=40)


def words_of(text):
    return {(int(w), int(b)) for b, w in zip(*X.features([text], S)[:2], strict=True)}


def by_word(text):
    out = {}
    for w, b in words_of(text):
        out.setdefault(w, set()).add(b)
    return [out[w] for w in sorted(out)]


def test_a_words_features_do_not_depend_on_its_place():
    alone = by_word("Scum")[0]
    assert by_word("a b, SCUM! scum\nx") [2] == alone and by_word("zz scum")[1] == alone
    assert len(alone) == 4 + 3 + 2 + 1  # <sc scu cum um>, <scu scum cum>, <scum scum>, the word
    assert len(alone & by_word("scumm")[0]) >= 5
    assert by_word("sc0m") == by_word("scom")


def model(texts, y):
    return X.fit(texts, np.array(y), S)


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(0)
    plain = ["river", "stone", "garden", "window", "letter", "morning", "market", "summer"]
    make = lambda bad: " ".join([*rng.choice(plain, 30), *(["grumblefuzz"] * bad), *rng.choice(plain, 30)])
    return model([make(i % 2) for i in range(200)], [i % 2 for i in range(200)])


def test_misspelling_and_long_clean_rest(small):
    rest = "river stone garden window " * 5000
    got = X.score_texts(["a grumblefuz here", "grumblefuzzz", rest, rest + "grumblefuzz " + rest, "", None, "123 ?"], 7, small)
    assert got[0] > 0.7 and got[1] > 0.7 and got[2] < 0.3 and got[3] > 0.7
    assert got[4] == got[5] == pytest.approx(1 / (1 + np.exp(-small.bias)))


def test_worst_bag_is_the_mean_of_its_features(small):
    text = "stone river grumblefuzz window letter summer"
    b, w, _ = X.features([text], S)
    n = S.window
    want = max(np.mean(small.weight[b[(w >= i) & (w < i + n)]]) for i in range(6 - n + 1)) + small.bias
    assert X.worst_bags([text], small)[0] == pytest.approx(want, abs=1e-4)


def test_pieces_of_a_long_text(small, monkeypatch):
    text = "river stone " * 60_000 + "grumblefuzz " + "river stone " * 60_000
    assert X.score_texts([text], 1, small)[0] > 0.7


@pytest.mark.parametrize("limit", [1, 5, 30, 31, 32, 33, 34, 200])
def test_cuts_change_nothing(small, monkeypatch, limit):
    """A toxic pair of words stands at every place beside the cuts."""
    texts = [f"{'river stone ' * k}grumble fuzz grumblefuzz! {'window garden 12 ' * 7}" for k in range(12)]
    texts += ["", "a", "one two three", "x" * 400, "river " * 3 + "- " * 90, " . grumblefuzz"]
    whole = X.score_texts(texts, len(texts), small)
    monkeypatch.setattr(X, "BLOCK_CHARS", limit)
    assert np.allclose(X.score_texts(texts, len(texts), small), whole, atol=1e-9)


def test_defined_cases(spark, small):
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("score", T.StringType()), T.StructField("toxic", T.StringType())])
    docs = spark.createDataFrame([(1, None, "x", "y"), (None, "", "x", "y"), (2, "grumblefuzz", "x", "y"),
                                  (2, "grumblefuzz", "x", "y")], kind)
    got = [r["toxicity"] for r in X.toxicity(spark, docs, small).collect()]
    assert got[0] == got[1] and got[2] == got[3] > 0.7
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.learn(docs, labels) is None
    assert {r["toxicity"] for r in X.toxicity(spark, docs, None).collect()} == {0.0}
    assert X.learn(docs, spark.createDataFrame([(None, 1, 1), (2, None, None), (2, 1, 1)], "doc_id long, quality int, toxic int")) is None
    assert X.toxicity(spark, docs.limit(0), small).collect() == []


def test_texts_still_scored_clean_keep_training():
    rng = np.random.default_rng(1)
    plain = ["river", "stone", "garden", "window", "letter", "morning", "market", "summer"]
    make = lambda bad: " ".join([*rng.choice(plain, 40), *bad, *rng.choice(plain, 40)])
    rare = ["quxilak", "quxilomm", "quxilept", "quxilung"]  # a third of the toxic texts, one word each
    texts = [make([]) for _ in range(276)] + [make(["grumblefuzz"] * 4) for _ in range(180)] + [make([rare[i % 4]]) for i in range(96)]
    m = X.fit(texts, np.array([0] * 276 + [1] * 276), X.Settings())
    # 0.08 to 0.11 when such texts were left out after the warm-up
    assert X.score_texts([make([r]) for r in rare], 4, m).min() > 0.14 > 0.05 > X.score_texts([make([])], 1, m)[0]


def test_sample_is_refilled_beside_long_texts(spark):
    long = "river stone " * 1000
    docs = [(i, long if i % 10 else f"grumblefuzz {i}") for i in range(300)] + [(i, f"river {i}") for i in range(300, 400)]
    labels = [(i, 1, int(i < 300)) for i in range(400)]
    got = X.labelled_sample(spark.createDataFrame(docs, "doc_id long, text string"),
                            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "toxic", X.F.lit(True), 20, 6000).collect()
    assert sorted(r["y"] for r in got) == [0] * 20 + [1] * 20


def test_held_out_accuracy(spark):
    rows = X.op10_toxicity(spark, "/root/testdata/sf0.1").collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [r["predicted"] for r in held if labels[r["doc_id"]] == 1]
    clean = [r["predicted"] for r in held if labels[r["doc_id"]] == 0]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.04  # these labels hold some noise
