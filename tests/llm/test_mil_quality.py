"""Multiple-instance quality: measures, gradients, blocks, held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from casefile.llm import mil_quality as Q

S = Q.Settings(passage_words=8, epochs=120, rows_per_class=300)
GOOD = "The river runs past the old stone house, and the garden behind it grows every summer. "
BAD = "BUY!! NOW!! BUY!! NOW!! $$$ | $$$ | 99 99 "


def test_measures_by_hand():
    x, owner = Q.passages(["Ab ab, 12!\n#\na b a b a b c", "", "é"], Q.Settings(passage_words=5))
    assert owner.tolist() == [0, 0, 0, 1, 2]
    got = dict(zip(Q.MEASURES, x[0], strict=True))  # Ab ab, 12! # a
    assert got["mean word length"] == pytest.approx(10 / 5 / 10) and got["upper case of letters"] == pytest.approx(1 / 5)
    assert got["digits"] == pytest.approx(0.2) and got["symbols"] == pytest.approx(0.1) and got["line ends"] == pytest.approx(0.4)
    second = dict(zip(Q.MEASURES, x[1], strict=True))  # b a b a b
    assert second["distinct words"] == pytest.approx(0.4) and second["repeated word triples"] == pytest.approx(2 / 5)
    assert dict(zip(Q.MEASURES, x[4], strict=True))["letters beyond ASCII"] == 1 and not x[3].any()


@pytest.fixture(scope="module")
def model():
    texts = [GOOD * 4 + (BAD * (i % 2)) * 3 + GOOD * 2 for i in range(60)]
    return Q.fit(*Q.passages(texts, S), np.arange(60) % 2 == 0, S)


def test_a_bad_passage_draws_the_attention(model):
    x, owner = Q.passages([GOOD * 6 + BAD * 3], S)
    e = Q.encode(np.clip((x - model.centre) / model.scale, -8, 8), model.weights)[3]
    alpha = np.exp(e) / np.exp(e).sum()
    assert alpha[-3:].mean() > alpha[:8].mean()
    p = Q.score_texts([GOOD * 6, GOOD * 6 + BAD * 3, GOOD * 6], 3, model)
    assert p[0] == p[2] > 0.8 and p[1] < 0.3


def test_blocks_give_the_score_of_the_whole(model):
    text = (GOOD + "x1 ") * 30
    whole = Q.score_texts([text], 1, model)[0]
    x, _ = Q.passages([text], S)
    h, _, _, e = Q.encode(np.clip((x - model.centre) / model.scale, -8, 8), model.weights)
    a = np.exp(e) / np.exp(e).sum()
    assert whole == pytest.approx(Q._sigmoid(a @ h @ model.weights["c"] + model.weights["b"])[0])
    assert 0 <= Q.score_texts([GOOD * 8000], 1, model)[0] <= 1  # several blocks


@pytest.mark.parametrize("limit", [1, 40, 97, 100, 101, 333, 1500])
def test_cuts_change_nothing(model, monkeypatch, limit):
    rng = np.random.default_rng(limit)
    vocabulary = np.array(["Ab", "ab,", "12!", "#", "é", "x" * 60, "the", "the", "river."])
    texts = ["".join(w + e for w, e in zip(rng.choice(vocabulary, n), rng.choice([" ", "\n", "  ", "\t\n"], n), strict=True))
             for n in (0, 3, 8, 16, 17, 200, 201, 800)] + [" " * 300, "y" * 300, "  z", GOOD * 9 + BAD * 9]
    whole = [Q.passages([t], S)[0] for t in texts]
    scores = Q.score_texts(texts, len(texts), model)
    monkeypatch.setattr(Q, "BLOCK_CHARS", limit)
    for t, x in zip(texts, whole, strict=True):
        assert np.allclose(np.concatenate(list(Q.long_passages(t, S))), x)
    assert np.allclose(Q.score_texts(texts, len(texts), model), scores, atol=1e-9)


def test_defined_cases(spark, model):
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("score", T.StringType()), T.StructField("labels", T.StringType())])
    docs = spark.createDataFrame([(1, None, "x", "y"), (None, "", "x", "y"), (2, GOOD, "x", "y"), (2, GOOD, "x", "y")], kind)
    got = [r["quality"] for r in Q.quality(spark, docs, model).collect()]
    assert got[0] == got[1] and got[2] == got[3] and all(0 <= g <= 1 for g in got)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.learn(docs, none) is None and {r["quality"] for r in Q.quality(spark, docs, None).collect()} == {1.0}
    assert Q.quality(spark, docs.limit(0), model).collect() == []


def test_held_out_accuracy(spark):
    rows = Q.op1_quality(spark, "/root/testdata/sf0.1").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] for r in held if labels[r["doc_id"]] == 1]) > 0.99
    assert np.mean([r["predicted"] for r in held if labels[r["doc_id"]] == 0]) < 0.05
