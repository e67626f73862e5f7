"""Language ID: n-gram counts, clusters, rejection, held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from casefile.llm import lang_id as L

S = L.Settings(dims=1024, sample=240, centroids=2)
WORDS = {"xx": "kalo mira tovu senda pilo raku", "yy": "strum blank hoft grend wuls plick", "zz": "éta oué lià çamo être düni"}


def text(lang, rng, n=40):
    return " ".join(rng.choice(WORDS[lang].split(), n))


def grams(t):
    """Letter n-grams of one to three places, read off by hand."""
    c = ["\0", *(x.lower() if x.isalpha() else "\0" for x in t), "\0", "\0"]
    out = []
    for i in range(1, len(c) - 2):
        if c[i] != "\0":
            out += [c[i], c[i] + c[i + 1], c[i - 1] + c[i] + c[i + 1]]
    return out


@pytest.mark.parametrize("t", ["", "A b", "Ab, cd-É 12", "漢字 x\ny"])
def test_as_many_counts_as_ngrams(t):
    counts = dict(L.ngram_counts([t, None, t + " zz"], 1024))[0]
    assert counts[0].sum() == len(grams(t)) and counts[1].sum() == 0
    assert np.count_nonzero(counts[0]) <= len({(len(g), g) for g in grams(t)})
    assert (counts[2] >= counts[0]).all()


def test_case_and_batches_change_nothing(monkeypatch):
    one = dict(L.ngram_counts(["Kalo MIRA"], 512))[0]
    many = np.concatenate([c for _, c in L.ngram_counts(["x"] * 200 + ["kalo mira"], 512)])
    assert (many[-1] == one[0]).all()
    long = "kalo mira " * 30_000  # several pieces, cut behind blanks
    got = dict(L.ngram_counts(["a", long, "b"], 512))
    assert sorted(got) == [0, 1, 2] and got[1].sum() == 30_000 * one.sum()


@pytest.mark.parametrize("limit", [1, 2, 3, 7, 50])
def test_cuts_change_nothing(monkeypatch, limit):
    texts = ["kalo mira, TOVU! étaß 12 漢字x " * 9, "a", "x" * 200, " b ", "😀é" * 60, "ends here "]
    whole = dict(L.ngram_counts(texts, 1024))[0]
    monkeypatch.setattr(L, "BLOCK_CHARS", limit)
    cut = np.concatenate([c for _, c in sorted(L.ngram_counts(texts, 1024), key=lambda x: x[0])])
    assert (cut == whole).all()


def test_thresholds():
    tally = np.zeros((2, L.LENGTHS, L.BINS), np.int64)
    tally[0, 5, 100], tally[0, 5, 40], tally[1, 5, 60:64] = 996, 4, 250  # four of a thousand are far away
    tally[0, 6, 300], tally[1, 6, 200] = 10, 89  # too few to tell
    got = L.thresholds(tally, 0.005) * L.BINS
    assert got[5] == pytest.approx(60) and got[4] == 0 and got[7] == got[6]
    assert got[6] == pytest.approx(max(200 * 0.495, 60))
    assert L.thresholds(tally, 0.001)[5] * L.BINS == pytest.approx(40)


def test_beginnings():
    for t in ("", "short text", "word " * 7, "x" * 500, "abc de " * 3000):
        b = L.beginning(t)
        assert t.startswith(b) and (b == "" or (b.endswith(" ") and len(b) <= len(t)))
    assert {len(L.beginning("ab " * 200 + "x" * n)) // 16 for n in range(60)} >= {0, 1, 3, 7}


@pytest.fixture(scope="module")
def model(spark):
    rng = np.random.default_rng(0)
    rows = [(text(lang, rng), lang, i) for i in range(150) for lang in WORDS]
    rows += [(None, "xx", 900), ("no language here", None, 901)]
    return L.learn(spark.createDataFrame(rows, "text string, lang string, key long"), S)


def test_defined_cases(spark, model):
    kind = T.StructType([T.StructField(n, t) for n, t in (
        ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("lang_id", T.StringType()))])
    rng = np.random.default_rng(1)
    texts = [None, "", "12 .!", "Текст на другом языке совсем", *(text(lang, rng) for lang in WORDS), text("yy", rng, 60_000)]
    docs = spark.createDataFrame([(None, t, "en", "x") for t in texts] * 2, kind)
    got = [r["lang_id"] for r in L.identify(spark, docs, model).collect()]
    assert got[:8] == got[8:]
    assert [tuple(g) for g in got[:3]] == [("und", 0.0, True)] * 3
    assert got[3]["rejected"] and got[3]["lang"] in WORDS
    assert [g["lang"] for g in got[4:8]] == ["xx", "yy", "zz", "yy"] and not any(g["rejected"] for g in got[4:8])
    none = spark.createDataFrame([], "text string, lang string, key long")
    assert L.learn(none, S) is None
    assert {tuple(r["lang_id"]) for r in L.identify(spark, docs, None).collect()} == {("und", 0.0, True)}
    assert L.identify(spark, docs.limit(0), model).collect() == []


def test_clusters_are_units_and_as_many_as_differ():
    x = np.eye(4, dtype=np.float32)[[0, 0, 1, 1, 2]]
    c = L.cluster(x, 3, 5)
    assert np.allclose(np.linalg.norm(c, axis=1), 1) and np.allclose((x @ c.T).max(axis=1), 1)
    assert len(L.cluster(x[:2], 3, 5)) == 1


UNSEEN = [  # the first article of the declaration of human rights
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván"]


def test_held_out_accuracy_and_rejection(spark):
    sf = "/root/testdata/sf0.1"
    rows = L.op9_language_id(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows) and len(rows) == len(lang)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]) > 0.98
    assert np.mean([r["rejected"] for r in rows if r["held_out"]]) < 0.01
    assert all(0 <= r["score"] <= 1 for r in rows)
    rng = np.random.default_rng(3)
    letters = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(n))
               for n in (20, 40, 80, 300) for _ in range(30)]
    unseen = [" ".join(rng.choice(t.split(), n)) for t in UNSEEN for n in (15, 30, 60) for _ in range(20)]
    strange = spark.createDataFrame([(t,) for t in letters + unseen], "text string")
    model = L.learn(L.learning_rows(docs))
    gone = [r["lang_id"]["rejected"] for r in L.identify(spark, strange, model).collect()]
    assert np.mean(gone[:len(letters)]) > 0.9 and np.mean(gone[len(letters):]) > 0.9
