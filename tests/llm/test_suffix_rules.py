"""Suffix-array repetition against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from casefile.llm import suffix_rules as S


def brute(w):
    out = [0] * len(w)
    for i in range(len(w)):
        for j in range(len(w)):
            k = 0
            while i != j and max(i, j) + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_repeats_and_spans(seed):
    rng = random.Random(seed)
    w = [rng.randint(0, rng.choice([1, 3, 9])) for _ in range(rng.randint(0, 60))]
    repeat = S.longest_repeats(np.array(w, np.int64))
    assert repeat.tolist() == brute(w)
    for k in (1, 3, 5):
        windows = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
        many = Counter(windows)
        want = {i + j for i, x in enumerate(windows) if many[x] > 1 for j in range(k)}
        assert set(np.flatnonzero(S.covered(repeat, k))) == want
        start, length = S.maximal_spans(repeat, k)
        for s, n in zip(start, length):  # the repeat occurs elsewhere, and not with one word more on either side
            others = [j for j in range(len(w) - n + 1) if j != s and w[j:j + n] == w[s:s + n]]
            assert others and not any(w[s:s + n + 1] == w[j:j + n + 1] and max(s, j) + n < len(w) for j in others)


def test_texts_of_one_pass_do_not_touch():
    a = list(S.measures(iter(["x y z w"] * 3 + [None, "", "x x x"]), S.Rules()))
    assert np.concatenate(a)[:, 6].tolist() == [0, 0, 0, 0, 0, 2]


def test_defined_cases(spark):
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("n_words", T.StringType()), T.StructField("repetition", T.StringType())])
    clean = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None), (2, ""), (3, clean), (3, clean), (4, clean + "\n" + clean), (5, " ".join(["a"] * 300_000)),
            (None, " ".join(f"w{i}" for i in range(60)) + "\nq w e r t\nq w e r t\n\n"), (6, "#*$%&|<> " * 2)]
    docs = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], kind)
    got = [(r["doc_id"], r["repetition"]) for r in S.repetition(docs).collect()]
    kept = [(i, r["kept"]) for i, r in got]
    assert kept == [(1, False), (2, False), (3, True), (3, True), (4, False), (5, False), (None, True), (6, False)]
    assert got[4][1]["longest_repeat"] == 80 and got[5][1]["longest_repeat"] == 299_999
    assert got[6][1]["n_dup_lines"] == 1 and got[6][1]["n_repeat_words"] == 10 and got[7][1]["n_symbols"] == 16
    assert S.repetition(docs.limit(0)).collect() == []
