"""Runs against plain search, synchronising sets, the query and its cases."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from casefile.llm import periodic_runs as R
from casefile.llm.common import table


def plain(words):
    """Every run (start, end, period), by trying all periods at all places."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= 2 * q:
                out.setdefault((i, j + q), q)
            i = max(j, i + 1) if j == i else j
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[2], r[0]))


def some_text(rng):
    """Stretches with periods inside periods, broken now and then."""
    out = []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 13, 31, 60]))]
        if rng.random() < 0.4:
            unit = unit * rng.randint(2, 6) + [rng.randrange(60) for _ in range(rng.randint(0, 4))]
        out += (unit * rng.randint(1, 6))[:rng.randint(1, 400)]
        if out and rng.random() < 0.3:
            out[rng.randrange(len(out))] = 77
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_those_of_plain_search(seed):
    rng = random.Random(seed)
    texts = [some_text(rng) for _ in range(60)]
    got = R.all_runs([np.array(t, np.int64) for t in texts])
    assert got == [plain(t) for t in texts]


def test_fibonacci_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    texts = [b, [0] * 1000, [0, 1] * 300 + [0], ([0] * 30 + [1]) * 20, list(range(999)) * 3, []]
    assert R.all_runs([np.array(t, np.int64) for t in texts]) == [plain(t) for t in texts]


def test_sets_are_locally_consistent_and_dense():
    rng = np.random.default_rng(2)
    w = np.tile(rng.integers(0, 50, 100), 6)
    h, t = R._mixed(w.astype(np.uint64) + np.uint64(1)), 1
    while t < 16:
        h, t = R._doubled(h, t), 2 * t
    at = R.synchronising_set(h, np.zeros(len(w), bool), 16)
    inside = [set(((at[(at >= s) & (at < s + 100)]) - s).tolist()) for s in (0, 100, 200, 300)]
    assert inside[0] == inside[1] == inside[2] == inside[3]
    assert np.diff(at).max() <= 16


KIND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("runs", T.StringType()), T.StructField("best", T.StringType())])


def wanted(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a, = [g % n]
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted((s, e - s, q) for s, e, q in plain(words) if e - s >= 24)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def queried(spark, path, rows):
    spark.createDataFrame([(*r, "x", "y") for r in rows], KIND).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return sorted(map(tuple, R.op12_periodic_runs(spark, str(path)).collect()), key=repr)


def test_query_on_planted_and_odd_texts(spark, tmp_path):
    rng = random.Random(5)
    ids = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    rows = [(i, " ".join(str(rng.randrange(30)) for _ in range(rng.randint(0, 200)))) for i in ids]
    rows += [(i, " \t\n".join(map(str, some_text(rng)))) for i in range(3000, 3100)]
    rows += [(None, "a " * 30), (9001, None), (9002, ""), (9003, " \x0b\x0c\r\n"), (9004, "ein Wort"), (9005, "x y " * 24),
             (9006, "é漢😀 " * 23), (9006, "é漢😀 " * 24), (9006, "é漢😀 " * 24), (-1, "a b " * 5000), (ids[0], None)]
    assert queried(spark, tmp_path, rows) == sorted((wanted(*r) for r in rows), key=repr)


def test_query_on_whole_texts(spark, sf_small):
    """Against plain search on every document that it can do in time."""
    docs = [tuple(r) for r in table(spark, sf_small, "documents").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r) for r in R.op12_periodic_runs(spark, sf_small).collect()}
    assert len(got) == len(docs)
    short = [d for d in docs if len((d[1] or "").split()) < 1200]
    assert len(short) > 150
    assert [got[d[0]] for d in short] == [wanted(*d) for d in short]


def test_empty_table_and_other_columns(spark, tmp_path):
    assert queried(spark, tmp_path / "none", []) == []
    df = spark.createDataFrame([(1, "a " * 40, "x", "y")], KIND)
    out = R.periodic_runs(df, out="best")
    assert out.columns == df.columns and out.first()["runs"] == "x"
    assert [tuple(r) for r in out.first()["best"]["runs"]] == [(0, 40, 1)] and out.first()["best"]["collapsed"] == "a"


def test_long_text():
    """Many words, few runs; blocks follow texts, not the other way round."""
    rng = random.Random(8)
    words = [str(rng.randrange(5000)) for _ in range(150_000)]
    words[70_000:100_000] = words[70_000:80_000] * 3
    (n, runs, kept), = R.found(iter([" ".join(words)]))
    assert n == 150_000 and len(runs) == 1 and runs[0][2] == 10_000 and runs[0][1] >= 30_000
    assert len(kept.split()) == 150_000 - runs[0][1] + 10_000
