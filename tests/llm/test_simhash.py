"""SimHash near-duplicates against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from casefile.llm import simhash_dedup as S

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("fp", T.StringType()), T.StructField("component_id", T.StringType())])


def slow_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits=2):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits
    out, seen = [None] * len(ids), set()
    for i in range(len(ids)):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for j in map(int, np.flatnonzero(near[todo.pop()])):
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        least = min((ids[k] for k in group if ids[k] is not None), default=None)
        for k in group:
            out[k] = least
    return out


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b", "A b C", "É x\x1fy\x0bz " * 9, "w " * 5000 + "end",
                                  "\x85 y z"])
def test_fingerprint_rule(text):
    assert S.fingerprint(text) == slow_fingerprint(text)


def test_blocks_of_a_long_text_change_nothing(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "SHINGLE_BLOCK", 100)
    assert S.fingerprint(text) == whole == slow_fingerprint(text)


def clustered(rng, n):
    centres = rng.integers(0, 2**64, 12, dtype=np.uint64)
    out = []
    for _ in range(n):
        x = int(rng.choice(centres))
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            x ^= 1 << int(b)
        out.append(x)
    return list(dict.fromkeys(out))


def test_forest_search_equals_brute_force():
    rng = np.random.default_rng(1)
    fps = np.array(clustered(rng, 600), np.uint64)
    shard = np.sort(rng.integers(0, 5, len(fps)))
    start = np.flatnonzero(np.concatenate(([True], np.diff(shard) != 0)))
    for radius in (0, 1, 2, 5):
        a, b = S.Forest(fps, start).within(np.arange(len(fps)), radius)
        near = (np.bitwise_count(fps[:, None] ^ fps[None]) <= radius) & (shard[:, None] == shard[None])
        np.fill_diagonal(near, False)
        assert set(zip(a.tolist(), b.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(near))))


@pytest.mark.parametrize("limit", [3, 20, 2000])
def test_links_of_any_shard_size_give_all_components(spark, limit):
    fps = clustered(np.random.default_rng(limit), 700)
    rows = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    found = S.components(spark, S.shard_links(S.shard_rows(spark, rows, 2, limit), 2))
    label = {r["node"]: r["label"] for r in found.collect()}
    want = brute_components(list(range(len(fps))), fps)
    signed = [r[0] for r in rows.collect()]
    groups = {}
    for s, w in zip(signed, want, strict=True):
        groups.setdefault(w, set()).add(label.get(s, s))
    assert all(len(g) == 1 for g in groups.values()) and len({*map(min, groups.values())}) == len(groups)


def test_query_equals_brute_force(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    fps = [slow_fingerprint(r["text"]) for r in rows]
    want = {(r["doc_id"], f"{f:016x}", c) for r, f, c in
            zip(rows, fps, brute_components([r["doc_id"] for r in rows], fps), strict=True)}
    assert {tuple(r)[:3] for r in S.op4_simhash(spark, sf_small).collect()} == want


def test_defined_cases(spark):
    long = "lorem ipsum dolor " * 4000
    docs = spark.createDataFrame([(7, None, "x", "y"), (3, "", "x", "y"), (5, "Same words here now", "x", "y"),
                                  (5, "same WORDS here now", "x", "y"), (None, "alone text of none", "x", "y"),
                                  (None, "same words here now", "x", "y"), (9, long, "x", "y")], DOCS)
    got = sorted(((r["doc_id"], r["component_id"]) for r in S.near_duplicates(spark, docs).collect()), key=str)
    assert got == sorted([(7, 3), (3, 3), (5, 5), (5, 5), (None, None), (None, 5), (9, 9)], key=str)
    assert S.near_duplicates(spark, docs.limit(0)).collect() == []


def test_one_row_of_each_component_stays(spark):
    docs = spark.createDataFrame([(7, None, "a", "y"), (3, "", "b", "y"), (5, "Same words here now", "c", "y"),
                                  (5, "same WORDS here now", "c", "y"), (5, "", "z", "y"), (None, "alone text of none", "d", "y"),
                                  (None, "alone TEXT of none", "d", "y"), (None, "same words here now", "e", "y"),
                                  (9, "another text", "f", "y")], DOCS)
    got = S.one_of_each(spark, docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "").lower()) for r in got.collect()) == [
        (0, "alone text of none"), (3, ""), (5, "same words here now"), (9, "another text")]
    assert S.one_of_each(spark, docs.limit(0)).collect() == []
