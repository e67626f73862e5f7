"""Spot signatures against plain Python, the order of documents, near duplicates."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.llm import spot_signatures as S

KIND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
                    + [T.StructField(n, T.StringType()) for n in ("h", "n", "slice", "w_id", "sigs", "next", "fp")])


def table_of(spark, rows):
    return spark.createDataFrame([(*r, *"abcdefg") for r in rows], KIND)


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def sigs(text, anchors):
    words = split(text)
    if all(w in anchors for w in words):
        return {hashlib.md5(text.encode()).hexdigest()[:16]}
    spots = set()
    for i, w in enumerate(["", *words]):
        if i == 0 or w in anchors:
            chain = [x for x in words[i:] if x not in anchors][:3]
            if chain:
                spots.add(" ".join([w, *chain]))
    return {hashlib.md5(s.encode()).hexdigest()[:16] for s in spots}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def common(rows, n=64):
    count = {}
    for _, text in rows:
        for w in set(split(text or "")):
            count[w] = count.get(w, 0) + 1
    return sorted(count, key=lambda w: (-count[w], w.encode()))[:n]


def wanted(rows):
    anchors = set(common(rows))
    docs = sorted({(d is not None, d or 0, hashlib.md5(f"{'' if d is None else d}:{t or ''}".encode()).hexdigest(), t or "") for d, t in rows}, reverse=True)
    out = {}
    for i, (has, d, _, text) in enumerate(docs):
        has_next, next_id, _, after = docs[(i + 1) % len(docs)]
        k = len(text) // 3
        edited = text[:len(text) - k] + after[:k]
        mine, changed, nxt = (sigs(x, anchors) for x in (text, edited, after))
        out[d if has else None, text] = (d if has else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), " ".join(sorted(mine)),
                                         " ".join(sorted(changed)), jaccard(mine, changed), jaccard(mine, nxt), next_id if has_next else None)
    return sorted((out[d, t or ""] for d, t in rows), key=repr)


def queried(spark, path, rows, **conf):
    table_of(spark, rows).write.parquet(f"{path}/documents.parquet")
    for k, v in conf.items():
        spark.conf.set(k.replace("_", "."), v)
    try:
        return sorted(map(tuple, S.op13_spot_signatures(spark, str(path)).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def some_rows(rng, n):
    vocabulary = ["the", "of", "and", "Die", "LA"] * 6 + [f"w{i}" for i in range(150)] + ["Été", "漢字", "it's", "x-y"]
    return [(rng.randrange(10_000), " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 5, 40, 200])))) for _ in range(n)]


@pytest.mark.parametrize("seed,partitions,coalesce", [(1, 8, "true"), (2, 13, "false")])
def test_query_is_the_contract(spark, tmp_path, seed, partitions, coalesce):
    rng = random.Random(seed)
    rows = some_rows(rng, 120)
    rows += [(7, rows[3][1]), (rows[0][0], rows[0][1]), rows[5], rows[5], rows[5], (None, "the w1 w2"), (None, None), (None, None),
             (8, None), (8, ""), (8, "w1"), (-3, "..."), (-3, "?!"), (9, "the of and"), (10, "😀 the w1 " * 500)]
    conf = {"spark_sql_shuffle_partitions": partitions}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert queried(spark, tmp_path, rows, **conf) == wanted(rows)


def test_empty_and_single(spark, tmp_path):
    assert queried(spark, tmp_path / "none", []) == []
    one = [(5, "a b c d e f the end")]
    assert queried(spark, tmp_path / "one", one) == wanted(one)
    nulls = [(None, None)] * 3
    assert queried(spark, tmp_path / "nulls", nulls) == wanted(nulls)


def test_hot_row_and_many_slices(spark, tmp_path):
    rng = random.Random(4)
    rows = some_rows(rng, 60) + [(500, "the same w1 w2 and w3 of w4")] * 200
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert queried(spark, tmp_path, rows, spark_sql_shuffle_partitions=40) == wanted(rows)


def test_signatures_of_given_anchors(spark):
    text = "The cat sat on the mat. THE end"
    got = table_of(spark, [(1, text)]).select(S.signatures(F.col("text"), ["the", "on"]).alias("s")).first()["s"]
    assert set(got) == sigs(text, {"the", "on"}) and got == sorted(got) and len(got) == 5
    assert table_of(spark, [(1, text)]).select(S.signatures(F.col("text"), []).alias("s")).first()["s"] == sorted(sigs(text, set()))


def test_arrays_are_computed_once(spark):
    """A text of 20,000 words takes no time that grows with its square."""
    rows = [(1, "the w1 of w2 and w3 " * 4000)]
    assert len(table_of(spark, rows).select(S.signatures(F.col("text"), ["the", "of", "and"]).alias("s")).first()["s"]) == 6


def test_size_bounds():
    bounds = S.size_bounds(0.8, 10_000)
    part = [sum(b <= n for b in bounds) for n in range(3001)]
    assert all(0 <= part[b] - part[a] <= 1 for b in range(1, 3001, 7) for a in range(-(-4 * b // 5), b + 1))


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(9)
    rows = [(i, t) for i, (_, t) in enumerate(some_rows(rng, 60))]
    for i in range(60, 140):  # copies with a few words changed, and some exact ones
        words = rng.choice(rows)[1].split()
        for _ in range(rng.choice([0, 1, 2, 6])):
            if words:
                words[rng.randrange(len(words))] = f"w{rng.randrange(150)}"
        rows.append((i, " ".join(words)))
    rows += [(None, rows[0][1]), (200, None), (201, "")]
    anchors = ["the", "of", "and", "die", "la"]
    members, links = S.near_duplicates(spark, table_of(spark, rows), anchors)
    prints = {d: frozenset(sigs(t or "", set(anchors))) for d, t in rows if d is not None}
    least = {}
    for d in sorted(prints):
        least.setdefault(prints[d], d)
    assert {r["doc_id"]: r["class"] for r in members.collect()} == {d: least[p] for d, p in prints.items()}
    want = {(a, b): jaccard(p, q) for p, a in least.items() for q, b in least.items() if a < b and jaccard(p, q) >= 0.8}
    got = {(r["a"], r["b"]): r["likeness"] for r in links.collect()}
    assert got == want and len(want) > 5


def test_threshold_must_select(spark):
    with pytest.raises(ValueError):
        S.near_duplicates(spark, table_of(spark, []), [], 0)
