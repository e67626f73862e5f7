"""Phrase and proximity search against brute force; defined cases."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from casefile.llm import phrase_index as P

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("term", T.StringType()), T.StructField("phrase", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("h", T.LongType())])


def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, n=10):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            for i in range(max(1, len(v) - n + 1) if v else 0):
                p = v[i:i + n]
                for j in range(len(w) - len(p) + 1):
                    if w[j:j + len(p)] == p:
                        hit |= set(range(j, j + len(p)))
                        found.add(item_id)
        if hit:
            out.append((doc_id, len(hit), tuple(sorted(str(i) for i in found if i is not None))))
    return sorted(set(out), key=str)  # repeated rows have one result


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS),
            spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS))


def run(spark, docs, items, window=10):
    d, i = frames(spark, docs, items)
    got = P.contamination(spark, P.tokenized(spark, d), i, window=window).collect()
    return sorted(((r["doc_id"], r["n_hit"], tuple(r["item_list"])) for r in got), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_on_few_words(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "ab", "é", "É", "x1", "the", "漢"]
    text = lambda n: rng.choice(["", "-", "\n"]) + rng.choice([" ", ", ", "\x00"]).join(rng.choices(vocabulary, k=n))
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    items = [(i, text(rng.randint(0, 7))) for i in range(12)]
    assert run(spark, docs, items, 4) == brute(docs, items, 4)


def test_defined_cases(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    long = "filler word " * 20_000 + passage.upper() + " filler" * 100
    docs = [(1, None), (2, ""), (3, passage), (3, passage), (3, "other text"), (None, "x " + passage), (4, long),
            (5, "alpha beta gamma"), (6, (passage + ". ") * 3)]
    items = [(10, passage), (10, passage), (9, passage), (None, "other text"), (8, ""), (7, None), (11, "beta gamma")]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert (3, 12, ("10", "11", "9")) in got and (3, 2, ()) in got and (5, 2, ("11",)) in got
    assert run(spark, docs, []) == [] and run(spark, [], items) == []


def near(docs, items, slop, n=10):
    """(doc_id, text, places, items): all words of a window, as often as it
    holds them, within slop words of its rarest one."""
    every = Counter(w for _, x in docs for w in words(x))
    phrases = {(item_id, tuple(v[i:i + n])) for item_id, x in items for v in [words(x)] for i in range(max(1, len(v) - n + 1) if v else 0)}
    out = set()
    for doc_id, text in docs:
        w, places, found = words(text), set(), set()
        for item_id, v in phrases:
            if all(t in every for t in v):
                lead = min(v, key=lambda t: (every[t], v.index(t)))
                for p, x in enumerate(w):
                    if x == lead and not Counter(v) - Counter(w[max(0, p - slop):p + slop + 1]):
                        places.add(p)
                        found.add(item_id)
        if places:
            out.add((doc_id, len(places), tuple(sorted(str(i) for i in found if i is not None))))
    return out


@pytest.mark.parametrize("slop", [2, P.SLOP, 14])
def test_proximity_of_all_words(spark, slop):
    rng = random.Random(slop)
    common, rare = ["the", "of", "and", "to", "in"], ["k1", "k2", "k3", "k4", "k5", "k6"]
    docs = [(i, rng.choice(["", "- "]) + " ".join(rng.choices(common + rare, [6] * 5 + [1] * 6, k=60))) for i in range(80)]
    docs += [(200, "of k9 the"), (200, "of k9 the"), (201, "k9 k1"), (None, "the k9 of"), (202, None)]
    items = [(1, "the k1 of and"), (2, "k9 the of"), (3, "to in the of"), (4, "k2 nowhere"), (None, "the k3"), (5, "k4 k4 the the"),
             (6, "k5"), (7, "k6 k6"), (8, "of the the k1 of k2 and to k3 in k1 the")]
    d, i = frames(spark, docs, items)
    rows = P.contamination(spark, P.tokenized(spark, d), i, slop=slop).collect()
    got = {(r["doc_id"], r["n_near"], tuple(r["near_list"])) for r in rows}
    want = near(docs, items, slop)
    assert got == want and {(200, 1, ("2",)), (None, 1, ("2",))} <= got and 201 not in {x[0] for x in got}
    if slop >= P.SLOP:  # every hit is near
        assert {(r["doc_id"], r["n_hit"], tuple(r["item_list"])) for r in rows if r["n_hit"]} == set(brute(docs, items))


def test_frequent_words_lead_many_phrases(spark):
    """One word leads every window; its second word and offset tell them apart."""
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices(["a", "b", "c"], k=80))) for i in range(30)]
    items = [(i, " ".join(rng.choices(["a", "b", "c"], k=rng.choice([1, 2, 3, 5, 9])))) for i in range(60)]
    assert run(spark, docs, items, 4) == brute(docs, items, 4)


def test_no_text_is_shuffled_where_terms_are_many(spark):
    """Without broadcasts of term tables exchanges carry strings and numbers only."""
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choices([f"w{k}" for k in range(40)], k=100))) for i in range(30)]
    items = [(i, docs[i][1][:60]) for i in range(5)]
    d, i = frames(spark, docs, items)
    words_ = P.tokenized(spark, d)
    windows = P.item_phrases(i.select("item_id", "text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        looked_up = P.written(spark, P.lookups(spark, words_, P.numbered(spark, windows.select("phrase").distinct())), "test")
        index = P.build_index(words_, looked_up, P.SLOP)
        plan = index._sc._jvm.PythonSQLUtils.explainString(index._jdf.queryExecution(), "formatted")
        sizes = [x for x in re.findall(r"Exchange\n(?:Input|Output)[^\[]*\[([^\]]*)", plan)]
        assert sizes and not any("words" in x for x in sizes)
        assert run(spark, docs, items) == brute(docs, items)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_column_name_clashes(spark):
    docs = spark.createDataFrame([(1, "alpha beta", "x", 2, 3), (2, "gamma", "y", 4, 5)], "doc_id long, text string, h string, doc_id_ long, H_ long")
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    assert [tuple(r) for r in P.clean(spark, docs, items).collect()] == [(2, "gamma", "y", 4, 5)]
