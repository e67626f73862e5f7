"""PII: base rules against plain matching, voting, EM, added spans, redaction."""

import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from casefile.llm import weak_pii as P

S = P.Settings()


def plain(text):
    """The contract's rules with finditer over the whole text."""
    out = []
    for k, (kind, rule) in enumerate(zip(P.KINDS, (P.EMAIL, P.IP, P.CARD, P.PHONE), strict=True)):
        for m in rule.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if ((kind == "ip" and any(not re.fullmatch("0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])", p) for p in m.group().split(".")))
                    or (kind == "card" and not (14 <= len(digits) <= 19 and P.luhn(digits)))
                    or (kind == "phone" and not 10 <= len(digits) <= 15)):
                continue
            out.append((m.start(), k, m.end()))
    return [(a, P.KINDS[k], b) for a, k, b in sorted(out)]


@pytest.mark.parametrize("seed", range(20))
def test_base_rules(seed):
    rng = random.Random(seed)
    parts = ["@", "a", "b.", ".", "c@d.e", "1", "+", "-", " ", "%", "é", "4111111111111111", "1.2.3.4", "@@", "..",
             "+1 (308) 555-7782", "_", "\n", "(", "256.1.1.1", "0001.2.3.4"]
    for _ in range(1000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert P.base_spans(text) == plain(text)


@pytest.mark.parametrize("part,found", [("0" * 5000, True), ("0" * 5000 + "255", True), ("0" * 5000 + "256", False),
                                        ("9" * 5000, False), ("0" * 5000 + "1" + "0" * 5000, False)])
def test_very_long_numbers(part, found):
    text = f"ip 1.2.{part}.4 and 1.2.3.{part} there"
    a, b = 3, 3 + len(f"1.2.{part}.4")
    want = [(a, "ip", b), (b + 5, "ip", len(text) - 6)] if found else []
    assert [s for s in P.base_spans(text) if s[1] == "ip"] == want == [s for s in plain(text) if s[1] == "ip"]


def test_em_finds_the_unreliable_labeller():
    rng = random.Random(0)
    patterns = {}
    for _ in range(4000):
        true = rng.random() < 0.3
        good = lambda q: (1 if true else -1) if rng.random() < q else (-1 if true else 1)  # noqa: B023, E731
        v = (good(.9), good(.9), good(.85), good(.5), good(.8), 0)
        patterns[v] = patterns.get(v, 0) + 1
    share, chance, post = P.reliabilities(patterns, {}, 100)
    gap = chance[:, 1, 2] - chance[:, 0, 2]
    assert abs(share - 0.3) < 0.07 and gap[0] > 0.6 and abs(gap[3]) < 0.15
    assert post[(1, 1, 1, 1, 1, 0)] > 0.95 > 0.05 > post[(-1, -1, -1, -1, -1, 0)]


TEXTS = ["mail me at x.y@mail.example.com or +1 (269) 555-3296 4524132264652876 today",
         "card 4111 1111 1111 1111 and ip 10.0.0.1 from host", "call (308) 555-7782 now", None, "", "no data here. At it. The end.",
         "write to jane.doe [at] example [dot] org please", "é" * 30 + " a.b@c.de"] + [f"phone +1 (308) 555-{i}" for i in range(1000, 1200)]


@pytest.fixture(scope="module")
def marked(spark):
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("kind", T.StringType()), T.StructField("spans", T.StringType())])
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "x", "y")], kind)
    return P.personal_data(spark, docs, P.learn(docs))


def test_base_spans_stay_and_the_method_adds(marked):
    got = {r["doc_id"]: r["pii"] for r in marked.collect()}
    for i, t in enumerate(TEXTS):
        assert [(x["start"], x["kind"], x["end"]) for x in got[i] if x["base"]] == plain(t or "")
    assert got[None] == got[0] and got[3] == got[4] == got[5] == []
    found = {(x["kind"], TEXTS[0][x["start"]:x["end"]]) for x in got[0] if not x["base"]}
    assert found == {("phone", "+1 (269) 555-3296"), ("card", "4524132264652876")}
    assert any(TEXTS[6][x["start"]:x["end"]] == "jane.doe [at] example [dot] org" for x in got[6])
    assert got[7][0]["start"] == 31


@pytest.mark.parametrize("blank", ["", " "])
@pytest.mark.parametrize("pair", ["()", "[]", "{}", "<>"])
def test_written_out_addresses_in_each_bracket(pair, blank):
    for at in ("at", "AT", "@"):
        span = f"jane.doe {pair[0]}{blank}{at}{blank}{pair[1]} example.org"
        assert P.candidates(f"to {span}, soon", []) == [(3, "email", 3 + len(span))]


def test_a_rare_kind_is_learned_beside_a_frequent_one(spark):
    rare = "write to jane.doe [at] example [dot] org please"
    texts = [f"{'x' * (i % 37)} call {i % 9} ({200 + i}) 555-{1000 + i} now{'!' * (i % 23)}" for i in range(700)]
    docs = spark.createDataFrame(list(enumerate([*texts, rare])), "doc_id long, text string")
    s = P.Settings(sample=4)
    model = P.learn(docs, s=s)
    assert set(model.weights) == {"email", "phone"}
    got = P.personal_data(spark, docs.filter("doc_id = 700"), model, s=s).first()["pii"]
    assert [(x["kind"], rare[x["start"]:x["end"]]) for x in got] == [("email", "jane.doe [at] example [dot] org")]


def test_redaction_and_empty_tables(spark, marked):
    got = {r["doc_id"]: r["text"] for r in P.redact(marked).collect()}
    assert got[0] == "mail me at <email> or <phone> <card> today" and got[3] is None and got[5] == TEXTS[5]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert P.learn(none).weights == {} and P.personal_data(spark, none, P.Model({})).collect() == []


def test_query_base_columns(spark, sf_small):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = P.op8_pii(spark, sf_small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(x[1] == k for x in base) for k in P.KINDS]
        assert {f"{k}:{a}:{b}" for a, k, b in base} <= set(r["spans"].split(",")) | {""}
