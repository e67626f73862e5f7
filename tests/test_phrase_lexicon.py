"""A lexicon of many multi-word entries against plain search; nearest events; reach of many starts."""

import datetime as dt
import random
import re

import numpy as np
import pytest

from casefile.operators import comms, ledger
from casefile.operators import phrase_lexicon as PL


def plain(messages, entities):
    by_words = {}
    for e in sorted(entities):
        w = re.findall("[0-9a-z_]+", e.lower())
        if w:
            by_words.setdefault(tuple(w), e)
    out = set()
    for i, subject, body in messages:
        w = re.findall("[0-9a-z_]+", f"{subject or ''} {body or ''}".lower())
        found = [(p, p + len(k), e) for k, e in by_words.items() for p in range(len(w)) if tuple(w[p:p + len(k)]) == k]
        out |= {(i, e) for a, b, e in found if not any(c <= a and d >= b and d - c > b - a for c, d, _ in found)}
    return out


def frames(spark, messages, entities):
    m = spark.createDataFrame([(*x, None) for x in messages], "id long, subject string, body string, sent_at date")
    return m, PL.entries(spark.createDataFrame([(e,) for e in entities], "entity string"))


@pytest.mark.parametrize("threshold", [None, "-1"])
def test_mentions_equal_plain_search(spark, threshold):
    rng = random.Random(2)
    vocabulary = ["aa", "b_b", "Cc", "dd,", "é", "x1", "\n", "-"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    entities = [text(rng.randint(1, 5)) for _ in range(60)] + ["aa", "AA", "aa cc", "aa-cc x1", "", "é", "nowhere at all"]
    messages = [(i, rng.choice([None, "", text(3)]), rng.choice([None, text(rng.randint(0, 60))])) for i in range(80)]
    m, lexicon = frames(spark, messages, entities)
    if threshold:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = PL.table_mentions(m, lexicon)
        assert {tuple(r) for r in got.collect()} == plain(messages, entities)
        plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
        moved = re.findall(r"Exchange\n(?:Input|Output)[^\[]*\[([^\]]*)", plan)
        assert moved and not any("_words" in x or "body" in x for x in moved)  # texts stay where they are
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ten_thousand_entries(spark):
    rng = random.Random(3)
    entities = {" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randint(2, 4))) for _ in range(12_000)}
    messages = [(i, None, " ".join(f"w{rng.randrange(300)}" for _ in range(60))) for i in range(60)]
    planted = sorted(entities)[:30]
    messages += [(100 + i, e, None) for i, e in enumerate(planted)]
    m, lexicon = frames(spark, messages, entities)
    assert lexicon.count() == len(entities) > 10_000
    got = {tuple(r) for r in PL.table_mentions(m, lexicon).collect()}
    keyed = {}
    for e in entities:
        keyed.setdefault(tuple(e.split()), e)
    want = set()
    for i, s, b in messages:
        w = f"{s or ''} {b or ''}".split()
        found = [(p, p + k, keyed[tuple(w[p:p + k])]) for p in range(len(w)) for k in (2, 3, 4) if tuple(w[p:p + k]) in keyed and p + k <= len(w)]
        want |= {(i, e) for a, z, e in found if not any(c <= a and d >= z and d - c > z - a for c, d, _ in found)}
    assert got == want and {(100 + i, e) for i, e in enumerate(planted)} <= got


@pytest.mark.parametrize("strangers", [None, 0])
def test_phrases_that_pass_by_chance_are_no_entries(spark, monkeypatch, strangers):
    rng = random.Random(5)
    vocabulary = ["aa", "b_b", "Cc", "dd,", "é", "x1"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    entities = [text(rng.randint(2, 4)) for _ in range(12)]
    messages = [(i, None, text(rng.randint(0, 40))) for i in range(60)]
    m, lexicon = frames(spark, messages, entities)
    tables = PL._tables
    monkeypatch.setattr(PL, "_tables", lambda x: {k: np.full_like(v, ~np.uint64(0)) for k, v in tables(x).items()})
    if strangers is not None:  # too many of them
        monkeypatch.setattr(PL, "STRANGERS", strangers)
    assert {tuple(r) for r in PL.table_mentions(m, lexicon).collect()} == plain(messages, entities)


@pytest.mark.parametrize("sent", [1 << 18, 0])
def test_messages_with_one_id_are_compared_together(spark, monkeypatch, sent):
    monkeypatch.setattr(PL, "SENT_IDS", sent)
    messages = [(1, "a b", None), (1, None, "x a b"), (2, "a b", "a b"), (None, "a b", None), (None, "s", "x a b"), (3, "x", "a b")]
    m, lexicon = frames(spark, messages, ["a b", "x a b", "a"])
    got = sorted(map(tuple, PL.table_mentions(m, lexicon).collect()), key=str)
    assert got == [(1, "x a b"), (2, "a b"), (3, "x a b"), (None, "a b"), (None, "x a b")]
    got = sorted(map(tuple, PL.table_mentions(m, lexicon, keep=("id", "subject"), dealt=True).collect()), key=str)
    assert got == [(1, "a b", "a b"), (1, None, "x a b"), (2, "a b", "a b"), (3, "x", "x a b"), (None, "a b", "a b"), (None, "s", "x a b")]


def test_empty_lexicon_and_messages(spark):
    m, lexicon = frames(spark, [(1, None, None), (2, "a", "b")], [])
    assert PL.table_mentions(m, lexicon).count() == 0
    m, lexicon = frames(spark, [], ["a b"])
    assert PL.table_mentions(m, lexicon).count() == 0


@pytest.mark.parametrize("events", [[], [0], [0, 0, 400], [10, 11, 50, 90, None]])
def test_nearest_event_equals_the_least_distance(spark, events):
    start = dt.date(2000, 1, 1)
    day = lambda n: None if n is None else start + dt.timedelta(days=n)
    rows = [(i, day(n)) for i, n in enumerate([None, -500, -1, 0, 1, 10, 30, 31, 70, 71, 90, 399, 400, 5000])]
    ev = spark.createDataFrame([(day(n),) for n in events], "event_date date")
    got = comms.nearest_event_days(spark.createDataFrame(rows, "id long, d date"), "d", ev)
    assert got.columns == ["id", "d", "days_to_event"]
    for r in got.collect():
        far = [abs((r.d - day(n)).days) for n in events if n is not None and r.d is not None]
        assert r.days_to_event == (min(far) if far else None)


def test_reach_of_many_starts_equals_one_walk_each(spark):
    rng = random.Random(4)
    io = [(f"j{i}", kind, f"d{rng.randrange(25)}") for i in range(30) for kind in ("in", "in", "out")]
    io += [(f"h{i}", kind, d) for i in range(20) for kind, d in (("in", "hub"), ("out", f"d{i}"))]  # a hub
    job_io = spark.createDataFrame(io, "job string, direction string, dataset string")
    starts = spark.createDataFrame([("d1",), ("hub",), ("d1",), ("alone",)], "dataset string")
    for direction, depth in (("down", None), ("up", None), ("down", 2)):
        got = {(r.source, r.dataset, r.depth, r.job) for r in ledger.lineage_reach(job_io, starts, direction, depth).collect()}
        want = {(s, r.dataset, r.depth, r.job) for s in ("d1", "hub", "alone")
                for r in ledger.lineage_walk_jobs(job_io, s, direction, depth).collect()}
        assert got == want
    jobs = spark.createDataFrame([("j1", "select 1")], "job string, sql_text string")
    rows = ledger.lineage_reach(job_io, starts, "down", 1, jobs).collect()
    assert {r.sql_text for r in rows if r.job != "j1"} == {None}
