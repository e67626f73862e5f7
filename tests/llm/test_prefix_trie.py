"""The prefix trie against plain dictionaries, with slices of every size."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from casefile.llm import prefix_trie as P

KIND = T.StructType([T.StructField(n, k) for n, k in (
    ("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()),
    ("key", T.StringType()), ("kind", T.StringType()), ("id", T.StringType()), ("t", T.LongType()))])


def plain(rows):
    """The contract, spelled out: {prefix: members} and sums over prefixes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        source = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        built[c] = tuple(turns.get(source, [])[:h] + own[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -10**9, len(m), len(kids.get(node, [])), leaves[node],
                   saved[node], hashlib.sha256(",".join(str(c) for c in sorted(m) if built[c] == node).encode()).hexdigest())
                  for node, m in members.items())


def got(spark, rows, partitions=8):
    df = spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], KIND)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = P.trie(spark, P.rebuilt(spark, df))
        assert out.columns == P.NODE
        return sorted((r[0], r[1], -10**9 if r[2] is None else r[2], *r[3:]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def random_rows(seed, convs=150, words=3, longest=7):
    rng = random.Random(seed)
    return [(c, i, rng.choice(["user", "assistant"]), rng.choice(["ab", "é漢", "", "longer text"][:words + 1]))
            for c in range(-20, convs) if c % 11 for i in range(rng.randint(1, longest))]


@pytest.mark.parametrize("run_bytes,fan_in,partitions", [(2_000_000, 64, 8), (1, 2, 5), (90, 3, 20), (400, 2, 1)])
def test_random_conversations(spark, monkeypatch, run_bytes, fan_in, partitions):
    monkeypatch.setattr(P, "FAN_IN", fan_in)
    # tasks run in other processes: the size of a tree travels with the function
    monkeypatch.setattr(P, "_slices", sliced(run_bytes))
    rows = random_rows(run_bytes)
    assert got(spark, rows, partitions) == plain(rows)


def sliced(run_bytes):
    slices = P._slices

    def run(batches):
        P.RUN_BYTES = run_bytes
        try:
            yield from slices(batches)
        finally:
            P.RUN_BYTES = 2_000_000

    return run


def test_hot_conversation_and_hot_prefix(spark, monkeypatch):
    """Two thirds of all conversations are copies, the rest share their first turns."""
    monkeypatch.setattr(P, "FAN_IN", 2)
    monkeypatch.setattr(P, "_slices", sliced(300))
    rows = []
    for c in range(0, 600, 5):  # h = 0 turns from elsewhere: a source of its own
        same = c % 15
        rows += [(c, 0, "user", "hi"), (c, 1, "assistant", "hello")] + ([(c, 2, "user", f"no {c}")] if not same else [])
    assert got(spark, rows, 16) == plain(rows)


def test_defined_cases(spark):
    rows = [(1, None, "b", "x"), (1, 0, "a", "y"), (1, 0, "a", "x"), (1, 0, None, None), (1, 0, None, None), (1, 0, "a", "w"),
            (None, 1, "a", "b"), (7, 1, "", ""), (5, 1, "r", None), (-7, 1, "q", "r"), (-5, 2, "q", "r"), (3, 3, "u", "v" * 100_000)]
    assert got(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "a", "b")]) == []


def test_very_long_conversation(spark):
    rows = [(c, i, "user", str(i % 7)) for c in (0, 5, 10) for i in range(3000 + c)]
    out = got(spark, rows)
    assert max(r[1] for r in out) == 3010 and len(out) == 3011
    assert [r for r in out if r[1] == 3000][0][3] == 3


def test_node_layouts():
    """Children are found and listed while the label table grows."""
    rng = random.Random(3)
    node, labels = P.Node(b""), rng.sample(range(256), 256)
    for n, label in enumerate(labels, 1):
        node.add(P.Node(bytes([label, 7])))
        assert len(node.children()) == n
        assert all((node.find(x) is not None) == (x in labels[:n]) for x in range(256))
        assert all(node.find(x).prefix[0] == x for x in labels[:n])


def test_paths_are_cut_where_keys_part():
    root = P.Node(b"")
    keys = [b"abcdef", b"abcxyz", b"abc", b"b", b"abcdefgh"]
    ends = {k: P.reach(root, 0, k, len(k)) for k in keys}
    assert all(P.reach(root, 0, k, len(k)) is ends[k] for k in keys)
    assert [k.prefix for k in root.children()] == [b"abc", b"b"]
    assert P.common(b"abc", b"abd") == 2 and P.common(b"", b"x") == 0 and P.common(b"xy", b"xyz") == 2
