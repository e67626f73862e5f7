"""Chat formatting: exact round trip, loss mask, defined cases."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.llm import chat_format as C

KIND = T.StructType([T.StructField(n, k) for n, k in (
    ("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()),
    ("formatted", T.StringType()), ("blocks", T.StringType()))])


def told(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], KIND)
    out = C.formatted(df).select("*", C.parsed(F.col("formatted")).alias("turns"), C.loss_text(F.col("segments")).alias("loss"))
    return {r["conv_id"]: r for r in out.collect()}


def test_round_trip_of_control_strings(spark):
    rng = random.Random(1)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "\\\\", "<", "/s>", "[", "\n", "$1", "a", "é漢😀", " ", ""]
    rows = [(c, i, rng.choice(["user", "assistant", "sys</s>tem\\", "a[INST]\nb", ""]), "".join(rng.choices(parts, k=rng.randint(0, 9))))
            for c in range(200) for i in range(rng.randint(1, 9))]
    got = told(spark, rows)
    for c in range(200):
        mine = [(r, t) for k, _, r, t in rows if k == c]
        assert [tuple(t) for t in got[c]["turns"]] == mine
        assert got[c]["loss"] == "".join(t for r, t in mine if r == "assistant")
        assert got[c]["formatted"] == "".join(s["text"] for s in got[c]["segments"])
        merged = sum(1 for a, b in zip([(None,), *mine], mine) if a[0] != b[0])
        assert got[c]["formatted"].count("</s>") == got[c]["formatted"].count("<s>") == merged


def test_template(spark):
    got = told(spark, [(1, 2, "user", "b"), (1, 1, "user", "a</s>"), (1, 3, "assistant", "c\\")])[1]
    assert got["formatted"] == "<s>user[INST]a<\\/s>[/INST]b</s><s>assistant[INST]c\\\\</s>"
    assert [(s["text"], s["loss"]) for s in got["segments"] if s["loss"]] == [("c\\\\", True)]


def test_defined_cases(spark):
    long = "x" * 300_000
    got = told(spark, [(None, 1, None, None), (2, 1, "assistant", "b"), (2, 1, "assistant", "a"), (2, None, "user", ""),
                       (2, 1, "assistant", "a"), (3, 0, "assistant", long)])
    assert [tuple(t) for t in got[None]["turns"]] == [("", "")]
    assert [tuple(t) for t in got[2]["turns"]] == [("user", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    assert got[2]["loss"] == "aab" and got[3]["loss"] == long
    assert told(spark, []) == {}


def test_many_turns_of_one_conversation(spark):
    got = told(spark, [(1, i, ("user", "assistant")[i // 3 % 2], f"t{i}") for i in range(5000)])[1]
    assert [t["text"] for t in got["turns"]] == [f"t{i}" for i in range(5000)]
