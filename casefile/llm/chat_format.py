"""Chat formatting with Spark expressions only.

A conversation's turn structs are collected and sorted by (turn, role, text);
adjacent turns of one role are merged into a block with array functions, and
blocks are concatenated as

    <s> role [INST] text [/INST] text ... </s>

without the blanks.  Marks never occur inside a role or a text: there a
backslash is doubled and a control string gets one behind its first character
(`</s>` becomes `<\\/s>`), which `unescape` takes back exactly.  The output is
cut into segments, each with its flag in the loss mask: what `formatted` holds
is their concatenation, and the mask covers the texts of `loss_role` alone.

Defined cases: null texts and roles are empty; a null turn comes first; equal
turn numbers are ordered by role, then text; repeated rows are turns of their
own; null conversation ids are one conversation.  A conversation is one row of
the output, so its turns meet in one task; nothing larger does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import table

OPEN, HEAD, NEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
#: The first character and the rest of every control string that is escaped.
CONTROL = r"(<(?=/?s>|</?SYS>>)|\[(?=/?INST\]))"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, blocks): each block a role and the texts of its turns."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    told = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    role, last = F.col("t.role"), F.size("t") - 1
    starts = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (role[i] != role[F.greatest(i - 1, F.lit(0))]))
    told = told.select("conv_id", "t", starts.alias("starts"))
    until = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("t")))
    merged = F.transform(F.arrays_zip("starts", until.alias("until")), lambda b: F.struct(
        role[b.starts].alias("role"), F.slice(F.col("t.text"), b.starts + 1, b.until - b.starts).alias("texts")))
    return told.select("conv_id", merged.alias("blocks"))


def segments_of(block: Column, loss_role: str) -> Column:
    """(text, loss) pieces: the head, each escaped text with the mark behind it."""
    n = F.size(block.texts)
    mark = lambda i: F.when(i + 1 < n, F.lit(NEXT)).otherwise(F.lit(CLOSE))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    head = piece(F.concat(F.lit(OPEN), escape(block.role), F.lit(HEAD)), F.lit(False))
    body = F.flatten(F.transform(block.texts, lambda t, i: F.array(
        piece(escape(t), block.role == loss_role), piece(mark(i), F.lit(False)))))
    return F.concat(F.array(head), body)


def formatted(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, segments, formatted) of every conversation in (conv_id, turn,
    role, text) rows."""
    segments = F.flatten(F.transform("blocks", lambda b: segments_of(b, loss_role)))
    cut = blocks(turns.select("conv_id", "turn", "role", "text")).select("conv_id", segments.alias("segments"))
    return cut.select("conv_id", "segments", F.array_join("segments.text", "").alias("formatted"))


def parsed(text: Column) -> Column:
    """The (role, text) turns that a formatted conversation holds."""
    ended = F.split(text, CLOSE)  # the part behind the last mark is empty
    return F.flatten(F.transform(F.slice(ended, F.lit(1), F.size(ended) - 1), lambda b: F.transform(
        F.split(F.substring_index(b, HEAD, -1), r"\[/INST\]", -1),
        lambda t: F.struct(unescape(F.substring(F.substring_index(b, HEAD, 1), len(OPEN) + 1, 2**31 - 1)).alias("role"),
                           unescape(t).alias("text")))))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s.loss), lambda s: unescape(s.text)), "")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    out = formatted(told.unionByName(probe)).select(
        "conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    told_again = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told_again.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
m AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens,
         length(regexp_replace(replace(text, '\', '\\'), '<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]', '\0+', 'g')) AS chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + CASE WHEN opens THEN length(role) + 13 ELSE 7 END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""
