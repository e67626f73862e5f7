"""Investigator transcripts as tables.

Messages: (run_id, turn, tool, text).  Occurrence counting (Q3) uses
`segmented_row_number`, which sorts only within (run, signature, turn
segment) and adds the counts of earlier segments, so one huge run is split
across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.functions.sequence import segmented_row_number
from casefile.functions.text import WORD_CLASS, is_create_wrapped, safe_evidence_table, strip_create_wrapper


def marker_pattern(words: Sequence[str]) -> str:
    """A marker word, blanks, then the artifact token that follows it."""
    alts = "|".join(words)
    return f"(?<![{WORD_CLASS}])({alts})[\\t\\n\\f\\r ]+([{WORD_CLASS}]+)"


def transcript_markers(msgs: DataFrame, words: Sequence[str]) -> DataFrame:
    """Q1: one row per marker occurrence: (run_id, turn, tool, marker, artifact)."""
    pat = marker_pattern(words)
    txt = F.lower(F.col("text"))
    m = msgs.select("run_id", "turn", "tool",
                    F.arrays_zip(F.regexp_extract_all(txt, F.lit(pat), 1).alias("marker"),
                                 F.regexp_extract_all(txt, F.lit(pat), 2).alias("artifact")).alias("_m"))
    return m.select("run_id", "turn", "tool", F.explode("_m").alias("_x")).select(
        "run_id", "turn", "tool", F.col("_x.marker").alias("marker"), F.col("_x.artifact").alias("artifact"))


def run_reliability(markers: DataFrame, runs: DataFrame, finding_marker: str) -> DataFrame:
    """Q2: findings per run (marker occurrences), pass = >= 1, pass rate over runs."""
    f = (markers.filter(F.col("marker") == finding_marker)
                .groupBy("run_id").agg(F.count(F.lit(1)).alias("findings")))
    per = (runs.select("run_id").distinct().join(f, "run_id", "left")
               .withColumn("findings", F.coalesce("findings", F.lit(0)).cast("long"))
               .withColumn("passed", F.col("findings") >= 1))
    rate = per.agg(F.round(F.avg(F.col("passed").cast("double")), 4).alias("pass_rate"))
    return per.crossJoin(rate)


def call_signatures(calls: DataFrame, args: str = "args") -> DataFrame:
    """Calls with a signature: the tool and its whole arguments."""
    return calls.withColumn("signature", F.concat("tool", F.lit("|"), F.coalesce(args, F.lit(""))))


def repeated_calls(calls: DataFrame, *, limit: int = 3, budget_turn: int = 22,
                   write_tools: Sequence[str] = (), note_tools: Sequence[str] = ()) -> DataFrame:
    """Q3 (C19): identical calls repeated within a run.

    Read calls are flagged at every occurrence >= limit; write tools at
    occurrences limit, 2*limit, ... (their count restarts after each hit).  The
    budget rule is tested first: a read call at turn >= budget_turn is reported
    as `budget` only, but still advances the counter.  Notes are never flagged.
    """
    c = calls.filter(~F.col("tool").isin(*note_tools)) if note_tools else calls
    c = segmented_row_number(c, ["run_id", "signature"], ["turn"], "occurrence")
    is_write = F.col("tool").isin(*write_tools) if write_tools else F.lit(False)
    budget = ~is_write & (F.col("turn") >= budget_turn)
    rep = F.when(is_write, F.col("occurrence") % limit == 0).otherwise(F.col("occurrence") >= limit)
    kind = F.when(budget, F.lit("budget")).when(rep, F.lit("repeat"))
    return (c.withColumn("flagged_as", kind).filter(F.col("flagged_as").isNotNull())
             .select("run_id", "turn", "tool", "signature", "occurrence", "flagged_as"))


def budget_breaches(calls: DataFrame, *, turn: int = 22, write_tools: Sequence[str] = (),
                    note_tools: Sequence[str] = ()) -> DataFrame:
    """Q4: read calls at or after the budget turn."""
    skip = [*write_tools, *note_tools]
    c = calls.filter(~F.col("tool").isin(*skip)) if skip else calls
    return c.filter(F.col("turn") >= turn).select("run_id", "turn", "tool")


def artifact_manifest(markers: DataFrame) -> DataFrame:
    """Q5: distinct (marker, artifact) over all runs, with the runs naming it."""
    return (markers.groupBy("marker", "artifact")
                   .agg(F.countDistinct("run_id").alias("runs"), F.count(F.lit(1)).alias("mentions")))


def transcript_trace(msgs: DataFrame, cut: int = 600) -> DataFrame:
    """Q6: flat trace, content cut to `cut` characters."""
    return msgs.select("run_id", "turn", F.col("tool").alias("kind"), "tool",
                       F.substring("text", 1, cut).alias("content"))


def normalized_tool_calls(calls: DataFrame, table_col: str = "table_arg", sql_col: str = "sql_arg",
                          schema: str = "analytics") -> DataFrame:
    """Bulk clean-up of recorded write calls: safe table name, validity,
    the SELECT inside a CREATE ... AS wrapper, trailing `;` dropped."""
    safe = safe_evidence_table(F.col(table_col), schema)
    return calls.select("run_id", "turn", safe.alias("safe_table"), safe.isNotNull().alias("is_valid"),
                        strip_create_wrapper(F.col(sql_col)).alias("select_sql"),
                        is_create_wrapped(F.col(sql_col)).alias("was_wrapped"))
