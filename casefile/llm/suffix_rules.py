"""Repetition rules from suffix arrays.

A text is taken as its words.  Its suffix array (prefix doubling in numpy, many
texts at a time) and the longest common prefixes of neighbouring suffixes give
the LCP intervals.  A suffix's innermost interval has the larger of its two
neighbouring prefixes as its length: the longest repeat that starts there.  A
repeat that goes on to the left too is part of the longer one a word before;
the others are the maximal repeats.  The union of their spans is what the text
repeats of itself.

`kept`: the base rules hold (`min_words` words, at most half of them in
repeated three-word windows), at most `max_covered_percent` of the words lie
in repeats of `min_repeat` words or more, and no repeat is above `max_repeat`
words.

Defined cases: null and empty texts have no words and fail the base rules.
Words are runs of anything but ASCII white space; words and lines are equal
only if all characters are.  Rows are judged one by one; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import fresh_names, small_batches, strings, table

SPACE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
#: Words in one numpy pass; a longer text is a pass of its own.
BLOCK_WORDS = 60_000


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    window: int = 3
    max_window_percent: int = 50
    min_repeat: int = 8
    max_covered_percent: int = 30
    max_repeat: int = 60


def suffix_ranks(words: np.ndarray, longest: int | None = None) -> list[np.ndarray]:
    """Rank arrays of the suffixes' first 1, 2, 4, ... words.

    Ends when all ranks differ.  Only suffixes that still share a rank are
    sorted again.  A rank is the position its group starts at in the order.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    levels = [_ranks(order, words)]
    tied, k = _tied(levels[0], order), 1
    while len(tied):
        rank = levels[-1]
        after = np.where(tied + k < n, rank[np.minimum(tied + k, n - 1)], -1)
        key = rank[tied].astype(np.int64) * (n + 1) + after + 1
        by = np.argsort(key, kind="stable")
        new = rank.copy()
        at, sorted_key = tied[by], key[by]
        group = rank[at]
        first = np.flatnonzero(np.concatenate(([True], np.diff(group) != 0)))
        place = np.arange(len(at)) - np.repeat(first, np.diff(np.concatenate((first, [len(at)]))))
        head = np.concatenate(([True], np.diff(sorted_key) != 0))
        new[at] = group + place[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
        levels.append(new)
        same = np.concatenate((~head[1:], [False])) | ~head
        tied, k = at[same], 2 * k
    return levels


def _ranks(order: np.ndarray, words: np.ndarray) -> np.ndarray:
    value = words[order]
    head = np.concatenate(([True], value[1:] != value[:-1]))
    out = np.empty(len(words), np.int32)
    out[order] = np.maximum.accumulate(np.where(head, np.arange(len(words)), 0))
    return out


def _tied(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    r = rank[order]
    same = r[1:] == r[:-1]
    return order[np.concatenate((same, [False])) | np.concatenate(([False], same))]


def longest_repeats(words: np.ndarray) -> np.ndarray:
    """For each position the length of its innermost LCP interval: the longest
    repeat that starts there (0: none)."""
    n = len(words)
    if n < 2:
        return np.zeros(n, np.int64)
    levels = suffix_ranks(words)
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)  # the last ranks are all different
    a, b = order[:-1], order[1:]
    lcp = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank, k = levels[level], 1 << level
        open_ = (a + lcp < n) & (b + lcp < n)
        i = np.flatnonzero(open_)
        same = rank[a[i] + lcp[i]] == rank[b[i] + lcp[i]]
        lcp[i[same]] += k
    out = np.zeros(n, np.int64)
    out[a] = lcp
    np.maximum.at(out, b, lcp)
    return out


def maximal_spans(repeat: np.ndarray, at_least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal repeats of `at_least` words or more."""
    goes_left = np.concatenate(([False], repeat[:-1] == repeat[1:] + 1))
    start = np.flatnonzero((repeat >= at_least) & ~goes_left)
    return start, repeat[start]


def covered(repeat: np.ndarray, at_least: int) -> np.ndarray:
    """Which words lie in the union of the maximal repeats' spans."""
    start, length = maximal_spans(repeat, at_least)
    edge = np.bincount(start, minlength=len(repeat) + 1) - np.bincount(start + length, minlength=len(repeat) + 1)
    return np.cumsum(edge)[:-1] > 0


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]


def measures(texts: Iterator[str | None], rules: Rules) -> Iterator[np.ndarray]:
    """A row of COLUMNS for each text, in runs of whole texts."""
    lines, held, size = [], [], 0
    for text in texts:
        text = text or ""
        words = text.encode("utf-8", "surrogatepass").split()
        chars = len(text) - sum(map(text.count, SPACE))
        lines.append((len(words), chars, sum(map(text.count, SYMBOLS)), _dup_lines(text)))
        ids: dict[bytes, int] = {}
        held.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words)))
        size += len(words)
        if size > BLOCK_WORDS:
            yield _measured(lines, held, rules)
            lines, held, size = [], [], 0
    if lines:
        yield _measured(lines, held, rules)


def _dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def _measured(base: list[tuple], held: list[np.ndarray], rules: Rules) -> np.ndarray:
    sizes = np.array([len(x) for x in held])
    # texts get words of their own, so that no common prefix spans two texts
    kinds = np.array([int(x.max()) + 1 if len(x) else 0 for x in held])
    words = np.concatenate(held) + np.repeat(np.cumsum(kinds) - kinds, sizes)
    repeat = longest_repeats(words)
    # a prefix is cut at its text's end, where the next text's words differ
    owner = np.repeat(np.arange(len(held)), sizes)
    out = np.zeros((len(held), len(COLUMNS)), np.int64)
    out[:, :4] = base
    if len(words):
        out[:, 4] = np.bincount(owner, covered(repeat, rules.window), len(held))
        out[:, 5] = np.bincount(owner, covered(repeat, rules.min_repeat), len(held))
        np.maximum.at(out[:, 6], owner, repeat)
    return out


def repetition(df: DataFrame, text: str = "text", out: str = "repetition", rules: Rules = Rules()) -> DataFrame:
    """`df` with a struct column `out`: the measures, base_failed and kept."""

    @F.arrow_udf("struct<" + ",".join(f"{c}:long" for c in COLUMNS) + ">")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            none = np.zeros((0, len(COLUMNS)), np.int64)
            rows = np.concatenate([none, *measures(strings(texts), rules)])
            yield pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], names=COLUMNS)

    small_batches(df.sparkSession)
    _, held = fresh_names(df, out, "measures")
    m = F.col(held)
    failed = (m.n_words < rules.min_words) | (100 * m.n_repeat_words > rules.max_window_percent * m.n_words)
    good = (100 * m.n_covered <= rules.max_covered_percent * m.n_words) & (m.longest_repeat <= rules.max_repeat)
    fields = [m[c].alias(c) for c in COLUMNS]
    return (df.withColumn(held, measured.asNondeterministic()(F.col(text)))
            .withColumn(out, F.struct(*fields, failed.alias("base_failed"), (~failed & good).alias("kept")))
            .drop(held))


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition(docs).select("doc_id", "repetition.*").drop("longest_repeat")


#: Words in windows of k that a text has twice are the words of its repeats of
#: k words or more, and a longest repeat above r is a window of r + 1 found twice.
OP5_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
win AS (
  SELECT doc_id, k, i, md5(array_to_string(list_slice(words, i, i + k - 1), ' ')) AS h
  FROM w, (VALUES (3), (8), (61)) AS v(k), unnest(range(1, len(words) - k + 2)) AS r(i)),
twice AS (
  SELECT doc_id, k, i FROM win
  QUALIFY count(*) OVER (PARTITION BY doc_id, k, h) > 1),
hit AS (
  SELECT doc_id, k, count(DISTINCT p) AS n
  FROM (SELECT doc_id, k, unnest(range(i, i + k)) AS p FROM twice) GROUP BY ALL),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(l.n, 0)::BIGINT AS n_dup_lines,
         coalesce((SELECT n FROM hit WHERE hit.doc_id = w.doc_id AND k = 3), 0)::BIGINT AS n_repeat_words,
         coalesce((SELECT n FROM hit WHERE hit.doc_id = w.doc_id AND k = 8), 0)::BIGINT AS n_covered,
         coalesce((SELECT n FROM hit WHERE hit.doc_id = w.doc_id AND k = 61), 0) AS n_long
  FROM w LEFT JOIN lines l USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_covered <= 30 * n_words AND n_long = 0 AS kept
FROM m
"""
