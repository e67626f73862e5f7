"""Periodic runs of words, found with string synchronising sets.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) of `min_length` words or more and at least MIN_PERIODS periods long.

Small periods (below FIRST_SCALE * 2) are found directly, by comparing each
word with the one q later.  Periods of 2t to 4t - 1 are found at scale t (a
power of two): position i is in the synchronising set if the least hash of the
t-word windows that start in [i, i + t] is that of the first or the last of
them.  Windows with a period of t / 3 or less have no hash; they lie in runs
that smaller scales have found, and are the only places without a position of
the set in every t words.  Membership depends on the 2t words from i on alone,
so in a run of period q the set repeats every q words: two of its positions
with equal contexts of 2t words, 2t to 4t - 1 words apart, propose their
distance as a period.  Each proposal is extended word by word as far as it
holds, so that hashes decide nothing; a stretch that a smaller period fills is
that period's run.

Texts are handled many at a time in numpy, with words numbered anew in each
text, so that no period spans two texts; texts too short for a scale are left
out of it.  A text needs memory in proportion to its words.

Defined cases: null and empty texts have no words and no runs.  Words are runs
of anything but ASCII white space.  Repeated rows get equal results; all other
columns stay, but one named like the output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import small_batches, strings, table

MIN_LENGTH, MIN_PERIODS = 24, 3
#: The first scale with a synchronising set; smaller periods are compared directly.
FIRST_SCALE = 4
#: Words in one numpy pass; a longer text is a pass of its own.
BLOCK_WORDS = 60_000

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _doubled(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the 2k words from each position on, from those of k words."""
    after = np.zeros_like(h)
    after[:-k] = h[k:]
    return _mixed(h * np.uint64(0x9E3779B97F4A7C15) + after)


def synchronising_set(h: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """The positions whose hash, or the one t later, is the least of the t + 1
    windows from there on; `periodic` windows count for nothing."""
    h = np.where(periodic, _NONE, h)
    least, k = h, 1
    while k < t:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    here, there = h[:-t], h[t:]
    least = np.minimum(least[:len(here)], there)
    return np.flatnonzero((least != _NONE) & ((here == least) | (there == least)))


def _agree(w: np.ndarray, i: int, j: int, forward: bool) -> int:
    """How many words from i and j on, or back from them, are equal (i < j)."""
    n, step, limit = 0, 64, len(w) - j if forward else i + 1
    while n < limit:
        m = min(step, limit - n)
        if forward:
            differ = w[i + n:i + n + m] != w[j + n:j + n + m]
        else:
            differ = (w[i - n - m + 1:i - n + 1] != w[j - n - m + 1:j - n + 1])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return n + at
        n, step = n + m, 2 * step
    return n


def _direct(w: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of period q, MIN_PERIODS long."""
    same = np.zeros(max(len(w) - q, 0) + 2, np.int8)
    same[1:-1] = w[q:] == w[:len(w) - q]
    edge = np.flatnonzero(np.diff(same))
    start, end = edge[::2], edge[1::2] + q
    long = end - start >= MIN_PERIODS * q
    return start[long], end[long]


def _proposals(h2: np.ndarray, at: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of the pairs of the set with equal contexts, by period."""
    context, pairs = h2[at], []
    for k in range(1, len(at)):
        apart = at[k:] - at[:-k]
        if not (apart < 4 * t).any():
            break
        good = (apart >= 2 * t) & (apart < 4 * t) & (context[k:] == context[:-k])
        if good.any():
            pairs.append((at[:-k][good], apart[good]))
    if not pairs:
        return at[:0], at[:0]
    i, p = (np.concatenate(x) for x in zip(*pairs))
    by = np.lexsort((i, p))
    return i[by], p[by]


def all_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each text of word numbers its runs (start, end, period) of any length,
    ordered by period, then start."""
    sizes = np.array([len(x) for x in texts], np.int64)
    out: list[dict[tuple[int, int], int]] = [{} for _ in texts]
    if not sizes.sum():
        return [[] for _ in texts]
    kinds = np.array([int(x.max()) + 1 if len(x) else 0 for x in texts])
    w = np.concatenate(texts) + np.repeat(np.cumsum(kinds) - kinds, sizes)
    alive, first = np.arange(len(texts)), np.cumsum(sizes) - sizes  # texts of this level, and their first words
    for q in range(1, 2 * FIRST_SCALE):
        start, end = _direct(w, q)
        owner = np.searchsorted(first, start, "right") - 1
        for o, s, e in zip(owner.tolist(), (start - first[owner]).tolist(), (end - first[owner]).tolist()):
            out[o].setdefault((s, e), q)
    h, t = _mixed(w.astype(np.uint64) + np.uint64(1)), 1
    while 2 * MIN_PERIODS * t <= sizes.max(initial=0):
        if t >= FIRST_SCALE:
            keep = sizes[alive] >= 2 * MIN_PERIODS * t
            mask = np.repeat(keep, sizes[alive])
            w, h, alive = w[mask], h[mask], alive[keep]
            first = np.cumsum(sizes[alive]) - sizes[alive]
        h2 = _doubled(h, t)
        if t >= FIRST_SCALE:
            periodic = np.zeros(len(w) + 1, np.int64)
            for o, at in zip(alive.tolist(), first.tolist()):
                for (s, e), q in out[o].items():
                    if MIN_PERIODS * q <= t <= e - s:
                        periodic[at + s] += 1
                        periodic[at + e - t + 1] -= 1
            chosen = synchronising_set(h, np.cumsum(periodic)[:-1] > 0, t)
            done, period = -1, 0  # up to where the period's last stretch reaches
            for i, p in zip(*(x.tolist() for x in _proposals(h2, chosen, t))):
                if p == period and i < done:
                    continue
                s = i - _agree(w, i - 1, i + p - 1, False) if i else 0
                e = i + p + _agree(w, i, i + p, True)
                period, done = p, e - p
                if e - s >= MIN_PERIODS * p:
                    o = int(np.searchsorted(first, s, "right")) - 1
                    out[int(alive[o])].setdefault((s - int(first[o]), e - int(first[o])), p)
        h, t = h2, 2 * t
    return [sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[2], r[0])) for found in out]


def _numbered(words: list[bytes]) -> np.ndarray:
    ids: dict[bytes, int] = {}
    return np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))


def found(texts: Iterator[str | None], min_length: int = MIN_LENGTH) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, runs (start, length, period) by start and period, collapsed text)."""
    held: list[list[bytes]] = []
    size = 0

    def block():
        for words, runs in zip(held, all_runs([_numbered(x) for x in held])):
            runs = sorted((s, e - s, q) for s, e, q in runs if e - s >= min_length)
            if runs:
                edge = np.zeros(len(words) + 1, np.int64)
                for s, n, q in runs:
                    edge[s + q] += 1
                    edge[s + n] -= 1
                kept = np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()
                yield len(words), runs, b" ".join([words[i] for i in kept])
            else:
                yield len(words), runs, b" ".join(words)

    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass").split())
        size += len(held[-1])
        if size > BLOCK_WORDS:
            yield from block()
            held, size = [], 0
    yield from block()


RUNS = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"


def periodic_runs(df: DataFrame, text: str = "text", out: str = "periodic", min_length: int = MIN_LENGTH) -> DataFrame:
    """`df` with a struct column `out`: the text's number of words, its runs by
    start and period, and its words, joined by blanks, without those that a run
    repeats: all that lie in a run after its first period."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    @F.arrow_udf(RUNS)
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n, runs, kept = [], [], []
            for words, mine, collapsed in found(strings(texts), min_length):
                n.append(words)
                runs.append([dict(zip(("start", "length", "period"), r)) for r in mine])
                kept.append(collapsed)
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(runs, pa.list_(run)), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["n_words", "runs", "collapsed"])

    small_batches(df.sparkSession)
    return df.withColumn(out, measured.asNondeterministic()(F.col(text)))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; of equal ones the first."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(
        r.length * best.period > best.length * r.period, r).otherwise(best))


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a period in the documents whose id's crc32 ends in 0: from
    word a on, the p words there are repeated to the end."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")

    def edited(s: Column) -> Column:
        n = F.size(s.w)

        def word(w: Column, i: Column) -> Column:
            a = s.g % n
            p = (n - a - (n - a) % (3 + s.g % 8)) / (3 + s.g % 8) + 1
            return F.when(i < a, w).otherwise(F.get(s.w, (a + (i - a) % p).cast("int")))

        return F.array_join(F.transform(s.w, word), " ")

    # words and g are values of an outer lambda: computed once
    bound = F.array(F.struct(words.alias("w"), ((h - h % 10) / 10).cast("long").alias("g")))
    return F.when(h % 10 == 0, F.get(F.transform(bound, edited), F.lit(0))).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # exploded, so that the optimizer does not merge the expression into the UDF's input
    text = F.explode(F.array(planted(F.col("doc_id"), F.col("text"))))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    runs = F.col("periodic.runs")
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    listed = F.when(F.size(runs) > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = F.col("best")
    return (periodic_runs(docs).select("doc_id", "periodic", strongest(runs).alias("best"))
            .select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.start.alias("start"), best.length.alias("length"),
                    best.period.alias("period"), F.floor(1000 * best.length / best.period).alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("periodic.collapsed").cast("binary"), 256).alias("collapsed_sha256")))
