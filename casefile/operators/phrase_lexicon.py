"""Mentions of a lexicon that is a table (X1, H2, D3): many entries of several
words each.

An entry occurs where its words stand one after another, whatever other
characters are between them; words are runs of ASCII letters, digits and
underscores of the lower-cased text, as for the regex lexicon.  Entries are
keyed by their first word: a token meets the lengths that entries beginning
with it have, and for each of them reads that many words off the text.  Work
follows the tokens, not the entries, and neither text nor tokens are shuffled:
they pass tables of at most HASHES hashed first words a length, then the words
read pass a table of BITS bits, in which each entry has set HITS.

What passes is an entry but for chance.  A first reading of the texts tells by
the entries themselves which phrases pass and are none, a few; the second one
leaves these out, and so knows a message's entries where its text is read.
Of those found in a message one that lies inside a longer one is left out.  No
place is shuffled, and a message's entries leave in one row.  Where there are
more than STRANGERS such phrases the places are shuffled and joined with the
entries instead, as are those of messages that share an id.

Defined cases: null subjects and bodies are empty; entries without a word occur
nowhere; of entries with the same words the first is found; the places of rows
with the same `keep` columns are compared together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions.text import search_text
from casefile.operators.staging import date_window_filter

#: Bits of the table that tokens are filtered with, for each length of an entry.
HASHES = 1 << 16
#: Bits of the table that the words of a place are filtered with (8 MB), and those of an entry.
BITS = 1 << 26
HITS = 8
#: Phrases that pass the tables and are no entry, as many as are sent to the texts.
STRANGERS = 1 << 18
#: Phrases that a task remembers to have read.
REMEMBERED = 1 << 19
#: Ids that more than one message has, as many as are sent to the texts.
SENT_IDS = 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_WORD = re.compile(rb"[0-9a-z_]+")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[0-9a-z_]+"), F.lit(0))


def entries(lexicon: DataFrame, entity_col: str = "entity") -> DataFrame:
    """(phrase, entity, n_words, first) of a table's entities."""
    w = words(F.col(entity_col))
    return (lexicon.select(F.array_join(w, " ").alias("phrase"), F.col(entity_col).alias("entity"), F.size(w).alias("n_words"))
            .filter("n_words > 0").groupBy("phrase", "n_words").agg(F.min("entity").alias("entity"))
            .withColumn("first", F.substring_index("phrase", " ", 1)))


class _Tokens:
    """The words of some texts in a row, and the hash of any of their stretches."""

    def __init__(self, texts: list[bytes]):
        found = [_WORD.findall(t) for t in texts]
        self.ends = np.cumsum([len(w) for w in found], dtype=np.int64)  # of the texts
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        coded = pa.array(list(chain.from_iterable(found)), pa.binary()).cast(pa.string()).dictionary_encode()
        self.vocabulary, self.codes = coded.dictionary, coded.indices.to_numpy()
        self.hashes = pd.util.hash_array(self.vocabulary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
        # a stretch is the sum of its words' hashes, times a step for each place
        steps, self._back = (self._from(1, np.cumprod(np.full(len(self.codes), x))) for x in (_STEP, _BACK))
        self._sums = self._from(0, np.cumsum(self.hashes[self.codes] * steps[:-1]))

    @staticmethod
    def _from(first: int, then: np.ndarray) -> np.ndarray:
        return np.concatenate([np.array([first], np.uint64), then])

    def stretches(self, at: np.ndarray, n: int | np.ndarray) -> np.ndarray:
        """Hashes of the `n` words from each of `at` on."""
        return (self._sums[at + n] - self._sums[at]) * self._back[at]

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        return pc.binary_join_element_wise(*(self.vocabulary.take(pa.array(self.codes[at + i])) for i in range(n)), " ")


def _next(x: np.ndarray) -> np.ndarray:
    return (x ^ (x >> np.uint64(32))) * _STEP


def _bit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - (BITS.bit_length() - 1))).astype(np.int64)


def _rows(kind: int, bits: np.ndarray) -> pa.RecordBatch:
    row, which = np.unique(bits >> 6, return_inverse=True)
    held = np.zeros(len(row), np.uint64)
    np.bitwise_or.at(held, which, np.uint64(1) << (bits & 63).astype(np.uint64))
    return pa.record_batch([np.full(len(row), kind, np.int32), row, held.view(np.int64)], ["kind", "row", "bits"])


def _tables(lexicon: DataFrame) -> dict[int, np.ndarray]:
    """The bits of the entries at 0, those of their first words by length; a
    bounded number of rows comes to the driver, whatever the entries."""
    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = _Tokens([p.encode() for p in b.column("phrase").to_pylist()])
            n = t.ends - t.starts
            x, bits = t.stretches(t.starts, n), []
            for _ in range(HITS):
                x = _next(x)
                bits.append(_bit(x))
            yield _rows(0, np.concatenate(bits))
            first = (t.hashes[t.codes[t.starts]] % HASHES).astype(np.int64)
            yield from (_rows(int(k), first[n == k]) for k in np.unique(n))

    rows = (lexicon.select("phrase").mapInArrow(set_bits, "kind int, row long, bits long")
            .groupBy("kind", "row").agg(F.bit_or("bits").alias("bits")).toArrow())
    kind, row, bits = (rows.column(c).to_numpy() for c in ("kind", "row", "bits"))
    out = {}
    for k in np.unique(kind).tolist():
        out[k] = np.zeros((HASHES if k else BITS) >> 6, np.uint64)
        out[k][row[kind == k]] = bits[kind == k].view(np.uint64)
    return out


def _held(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (table[bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1) == 1


def _candidates(t: _Tokens, tables: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first token, number of words, phrase) of all places that may be an entry's."""
    last, here = np.repeat(t.ends, t.ends - t.starts), np.arange(len(t.codes))
    first = (t.hashes % HASHES).astype(np.int64)
    found = [(np.zeros(0, np.int64), 0, pa.array([], pa.string()))]
    for n, firsts in tables.items():
        if n and len(here):
            at = np.flatnonzero(_held(firsts, first)[t.codes] & (here + n <= last))  # at a text's end fewer words may be left
            x = t.stretches(at, n)
            for _ in range(HITS):
                x = _next(x)
                ok = _held(tables[0], _bit(x))
                at, x = at[ok], x[ok]
            found.append((at, n, t.phrases(at, n)))
    return (np.concatenate([at for at, _, _ in found]), np.concatenate([np.full(len(at), n, np.int64) for at, n, _ in found]),
            pa.concat_arrays([p for _, _, p in found]))


def _places(shared: Broadcast, keep: Sequence[str]):
    """(keep..., phrase, pos, n_words): all places of the texts that may be an entry's."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = _Tokens(b.column("_text").to_pylist())
            at, n, phrases = _candidates(t, shared.value)
            owner = np.searchsorted(t.ends, at, side="right")
            pos = pa.array((at - t.starts[owner]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(owner)) for c in keep), phrases, pos, pa.array(n.astype(np.int32))],
                                             [*keep, "phrase", "pos", "n_words"])
    return read


def _phrases(shared: Broadcast):
    """(phrase): what `_candidates` finds, most of it once a task."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for b in batches:
            found = _candidates(_Tokens(b.column("_text").to_pylist()), shared.value)[2]
            new = [p for p in found.dictionary_encode().dictionary.to_pylist() if p not in seen]
            if len(seen) + len(new) > REMEMBERED:
                seen.clear()
            seen.update(new)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string())], ["phrase"])
    return read


def _mentions(shared: Broadcast, strangers: Broadcast, keep: Sequence[str]):
    """(keep..., phrases): the entries in each text that has some, without those
    that lie inside a longer one wherever they stand."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.array(strangers.value, pa.string())
        for b in batches:
            t = _Tokens(b.column("_text").to_pylist())
            at, n, phrases = _candidates(t, shared.value)
            known = np.flatnonzero(~pc.is_in(phrases, value_set=none).to_numpy(zero_copy_only=False))
            order = known[np.lexsort((-n[known], at[known]))]
            end, outer = (at + n)[order], np.ones(len(order), bool)
            outer[1:] = np.maximum.accumulate(end)[:-1] < end[1:]  # places of earlier texts end before this one's begin
            chosen = order[outer]
            owner, coded = np.searchsorted(t.ends, at[chosen], side="right"), phrases.take(pa.array(chosen)).dictionary_encode()
            pairs = np.unique(owner * max(1, len(coded.dictionary)) + coded.indices.to_numpy())
            texts, first = np.unique(pairs // max(1, len(coded.dictionary)), return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(pairs)).astype(np.int32)),
                                             coded.dictionary.take(pa.array(pairs % max(1, len(coded.dictionary)))))
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(texts)) for c in keep), lists], [*keep, "phrases"])
    return read


def _texts(emails: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, str]:
    """The columns that are read in Python, and the types of those kept."""
    text = F.lower(search_text("subject", "body")).cast("binary").alias("_text")
    return emails.select(*keep, text), "".join(f"`{c}` {emails.schema[c].dataType.simpleString()}, " for c in keep)


def _found(emails: DataFrame, lexicon: DataFrame, shared: Broadcast, keep: Sequence[str]) -> DataFrame:
    texts, types = _texts(emails, keep)
    places = texts.mapInArrow(_places(shared, keep), f"{types}phrase string, pos int, n_words int")
    return places.join(lexicon.select("phrase", "n_words", "entity"), ["phrase", "n_words"]).select(*keep, "entity", "pos", "n_words")


def _strangers(emails: DataFrame, lexicon: DataFrame, shared: Broadcast) -> list[str] | None:
    """The phrases of the texts that pass the tables and are no entry, or None if they are too many."""
    read = _texts(emails, [])[0].mapInArrow(_phrases(shared), "phrase string").distinct()
    out = read.join(lexicon.select("phrase"), "phrase", "left_anti").limit(STRANGERS + 1).toArrow().column("phrase").to_pylist()
    return out if len(out) <= STRANGERS else None


def _prepared(emails: DataFrame, lexicon: DataFrame, window: tuple[str | None, str | None] | None) -> tuple[DataFrame, Broadcast]:
    # texts go to Python in batches of a few MB, whatever their lengths; the session keeps this
    emails.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    shared = emails.sparkSession.sparkContext.broadcast(_tables(lexicon))  # BITS, and HASHES for each length
    return emails if window is None or window == (None, None) else date_window_filter(emails, "sent_at", *window), shared


def occurrences(emails: DataFrame, lexicon: DataFrame, *, window: tuple[str | None, str | None] | None = None,
                keep: Sequence[str] = ("id",)) -> DataFrame:
    """(keep..., entity, pos, n_words): every place of every entry of `lexicon`
    (as `entries` makes it)."""
    e, shared = _prepared(emails, lexicon, window)
    return _found(e, lexicon, shared, keep)


def longest_only(found: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """Without the places that lie inside a longer place of the same message."""
    end = F.col("pos") + F.col("n_words")
    before = Window.partitionBy(*keep).orderBy("pos", F.desc("n_words")).rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("_reach", F.max(end).over(before)).filter(F.col("_reach").isNull() | (F.col("_reach") < end)).drop("_reach")


def table_mentions(emails: DataFrame, lexicon: DataFrame, *, window: tuple[str | None, str | None] | None = None,
                   keep: Sequence[str] = ("id",), dealt: bool = False) -> DataFrame:
    """X1 for a lexicon table: one row per (message, entity mentioned).  The
    first of `keep` is the message's id; with `dealt`, rows are dealt by it, a
    message's entities in one row until then."""
    e, shared = _prepared(emails, lexicon, window)
    key = keep[0]

    def by_place(some: DataFrame) -> DataFrame:
        return longest_only(_found(some, lexicon, shared, keep), keep).select(*keep, "entity").distinct()

    strangers = _strangers(e, lexicon, shared)
    if strangers is None:
        return by_place(e)
    again = e.groupBy(key).count().filter("count > 1").select(F.col(key).alias("_again"))
    n = again.count()

    def of(how: str) -> DataFrame:
        return e.join(F.broadcast(again) if n <= SENT_IDS else again, F.col(key).eqNullSafe(F.col("_again")), how)

    texts, types = _texts(of("left_anti") if n else e, keep)
    out = texts.mapInArrow(_mentions(shared, e.sparkSession.sparkContext.broadcast(strangers), keep), f"{types}phrases array<string>")
    out = (out.repartition(key) if dealt else out).select(*keep, F.explode("phrases").alias("phrase"))
    if lexicon.filter("entity <> phrase").isEmpty():
        out = out.withColumnRenamed("phrase", "entity")
    else:
        out = out.join(lexicon.select("phrase", "entity"), "phrase").select(*keep, "entity")
    return out.unionByName(by_place(of("left_semi"))) if n else out
