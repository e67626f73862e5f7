"""Quality by attention-based multiple-instance learning.

A text is a bag of passages (`passage_words` words each).  Every passage is
encoded: measures of its characters, words and repeats go through a learned
tanh layer.  Gated attention (tanh(V h) * sigmoid(U h), one weight per passage,
softmax over the text) gives the weighted passage representation, and a
logistic layer scores it.  All weights are learned together from the labels of
whole texts, on a bounded sample, with Adam in numpy.

Scoring keeps per text only the running sums of the softmax, so a text's
passages may come in any number of blocks.

Defined cases: null and empty texts are one passage without words.  With
labels of one class only, or none, every score is 1: nothing speaks against
the text.  Rows are judged one by one; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import (blocks, code_points, cut_at_words, id_remainder, labelled_sample, letter_fold, small_batches,
                                 strings, table)

MEASURES = ("mean word length", "upper case of letters", "letters", "digits", "symbols", "exclamations", "full stops",
            "commas", "line ends", "word equals the one before", "distinct words", "repeated word triples",
            "letters beyond ASCII", "one-character words", "words")

SPACE = " \t\n\x0b\x0c\r"
#: Code points of texts in one numpy pass.
BLOCK_CHARS = 100_000


@dataclass(frozen=True)
class Settings:
    passage_words: int = 64
    hidden: int = 16
    attention: int = 12
    #: The bounded sample: texts of each class and code points of a text.
    rows_per_class: int = 1200
    max_chars: int = 20_000
    epochs: int = 250
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 5
    #: Score from which a text counts as good.
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    settings: Settings


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Bit set of each code point: space, letter, upper case, digit, symbol,
    exclamation, full stop, comma; beyond-ASCII letters follow from the code."""
    fold = letter_fold()
    kind = (fold > 0).astype(np.uint8) << 1
    kind |= ((fold > 0) & (fold != np.arange(len(fold)))).astype(np.uint8) << 2
    for bit, chars in ((0, SPACE), (3, "0123456789"), (4, "#*$%&|<>"), (5, "!?"), (6, "."), (7, ",")):
        kind[[ord(c) for c in chars]] |= 1 << bit
    return kind


@dataclass
class Words:
    """The words of some texts: code points and their kinds; start, end, text
    and hash of each word; whether it equals the one before, and whether the
    triple that it starts has been there before; the triples."""

    codes: np.ndarray
    kind: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hashed: np.ndarray
    same: np.ndarray
    again: np.ndarray
    triple: np.ndarray

    def own(self, lead: int, own: int) -> Words:
        """Some of the words alone."""
        at = slice(lead, lead + own)
        return Words(self.codes, self.kind, *(x[at] for x in (self.start, self.end, self.text, self.hashed, self.same,
                                                              self.again, self.triple)))


def _words(texts: list[str], seen: np.ndarray | None = None) -> Words:
    """`seen`: sorted triples that were in the text before, if it is a piece of one."""
    codes, row = code_points(texts)
    kind = _kinds()[codes]
    edge = np.diff(np.concatenate(([False], (kind & 1) == 0, [False])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text = row[start]
    hashed = _word_hashes(codes, start, end)
    same = np.zeros(len(text), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (text[1:] == text[:-1])
    again, triple = np.zeros(len(text), bool), np.empty(0, np.uint64)
    if len(text) > 2:
        triple = hashed[:-2] * np.uint64(3) + hashed[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashed[2:] * np.uint64(0x165667B19E3779F9)
        inside = text[:-2] == text[2:]
        triple = triple ^ (text[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, new = np.unique(triple, return_index=True)
        again[:-2] = inside
        again[new] = False if seen is None else np.isin(triple[new], seen)
    return Words(codes, kind, start, end, text, hashed, same, again, triple)


def passages(texts: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The measures of every passage and the text it belongs to (ascending)."""
    return _measured(_words(texts), len(texts), s)


def long_passages(text: str, s: Settings) -> Iterator[np.ndarray]:
    """The passages of one text, piece by piece; they are those of the whole:
    a piece has whole passages, and the words beside them that they look at."""
    space = np.zeros(0x110000, bool)
    space[[ord(c) for c in SPACE]] = True
    seen = np.empty(0, np.uint64)
    for piece, lead, own in cut_at_words(text, BLOCK_CHARS, ~space, s.passage_words, before=1, after=2):
        words = _words([piece], seen).own(lead, own)
        seen = np.union1d(seen, words.triple)
        yield _measured(words, 1, s)[0]


def _measured(w_: Words, n_texts: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    codes, kind, start, end, text, hashed, same, again = (
        w_.codes, w_.kind, w_.start, w_.end, w_.text, w_.hashed, w_.same, w_.again)
    first = np.searchsorted(text, np.arange(n_texts))
    n_words = np.diff(np.concatenate((first, [len(text)])))
    place = np.arange(len(text)) - first[text]
    # passages: runs of words of one text; a text without words has one too
    n_pass = np.maximum(1, -(-n_words // s.passage_words))
    base = np.cumsum(n_pass) - n_pass
    owner = np.repeat(np.arange(n_texts), n_pass)
    home = base[text] + place // s.passage_words
    total = len(owner)

    def chars(mask: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(mask)))
        return np.bincount(home, upto[end] - upto[start], total)

    length = end - start
    words = np.bincount(home, minlength=total).astype(float)
    size = np.bincount(home, length, total)
    letters = chars((kind & 2) > 0)
    _, at = np.unique(hashed ^ (home.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    distinct = np.bincount(home[at], minlength=total)
    line_end = np.zeros(len(codes) + 1, bool)
    line_end[:-1] = codes == 10
    breaks = np.bincount(home, line_end[end], total)
    w, c, lt = np.maximum(words, 1), np.maximum(size, 1), np.maximum(letters, 1)
    x = np.stack([
        size / w / 10, chars((kind & 4) > 0) / lt, letters / c, chars((kind & 8) > 0) / c, chars((kind & 16) > 0) / c,
        chars((kind & 32) > 0) / c, chars((kind & 64) > 0) / w, chars((kind & 128) > 0) / w, breaks / w,
        np.bincount(home, same, total) / w, distinct / w, np.bincount(home, again, total) / w,
        chars(((kind & 2) > 0) & (codes > 127)) / lt, np.bincount(home, length == 1, total) / w, np.log1p(words) / 4], axis=1)
    return x.astype(np.float32), owner


def _word_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word: the sum of its characters' hashes by place."""
    size = end - start
    word = np.repeat(np.arange(len(start)), size)
    ends = np.cumsum(size)
    place = np.arange(ends[-1] if len(ends) else 0) - (ends - size)[word]
    mixed = (codes[np.repeat(start, size) + place].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(0xBF58476D1CE4E5B9))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed ^ (mixed >> np.uint64(32)), dtype=np.uint64)))
    return total[ends] - total[ends - size]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def encode(x: np.ndarray, m: dict[str, np.ndarray]):
    """Passage representations, the two halves of the gate, and the attention's log."""
    h = np.tanh(x @ m["A"] + m["a"])
    t, g = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    return h, t, g, (t * g) @ m["w"]


def fit(x: np.ndarray, owner: np.ndarray, y: np.ndarray, s: Settings) -> Model | None:
    """x: passages of all texts, owner: the text of each (ascending), y: labels."""
    if len(set(y.tolist())) < 2:
        return None
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = np.clip((x - centre) / scale, -8, 8)
    rng = np.random.default_rng(s.seed)
    k, d = s.hidden, s.attention
    m = {"A": rng.normal(0, 0.3, (x.shape[1], k)), "a": np.zeros(k), "V": rng.normal(0, 0.3, (k, d)),
         "U": rng.normal(0, 0.3, (k, d)), "w": rng.normal(0, 0.3, d), "c": rng.normal(0, 0.3, k), "b": np.zeros(1)}
    state = {n: [np.zeros_like(p), np.zeros_like(p)] for n, p in m.items()}
    first = np.searchsorted(owner, np.arange(len(y)))
    for step in range(1, s.epochs + 1):
        h, t, g, e = encode(x, m)
        e = np.exp(e - np.maximum.reduceat(e, first)[owner])
        alpha = e / np.add.reduceat(e, first)[owner]
        z = np.add.reduceat(alpha[:, None] * h, first)
        p = _sigmoid(z @ m["c"] + m["b"])
        out = (p - y) / len(y)
        dz = out[:, None] * m["c"]
        da = (h * dz[owner]).sum(axis=1)
        de = alpha * (da - np.add.reduceat(alpha * da, first)[owner])
        dt, dg = de[:, None] * m["w"] * g * (1 - t * t), de[:, None] * m["w"] * t * g * (1 - g)
        dh = (alpha[:, None] * dz[owner] + dt @ m["V"].T + dg @ m["U"].T) * (1 - h * h)
        grad = {"A": x.T @ dh, "a": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de,
                "c": z.T @ out, "b": np.array([out.sum()])}
        for n, p_ in m.items():
            got = grad[n] + s.decay * p_
            u, v = state[n]
            u[:] = 0.9 * u + 0.1 * got
            v[:] = 0.999 * v + 0.001 * got * got
            p_ -= s.rate * (u / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(centre, scale, m, s)


def score_texts(texts: Iterable[str | None], n: int, model: Model) -> np.ndarray:
    """Sums of exp(attention) and of representations under it, per text."""
    m, s = model.weights, model.settings
    weight, rep = np.zeros(n), np.zeros((n, s.hidden))
    for start, parts in blocks(texts, BLOCK_CHARS):
        long = len(parts[0]) > BLOCK_CHARS
        for x, owner in ((p, np.zeros(len(p), np.int64)) for p in long_passages(parts[0], s)) if long else [passages(parts, s)]:
            h, _, _, e = encode(np.clip((x - model.centre) / model.scale, -8, 8), m)
            e = np.exp(e)  # bounded: |e| is at most the sum of |w|
            np.add.at(weight, start + owner, e)
            np.add.at(rep, start + owner, e[:, None] * h)
    return _sigmoid((rep / np.maximum(weight, 1e-300)[:, None]) @ m["c"] + m["b"])


def learn(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model | None:
    """From labelled documents whose id's crc32 mod 5 is not 0."""
    learns = id_remainder(F.col("_id"), 5, 0) != 0
    got = labelled_sample(docs, labels, "quality", learns, s.rows_per_class, s.max_chars).collect()
    if not got:
        return None
    x, owner = zip(*((p, o + start) for start, parts in blocks([r["text"] for r in got], BLOCK_CHARS)
                     for p, o in [passages(parts, s)]), strict=True)
    return fit(np.concatenate(x), np.concatenate(owner), np.array([r["y"] for r in got]), s)


def quality(spark: SparkSession, df: DataFrame, model: Model | None, text: str = "text",
            out: str = "quality") -> DataFrame:
    """`df` with the score of `text` in the double column `out`."""
    if model is None:
        return df.withColumn(out, F.lit(1.0))
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a few thousand weights

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(score_texts(strings(texts), len(texts), shared.value))

    return df.withColumn(out, judge.asNondeterministic()(F.col(text)))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return quality(spark, docs, model, out="score").select(
        "doc_id", (id_remainder(F.col("doc_id"), 5, 0) == 0).alias("held_out"), "score",
        (F.col("score") >= Settings.threshold).cast("int").alias("predicted"))
