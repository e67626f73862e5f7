"""Toxicity from subword-bag embeddings.

A bag is `window` words; its features are the words' letter n-grams (3 to 5
letters, lower-cased, with word borders) and the words themselves, hashed into
`buckets`.  Feature embeddings are averaged over the bag and go into a linear
softmax with two classes; embeddings and softmax are trained jointly (Adam, in
numpy) on a bounded sample of labelled texts.  Unseen misspellings share most
n-grams with the word, so they share its vector.  Labels belong to texts, so
training first takes every bag of a toxic text as toxic, then only its worst.
A text's score is that of its worst bag: a text stays toxic however long the
clean rest is.  Long texts are scored in pieces that share `window` - 1 words,
so that their bags are those of the whole.

With two classes the softmax of an average is a sigmoid of the average of one
number per feature (embedding times difference of the class weights), so
scoring looks up that number only.

Defined cases: null and empty texts, and texts without a letter, are one empty
bag, whose score is the softmax of the bias.  Without toxic and clean labels
every score is 0.  Rows are judged one by one; other columns stay.
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

#: Code points of texts in one numpy pass.
BLOCK_CHARS = 100_000


@dataclass(frozen=True)
class Settings:
    window: int = 4
    sizes: tuple[int, ...] = (3, 4, 5)
    bucket_bits: int = 18
    dims: int = 8
    #: The bounded sample: texts of each class and code points of a text.
    rows_per_class: int = 1000
    max_chars: int = 6000
    warm_epochs: int = 3
    epochs: int = 9
    rate: float = 0.05
    dropout: float = 0.4
    seed: int = 7
    #: Score at which a text counts as toxic.
    threshold: float = 0.7


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # one number per bucket: embedding . (toxic - clean weights)
    bias: float
    settings: Settings


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Letters lower-cased; digits written for letters count as those letters."""
    fold = letter_fold().copy()
    for digit, letter in zip("013457", "oieast", strict=True):
        fold[ord(digit)] = ord(letter)
    return fold


def features(texts: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, word) of every feature, in order of words, and each word's text."""
    codes, row = code_points(texts)
    c = np.concatenate(([0], _fold()[codes], np.zeros(max(s.sizes), np.uint32))).astype(np.uint32)
    letter = c > 0
    starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    word_at = np.cumsum(np.concatenate(([False], letter[1:] & ~letter[:-1]))) - 1
    n = len(codes)
    bucket, word = [], []
    run = letter[1:n + 1]  # does the position after the first one continue a word
    h = c[:n] * np.uint32(2654435761)
    for size in range(2, max(s.sizes) + 1):
        h = (h ^ (h >> np.uint32(13))) * np.uint32(2246822519) + c[size - 1:n + size - 1]
        if size > 2:
            run = run & letter[size - 2:n + size - 2]
        if size in s.sizes:
            at = np.flatnonzero(run)
            g = h[at] * np.uint32(3266489917) + np.uint32(size * 668265263 & 0xFFFFFFFF)
            bucket.append((g ^ (g >> np.uint32(16))) * np.uint32(2654435761) >> np.uint32(32 - s.bucket_bits))
            word.append(word_at[at + 1])
    # a word is the sum of its letters' hashes by place
    place = np.arange(len(c)) - np.maximum.accumulate(np.where(np.concatenate(([True], ~letter[:-1])), np.arange(len(c)), 0))
    mixed = (c + np.uint32(1)) * (place.astype(np.uint32) * np.uint32(2) + np.uint32(1)) * np.uint32(2654435761)
    mixed = np.where(letter, mixed ^ (mixed >> np.uint32(15)), 0).astype(np.uint32)
    total = np.concatenate((np.zeros(1, np.uint32), np.cumsum(mixed, dtype=np.uint32)))
    whole = (total[ends] - total[starts]) * np.uint32(2246822519)
    bucket.append((whole ^ (whole >> np.uint32(14))) * np.uint32(2654435761) >> np.uint32(32 - s.bucket_bits))
    word.append(np.arange(len(starts)))
    return np.concatenate(bucket).astype(np.int64), np.concatenate(word), row[starts - 1]


def fit(texts: list[str], y: np.ndarray, s: Settings) -> Model | None:
    """Joint training on whole texts with labels 0 and 1."""
    if len(texts) == 0 or len(set(y.tolist())) < 2:
        return None
    found, n_words = [], 0
    for start, parts in blocks(texts, BLOCK_CHARS):
        b, v, t = features(parts, s)
        order = np.argsort(v, kind="stable")
        found.append((b[order].astype(np.int32), (v[order] + n_words).astype(np.int32), t + start))
        n_words += len(t)
    bucket, word, text = (np.concatenate(x) for x in zip(*found, strict=True))
    del found
    # training bags do not overlap: each text's words in runs of `window`
    first = np.searchsorted(text, np.arange(len(texts)))
    place = np.arange(len(text)) - first[text]
    head = (place % s.window) == 0
    bag_of_word = np.cumsum(head) - 1
    bag_text = text[head]
    edge = np.searchsorted(bag_of_word[word], np.arange(len(bag_text) + 1))
    del word
    size = np.diff(edge)
    rng = np.random.default_rng(s.seed)
    e = rng.normal(0, 0.1, (1 << s.bucket_bits, s.dims)).astype(np.float32)
    w = rng.normal(0, 0.1, (2, s.dims)).astype(np.float32)
    b = np.zeros(2, np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (e, w, b)]
    step = 0

    def scores(bags: np.ndarray, z: np.ndarray, drop: float = 0.0):
        """Log-odds of `bags`, their features, the bag each belongs to and how
        many a bag has; a share of `drop` is left out, so that no feature
        carries a word alone."""
        many = size[bags]
        ends = np.cumsum(many)
        at = np.repeat(edge[bags] - (ends - many), many) + np.arange(many.sum())
        own = np.repeat(np.arange(len(bags)), many)
        if drop:
            left = rng.random(len(at)) >= drop
            at, own = at[left], own[left]
            many = np.maximum(np.bincount(own, minlength=len(bags)), 1)
        f = bucket[at]
        return np.bincount(own, z[f], len(bags)) / many + (b[1] - b[0]), f, own, many

    for epoch in range(s.warm_epochs + s.epochs):
        used = np.arange(len(bag_text))
        if epoch >= s.warm_epochs:  # of a toxic text only the worst bag is toxic
            z = (e @ (w[1] - w[0])).astype(np.float64)
            odds = np.concatenate([scores(part, z)[0] for part in np.array_split(used, max(1, len(used) // 8192))])
            worst = np.lexsort((-odds, bag_text))
            worst = worst[np.concatenate(([True], np.diff(bag_text[worst]) != 0))]
            toxic = worst[y[bag_text[worst]] == 1]
            clean = used[y[bag_text] == 0]
            used = np.concatenate((np.repeat(toxic, max(1, len(clean) // (4 * max(1, len(toxic))))), clean))
        for part in np.array_split(rng.permutation(used), max(1, len(used) // 8192)):
            d = w[1] - w[0]
            z = (e @ d).astype(np.float64)
            odds, f, own, many = scores(part, z, s.dropout)
            g = (1 / (1 + np.exp(-odds)) - y[bag_text[part]]) / len(part)
            # both class weights get the gradient with opposite signs
            per = np.bincount(f, (g / many)[own], len(e)).astype(np.float32)
            hit = np.flatnonzero(per)
            mean = per[hit] @ e[hit]
            step += 1
            _adam(e, state[0], per[hit, None] * d, step, s.rate, hit)
            _adam(w, state[1], np.stack((-mean, mean)), step, s.rate)
            _adam(b, state[2], np.array([-g.sum(), g.sum()], np.float32), step, s.rate)
    return Model((e @ (w[1] - w[0])).astype(np.float32), float(b[1] - b[0]), s)


def _adam(p, state, grad, step, rate, rows=slice(None)) -> None:
    m, v = state
    m[rows] = 0.9 * m[rows] + 0.1 * grad
    v[rows] = 0.99 * v[rows] + 0.01 * grad * grad
    p[rows] -= rate * (m[rows] / (1 - 0.9 ** step)) / (np.sqrt(v[rows] / (1 - 0.99 ** step)) + 1e-8)


def worst_bags(texts: list[str], m: Model) -> np.ndarray:
    """The log-odds of each text's worst bag of `window` neighbouring words."""
    s = m.settings
    bucket, word, text = features(texts, s)
    out = np.full(len(texts), -np.inf)
    if not len(text):
        return out
    total = np.concatenate(([0.0], np.cumsum(np.bincount(word, m.weight[bucket], len(text)))))
    many = np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(text)))))
    first = np.searchsorted(text, np.arange(len(texts)))
    last = np.searchsorted(text, np.arange(len(texts)), side="right")
    at = np.arange(len(text))
    start = np.maximum(np.minimum(at, last[text] - s.window), first[text])
    end = np.minimum(start + s.window, last[text])
    odds = (total[end] - total[start]) / (many[end] - many[start]) + m.bias
    np.maximum.at(out, text, odds)
    return out


def score_texts(texts: Iterable[str | None], n: int, m: Model) -> np.ndarray:
    odds = np.full(n, -np.inf)
    for start, parts in blocks(texts, BLOCK_CHARS):
        if len(parts[0]) > BLOCK_CHARS:  # every bag lies in one of its pieces
            pieces = cut_at_words(parts[0], BLOCK_CHARS, _fold() > 0, before=m.settings.window - 1)
            odds[start] = max(worst_bags([piece], m)[0] for piece, _, _ in pieces)
        else:
            odds[start:start + len(parts)] = worst_bags(parts, m)
    odds = np.where(np.isneginf(odds), m.bias, odds)
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def learn(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model | None:
    """From labelled documents whose id's crc32 mod 3 is not 1."""
    learns = id_remainder(F.col("_id"), 3, 1) != 1
    got = labelled_sample(docs, labels, "toxic", learns, s.rows_per_class, s.max_chars).collect()
    return fit([r["text"] for r in got], np.array([r["y"] for r in got], np.int64), s)


def toxicity(spark: SparkSession, df: DataFrame, model: Model | None, text: str = "text",
             out: str = "toxicity") -> DataFrame:
    """`df` with the score of `text` in the double column `out`."""
    if model is None:
        return df.withColumn(out, F.lit(0.0))
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # 2^bucket_bits floats: 1 MB

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(score_texts(strings(texts), len(texts), shared.value))

    return df.withColumn(out, judge.asNondeterministic()(F.col(text)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    return toxicity(spark, docs, model, out="score").select(
        "doc_id", (id_remainder(F.col("doc_id"), 3, 1) == 1).alias("held_out"), "score",
        (F.col("score") >= Settings.threshold).cast("int").alias("predicted"))
