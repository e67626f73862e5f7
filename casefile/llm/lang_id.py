"""Language ID by nearest centroid.

A text's vector holds TF-IDF weights of letter n-grams (one to three letters,
lower-cased, word borders included), hashed into `dims` buckets and brought to
length one.  Document frequencies come from every learning row.  On a bounded
sample of them each language's vectors are clustered into several centroids
(spherical k-means), and a text gets the language of the centroid with the
largest cosine.

A text is rejected if it is farther from its centroid than all but a share of
`false_reject` of the learning rows of about its length are: the distances of
every learning row are counted by length (the number of letters, in powers of
two), since a short text's cosine is small in any language.  Short texts are
rare, so a beginning of each row, of a length that varies with the row's, is
counted as well, in a table of its own; neither table may lose more than that
share.  With fewer rows in both than the share can be told from, the least
cosine seen is lowered in proportion, or that of the length below it taken.

Long texts are counted in pieces that know the letters beside them, so that
their n-grams are those of the whole.

Defined cases: a text that is null or has no letter is `und` with score 0 and
rejected.  Without learning rows every text is.  Equal cosines go to the
language that sorts first.  Rows are judged one by one, so repeated rows get
equal results; other columns of the input are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casefile.llm.common import blocks, code_points, id_remainder, letter_fold, small_batches, strings, table

UNKNOWN = "und"

#: Code points of texts in one numpy pass: what fits a core's cache.
BLOCK_CHARS = 100_000
#: Lengths (powers of two) and parts of the cosine that distances are counted in.
LENGTHS, BINS = 16, 500


@dataclass(frozen=True)
class Settings:
    dims: int = 4096
    #: The sample the clusters are fitted on: so many learning rows, an equal
    #: part for each language.
    sample: int = 2400
    centroids: int = 4
    rounds: int = 8
    #: The share of the learning rows of each length that may be rejected.
    false_reject: float = 0.005


@dataclass(frozen=True)
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (langs * centroids, dims)
    owner: np.ndarray  # index into langs of each centroid
    least: np.ndarray  # the least cosine that is not rejected, by length


def ngram_counts(texts: Iterable[str | None], dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts): matrices of rows x dims, few rows at a time."""
    fold = letter_fold()
    for start, parts in blocks(texts, BLOCK_CHARS):
        if len(parts[0]) > BLOCK_CHARS:
            yield start, _long_counts(parts[0], fold, dims)
            continue
        for at in range(0, len(parts), 64):
            codes, row = code_points(parts[at:at + 64])
            yield start + at, _counts(np.concatenate(([0], fold[codes], [0])), row, len(parts[at:at + 64]), dims)


def _long_counts(text: str, fold: np.ndarray, dims: int) -> np.ndarray:
    """One text's counts, piece by piece, each with the character before and after."""
    out = np.zeros((1, dims), np.float32)
    for at in range(0, len(text), BLOCK_CHARS):
        piece = text[max(at - 1, 0):at + BLOCK_CHARS + 1]
        codes = fold[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        codes = np.concatenate(([0][:at == 0], codes, [0][:at + BLOCK_CHARS >= len(text)]))
        out += _counts(codes, np.zeros(len(codes) - 2, np.int64), 1, dims)
    return out


def _counts(c: np.ndarray, row: np.ndarray, rows: int, dims: int) -> np.ndarray:
    """n-grams around the letters of c, without its first and last place."""
    c = c.astype(np.uint32)
    mid, left, right = c[1:-1], c[:-2], c[2:]
    here = np.flatnonzero(mid)
    m, base = mid[here], row[here] * dims
    shift = np.uint32(32 - dims.bit_length() + 1)
    one = m * np.uint32(2654435761)
    two = one + right[here] * np.uint32(2246822519) + np.uint32(374761393)
    three = two + left[here] * np.uint32(3266489917) + np.uint32(668265263)
    h = np.concatenate((one, two, three))
    h ^= h >> np.uint32(15)
    h *= np.uint32(2654435761)
    h >>= shift
    counts = np.bincount(np.tile(base, 3) + h, minlength=rows * dims)
    return counts.astype(np.float32).reshape(rows, dims)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(counts) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def lengths(counts: np.ndarray) -> np.ndarray:
    """The power of two of each row's letters; a letter has three n-grams."""
    letters = np.maximum(counts.sum(axis=1) / 3, 1)
    return np.minimum(np.floor(np.log2(letters)).astype(np.int64), LENGTHS - 1)


def nearest(counts: np.ndarray, idf: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's centroid and the cosine with it."""
    cos = vectors(counts, idf) @ centroids.T
    pick = cos.argmax(axis=1)
    return pick, np.clip(cos[np.arange(len(cos)), pick], 0.0, 1.0)


def beginning(text: str) -> str:
    """The text up to the last blank before a length that depends on its own;
    empty without one."""
    powers = len(text).bit_length() - 4  # from 16 code points on
    if powers < 1:
        return ""
    size = 16 << len(text) % powers
    return text[:text.rfind(" ", 0, size) + 1]


def thresholds(tally: np.ndarray, false_reject: float) -> np.ndarray:
    """tally: rows by table, length and part of the cosine -> the least cosine
    of each length that is not rejected."""
    out = np.zeros(LENGTHS)
    for k in range(LENGTHS):
        least = []
        for rows in tally[:, k]:
            if rows.sum():
                below = np.cumsum(rows) - rows
                least.append(np.flatnonzero(below <= rows.sum() * false_reject).max() / BINS)
        enough = min(1.0, tally[:, k].sum() * false_reject)
        out[k] = min(least, default=0.0) * enough
        if enough < 1 and k:  # a longer text is no farther from its centroid
            out[k] = max(out[k], min([out[k - 1], *least]))
    return out


def learn(rows: DataFrame, settings: Settings = Settings()) -> Model | None:
    """`rows`: (text, lang, key); key only orders the sample."""
    s = settings
    small_batches(rows.sparkSession)
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(s.dims, np.int64), 0
        for b in batches:
            for _, counts in ngram_counts(strings(b.column(0)), s.dims):
                seen += (counts > 0).sum(axis=0)
                n += len(counts)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int32()), pa.array([n, *seen[at]], pa.int64())],
                                         names=["bucket", "n"])

    got = (rows.select("text").mapInArrow(frequencies, "bucket int, n long")
           .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # dims + 1 rows at most
    df = {r["bucket"]: r["n"] for r in got}
    total = df.pop(-1, 0)
    if not total:
        return None
    idf = np.full(s.dims, np.log(1.0 + total), np.float32)
    for bucket, n in df.items():
        idf[bucket] = np.log((1.0 + total) / (1.0 + n)) + 0.05

    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    each = max(2 * s.centroids, s.sample // len(counts))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, c in ngram_counts(strings(b.column(0)), s.dims):
                v = vectors(c, idf).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(start, len(v)), b.column(2).slice(start, len(v)),
                     pa.array([x.tobytes() for x in v], pa.binary())], names=["lang", "h", "v"])

    # about twice the wanted rows of each language pass the hash limit; vectors,
    # not texts, meet in the windows that take the first of them
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2.0 * each / n + 1e-7))])
    h = F.pmod(F.xxhash64("key"), F.lit(1 << 30))
    near = (rows.select("text", "lang", h.alias("h")).filter(F.col("h") <= share[F.col("lang")] * (1 << 30))
            .mapInArrow(encode, "lang string, h long, v binary"))
    order = Window.partitionBy("lang").orderBy("h", "v")
    got = near.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= each).select("lang", "v").collect()
    vector_of: dict[str, list] = {}
    for r in got:
        vector_of.setdefault(r["lang"], []).append(np.frombuffer(r["v"], np.float16))

    centres, owner = [], []
    langs = sorted(counts)
    for k, lang in enumerate(langs):
        x = np.array(sorted(vector_of.get(lang, []), key=bytes), np.float32).reshape(-1, s.dims)
        x = x[np.linalg.norm(x, axis=1) > 0]
        if not len(x):
            continue
        c = cluster(x, s.centroids, s.rounds)
        centres.append(c)
        owner += [k] * len(c)
    if not centres:
        return None
    centres = np.concatenate(centres)

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(2 * LENGTHS * BINS, np.int64)
        for b in batches:
            for which, texts in enumerate((strings(b.column(0)), map(beginning, strings(b.column(0))))):
                for _, c in ngram_counts(texts, s.dims):
                    c = c[c.any(axis=1)]
                    part = np.minimum(nearest(c, idf, centres)[1] * BINS, BINS - 1).astype(np.int64)
                    seen += np.bincount((which * LENGTHS + lengths(c)) * BINS + part, minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], names=["cell", "n"])

    tally = np.zeros(2 * LENGTHS * BINS, np.int64)
    for r in (rows.select("text").mapInArrow(tallied, "cell int, n long")
              .groupBy("cell").agg(F.sum("n").alias("n")).collect()):  # 2 * LENGTHS * BINS rows at most
        tally[r["cell"]] = r["n"]
    return Model(langs, idf, centres, np.array(owner), thresholds(tally.reshape(2, LENGTHS, BINS), s.false_reject))


def cluster(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means from farthest-point seeds."""
    mean = x.mean(axis=0)
    seeds = [int((x @ mean).argmax())]
    while len(seeds) < min(k, len(x)):
        near = (x @ x[seeds].T).max(axis=1)
        if near.min() > 0.999:
            break
        seeds.append(int(near.argmin()))
    c = x[seeds]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = np.array([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def identify(spark: SparkSession, df: DataFrame, model: Model | None, text: str = "text",
             out: str = "lang_id") -> DataFrame:
    """`df` with a struct column `out` (lang, score, rejected)."""
    kind = "struct<lang:string,score:double,rejected:boolean>"
    if model is None:
        unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
        return df.withColumn(out, unknown)
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # dims x centroids floats

    @F.arrow_udf(kind)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        dims = len(m.idf)
        for texts in batches:
            n = len(texts)
            best, sim, least = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            any_letter = np.zeros(n, bool)
            for start, counts in ngram_counts(strings(texts), dims):
                at = slice(start, start + len(counts))
                pick, sim[at] = nearest(counts, m.idf, m.centroids)
                best[at], least[at], any_letter[at] = m.owner[pick], m.least[lengths(counts)], counts.any(axis=1)
            sim = np.where(any_letter, sim, 0.0)
            lang = [m.langs[b] if ok else UNKNOWN for b, ok in zip(best, any_letter, strict=True)]
            gone = ~any_letter | (sim < least)
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(sim, pa.float64()), pa.array(gone)],
                                             names=["lang", "score", "rejected"])

    return df.withColumn(out, judge.asNondeterministic()(F.col(text)))


def learning_rows(docs: DataFrame) -> DataFrame:
    """Documents whose id's crc32 mod 3 is not 1; one without id never counts."""
    return docs.filter(id_remainder(F.col("doc_id"), 3, 1) != 1).select("text", "lang", F.col("doc_id").alias("key"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(learning_rows(docs))
    return identify(spark, docs.select("doc_id", "text"), model).select(
        "doc_id", (id_remainder(F.col("doc_id"), 3, 1) == 1).alias("held_out"),
        F.col("lang_id.lang").alias("lang_pred"), F.col("lang_id.score").alias("score"),
        F.col("lang_id.rejected").alias("rejected"))
