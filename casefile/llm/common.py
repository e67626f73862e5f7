"""What the operators of this package share: narrow reads, learning splits,
bounded samples, written intermediate tables and blocks of texts for numpy."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.session import work_path

#: Code points handled by one numpy pass; bounds a task's memory for any text.
BLOCK_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of a few MB, whatever their lengths; an
    executor may run many Python workers beside its heap.  Sets this option of
    the session, which keeps it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def id_remainder(col: Column, m: int, null: int) -> Column:
    """crc32 of the id's decimal text, mod m; `null` for a row without id."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % m, F.lit(null))


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Names for further columns that `df` has none of, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: cuts lineage, survives lost
    executors, and gives the planner its real size."""
    path = work_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, key: str | list[str], rows: int, count: int | None = None) -> DataFrame:
    """At most `rows` rows of `df`, those with the smallest hash of `key`.

    Only rows below a hash limit (about twice the wanted share) reach the
    final top-k, so the merge stays small however many partitions there are.
    """
    n = df.count() if count is None else count
    key = [key] if isinstance(key, str) else key
    h = F.pmod(F.xxhash64(*key, F.lit(11)), F.lit(1 << 30))
    if n > 2 * rows:
        df = df.filter(h < int((1 << 30) * min(1.0, 2.0 * rows / n)))
    return df.orderBy(h, *key).limit(rows)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learns: Column, rows_per_class: int,
                    max_chars: int) -> DataFrame:
    """(text, y) of at most `rows_per_class` labelled documents of each class
    and `max_chars` code points each: the bounded sample a classifier is
    fitted on.  Only documents within that length are chosen from.  A document
    labelled more than once counts with its largest label; rows without id,
    text or label are not learned from."""
    ids = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
           .filter(F.col("_id").isNotNull() & F.col("y").isin(0, 1)).filter(learns))
    fits = F.col("text").isNotNull() & (F.length("text") <= max_chars)
    short = docs.filter(F.col("doc_id").isNotNull() & fits).select(F.col("doc_id").alias("_id")).distinct()
    ids = written(docs.sparkSession, ids.groupBy("_id").agg(F.max("y").alias("y")).join(short, "_id", "left_semi"), "labelled")
    counts = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    picked = [hash_sample(ids.filter(F.col("y") == y), "_id", rows_per_class, counts[y]) for y in sorted(counts)]
    if not picked:
        return docs.select("text", F.lit(0).alias("y")).limit(0)
    chosen = picked[0] if len(picked) == 1 else picked[0].unionAll(picked[1])
    # 2 * rows_per_class rows of (long, int) at most: a proven bound
    return (docs.select(F.col("doc_id").alias("_id"), "text")
            .filter(fits)
            .join(F.broadcast(chosen), "_id").orderBy(F.xxhash64("_id"), "text")
            .limit(2 * rows_per_class).select("text", "y"))


def strings(texts: pa.Array) -> Iterator[str | None]:
    """A batch's texts as Python strings, few at a time."""
    for at in range(0, len(texts), 256):
        yield from texts.slice(at, 256).to_pylist()


def blocks(texts: Iterable[str | None], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts): runs of whole texts of about `limit` code points
    together; a longer text is a run of its own, null counts as empty."""
    start, size, run = 0, 0, []
    for i, t in enumerate(texts):
        t = t or ""
        if run and size + len(t) > limit:
            yield start, run
            start, size, run = i, 0, []
        run.append(t)
        size += len(t) + 1
    if run:
        yield start, run


def cut_at_words(text: str, limit: int, is_word: np.ndarray, step: int = 1, before: int = 0,
                 after: int = 0) -> Iterator[tuple[str, int, int]]:
    """(piece, lead, own): a long text as pieces of about `limit` code points
    that can be handled one by one with the result of the whole.

    Words are runs of code points marked in `is_word`; pieces are cut between
    words only.  Each word is some piece's own, a multiple of `step` of them in
    all pieces but the last; `lead` words of context stand before a piece's own
    ones (`before` of them, or all there are) and at least `after` follow them,
    up to the text's end.  A piece has more than `before` own words, so it grows
    with a text's longest words, whatever the limit.
    """
    at, lead, size, first = 0, 0, limit, True
    while True:
        stop = at + size
        while stop < len(text):  # to the end of the word that goes on there
            inside = is_word[_codes(text[stop:stop + 4096])]
            if not inside.all():
                stop += int(inside.argmin())
                break
            stop += len(inside)
        last = stop >= len(text)
        piece = text[at:stop]
        starts = np.flatnonzero(np.diff(np.concatenate(([False], is_word[_codes(piece)])).astype(np.int8)) == 1)
        own = len(starts) - lead
        if not last:
            own = (own - after) // step * step
            if own < max(step, before + 1):
                size *= 2
                continue
        if own or first:
            yield piece, lead, own
        if last:
            return
        next_ = lead + own
        lead, size, first = min(before, next_), limit, False
        at += int(starts[next_ - lead])


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, each text closed by a line feed, and the text's number
    of every position."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return codes, np.repeat(np.arange(len(texts), dtype=np.int64), lengths)


@lru_cache(maxsize=1)
def letter_fold() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for anything else."""
    fold = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            fold[i] = ord(low) if len(low) == 1 else i
    return fold
