"""SentencePiece encoding and decoding over a distinct-chunk table.

No piece of the model crosses from a word into the next white-space marker
(checked when the model is opened), so a marked word, a run of markers with
the characters up to the next run, is segmented alike wherever it stands.
Each Python worker keeps a table of distinct marked words: a word is segmented
once, and a text's ids are the words' ids joined back by position.  The table
is not shared between workers on purpose: shuffling every word position to a
global table moves several times the input, while frequent words are met in
every task.  It is emptied at `table_words` words, so its memory is bounded.

Decoding looks up each id's bytes, joins them and drops the space that
encoding put in front; ids whose bytes are not UTF-8 go through the library.

Defined cases: null is encoded like the empty text, whose only id is the end
id; U+2581 in a text is a white-space marker and comes back as a space, as in
the library.  Rows are handled one by one; other columns are kept.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import blocks, small_batches, strings, table

MARK = "▁"
#: Distinct marked words kept by a Python worker at a time.
TABLE_WORDS = 100_000


@lru_cache(maxsize=2)
def _open(proto: bytes) -> sentencepiece.SentencePieceProcessor:
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    crossing = [p for p in map(sp.id_to_piece, range(sp.get_piece_size())) if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross white-space markers: {crossing[:5]}")
    for probe in ("", " ", "a", "  a  b ", "\n a", " a\nb"):
        if [i for ids in _segment(sp, _words(probe)) for i in ids] != sp.encode(probe):
            raise ValueError("the model's normaliser changes white space; words cannot be segmented alone")
    return sp


def _words(text: str) -> list[str]:
    """The marked words of a text, each without its first marker, as spaces."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [w[1:] for w in re.findall(" +[^ ]*", " " + text)]
    return text.split(" ")


def _segment(sp, words: list[str]) -> list[list[int]]:
    """The library puts the first marker back, but not before nothing."""
    alone = [sp.piece_to_id(MARK)]
    return [ids if w else alone for w, ids in zip(words, sp.encode(words, num_threads=1), strict=True)]


class ChunkTable:
    """Distinct marked word -> its ids, filled as words are met."""

    def __init__(self, sp, limit: int):
        self.sp, self.limit = sp, limit
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.starts, self.ids = array("q", [0]), array("i")

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of `words`, one after the other, and where each word's end."""
        if len(self.number) > self.limit:
            self._clear()
        known = self.number
        new = [w for w in dict.fromkeys(words) if w not in known]
        for w, ids in zip(new, _segment(self.sp, new), strict=True):
            known[w] = len(known)
            self.ids.extend(ids)
            self.starts.append(len(self.ids))
        numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        starts = np.frombuffer(self.starts, np.int64)
        first = starts[numbers]
        lengths = starts[numbers + 1] - first
        ends = np.cumsum(lengths)
        at = np.repeat(first - (ends - lengths), lengths) + np.arange(lengths.sum())
        return np.frombuffer(self.ids, np.int32)[at] if len(at) else np.empty(0, np.int32), ends


@lru_cache(maxsize=2)
def _table(proto: bytes, limit: int) -> ChunkTable:
    return ChunkTable(_open(proto), limit)


def _encoded(texts: pa.Array, sp, known: ChunkTable, end_id: bool) -> pa.Array:
    flat, sizes = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
    last = np.array([sp.eos_id()] if end_id else [], np.int32)
    for _, parts in blocks(strings(texts), 200_000):
        words = [_words(t) for t in parts]
        ids, ends = known.encode([w for ws in words for w in ws])
        bounds = np.concatenate(([0], ends))[np.cumsum([0, *map(len, words)])]
        flat.append(np.insert(ids, np.repeat(bounds[1:], len(last)), np.tile(last, len(parts))))
        sizes.append(np.diff(bounds) + len(last))
    return pa.ListArray.from_arrays(np.concatenate(sizes).cumsum().astype(np.int32), pa.array(np.concatenate(flat)))


def _decoded(lists: pa.Array, sp, surface: list[bytes]) -> pa.Array:
    edges, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    # one row's ids at a time as Python numbers, not a whole batch's
    return pa.array((_decode(sp, surface, flat[a:b].tolist()) for a, b in zip(edges, edges[1:], strict=False)), pa.string())


def encode(spark: SparkSession, df: DataFrame, model_path: str, text: str = "text", out: str = "ids",
           end_id: bool = True, table_words: int = TABLE_WORDS) -> DataFrame:
    """`df` with the ids of `text` in the array column `out`."""
    small_batches(spark)
    proto = spark.sparkContext.broadcast(_proto(model_path))  # one model file

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sp, known = _open(proto.value), _table(proto.value, table_words)
        for texts in batches:
            yield _encoded(texts, sp, known, end_id)

    return df.withColumn(out, to_ids.asNondeterministic()(F.col(text)))


def decode(spark: SparkSession, df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`df` with the text of the array column `ids` in `out`; null ids: empty."""
    small_batches(spark)
    proto = spark.sparkContext.broadcast(_proto(model_path))

    @F.arrow_udf("string")
    def to_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sp = _open(proto.value)
        surface = _surfaces(sp)
        for lists in batches:
            yield _decoded(lists, sp, surface)

    return df.withColumn(out, to_text.asNondeterministic()(F.col(ids)))


def encode_decode(spark: SparkSession, df: DataFrame, model_path: str, text: str = "text", out: str = "coded",
                  end_id: bool = True, table_words: int = TABLE_WORDS) -> DataFrame:
    """`df` with a struct column `out`: the ids of `text`, and what they decode
    to.  Both in one pass, so that an executor runs half the Python workers."""
    small_batches(spark)
    proto = spark.sparkContext.broadcast(_proto(model_path))

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def to_both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sp, known = _open(proto.value), _table(proto.value, table_words)
        surface = _surfaces(sp)
        for texts in batches:
            ids = _encoded(texts, sp, known, end_id)
            yield pa.StructArray.from_arrays([ids, _decoded(ids, sp, surface)], names=["ids", "decoded"])

    return df.withColumn(out, to_both.asNondeterministic()(F.col(text)))


def _surfaces(sp) -> list[bytes]:
    out = []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        out.append(b"" if sp.is_control(i) else bytes([int(p[3:5], 16)]) if sp.is_byte(i)
                   else b"\xff" if sp.is_unknown(i) else p.replace(MARK, " ").encode())
    return out


def _decode(sp, surface: list[bytes], ids: list[int] | None) -> str:
    try:
        text = b"".join(map(surface.__getitem__, ids or ())).decode()
    except UnicodeDecodeError:
        return sp.decode(ids)
    return text[1:] if text[:1] == " " else text


def _proto(model_path: str) -> bytes:
    with open(model_path, "rb") as f:
        return f.read()


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode_decode(spark, docs, path).select("doc_id", "coded.*")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
