"""SentencePiece codec against the library."""

import random

import public_tokenizers
import sentencepiece
import pytest
from pyspark.sql import types as T

from casefile.llm import sentencepiece_codec as C

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def fuzz(seed, n):
    rng = random.Random(seed)
    parts = [*" ▁\n\t\r\x00aéb.ß😀漢　\xa0ﬁ‍�", "  ", "the", "</s>", "<0x0A>", "<s>", "     ", "12345"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)]


def test_chunks_and_pieces(sp):
    table = C.ChunkTable(C._open(C._proto(PATH)), 50)  # small: emptied again and again
    surface = C._surfaces(sp)
    for text in fuzz(1, 5000):
        ids, _ = table.encode(C._words(text))
        assert ids.tolist() == sp.encode(text), text
        assert C._decode(sp, surface, [*ids.tolist(), sp.eos_id()]) == sp.decode([*ids.tolist(), sp.eos_id()])


def test_columns(spark, sp):
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())])
    texts = [None, "", *fuzz(2, 300), "word other word " * 40_000, "x" * 300_000, "same", "same"]
    docs = spark.createDataFrame([(None, t, "a", "b") for t in texts], kind)
    got = C.decode(spark, C.encode(spark, docs, PATH), PATH).collect()
    for r, t in zip(got, texts, strict=True):
        want = sp.encode(t or "", add_eos=True)
        assert r["ids"] == want and r["decoded"] == sp.decode(want)
    both = C.encode_decode(spark, docs, PATH).collect()
    assert [(r["coded"]["ids"], r["coded"]["decoded"]) for r in both] == [(r["ids"], r["decoded"]) for r in got]
    assert C.encode(spark, docs.limit(0), PATH).collect() == []
    assert [r["ids"] for r in C.encode(spark, docs.limit(2), PATH, end_id=False).collect()] == [[], []]


def test_decoding_of_any_ids(spark, sp):
    rows = spark.createDataFrame([([3 + 0xE6, 3 + 0xBC, 2],), (None,), ([],), ([259, 259],)], "ids array<int>")
    got = [r["decoded"] for r in C.decode(spark, rows, PATH).collect()]
    assert got == [sp.decode([3 + 0xE6, 3 + 0xBC, 2]), "", "", sp.decode([259, 259])]
