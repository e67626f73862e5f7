"""The pipeline against a brute-force version of its stages."""

import sentencepiece
import public_tokenizers
from pyspark.sql import types as T

import corpus_pipeline as C
from casefile.llm import lang_id, phrase_index, weak_pii
from tests.llm.test_phrase_index import brute
from tests.llm.test_simhash import brute_components, slow_fingerprint


def test_run_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rejected = {r["doc_id"] for r in lang_id.op9_language_id(spark, sf_small).filter("rejected").collect()}
    left = {r["doc_id"]: r for r in docs.collect() if r["doc_id"] not in rejected}
    ids = list(left)
    named = brute_components(ids, [slow_fingerprint(left[i]["text"]) for i in ids])
    left = {i: left[i] for i, c in zip(ids, named, strict=True) if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {x[0] for x in brute([(i, r["text"]) for i, r in left.items()], items)}
    left = {i: r for i, r in left.items() if i not in dirty}
    want = {}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    model = weak_pii.learn(spark.createDataFrame([(r["text"],) for r in left.values()], "text string"))
    for i, r in left.items():
        text, base = r["text"], weak_pii.base_spans(r["text"])
        spans = sorted([*base, *weak_pii.added_spans(text, base, model, weak_pii.Settings())],
                       key=lambda x: (x[0], weak_pii.KINDS.index(x[1])))
        out, at = "", 0
        for a, kind, b in spans:
            out, at = (out + text[at:a] + f"<{kind}>" if a >= at else out), max(at, b)
        text = out + text[at:]
        want[i] = (text, len(text), sp.encode(text, add_eos=True))
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["ids"]) for r in C.run(spark, sf_small).collect()}
    assert got == want and 0 < len(got) < docs.count()


def test_stages_keep_columns_and_odd_rows(spark, tmp_path):
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                         T.StructField("ids", T.StringType()), T.StructField("score", T.StringType())])
    text = "the river runs past the old stone house and the garden behind it grows {} every summer day"
    rows = [(i, text.format(f"word{'abcdefghij'[i % 10]}{i} " * 9), "en", "s", 1, "x", "y") for i in range(40)]
    rows += [(None, None, None, None, None, None, None), (3, rows[3][1], "en", "s", 1, "x", "y"), (50, "", "en", "s", 0, "x", "y")]
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        docs = C.written(spark, out, name)
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    last = C.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    ids = [r["doc_id"] for r in last]
    assert len(ids) == len(set(ids)) and set(ids) <= set(range(40)) and all(r["lossless"] for r in last)
