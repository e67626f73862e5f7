"""The corpus pipeline over `documents`.

Each stage takes the documents that its predecessor kept and calls one
operator of casefile.llm; all but the last give documents back with the same
columns.  Null and empty texts have no language and go in the first stage; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm import lang_id, phrase_index, sentencepiece_codec, simhash_dedup, weak_pii
from casefile.llm.common import fresh_names, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected."""
    out, = fresh_names(docs, "lang_id")
    judged = lang_id.identify(spark, docs, lang_id.learn(lang_id.learning_rows(docs)), out=out)
    return judged.filter(~F.col(out)["rejected"]).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    return simhash_dedup.one_of_each(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return phrase_index.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows."""
    spans, = fresh_names(docs, "spans")
    marked = weak_pii.personal_data(spark, docs, weak_pii.learn(docs), out=spans)
    out = weak_pii.redact(marked, spans=spans)
    if "n_chars" in docs.columns:
        changed = F.size(spans) > 0
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their ids, and whether decoding gives the text back."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    out, = fresh_names(docs, "coded")
    coded = sentencepiece_codec.encode_decode(spark, docs, path, out=out)
    ids = F.col(out)["ids"]
    return coded.select(*[c for c in docs.columns if c not in ("ids", "n_tokens", "lossless")], ids.alias("ids"),
                        F.size(ids).cast("long").alias("n_tokens"),
                        (F.col(out)["decoded"] == F.coalesce("text", F.lit(""))).alias("lossless"))


STAGES = [("language_id", language), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("personal_data", personal_data), ("tokens", tokens)]
#: Language ID, fingerprints and tokens are beyond SQL; the tests hold run()
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
