"""URL filters: fixed rules first, gradient-boosted trees for the rest.

DataFrame functions and MLlib's JVM trees only.  A rule (host, path) fits its
host and all subdomains of URLs whose path starts with the rule's; the longest
fitting rule decides.  URLs that a rule decides are the labelled ones: boosted
trees are trained on a bounded sample of the distinct ones, each weighing as
many rows as it has, on lexical features: lengths, depth, digit ratios,
entropy, parameter counts and what the labelled URLs say about the host's
suffix.  Suffix statistics come from all URLs, in `SUFFIX_BUCKETS` hashed
buckets and FOLDS parts of the hosts, so the table broadcast with them is
bounded whatever the hosts are.  A labelled URL is described by the hosts of
the other parts alone, so its own label does not tell on it; URLs that no rule
decides count half for either verdict, so a suffix that rules judge in part is
drawn to the middle by the rest of it.

Defined cases: a null URL, or one without `://`, has an empty host and path,
meets no rule and is judged by its features.  Without labelled URLs of both
kinds the trees cannot be trained and every other URL is allowed.  Rows are
judged one by one: repeated rows get equal verdicts, other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import table, written

#: verdict, host, path (fixed values of the contract)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
SUFFIX_BUCKETS, FOLDS = 4096, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    #: The bounded sample: distinct labelled URLs the trees are trained on.
    sample: int = 20_000
    trees: int = 12
    depth: int = 3
    threshold: float = 0.5


def parts(urls: DataFrame) -> DataFrame:
    """`urls` (page_id, url) with host and path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    return urls.select("page_id", url.alias("url"),
                       F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER).alias("host"),
                       F.regexp_extract(url, pattern, 2).alias("path"))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as (name, verdict); null if none fits."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("name"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _count(text: Column, chars: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{chars}]", ""))


def _entropy(text: Column) -> Column:
    """Bits per character; each distinct character is counted by its absence."""
    n = F.greatest(F.char_length(text), F.lit(1))
    share = lambda c: (F.char_length(text) - F.char_length(F.replace(text, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")), F.lit(0.0),
                       lambda total, c: total - share(c) * F.log2(share(c)))


def suffix_bucket(host: Column) -> Column:
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -1)), F.lit(SUFFIX_BUCKETS))


FEATURES = ("url_chars", "host_chars", "path_chars", "depth", "host_labels", "digit_ratio", "host_digits", "entropy",
            "host_entropy", "parameters", "escapes", "hyphens", "fragment", "secure", "suffix_blocked")


def lexical(urls: DataFrame, suffixes: DataFrame) -> DataFrame:
    """`urls` (url, host, path, rule, ...) with FEATURES."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    chars = F.greatest(F.char_length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    own = {
        "url_chars": F.char_length(url), "host_chars": F.char_length(host), "path_chars": F.char_length(path),
        "depth": _count(path, "/"), "host_labels": _count(host, "."), "digit_ratio": _count(url, "0-9") / chars,
        "host_digits": _count(host, "0-9"), "entropy": _entropy(url), "host_entropy": _entropy(host),
        "parameters": F.when(query == "", 0).otherwise(1 + _count(query, "&;")), "escapes": _count(url, "%"),
        "hyphens": _count(url, "_-"), "fragment": url.contains("#").cast("int"), "secure": url.startswith("https").cast("int"),
    }
    # at most SUFFIX_BUCKETS rows of FOLDS pairs of numbers: a proven bound
    joined = urls.withColumn("bucket", suffix_bucket(host)).join(F.broadcast(suffixes), "bucket", "left")
    # a labelled URL leaves its own fold out; a suffix without URLs says nothing
    fold = F.when(F.col("rule").isNotNull(), host_fold(host)).otherwise(-1)
    total = lambda k: F.aggregate(F.col("folds"), F.lit(0.0), lambda t, x: t + F.when(x.fold == fold, 0.0).otherwise(x[k]))
    own["suffix_blocked"] = F.coalesce((total("blocked") + 1) / (total("urls") + 2), F.lit(0.5))
    return joined.select(*urls.columns, *[c.cast("double").alias(k) for k, c in own.items()])


def host_fold(host: Column) -> Column:
    return F.pmod(F.xxhash64(host, F.lit(5)), F.lit(FOLDS))


def suffix_statistics(ruled: DataFrame) -> DataFrame:
    """(bucket, folds): of each part of a bucket's hosts its URLs and how many of
    them are blocked; one that no rule decides counts half."""
    blocked = F.when(F.col("rule").isNull(), 0.5).otherwise((F.col("rule.verdict") == "block").cast("double"))
    return (ruled.groupBy(suffix_bucket(F.col("host")).alias("bucket"), host_fold(F.col("host")).alias("fold"))
            .agg(F.count("*").cast("double").alias("urls"), F.sum(blocked).alias("blocked"))
            .groupBy("bucket").agg(F.collect_list(F.struct("fold", "urls", "blocked")).alias("folds")))  # FOLDS at most


def distinct_sample(labelled: DataFrame, rows: int) -> DataFrame:
    """`labelled` as distinct URLs with their rows `n`, at most `rows` of each
    label: those with the smallest hash, whatever the counts are."""
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.approx_count_distinct("url", 0.02).alias("n")).collect()}
    h, kinds = F.pmod(F.xxhash64("url", F.lit(11)), F.lit(1 << 30)), []
    for label, n in sorted(counts.items()):
        kind = labelled.filter(F.col("label") == label)
        if n > 4 * rows:  # about three times the wanted URLs are grouped, not all
            kind = kind.filter(h < int((1 << 30) * 3.0 * rows / n))
        kinds.append(kind.groupBy("url", "host", "path", "rule", "label").agg(F.count("*").alias("n")).orderBy(h, "url").limit(rows))
    return reduce(DataFrame.unionAll, kinds)


def learn(spark: SparkSession, ruled: DataFrame, s: Settings = Settings()) -> tuple[GBTClassificationModel | None, DataFrame]:
    """The trees and the suffix table, from (url, host, path, rule) rows."""
    labelled = (ruled.filter(F.col("rule").isNotNull())
                .select("url", "host", "path", "rule", (F.col("rule.verdict") == "block").cast("int").alias("label")))
    suffixes = written(spark, suffix_statistics(ruled), "suffixes")
    if labelled.select("label").distinct().count() < 2:
        return None, suffixes
    sample = written(spark, lexical(distinct_sample(labelled, s.sample // 2), suffixes), "sample")
    # both kinds weigh the same, whatever their shares are; a URL weighs as its rows do
    drawn = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    share = F.when(F.col("label") == 0, 1.0 / drawn[0]).otherwise(1.0 / drawn[1])
    sample = sample.withColumn("weight", F.col("n") * share * sum(drawn.values()))
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=s.trees, maxDepth=s.depth,
                          stepSize=0.3, seed=3)
    return trees.fit(_vectors(sample)), suffixes


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def judged(spark: SparkSession, urls: DataFrame, rules=RULES, s: Settings = Settings()) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every (page_id, url)."""
    ruled = parts(urls)
    ruled = ruled.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    model, suffixes = learn(spark, ruled, s)
    if model is None:
        scored = ruled.withColumn("score", F.lit(0.0))
    else:
        scored = model.transform(_vectors(lexical(ruled, suffixes)))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    verdict = F.when(F.col("score") >= s.threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("rule.name").alias("rule"),
                         F.coalesce("rule.verdict", verdict).alias("verdict"), "score")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, table(spark, sf_dir, "pages").select("page_id", "url"))
