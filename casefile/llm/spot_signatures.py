"""SpotSigs document fingerprints, with DataFrame functions only.

The words that most documents hold are the anchors.  Every anchor in a text,
and the text's beginning, starts a chain: the next CHAIN words that are no
anchors.  The distinct hashes of (anchor, chain) are the text's spot
signatures; changes elsewhere in the text leave them as they are.  A text
without a word beside anchors has the hash of the whole text as its signature.
Fingerprints are the signatures in order; their likeness is Jaccard's.

`near_duplicates` partitions fingerprints by the number of their signatures,
so that sets whose sizes alone rule a likeness out never meet, and looks each
set up by its rarest signatures only: a set that shares none of them with
another, or whose remaining signatures are too few, is pruned before the two
are compared.

Defined cases: null texts are empty, and the empty text's fingerprint is its
hash.  Rows with equal id and text are one document, in order and as links,
given back once a row.  In descending order null ids come last; of equal ids
the one with the larger md5 of id and text is first.  Other columns are
ignored.  An empty table has no anchors and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casefile.llm.common import table, written
from casefile.llm.phrase_index import SEPARATORS, fold

#: How many words are anchors, and how long a chain is.
ANCHORS, CHAIN = 64, 3
#: Characters of a signature.
SIGNATURE = 16
SIMILAR = 0.8


def words(text: Column) -> Column:
    return F.filter(F.split(fold(text), SEPARATORS, -1), lambda w: w != "")


def common_words(docs: DataFrame, n: int = ANCHORS) -> list[str]:
    """The n words that most documents hold, of equal ones the first."""
    held = docs.select(F.explode(F.array_distinct(words(F.coalesce("text", F.lit(""))))).alias("word"))
    top = held.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(n)
    return [r["word"] for r in top.collect()]  # n words


def signatures(text: Column, anchors: list[str], chain: int = CHAIN) -> Column:
    """The sorted distinct spot signatures of a text that is not null."""
    def is_anchor(w: Column) -> Column:
        return w.isin(anchors) if anchors else F.lit(False)

    def spots(s: Column) -> Column:
        # before the k-th anchor, at word i, stand i - k words that are none
        spot = F.transform(s.at, lambda i, k: F.when(i - k < F.size(s.content), F.concat_ws(
            " ", F.get(s.words, i), F.slice(s.content, i - k + 1, F.lit(chain)))))
        first = F.array(F.concat_ws(" ", F.lit(""), F.slice(s.content, F.lit(1), F.lit(chain))))
        every = F.concat(first, F.filter(spot, lambda x: x.isNotNull()))
        hashed = F.transform(every, lambda x: F.substring(F.md5(x.cast("binary")), 1, SIGNATURE))
        whole = F.array(F.substring(F.md5(s.text.cast("binary")), 1, SIGNATURE))
        return F.when(F.size(s.content) > 0, F.array_sort(F.array_distinct(hashed))).otherwise(whole)

    # arrays that lambdas refer to are values of an outer lambda: computed once
    split = F.transform(F.array(text), lambda t: F.struct(t.alias("text"), words(t).alias("words")))
    marked = F.transform(split, lambda s: F.struct(
        s.text.alias("text"), s.words.alias("words"), F.filter(s.words, lambda w: ~is_anchor(w)).alias("content"),
        F.filter(F.transform(s.words, lambda w, i: F.when(is_anchor(w), i)), lambda i: i.isNotNull()).alias("at")))
    return F.get(F.transform(marked, spots), F.lit(0))


def as_text(sigs: Column) -> Column:
    return F.array_join(sigs, " ")


def from_text(fingerprint: Column) -> Column:
    return F.split(fingerprint, " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard's similarity of two sets of signatures."""
    both = F.size(F.array_intersect(a, b))
    return F.when(both == 0, 0.0).otherwise(both / (F.size(a) + F.size(b) - both))


# --- a document and the next one


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, h, text): h tells documents apart."""
    text = F.coalesce("text", F.lit(""))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    return docs.select("doc_id", F.md5(named.cast("binary")).alias("h"), text.alias("text"))


def followers(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(h, to_h, to_chars): for every document the one before it in descending
    order of (doc_id, h), with its length; before the first stands the last.

    Sorted slices are numbered each for itself; what stands before a slice's
    first row comes from a table of the slices' last rows.
    """
    ids = written(spark, keyed(docs).groupBy("doc_id", "h").agg(F.max(F.char_length("text")).alias("n")), "ids")
    order = [F.desc_nulls_last("doc_id"), F.desc("h")]
    sliced = written(spark, ids.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "slices")
    row = F.struct("doc_id", "h", "n")
    # a row a slice: null ids are the least in structs and the last in order
    ends = sliced.groupBy("slice").agg(F.min(row).alias("last"))
    by_slice = Window.orderBy("slice")
    before = written(spark, ends.select(
        F.col("slice").alias("of"),
        F.coalesce(F.lag("last").over(by_slice), F.last("last").over(by_slice.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("end")), "ends")
    linked = sliced.withColumn("to", F.lag(row).over(Window.partitionBy("slice").orderBy(*order)))
    to = F.coalesce("to", "end")
    return linked.join(before, F.col("slice") == F.col("of")).select("h", to.h.alias("to_h"), to.n.alias("to_chars"))


def edited(text: Column, head: Column) -> Column:
    """The text, its last third replaced by `head`."""
    n = F.char_length(text)
    return F.concat(F.substring(text, F.lit(1), n - F.floor(n / 3).cast("int")), head)


def with_next(spark: SparkSession, docs: DataFrame, anchors: list[str]) -> DataFrame:
    """(doc_id, text, next_id, head, next): each document with the next one's id,
    first characters (a third of its own length) and fingerprint.  Both joins
    read the same columns of the texts, so that these are dealt once."""
    wanted = written(spark, followers(spark, docs), "followers")
    here = keyed(docs)
    sent = here.join(wanted, "h").select(
        F.col("to_h").alias("h"), F.col("doc_id").alias("next_id"),
        F.substring("text", F.lit(1), F.floor(F.col("to_chars") / 3).cast("int")).alias("head"),
        F.unhex(F.array_join(signatures(F.col("text"), anchors), "")).alias("next"))
    # a repeated row sends the same more than once
    once = sent.groupBy("h").agg(*[F.first(c).alias(c) for c in ("next_id", "head", "next")])
    return here.join(once, "h").select(
        "doc_id", "text", "next_id", "head", F.regexp_extract_all(F.lower(F.hex("next")), F.lit(f".{{{SIGNATURE}}}"), F.lit(0)).alias("next"))


# --- near duplicates


def size_bounds(similar: float, longest: int = 1 << 31) -> list[int]:
    """The least set size of each partition: sets that are `similar` lie in the
    same partition or in neighbouring ones."""
    bounds, b = [], 1
    while b <= longest:
        bounds.append(b)
        b = int(b / similar) + 1
    return bounds


def near_duplicates(spark: SparkSession, docs: DataFrame, anchors: list[str], similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, class) and links (a, b, likeness) between classes.

    Documents with equal fingerprints are one class, named by its least id;
    links are all pairs of classes with a likeness of `similar` or more, a < b.
    Documents without id are in no class.
    """
    if not 0 < similar <= 1:
        raise ValueError(f"a likeness of {similar} links nothing or everything")
    prints = written(spark, docs.filter(F.col("doc_id").isNotNull()).select("doc_id", as_text(signatures(F.coalesce("text", F.lit("")), anchors)).alias("fp")), "prints")
    classes = written(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("class")), "classes")
    members = prints.join(classes, "fp").select("doc_id", "class")
    sigs = classes.select("class", F.explode(from_text(F.col("fp"))).alias("sig"), F.size(from_text(F.col("fp"))).alias("size"))
    held = sigs.groupBy("sig").agg(F.count("*").alias("n")).filter("n > 1")
    rare = sigs.join(held, "sig").groupBy("class", "size").agg(F.sort_array(F.collect_list(F.struct("n", "sig"))).alias("s"))
    # signatures of one class alone come first in order and look nothing up
    alone = F.col("size") - F.size("s")
    looked_up = F.greatest(F.col("size") - F.ceil(F.col("size") * similar - 1e-9).cast("int") + 1 - alone, F.lit(0))
    part = F.size(F.filter(F.array(*[F.lit(b) for b in size_bounds(similar)]), lambda b: b <= F.col("size")))
    rows = written(spark, rare.select("class", "size", part.alias("part"), alone.alias("alone"), F.posexplode(
        F.slice("s", F.lit(1), looked_up)).alias("pos", "x")).select("class", "size", "part", F.col("x.sig").alias("sig"), (F.col("alone") + F.col("pos")).alias("pos")), "rare")
    left = rows.select("sig", F.col("class").alias("a"), F.col("size").alias("a_size"), F.col("pos").alias("a_pos"),
                       F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    right = rows.select("sig", F.col("class").alias("b"), F.col("size").alias("b_size"), F.col("pos").alias("b_pos"), "part")
    # what is left of both sets from their first shared signature on must suffice
    rest = F.least(F.col("a_size") - F.col("a_pos"), F.col("b_size") - F.col("b_pos"))
    need = similar / (1 + similar) * (F.col("a_size") + F.col("b_size")) - 1e-9
    smaller = (F.col("a_size") < F.col("b_size")) | ((F.col("a_size") == F.col("b_size")) & (F.col("a") < F.col("b")))
    pairs = written(spark, left.join(right, ["sig", "part"]).filter(smaller & (F.col("a_size") >= similar * F.col("b_size") - 1e-9))
                    .filter(rest >= need).select("a", "b").distinct(), "pairs")
    one, two = (classes.select(F.col("class").alias(c), from_text(F.col("fp")).alias(f"{c}_sigs")) for c in "ab")
    links = (pairs.join(one, "a").join(two, "b").withColumn("likeness", likeness(F.col("a_sigs"), F.col("b_sigs")))
             .filter(F.col("likeness") >= similar)
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness"))
    return members, links


def op13_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    anchors = common_words(docs)
    text = F.col("text")
    both = (with_next(spark, docs, anchors)
            .select("doc_id", "next_id", F.char_length(text).cast("long").alias("n_chars"), "next", edited(text, F.col("head")).alias("edited"),
                    signatures(text, anchors).alias("sigs"))
            .withColumn("edited_sigs", signatures(F.col("edited"), anchors)))
    return both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       as_text(F.col("sigs")).alias("fingerprint"), as_text(F.col("edited_sigs")).alias("edited_fingerprint"),
                       likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                       likeness(F.col("sigs"), F.col("next")).alias("near_next"), "next_id")


OP13_SQL = r"""
WITH d AS (
  SELECT DISTINCT doc_id, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS h, coalesce(text, '') AS text
  FROM documents),
n AS (
  SELECT doc_id, h, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next,
         CASE WHEN lead(text) OVER w IS NULL THEN first_value(doc_id) OVER w ELSE lead(doc_id) OVER w END AS next_id
  FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, h DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
t AS (SELECT *, left(text, length(text) - length(text) // 3) || left(next, length(text) // 3) AS edited FROM n),
each AS (SELECT DISTINCT text FROM (SELECT text FROM t UNION ALL SELECT edited FROM t)),
w AS (
  SELECT text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM each),
common AS (
  SELECT list(word) AS words FROM (
    SELECT word FROM (SELECT unnest(list_distinct(w)) AS word FROM documents JOIN w ON w.text = coalesce(documents.text, ''))
    GROUP BY word ORDER BY count(*) DESC, word LIMIT 64)),
c AS (
  SELECT text, w, list_filter(w, lambda x: NOT list_contains(words, x)) AS content,
         list_filter(list_transform(w, lambda x, i: CASE WHEN list_contains(words, x) THEN i END), lambda i: i IS NOT NULL) AS places
  FROM w, common),
spots AS (
  SELECT text, CASE WHEN len(content) = 0 THEN [text] ELSE list_concat(
      [' ' || array_to_string(list_slice(content, 1, 3), ' ')],
      list_filter(list_transform(places, lambda i, k: CASE WHEN i - k < len(content)
          THEN w[i] || ' ' || array_to_string(list_slice(content, i - k + 1, i - k + 3), ' ') END), lambda x: x IS NOT NULL)) END AS s
  FROM c),
f AS (SELECT text, list_sort(list_distinct(list_transform(s, lambda x: left(md5(x), 16)))) AS f FROM spots)
SELECT documents.doc_id, length(t.text)::BIGINT AS n_chars, sha256(t.edited) AS edited_sha256,
       array_to_string(a.f, ' ') AS fingerprint, array_to_string(b.f, ' ') AS edited_fingerprint,
       len(list_intersect(a.f, b.f)) / len(list_distinct(list_concat(a.f, b.f))) AS near_edited,
       len(list_intersect(a.f, c.f)) / len(list_distinct(list_concat(a.f, c.f))) AS near_next, t.next_id
FROM documents
JOIN t ON t.doc_id IS NOT DISTINCT FROM documents.doc_id AND t.text = coalesce(documents.text, '')
JOIN f a ON a.text = t.text JOIN f b ON b.text = t.edited JOIN f c ON c.text = t.next
"""
