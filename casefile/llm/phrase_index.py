"""Benchmark decontamination through a positional inverted index.

DataFrame functions only.  The training texts are split into words once; the
index stores (term, document, position) of the terms that test phrases are
looked up by, each posting with as many words around it as the phrases of its
term reach.  A phrase (a window of an item) is looked up by its rarest term,
counted over the whole corpus, and then by its second rarest: the list of the
one, shifted by the offset between the two in the phrase, is intersected with
the list of the other by an equi-join on (term, offset, the term that stands
there), so that a term which leads many phrases meets each of its postings
once an offset, not once a phrase.  What both terms agree on is read off the
posting and joined with the phrases themselves.  A proximity match is a place
of the rarest term with all words of the phrase, as often as it holds them,
within `slop` words, in any order; it is looked up by the second term too.

Term tables are written first, so the planner knows their size: small ones are
broadcast below spark.sql.autoBroadcastJoinThreshold, others are joined by a
shuffle.  Before that join, tokens pass a table of term hashes that has at most
TERM_BUCKETS rows whatever the terms are, and only then are the words around
them cut out: whole texts are never shuffled.  Postings, candidates and hits
are spread by document and position, so neither a hot phrase nor a hot term
gathers in one task.

Defined cases: null texts have no words.  Rows are told apart by doc_id and
text, so rows with equal ids and other texts keep their own results, and
repeated rows get equal ones; null ids are kept.  An item without an id marks
words but is not listed.  An empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.llm.common import fresh_names, table, written

#: Everything that is no word character: A-Z are words too before lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
#: How far from its rarest term a phrase's other terms may stand in a proximity match.
SLOP = WINDOW - 1
#: Rows of the table that tokens are filtered with before any term table.
TERM_BUCKETS = 1 << 16


def fold(word: Column) -> Column:
    """A-Z lower-cased; `lower` does that on text that is all ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def word_list(text: Column) -> Column:
    # only the first and the last part may be empty
    return F.filter(F.split(fold(F.coalesce(text, F.lit(""))), SEPARATORS, -1), lambda x: x != "")


def tokenized(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, h, words) of every row, written: texts are split once."""
    return written(spark, docs.select("doc_id", F.xxhash64("text").alias("h"), word_list(F.col("text")).alias("words")), "words")


def item_phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, phrase): the distinct windows of each item, words space-joined."""
    words = items.select("item_id", word_list(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    return (words.select("item_id", "w", F.explode(starts).alias("i"))
            .select("item_id", F.array_join(F.slice("w", F.col("i"), F.lit(window)), " ").alias("phrase")).distinct())


def numbered(spark: SparkSession, phrases: DataFrame) -> DataFrame:
    """(phrase_id, phrase), written, so that the numbers stay."""
    return written(spark, phrases.select(F.monotonically_increasing_id().alias("phrase_id"), "phrase"), "numbered")


def frequencies(words: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each of `terms` stands in all texts."""
    return words.select(F.explode("words").alias("term")).join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))


def lookups(spark: SparkSession, words: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase_id, phrase, size, lead, at, second, apart): each numbered phrase
    with its rarest term, that term's first place in it, the second rarest and
    how far behind the first it stands (the rarest itself if there is no
    other).  Phrases with a term that stands nowhere cannot occur and are left out."""
    split = phrases.select("phrase_id", "phrase", F.split("phrase", " ").alias("w"))
    terms = written(spark, split.select(F.explode("w").alias("term")).distinct(), "terms")
    known = written(spark, frequencies(words, terms), "frequencies")
    placed = split.select("phrase_id", "phrase", F.posexplode("w").alias("offset", "term")).join(known, "term")
    once = placed.groupBy("phrase_id", "phrase", "term", "n").agg(F.min("offset").alias("offset"), F.count("*").alias("times"))
    order = F.sort_array(F.collect_list(F.struct("n", "offset", "term")))  # at most a window's words
    size = F.size(F.split("phrase", " "))
    ranked = (once.groupBy("phrase_id", "phrase").agg(order.alias("t"), F.sum("times").alias("found"))
              .filter(F.col("found") == size))
    first, second = F.get("t", F.lit(0)), F.coalesce(F.get("t", F.lit(1)), F.get("t", F.lit(0)))
    return ranked.select("phrase_id", "phrase", size.alias("size"), first.term.alias("lead"), first.offset.alias("at"),
                         second.term.alias("second"), (second.offset - first.offset).alias("apart"))


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets))


def build_index(words: DataFrame, looked_up: DataFrame, slop: int | None = None) -> DataFrame:
    """The postings of the lead terms: (term, doc_id, h, pos, first, around).
    `around` holds the words from number `first` on, space-joined, as far as
    the term's phrases reach, or `slop` words to both sides if it leads one of
    several words."""
    reach = lambda c: c if slop is None else F.greatest(c, F.when(F.col("size") > 1, slop).otherwise(0))
    terms = looked_up.groupBy(F.col("lead").alias("term")).agg(
        F.max(reach(F.col("at"))).alias("before"), F.max(reach(F.col("size") - 1 - F.col("at"))).alias("after"))
    # at most TERM_BUCKETS rows of three numbers: a proven bound
    hashes = terms.groupBy(_bucket(F.col("term"), TERM_BUCKETS).alias("bucket")).agg(
        F.max("before").alias("before"), F.max("after").alias("after"))
    tokens = words.select("doc_id", "h", "words", F.posexplode("words").alias("pos", "term"))
    first = F.greatest(F.col("pos") - F.col("before"), F.lit(0))
    cut = (tokens.withColumn("bucket", _bucket(F.col("term"), TERM_BUCKETS)).join(F.broadcast(hashes), "bucket")
           .select("term", "doc_id", "h", "pos", first.alias("first"),
                   F.array_join(F.slice("words", first + 1, F.col("pos") - first + F.col("after") + 1), " ").alias("around")))
    return cut.join(terms.select("term"), "term")


def _part(around: Column, start: Column, size: Column) -> Column:
    return F.slice(F.split(around, " "), start + 1, size)


def phrase_matches(index: DataFrame, looked_up: DataFrame) -> DataFrame:
    """(phrase_id, size, doc_id, h, start): every place of every phrase."""
    # at most as many offsets and shapes a term as fit a window
    offsets = looked_up.groupBy(F.col("lead").alias("term")).agg(F.collect_set("apart").alias("offsets"))
    shapes = looked_up.groupBy(F.col("lead").alias("term"), "apart", "second").agg(
        F.collect_set(F.struct("at", "size")).alias("shapes"))
    here = F.col("pos") - F.col("first")
    beside = (index.join(offsets, "term").withColumn("apart", F.explode("offsets")).filter(here + F.col("apart") >= 0)
              .withColumn("second", F.get(F.split("around", " "), here + F.col("apart"))).drop("offsets"))
    both = (beside.join(shapes, ["term", "apart", "second"]).withColumn("shape", F.explode("shapes"))
            .select("doc_id", "h", "pos", "first", "around", F.col("shape.at").alias("at"), F.col("shape.size").alias("size"))
            .filter(here >= F.col("at")))
    read = both.select("doc_id", "h", (F.col("pos") - F.col("at")).alias("start"), "at",
                       F.array_join(_part(F.col("around"), here - F.col("at"), F.col("size")), " ").alias("phrase"))
    return (read.join(looked_up.select("phrase_id", "phrase", "size", "at"), ["phrase", "at"])
            .select("phrase_id", "size", "doc_id", "h", "start").distinct())  # repeated rows give a place more than once


def proximity_matches(index: DataFrame, looked_up: DataFrame, slop: int) -> DataFrame:
    """(phrase_id, doc_id, h, pos): places of a phrase's rarest term that have all
    its words, as often as it holds them, within `slop` words, in any order.
    The index must have been built with this `slop` or a wider one."""
    # which second terms a lead has, as a set of hashes: a bounded filter
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))
    leads = looked_up.groupBy(F.col("lead").alias("term")).agg(F.bit_or(bit(F.col("second"))).alias("seconds"))
    here = F.col("pos") - F.col("first")
    before = F.least(here, F.lit(slop))
    near = index.join(leads, "term").select(
        "term", "doc_id", "h", "pos", "seconds",
        F.array_join(_part(F.col("around"), here - before, before + slop + 1), " ").alias("near"))
    beside = (near.withColumn("second", F.explode(F.array_distinct(F.split("near", " "))))
              .filter(F.col("seconds").bitwiseAND(bit(F.col("second"))) != 0))
    phrase, around = F.split("phrase", " "), F.split("near", " ")
    often = lambda words, w: F.size(F.filter(words, lambda x: x == w))
    return (beside.join(looked_up.select("phrase_id", "phrase", F.col("lead").alias("term"), "second"), ["term", "second"])
            .filter(F.forall(F.array_distinct(phrase), lambda w: often(around, w) >= often(phrase, w)))
            .select("phrase_id", "doc_id", "h", "pos").distinct())


def _items_of(found: DataFrame, of_item: DataFrame, name: str) -> DataFrame:
    """(doc_id, h, name): the ids of the items that each document has phrases of."""
    ids = found.select("doc_id", "h", "phrase_id").distinct().join(of_item, "phrase_id")
    return (ids.select("doc_id", "h", F.col("item_id").cast("string").alias("item")).distinct()
            .groupBy("doc_id", "h").agg(F.sort_array(F.collect_list("item")).alias(name)))  # at most the benchmark's


def _both(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """A join on doc_id and h that keeps null ids together."""
    r = right.withColumnsRenamed({"doc_id": "r_id", "h": "r_h"})
    same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("h") == F.col("r_h"))
    return left.join(r, same, how).drop("r_id", "r_h")


def contamination(spark: SparkSession, words: DataFrame, items: DataFrame, window: int = WINDOW,
                  slop: int | None = None) -> DataFrame:
    """(doc_id, h, n_hit, item_list) of the tokenized documents with a hit; with
    `slop` also (n_near, near_list), of those with a place near a phrase."""
    windows = written(spark, item_phrases(items.select("item_id", "text"), window), "phrases")
    phrases = numbered(spark, windows.select("phrase").distinct())
    of_item = written(spark, windows.join(phrases, "phrase").select("phrase_id", "item_id"), "items")
    looked_up = written(spark, lookups(spark, words, phrases), "lookups")
    index = written(spark, build_index(words, looked_up, slop), "postings")
    found = written(spark, phrase_matches(index, looked_up), "matches")
    last = F.col("start") + F.col("size") - 1
    hit = (found.select("doc_id", "h", F.explode(F.sequence("start", last)).alias("p")).distinct()
           .groupBy("doc_id", "h").agg(F.count("*").alias("n_hit")))
    out = _both(hit, _items_of(found, of_item, "item_list"), "inner")
    if slop is None:
        return out
    near = written(spark, proximity_matches(index, looked_up, slop), "near")
    places = near.select("doc_id", "h", "pos").distinct().groupBy("doc_id", "h").agg(F.count("*").alias("n_near"))
    # a phrase of one window lies near its rarest term, so every hit is near
    return _both(_both(places, _items_of(near, of_item, "near_list"), "inner"), out, "left")


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` without a hit, as they are."""
    d_id, d_h = fresh_names(docs, "doc_id", "h")
    dirty = contamination(spark, tokenized(spark, docs), items, window).select(
        F.col("doc_id").alias(d_id), F.col("h").alias(d_h))
    same = F.col("doc_id").eqNullSafe(F.col(d_id)) & (F.xxhash64("text") == F.col(d_h))
    return docs.join(written(spark, dirty, "dirty"), same, "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = tokenized(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    dirty = contamination(spark, words, table(spark, sf_dir, "benchmark"), slop=SLOP)
    none = F.array().cast("array<string>")
    items, near = F.coalesce("item_list", none), F.coalesce("near_list", none)
    return (_both(words.select("doc_id", "h", F.size("words").cast("long").alias("n_words")), dirty, "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                    F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated"),
                    F.coalesce("n_near", F.lit(0)).alias("n_near"), F.size(near).cast("long").alias("n_near_items")))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + 9), ' ') AS phrase
  FROM b, unnest(range(1, greatest(2, len(w) - 8))) AS r(i) WHERE len(w) > 0),
place AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM d, (SELECT DISTINCT k FROM win) AS v, unnest(range(1, len(w) - k + 2)) AS r(i)),
hit AS (SELECT doc_id, item_id, k, i FROM place JOIN win USING (phrase, k)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
freq AS (SELECT term, count(*) AS n FROM (SELECT unnest(w) AS term FROM d) GROUP BY term),
-- the rarest word of a window, of equally rare ones the first; a word that no text has rules the window out
led AS (
  SELECT phrase, arg_min(p.term, {'n': n, 'i': i}) AS term
  FROM (SELECT phrase, unnest(string_split(phrase, ' ')) AS term, generate_subscripts(string_split(phrase, ' '), 1) AS i
        FROM (SELECT DISTINCT phrase FROM win)) p LEFT JOIN freq USING (term)
  GROUP BY phrase HAVING count(*) = count(n)),
led_items AS (SELECT led.term, phrase, item_id FROM led JOIN win USING (phrase)),
near AS (
  SELECT doc_id, i, item_id
  FROM (SELECT doc_id, i, w[i] AS term, list_slice(w, greatest(1, i - 9), i + 9) AS near FROM d, unnest(range(1, len(w) + 1)) AS r(i))
  JOIN led_items USING (term)
  WHERE len(list_filter(list_distinct(string_split(phrase, ' ')), lambda x:
      len(list_filter(near, lambda y: y = x)) < len(list_filter(string_split(phrase, ' '), lambda z: z = x)))) = 0),
nn AS (SELECT doc_id, count(DISTINCT i) AS n_near, count(DISTINCT item_id) AS n_near_items FROM near GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near, coalesce(n_near_items, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN nn USING (doc_id)
"""
