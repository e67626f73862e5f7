"""Lexical analytics: whole-word lexicon mentions (X1), co-mention edges (X2,
J4), known flags (U1, J3), leakage (H2, G5, G6, P5), the entity web and its
shadow candidates (H3, G7, H3p, P6).

Plan shape: message text never crosses a shuffle.  Mentions are extracted
where the text is read (filter -> lower -> regex -> explode, all narrow), and
only (id, entity) pairs — or, for the web, per-message entity pairs — travel
to the aggregation.  Pairs are built from each message's sorted, distinct hit
array, so the self-join of the SQL form (a second shuffle) is not needed; the
number of pairs per message is bounded by the lexicon size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.functions.text import address_domain, lexicon_hits, search_text
from casefile.operators.comms import first_event_scalar
from casefile.operators.staging import date_window_filter, is_internal, keyword_prefilter


def _hit_arrays(emails: DataFrame, words: Sequence[str], *, prefilter: Sequence[str],
                window: tuple[str | None, str | None] | None, keep: Sequence[str]) -> DataFrame:
    e = emails
    if window is not None and window != (None, None):
        e = date_window_filter(e, "sent_at", *window)
    if prefilter:
        e = keyword_prefilter(e, prefilter)
    e = e.select(*keep, search_text("subject", "body").alias("_txt"))
    return e.select(*keep, lexicon_hits("_txt", words).alias("_hits"))


def lexicon_mentions(emails: DataFrame, words: Sequence[str], *, prefilter: Sequence[str] = (),
                     window: tuple[str | None, str | None] | None = None,
                     keep: Sequence[str] = ("id",)) -> DataFrame:
    """One row per (message, distinct whole-word hit): keep columns + entity.

    The regex pass is itself the filter: messages without a hit explode to
    nothing.  `explode_outer` + a NOT NULL filter keeps Catalyst from
    inferring a `size(hits) > 0` pre-filter that would run the regex twice.
    `prefilter` (F2) is a word list of its own: with one, only messages that
    name one of its words count, which changes the result where it is smaller
    than the lexicon.
    """
    h = _hit_arrays(emails, words, prefilter=prefilter, window=window, keep=keep)
    return (h.select(*keep, F.explode_outer("_hits").alias("entity"))
             .filter(F.col("entity").isNotNull()))


def _pairs(arr):
    """All (x, y) with x before y in a sorted array, as an array of structs."""
    return F.flatten(F.transform(
        arr, lambda x, i: F.transform(
            F.slice(arr, i + 2, F.greatest(F.size(arr) - i - 1, F.lit(0))),
            lambda y: F.struct(x.alias("entity_a"), y.alias("entity_b")))))


def co_mention_edges(emails: DataFrame, words: Sequence[str], *, prefilter: Sequence[str] = (),
                     window: tuple[str | None, str | None] | None = None) -> DataFrame:
    """(entity_a < entity_b, co_mentions) over messages mentioning both."""
    h = _hit_arrays(emails, words, prefilter=prefilter, window=window, keep=("id",))
    p = (h.select(F.explode_outer(_pairs(F.array_sort("_hits"))).alias("_p"))
          .filter(F.col("_p").isNotNull()))
    return (p.groupBy(F.col("_p.entity_a").alias("entity_a"), F.col("_p.entity_b").alias("entity_b"))
             .agg(F.count(F.lit(1)).alias("co_mentions")))


def co_mention_self_join(mentions: DataFrame) -> DataFrame:
    """The SQL shape — self equi-join on the message id with a < b.

    Both sides are the same DataFrame.  A sort-merge join puts both behind the
    same hash exchange on the id, which is planned once and reused
    (ReusedExchange), so the text scan runs once; a broadcast plan would scan
    the text for each side."""
    a, b = mentions.alias("a").hint("merge"), mentions.alias("b")
    j = a.join(b, (F.col("a.id") == F.col("b.id")) & (F.col("a.entity") < F.col("b.entity")))
    return (j.groupBy(F.col("a.entity").alias("entity_a"), F.col("b.entity").alias("entity_b"))
             .agg(F.count(F.lit(1)).alias("co_mentions")))


def known_entities(entities: DataFrame, aliases: Sequence[str] = ()) -> DataFrame:
    """lower(known entity names) UNION ALL the alias list."""
    base = entities.filter(F.col("known")).select(F.lower("entity").alias("entity"))
    if not aliases:
        return base
    al = entities.sparkSession.createDataFrame([(a.lower(),) for a in aliases], "entity string")
    return base.unionByName(al)


def known_flag_existence(edges: DataFrame, known: DataFrame) -> DataFrame:
    """`entity_x IN known` as booleans, via a left join to the distinct
    known list (no fan-out); AQE broadcasts the list by its real size."""
    k = known.select("entity").distinct()
    ka = k.select(F.col("entity").alias("_ka"))
    kb = k.select(F.col("entity").alias("_kb"))
    return (edges.join(ka, F.col("entity_a") == F.col("_ka"), "left")
                 .join(kb, F.col("entity_b") == F.col("_kb"), "left")
                 .withColumn("a_known", F.col("_ka").isNotNull())
                 .withColumn("b_known", F.col("_kb").isNotNull())
                 .drop("_ka", "_kb"))


def hunt_entity_web(emails: DataFrame, entities: DataFrame, words: Sequence[str], *,
                    aliases: Sequence[str] = (), prefilter: Sequence[str] = (),
                    window: tuple[str | None, str | None] | None = None) -> DataFrame:
    """H3: co-mention edges with known flags."""
    edges = co_mention_edges(emails, words, prefilter=prefilter, window=window)
    out = known_flag_existence(edges, known_entities(entities, aliases))
    return out.select("entity_a", "entity_b", "co_mentions", "a_known", "b_known")


def shadow_candidates(web: DataFrame, threshold: int = 20) -> DataFrame:
    """Per unknown entity, co-mentions with known ones; total >= threshold."""
    cand = F.when(F.col("a_known"), F.col("entity_b")).otherwise(F.col("entity_a"))
    return (web.filter(F.col("a_known") != F.col("b_known"))
               .groupBy(cand.alias("candidate"))
               .agg(F.sum("co_mentions").cast("long").alias("total"))
               .filter(F.col("total") >= threshold))


def classification_proposals(web: DataFrame, glossary: DataFrame, threshold: int = 20) -> DataFrame:
    """H3p: shadow candidates not yet in the glossary, as pending proposals."""
    g = glossary.select(F.lower("name").alias("_term")).distinct()
    s = shadow_candidates(web, threshold)
    return (s.join(g, s.candidate == g._term, "left_anti")
             .select(F.col("candidate").alias("term"), F.col("total").alias("support"),
                     F.lit("pending-review").alias("status")))


def unknown_right_side(web: DataFrame, k: int = 10) -> DataFrame:
    """Co-mentions by entity_b where b is unknown, top k (a report)."""
    return (web.filter(~F.col("b_known"))
               .groupBy("entity_b").agg(F.sum("co_mentions").cast("long").alias("total"))
               .orderBy(F.desc("total"), "entity_b").limit(k))


def hunt_external_leakage(emails: DataFrame, recipients: DataFrame, events: DataFrame,
                          words: Sequence[str], *, window: tuple[str, str], suffix: str,
                          prefilter: Sequence[str] = ()) -> DataFrame:
    """H2: messages naming lexicon entities sent outside the perimeter before
    the first event; one row per message x entity x external recipient."""
    hits = lexicon_mentions(emails, words, prefilter=prefilter, window=window,
                            keep=("id", "sent_at", "sender", "subject"))
    return sent_outside(hits, recipients, events, suffix)


def sent_outside(hits: DataFrame, recipients: DataFrame, events: DataFrame, suffix: str) -> DataFrame:
    """H2 from mentions (id, sent_at, sender, subject, entity) on."""
    r = recipients.filter(~is_internal("addr", suffix) & F.col("addr").contains("@"))
    j = hits.join(r, hits.id == r.email_id)
    j = first_event_scalar(j, "sent_at", events)
    return j.select(F.col("id").alias("email_id"), "sent_at", "sender", "subject", "entity",
                    F.col("addr").alias("external_recipient"),
                    address_domain("addr").alias("external_domain"), "days_before_disclosure")


def leak_distinct_counts(leak: DataFrame) -> DataFrame:
    """Distinct messages and addresses, overall and strictly before the event."""
    pre = F.col("days_before_disclosure") > 0
    return leak.agg(
        F.countDistinct("email_id").alias("distinct_emails"),
        F.countDistinct("external_recipient").alias("distinct_addresses"),
        F.countDistinct(F.when(pre, F.col("email_id"))).alias("predisclosure_emails"),
        F.countDistinct(F.when(pre, F.col("external_recipient"))).alias("predisclosure_addresses"))


def leak_domains(leak: DataFrame, k: int = 6) -> DataFrame:
    """Distinct messages per external domain, top k, ties by domain."""
    return (leak.groupBy("external_domain").agg(F.countDistinct("email_id").alias("n"))
                .orderBy(F.desc("n"), "external_domain").limit(k))


def leak_domain_rows(leak: DataFrame, k: int = 12) -> DataFrame:
    """P5: row counts per external domain, top k, ties by domain."""
    return (leak.groupBy("external_domain").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.desc("n"), "external_domain").limit(k))
