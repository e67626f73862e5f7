"""Review state and incidents derived from an append-only tag-event log
(L6-L13).

Tag events: (event_id, at, entity, category, operation, modifier, actor, note).
A finding is recorded or reopened -> `pending-review`; accept -> `confirmed`;
reject -> `rejected`.  Only ADD events change the state: a REMOVE takes a tag
away beside the ADD of another, and is no verdict.  A verdict is legal only
from pending (C16), so over the entity's state events ordered by (at, event_id)
a verdict is effective iff the previous state event is a pending one.  A
pending event reopens iff the previous *legal* event (pending, or an effective
verdict) is a verdict, which is then the state it leaves.  Previous events come
from `segmented_prev`, which sorts slices of bounded size, so a hot entity is
not one task, however its events lie in time.  Final states use aggregations
only (last pending, first verdict after it).

Incidents (C17): an effective accept raises on each implicated asset, an
effective reject or a reopen resolves.  Over the actions of a finding a raise
is new iff the previous action is absent or a resolve, and a resolve is
effective iff the previous action is a raise.  All assets of a finding see the
same actions, under the finding's own title: effects and intervals are decided
once a finding, and only what comes of them meets the assets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions.sequence import segmented_prev
from casefile.functions.text import short_name

PENDING, CONFIRMED, REJECTED = "pending-review", "confirmed", "rejected"
VERDICTS = (CONFIRMED, REJECTED)
LIST_PRECEDENCE = (PENDING, CONFIRMED, REJECTED)
BOARD_PRECEDENCE = (CONFIRMED, REJECTED, PENDING)


def _pos() -> Column:
    return F.struct("at", "event_id")


def state_log(tag_events: DataFrame) -> DataFrame:
    """(entity, event_id, at, kind, actor, note) for the state-changing tag events."""
    tag = short_name("modifier")
    return (tag_events.filter((F.col("category") == "TAG") & (F.col("operation") == "ADD")
                              & tag.isin(PENDING, *VERDICTS))
                      .select("entity", "event_id", "at", tag.alias("kind"), "actor", "note"))


def with_previous(log: DataFrame) -> DataFrame:
    """Adds `prev_kind`: the entity's previous state event."""
    return segmented_prev(log, ["entity"], ["at", "event_id"], ["kind"])


def annotated_log(tag_events: DataFrame) -> DataFrame:
    """The state events, each with `effective` (a verdict right after a pending
    event) and `from_state` (the verdict that a pending event reopens, else
    null).  Verdict, reopen and incident views all project from it; write it
    once where several of them are asked."""
    p = with_previous(state_log(tag_events))
    p = p.withColumn("effective", F.col("kind").isin(*VERDICTS)
                     & F.coalesce(F.col("prev_kind") == PENDING, F.lit(False))).drop("prev_kind")
    legal = with_previous(p.filter((F.col("kind") == PENDING) | F.col("effective")))
    state = F.when((F.col("kind") == PENDING) & F.col("prev_kind").isin(*VERDICTS), F.col("prev_kind"))
    cols = ["entity", "event_id", "at", "kind", "actor", "note", "effective"]
    refused = p.filter((F.col("kind") != PENDING) & ~F.col("effective"))
    return (legal.select(*cols, state.alias("from_state"))
                 .unionByName(refused.select(*cols, F.lit(None).cast("string").alias("from_state"))))


def verdicts(annotated: DataFrame) -> DataFrame:
    """Every verdict with its reviewer, time and note, and `effective`."""
    return (annotated.filter(F.col("kind").isin(*VERDICTS))
                     .select("event_id", "entity", F.col("at").cast("timestamp_ntz").alias("at"),
                             F.col("kind").alias("verdict"), F.col("actor").alias("reviewer"), "note", "effective"))


def refused_verdicts(annotated: DataFrame) -> DataFrame:
    """The verdicts that were not legal: nothing was pending."""
    return verdicts(annotated).filter(~F.col("effective")).drop("effective")


def reopens(annotated: DataFrame) -> DataFrame:
    """Pending events that reopen a reviewed finding; `from_state` is the
    effective verdict they undo."""
    return (annotated.filter(F.col("from_state").isNotNull())
                     .select("event_id", "entity", F.col("at").cast("timestamp_ntz").alias("at"), "from_state"))


def apply_verdict(tag_events: DataFrame) -> DataFrame:
    return verdicts(annotated_log(tag_events))


def reopen_finding(tag_events: DataFrame) -> DataFrame:
    return reopens(annotated_log(tag_events))


def review_states(tag_events: DataFrame, precedence: Sequence[str] = BOARD_PRECEDENCE) -> DataFrame:
    """Current state per entity: the first verdict after the last pending
    event, else pending; `unknown` when no pending event ever happened.

    With a totally ordered log exactly one state holds at a time; `precedence`
    only orders the ranking column `state_rank` used by list and board views.
    """
    log = state_log(tag_events)
    last_p = (log.filter(F.col("kind") == PENDING)
                 .groupBy("entity").agg(F.max(_pos()).alias("_lp")))
    after = (log.filter(F.col("kind").isin(*VERDICTS)).join(last_p, "entity")
                .filter(_pos() > F.col("_lp"))
                .groupBy("entity").agg(F.min_by(F.struct("kind", "at"), _pos()).alias("_v")))
    ents = log.groupBy("entity").agg(F.count(F.lit(1)).alias("state_events"))
    out = ents.join(last_p, "entity", "left").join(after, "entity", "left")
    state = (F.when(F.col("_v").isNotNull(), F.col("_v.kind"))
              .when(F.col("_lp").isNotNull(), F.lit(PENDING))
              .otherwise(F.lit("unknown")))
    at = F.when(F.col("_v").isNotNull(), F.col("_v.at")).otherwise(F.col("_lp.at"))
    rank = F.coalesce(*[F.when(state == s, F.lit(i)) for i, s in enumerate(precedence)],
                      F.lit(len(precedence)))
    return out.select("entity", state.alias("state"), at.cast("timestamp_ntz").alias("state_at"),
                      "state_events", rank.alias("state_rank"))


#: Letters of the pieces that names are indexed by.
GRAM = 3
#: Letters of a longer key that it is looked up by, before it is compared.
LOOKED_UP = 64
#: Rows of the table that says which lengths are asked for behind a piece.
HASHES = 1 << 16


def _grams(text: Column, gram: int) -> Column:
    """The distinct pieces of `gram` characters; none of a shorter text."""
    n = F.char_length(text)
    return F.when(n >= gram, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(n - gram + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(gram))))
    ).otherwise(F.array().cast("array<string>"))


def resolve_finding_keys(keys: DataFrame, evidence_sets: DataFrame, key_col: str = "key",
                         name_col: str = "entity", hunt_col: str | None = None, gram: int = GRAM) -> DataFrame:
    """Each command key must be a substring of the name of exactly one
    evidence set, or of the id of its hunt if `hunt_col` gives it.

    Where a name has a piece of `gram` letters that keys begin with, as many
    letters are read off it as these keys have, and joined with the keys that
    they are: rows are matches, and no key meets a name only for a piece that
    the two share.  Of keys longer than LOOKED_UP the beginning is joined and
    the whole then compared; keys shorter than a piece are looked up in an
    index of all shorter pieces.  Names that several keys ask for and keys that
    many names hold are counted, not listed.  Output: key, n_matches,
    resolved, status; a null or empty key matches nothing.
    """
    k = keys.select(F.col(key_col).alias("key")).distinct()
    names = evidence_sets.select(F.col(name_col).alias("_set"), F.array_distinct(F.array_compact(F.array(
        F.col(name_col), *([F.col(hunt_col)] if hunt_col else [])))).alias("_texts")).distinct()
    texts = names.select("_set", F.explode("_texts").alias("_text"))
    short = F.char_length("key") < gram
    # long keys: as many letters as are asked for behind their first piece; the table has HASHES
    # rows at most, with lengths of no more than LOOKED_UP
    hashed = lambda piece: F.pmod(F.xxhash64(piece), F.lit(HASHES))
    long = k.filter(~short).withColumn("_look", F.substring("key", 1, max(LOOKED_UP, gram)))
    asked = (long.groupBy(hashed(F.substring("key", 1, gram)).alias("_hash"))
             .agg(F.collect_set(F.char_length("_look")).alias("_lengths")))
    places = F.explode(F.sequence(F.lit(1), F.char_length("_text") - gram + 1)).alias("_at")
    index = (texts.filter(F.char_length("_text") >= gram).select("_set", "_text", places)
             .withColumn("_hash", hashed(F.substring(F.col("_text"), F.col("_at"), F.lit(gram)))).join(F.broadcast(asked), "_hash")
             .select("_set", "_text", "_at", F.explode("_lengths").alias("_length"))
             .filter(F.col("_at") + F.col("_length") <= F.char_length("_text") + 1)
             .select("_set", "_text", F.substring(F.col("_text"), F.col("_at"), F.col("_length")).alias("_look")))
    found = index.join(long, "_look").filter(F.contains(F.col("_text"), F.col("key"))).select("key", "_set")
    # short keys: every piece of one letter to gram - 1, of which a name has gram - 1 times its letters
    pieces = F.array_distinct(F.flatten(F.array(*[_grams(F.col("_text"), n) for n in range(1, gram)]))) if gram > 1 else F.array()
    small = texts.select("_set", F.explode(pieces).alias("key")).join(k.filter(short), "key").select("key", "_set")
    hits = (found.unionByName(small).distinct().groupBy("key")
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_set").alias("_any")))
    m = (k.join(hits, "key", "left").withColumn("n_matches", F.coalesce("_n", F.lit(0))))
    status = (F.when(F.col("n_matches") == 1, F.lit("resolved"))
               .when(F.col("n_matches") == 0, F.lit("unmatched")).otherwise(F.lit("ambiguous")))
    return m.select("key", "n_matches",
                    F.when(F.col("n_matches") == 1, F.col("_any")).alias("resolved"),
                    status.alias("status"))


def implicated_assets(evidence: DataFrame, evidence_table: str) -> DataFrame:
    """Distinct `dataset` values of the flagged evidence rows, else the
    evidence set itself (D4)."""
    spark = evidence.sparkSession
    me = spark.createDataFrame([(evidence_table,)], "evidence_table string")
    if "dataset" not in evidence.columns:
        return me.withColumn("asset", F.col("evidence_table"))
    ev = evidence.filter(F.col("flagged")) if "flagged" in evidence.columns else evidence
    ds = (ev.filter(F.col("dataset").isNotNull()).select(F.col("dataset").alias("asset")).distinct()
            .select(F.lit(evidence_table).alias("evidence_table"), "asset"))
    none = (me.crossJoin(ds.agg(F.count(F.lit(1)).alias("_n"))).filter(F.col("_n") == 0)
              .select("evidence_table", F.col("evidence_table").alias("asset")))
    return ds.unionByName(none)


def incident_title(entity: Column) -> Column:
    return F.concat(F.lit("investigation: "), entity)


def finding_actions(tag_events: DataFrame, annotated: DataFrame | None = None) -> DataFrame:
    """(entity, title, action, at, event_id, message, effective): the raise and
    resolve actions of each finding, before they meet any asset."""
    a = annotated_log(tag_events) if annotated is None else annotated
    action = (F.when(F.col("from_state").isNotNull(), F.lit("resolve"))
               .when(F.col("effective") & (F.col("kind") == CONFIRMED), F.lit("raise"))
               .when(F.col("effective"), F.lit("resolve")))
    message = (F.when(F.col("from_state").isNotNull(), F.lit("reopened"))
                .otherwise(F.concat("kind", F.lit(" by "), "actor")))
    acts = (a.select("entity", "event_id", F.col("at").cast("timestamp_ntz").alias("at"), action.alias("action"),
                     message.alias("message")).filter(F.col("action").isNotNull()))
    return incident_effects(acts, ["entity"]).withColumn("title", incident_title(F.col("entity")))


def landed(actions: DataFrame, assets: DataFrame | None) -> DataFrame:
    """Rows of findings on the assets that these implicate, as `dataset`; a
    finding without a mapping lands on itself."""
    if assets is None:
        return actions.withColumn("dataset", F.col("entity")).drop("entity")
    return (actions.join(assets.select(F.col("evidence_table").alias("_of"), "asset"), F.col("entity") == F.col("_of"), "left")
                   .withColumn("dataset", F.coalesce("asset", "entity")).drop("_of", "asset", "entity"))


def incident_actions(tag_events: DataFrame, assets: DataFrame | None = None,
                     annotated: DataFrame | None = None) -> DataFrame:
    """Raise / resolve actions with `effective` and `message` per (dataset, title).

    `assets(evidence_table, asset)` maps a finding to the assets its incident
    lands on; findings without a mapping land on themselves.
    """
    return landed(finding_actions(tag_events, annotated), assets).select(
        "dataset", "title", "action", "at", "event_id", "message", "effective")


def incident_effects(actions: DataFrame, keys: Sequence[str] = ("dataset", "title")) -> DataFrame:
    """C17 over (keys..., action, at, event_id): a raise is effective iff the
    previous action is absent or a resolve; a resolve iff it is a raise."""
    p = segmented_prev(actions, list(keys), ["at", "event_id"], ["action"])
    eff = (F.when(F.col("action") == "raise",
                  F.col("prev_action").isNull() | (F.col("prev_action") == "resolve"))
            .otherwise(F.coalesce(F.col("prev_action") == "raise", F.lit(False))))
    return p.withColumn("effective", eff).drop("prev_action")


def incident_intervals(actions: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """(dataset, title, opened_at, opened_by, closed_at, closed_by, message):
    when each incident was open, from the finding's actions; closed_at, its
    event and message are null while it is.  An interval holds its beginning
    and not its end."""
    # effective actions alternate: the one before a resolve is its raise
    done = segmented_prev(actions.filter("effective"), ["entity"], ["at", "event_id"], ["at", "event_id"])
    closed = done.filter(F.col("action") == "resolve").select(
        "entity", "title", F.col("prev_at").alias("opened_at"), F.col("prev_event_id").alias("opened_by"),
        F.col("at").alias("closed_at"), F.col("event_id").alias("closed_by"), "message")
    last = actions.filter("effective").groupBy("entity", "title").agg(
        F.max_by(F.struct("action", "at", "event_id"), F.struct("at", "event_id")).alias("l"))
    still = last.filter(F.col("l.action") == "raise").select(
        "entity", "title", F.col("l.at").alias("opened_at"), F.col("l.event_id").alias("opened_by"),
        F.lit(None).cast("timestamp_ntz").alias("closed_at"), F.lit(None).cast("long").alias("closed_by"),
        F.lit(None).cast("string").alias("message"))
    return landed(closed.unionByName(still), assets).select(
        "dataset", "title", "opened_at", "opened_by", "closed_at", "closed_by", "message")


def incidents_as_of(intervals: DataFrame, at: str) -> DataFrame:
    """The incidents that were open at one time."""
    t = F.lit(at).cast("timestamp_ntz")
    return (intervals.filter((F.col("opened_at") <= t) & (F.col("closed_at").isNull() | (F.col("closed_at") > t)))
                     .select("dataset", "title", "opened_at"))


def open_incidents_by_day(intervals: DataFrame) -> DataFrame:
    """(day, opened, closed, still_open): of every day with a change.  Days are
    summed up first, so the running sum is over a row a day."""
    day = lambda c: F.to_date(F.col(c)).alias("day")
    moves = (intervals.groupBy(day("opened_at")).agg(F.count(F.lit(1)).alias("opened")).withColumn("closed", F.lit(0).cast("long"))
             .unionByName(intervals.filter(F.col("closed_at").isNotNull()).groupBy(day("closed_at"))
                          .agg(F.count(F.lit(1)).alias("closed")).withColumn("opened", F.lit(0).cast("long"))))
    days = moves.groupBy("day").agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return days.withColumn("still_open", F.sum(F.col("opened") - F.col("closed")).over(upto))


def raise_incidents(actions: DataFrame) -> DataFrame:
    """New incidents (no ACTIVE one with the same title on the asset)."""
    return actions.filter((F.col("action") == "raise") & F.col("effective")).drop("action", "effective")


def resolve_incidents(actions: DataFrame) -> DataFrame:
    """Resolutions that close an ACTIVE incident."""
    return actions.filter((F.col("action") == "resolve") & F.col("effective")).drop("action", "effective")


def active_incidents(actions: DataFrame) -> DataFrame:
    """(dataset, title) whose latest action is a raise."""
    last = (actions.groupBy("dataset", "title")
                   .agg(F.max_by(F.struct("action", "at"), F.struct("at", "event_id")).alias("_l")))
    return (last.filter(F.col("_l.action") == "raise")
                .select("dataset", "title", F.col("_l.at").alias("raised_at")))
