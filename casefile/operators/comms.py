"""Communication analytics: cross-group edges (J2, S5), weekly volume (G2),
fixed-baseline z-scores (G3, J5, A1), event distance (J6, J7), hunt 1 and its
exhibits (H1, H1x).

Plan shape: the edge table is joined twice to a de-duplicated group lookup
(addr -> in A / in B), once per endpoint, instead of four IN-subqueries.  The
lookup grows with the registry, so it carries no broadcast hint; AQE
broadcasts it when small and shuffles otherwise.  Everything after the weekly
sum is tiny (one row per week).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casefile.functions.stats import (is_integral, mean_from_sums, moment_sums, round_half_up,
                                      stddev_from_sums)
from casefile.functions.text import message_excerpt, week_bucket


def group_lookup(registry: DataFrame, group_a: Sequence[str], group_b: Sequence[str],
                 dept_col: str = "dept") -> DataFrame:
    """addr -> (in_a, in_b); one row per address even if the registry repeats it."""
    d = F.col(dept_col)
    return (registry.filter(d.isin(*group_a) | d.isin(*group_b))
                    .groupBy("addr")
                    .agg(F.max(d.isin(*group_a)).alias("in_a"),
                         F.max(d.isin(*group_b)).alias("in_b")))


def cross_group_filter(df: DataFrame, registry: DataFrame, group_a: Sequence[str],
                       group_b: Sequence[str], sender: str = "sender",
                       recipient: str = "recipient") -> DataFrame:
    """Keep rows whose (sender, recipient) go A->B or B->A; adds `sender_in_a`."""
    g = group_lookup(registry, group_a, group_b)
    s = g.select(F.col("addr").alias("_s_addr"), F.col("in_a").alias("_s_a"), F.col("in_b").alias("_s_b"))
    r = g.select(F.col("addr").alias("_r_addr"), F.col("in_a").alias("_r_a"), F.col("in_b").alias("_r_b"))
    j = (df.join(s, F.col(sender) == F.col("_s_addr"))
           .join(r, F.col(recipient) == F.col("_r_addr")))
    cond = (F.col("_s_a") & F.col("_r_b")) | (F.col("_s_b") & F.col("_r_a"))
    return (j.filter(cond)
             .withColumn("sender_in_a", F.col("_s_a"))
             .drop("_s_addr", "_s_a", "_s_b", "_r_addr", "_r_a", "_r_b"))


def cross_group_edges(edges: DataFrame, registry: DataFrame, group_a: Sequence[str],
                      group_b: Sequence[str]) -> DataFrame:
    """The edges between the two groups, both directions."""
    return cross_group_filter(edges, registry, group_a, group_b).drop("sender_in_a")


def cross_group_volume(edges: DataFrame, registry: DataFrame, group_a: Sequence[str],
                       group_b: Sequence[str]) -> DataFrame:
    """(week, vol) summed over the cross-group edges."""
    x = cross_group_edges(edges, registry, group_a, group_b)
    return x.groupBy("week").agg(F.sum("n").cast("long").alias("vol"))


def baseline_stats(series: DataFrame, value: str, key: str, lo: str, hi: str) -> DataFrame:
    """Global mean and sample stddev over the baseline window; always one row.

    Integer volumes use exact integer moments (merge-order independent).  The
    window is a condition inside the aggregate rather than a filter below it:
    the series subtree then stays identical to the one the z-scores read, and
    AQE reuses its shuffle stage instead of recomputing the series join.
    """
    k = F.col(key)
    inside = (k >= F.lit(lo).cast("date")) & (k <= F.lit(hi).cast("date"))
    if is_integral(series.schema[value].dataType):
        return series.agg(*moment_sums(value, inside)).select(mean_from_sums().alias("mu"),
                                                              stddev_from_sums().alias("sigma"))
    v = F.when(inside, F.col(value))
    return series.agg(F.avg(v).alias("mu"), F.stddev_samp(v).alias("sigma"))


def zscore_fixed_baseline(series: DataFrame, value: str = "vol", key: str = "week", *,
                          baseline: tuple[str, str], flag_from: str, z: float = 2.0,
                          densify: bool = False) -> DataFrame:
    """A1 (J5 + G3): z = (v - mu) / sigma against a fixed baseline window.

    sigma = 0 or a baseline of fewer than two points gives z NULL (never
    flagged).  `zscore` is rounded to 2 places, the flag uses the unrounded
    value (C7).  Weeks without traffic are absent and stay absent unless
    `densify` (C6).
    """
    if densify:
        bounds = series.agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
        grid = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 7 DAYS"))).alias(key))
        series = grid.join(series, key, "left").fillna({value: 0})
    stats = baseline_stats(series, value, key, *baseline)
    raw_z = F.try_divide(F.col(value) - F.col("mu"), F.col("sigma"))
    # one-row stats: a fixed bound, broadcast nested-loop join
    return (series.crossJoin(F.broadcast(stats))
                  .select("*", raw_z.alias("_z"))
                  .withColumn("zscore", round_half_up(F.col("_z"), 2))
                  .withColumn("flagged", (F.col("_z") >= z) & (F.col(key) >= F.lit(flag_from).cast("date")))
                  .drop("_z", "mu", "sigma"))


def nearest_event_days(df: DataFrame, date_col: str, events: DataFrame,
                       event_col: str = "event_date", name: str = "days_to_event") -> DataFrame:
    """Min |days| from `date_col` to any event.

    The days between the first and the last event get their distances from the
    event before and the one after, by windows over a calendar; a row looks its
    day up there.  Days outside are as far as the first or the last event is.
    The calendar is bounded by its years (36.5k days a century), whatever the
    size of the event table or of `df`; no row walks the events.
    """
    ev = events.select(F.col(event_col).cast("date").alias("_day")).filter("_day is not null").distinct()
    ends = ev.agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"))  # one row
    days = ends.filter("_first is not null").select(F.explode(F.sequence("_first", "_last")).alias("_day"))
    marked = days.join(ev.withColumn("_event", F.col("_day")), "_day", "left")
    upto = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.orderBy("_day").rowsBetween(0, Window.unboundedFollowing)
    near = marked.select("_day", F.least(F.datediff("_day", F.last("_event", True).over(upto)),
                                         F.datediff(F.first("_event", True).over(after), "_day")).alias("_near"))
    d = F.col(date_col).cast("date")
    outside = F.least(F.abs(F.datediff(d, "_first")), F.abs(F.datediff(d, "_last")))
    return (df.crossJoin(F.broadcast(ends)).join(F.broadcast(near), d == F.col("_day"), "left")
              .withColumn(name, F.coalesce("_near", outside).cast("long"))
              .drop("_day", "_near", "_first", "_last"))


def first_event_scalar(df: DataFrame, date_col: str, events: DataFrame,
                       event_col: str = "event_date", name: str = "days_before_disclosure") -> DataFrame:
    """Days from `date_col` to the earliest event (uncorrelated scalar)."""
    first = events.agg(F.min(event_col).alias("_first"))
    return (df.crossJoin(F.broadcast(first))
              .withColumn(name, F.datediff(F.col("_first"), F.col(date_col)).cast("long"))
              .drop("_first"))


def hunt_comm_spikes(edges: DataFrame, registry: DataFrame, events: DataFrame, *,
                     group_a: Sequence[str], group_b: Sequence[str],
                     baseline: tuple[str, str], flag_from: str, z: float = 2.0,
                     window: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """H1: cross-group weekly volume, z against the baseline, event distance, flag.

    Output: week, vol, zscore, days_to_event, flagged.
    """
    series = cross_group_volume(edges, registry, group_a, group_b)
    scored = zscore_fixed_baseline(series, "vol", "week", baseline=baseline,
                                   flag_from=flag_from, z=z)
    lo, hi = window
    if lo is not None:
        scored = scored.filter(F.col("week") >= F.lit(lo).cast("date"))
    if hi is not None:
        scored = scored.filter(F.col("week") <= F.lit(hi).cast("date"))
    out = nearest_event_days(scored, "week", events)
    return out.select("week", "vol", "zscore", "days_to_event", "flagged")


def hunt_exhibits(emails: DataFrame, recipients: DataFrame, registry: DataFrame, *,
                  group_a: Sequence[str], group_b: Sequence[str],
                  weeks: DataFrame | Sequence[str], labels: tuple[str, str] = ("A -> B", "B -> A"),
                  excerpt_len: int = 500) -> DataFrame:
    """H1x: the individual cross-group messages behind the given week(s).

    `weeks` is a list of week starts or a DataFrame with a `week` column (e.g.
    the flagged rows of H1).  The week filter runs before the recipient join,
    and the body is touched only for the surviving messages.  Weeks are of a
    calendar (53 a year at most, whatever the input) and are broadcast: no
    message is shuffled by its week, of which a few have all messages.
    """
    e = emails.filter(F.col("sent_at").isNotNull()).withColumn("_week", week_bucket("sent_at"))
    if isinstance(weeks, DataFrame):
        e = e.join(F.broadcast(weeks.select(F.col("week").alias("_week")).distinct()), "_week", "left_semi")
    else:
        e = e.filter(F.col("_week").isin(*[F.lit(w).cast("date") for w in weeks]))
    j = e.join(recipients.select("email_id", "addr"), e.id == recipients.email_id)
    x = cross_group_filter(j, registry, group_a, group_b, sender="sender", recipient="addr")
    direction = F.when(F.col("sender_in_a"), F.lit(labels[0])).otherwise(F.lit(labels[1]))
    return x.select("msg_id", "sent_at", "sender", F.col("addr").alias("recipient"),
                    direction.alias("direction"), "subject",
                    message_excerpt("body", excerpt_len).alias("excerpt"), "mailbox", "folder")


def direction_label(sender_in_a: Column, labels: tuple[str, str]) -> Column:
    """T5: CASE on membership of the sender in group A."""
    return F.when(sender_in_a, F.lit(labels[0])).otherwise(F.lit(labels[1]))
