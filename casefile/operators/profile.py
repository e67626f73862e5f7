"""Profiles and board/report queries.

Every report is an aggregation; top-k reports use `orderBy().limit()` with a
tie-breaker (TakeOrderedAndProject keeps only k rows per partition).  Lists
that could grow with the data are returned as rows, not collected into one
value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_range_profile(emails: DataFrame, lo: str, hi: str, col: str = "sent_at") -> DataFrame:
    """One row — rows, min/max date, NULL dates, dates outside [lo, hi]."""
    c = F.col(col)
    out = (c < F.lit(lo).cast("date")) | (c > F.lit(hi).cast("date"))
    return emails.agg(F.count(F.lit(1)).alias("rows"), F.min(c).alias("min_date"),
                      F.max(c).alias("max_date"), F.count_if(c.isNull()).alias("null_dates"),
                      F.count_if(out).alias("outside_range"))


def bad_date_senders(emails: DataFrame, lo: str, hi: str, col: str = "sent_at") -> DataFrame:
    """Per sender, messages with a NULL or implausible date (only senders with any)."""
    c = F.col(col)
    bad = c.isNull() | (c < F.lit(lo).cast("date")) | (c > F.lit(hi).cast("date"))
    return (emails.groupBy("sender")
                  .agg(F.count_if(bad).alias("bad_dates"), F.count(F.lit(1)).alias("messages"))
                  .filter(F.col("bad_dates") > 0))


def registry_distribution(registry: DataFrame) -> DataFrame:
    """Registry rows per department."""
    return registry.groupBy("dept").agg(F.count(F.lit(1)).alias("n"))


def unregistered_senders(emails: DataFrame, recipients: DataFrame, registry: DataFrame,
                         min_count: int = 1) -> DataFrame:
    """Active senders / recipients missing from the registry, with counts."""
    reg = registry.select("addr").distinct()
    s = (emails.filter(F.col("sender").isNotNull())
               .groupBy(F.col("sender").alias("addr")).agg(F.count(F.lit(1)).alias("n"))
               .withColumn("role", F.lit("sender")))
    r = (recipients.groupBy("addr").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("role", F.lit("recipient")))
    both = s.unionByName(r).filter(F.col("n") >= min_count)
    return both.join(reg, "addr", "left_anti").select("role", "addr", "n")


def top_senders(df: DataFrame, col: str, k: int = 10, role: str | None = None) -> DataFrame:
    """K2: messages per address, top k, ties by address."""
    out = (df.groupBy(F.col(col).alias("addr")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "addr").limit(k))
    return out.withColumn("role", F.lit(role or col))


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table (one aggregate per table, unioned)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def exhibit_counts(exhibits: DataFrame) -> DataFrame:
    """Rows, distinct messages, recipients and senders."""
    return exhibits.agg(F.count(F.lit(1)).alias("edges"),
                        F.countDistinct("msg_id").alias("distinct_messages"),
                        F.countDistinct("recipient").alias("distinct_recipients"),
                        F.countDistinct("sender").alias("distinct_senders"))


def exhibit_members(exhibits: DataFrame) -> DataFrame:
    """The distinct sender / recipient lists, as rows (role, addr)."""
    s = exhibits.select(F.lit("sender").alias("role"), F.col("sender").alias("addr"))
    r = exhibits.select(F.lit("recipient").alias("role"), F.col("recipient").alias("addr"))
    return s.unionByName(r).distinct()


def message_dossier(exhibits: DataFrame) -> DataFrame:
    """One row per message; recipients sorted and joined with ', '.

    The recipient list is per message (bounded by the message itself).
    """
    return (exhibits.groupBy("msg_id")
                    .agg(F.min("sent_at").alias("sent_at"), F.min("sender").alias("sender"),
                         F.array_join(F.array_sort(F.collect_set("recipient")), ", ").alias("recipients"),
                         F.min("subject").alias("subject"), F.min("excerpt").alias("excerpt")))


def flagged_peaks(spikes: DataFrame) -> DataFrame:
    """K1: flagged weeks with `is_peak` on the highest z (ties: earliest week)."""
    f = spikes.filter(F.col("flagged")).select("week", "vol", "zscore")
    peak = f.orderBy(F.desc("zscore"), "week").limit(1).select(F.col("week").alias("_peak"))
    return (f.join(F.broadcast(peak), F.col("week") == F.col("_peak"), "left")
             .withColumn("is_peak", F.col("_peak").isNotNull()).drop("_peak"))


def spike_series(spikes: DataFrame) -> DataFrame:
    """(week, vol, zscore) for plotting (order at the sink)."""
    return spikes.select("week", "vol", "zscore")


def flag_totals(evidence: Mapping[str, DataFrame]) -> DataFrame:
    """Flagged rows per governance evidence table."""
    parts = [df.agg(F.count_if(F.col("flagged")).alias("flagged"), F.count(F.lit(1)).alias("audited"))
               .select(F.lit(name).alias("evidence_table"), "flagged", "audited")
             for name, df in evidence.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def headline_stats(spikes: DataFrame, exhibits: DataFrame, flag_from: str) -> DataFrame:
    """Peak flagged week, its vol / z / days, the rounded mean before the
    flag window, and the exhibit edge / message counts — one row."""
    peak = (spikes.filter(F.col("flagged")).orderBy(F.desc("zscore"), "week").limit(1)
                  .select(F.col("week").alias("peak_week"), F.col("vol").alias("peak_volume"),
                          F.col("zscore").alias("peak_zscore"), "days_to_event"))
    base = (spikes.filter(F.col("week") < F.lit(flag_from).cast("date"))
                  .agg(F.round(F.avg("vol"), 0).alias("baseline_mean")))
    ex = exhibits.agg(F.count(F.lit(1)).alias("exhibit_edges"),
                      F.countDistinct("msg_id").alias("exhibit_messages"))
    return base.crossJoin(ex).join(peak, how="left")


def board_summary(evidence_rows: DataFrame, states: DataFrame) -> DataFrame:
    """Hunts, reviewed and confirmed evidence sets, total evidence rows.

    `evidence_rows(evidence_table, rows)`; `states(entity, state)`.
    """
    ev = evidence_rows.agg(F.count(F.lit(1)).alias("hunts"), F.sum("rows").cast("long").alias("evidence_rows"))
    st = states.agg(F.count(F.lit(1)).alias("reviewed"),
                    F.count_if(F.col("state") == "confirmed").alias("confirmed"))
    return ev.crossJoin(st)


def evidence_row_counts(evidence: Mapping[str, DataFrame]) -> DataFrame:
    return table_row_counts(evidence).withColumnRenamed("table", "evidence_table")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
