"""Message staging (S1, T1), filters (F1-F4) and the message x recipient
operators (J1, G1).

`raw` is the raw message table: id, msg_id, sender, date (text), subject, body,
mailbox, folder, recipients (comma list).  Staging is narrow (no shuffle):
typed emails and exploded recipients both come from one pass over `raw`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.functions.text import (any_substring, safe_date, unicode_trim,
                                     week_bucket)

EMAIL_COLUMNS = ("id", "msg_id", "sender", "sent_at", "subject", "body", "mailbox", "folder")


def stage_messages(raw: DataFrame, more: Iterable[str] = ()) -> DataFrame:
    """Typed emails; unparseable dates become NULL, every row is kept.
    `more` names raw columns to keep beside."""
    return raw.select("id", "msg_id", "sender", safe_date("date").alias("sent_at"),
                      "subject", "body", "mailbox", "folder", *more)


def _recipient_tokens(raw: DataFrame, sep: str, keep: Iterable[str]) -> DataFrame:
    keep = list(keep)
    exploded = (raw.filter(F.col("recipients").isNotNull())
                   .select(*keep, F.explode(F.split("recipients", sep)).alias("_tok")))
    addr = unicode_trim("_tok")
    return (exploded.select(*keep, addr.alias("addr"))
                    .filter((F.col("addr") != "") & F.col("addr").contains("@")))


def explode_recipients(raw: DataFrame, sep: str = ",") -> DataFrame:
    """One row per trimmed address; NULL lists, empty tokens and tokens
    without `@` are dropped, duplicates kept."""
    return _recipient_tokens(raw, sep, ["id"]).withColumnRenamed("id", "email_id")


def message_recipient_join(emails: DataFrame, recipients: DataFrame) -> DataFrame:
    """Inner equi-join of messages and recipients on the message id."""
    return emails.join(recipients, emails.id == recipients.email_id, "inner").drop("email_id")


def weekly_edges(emails: DataFrame, recipients: DataFrame) -> DataFrame:
    """G1: messages per (sender, recipient, week); NULL dates excluded,
    duplicate recipients counted twice (C12)."""
    e = emails.filter(F.col("sent_at").isNotNull()).select("id", "sender", "sent_at")
    j = e.join(recipients.select("email_id", "addr"), e.id == recipients.email_id)
    return (j.groupBy("sender", F.col("addr").alias("recipient"),
                      week_bucket("sent_at").alias("week"))
             .agg(F.count(F.lit(1)).alias("n")))


def weekly_edges_from_edges(edges: DataFrame) -> DataFrame:
    """G1 over (email_id, sender, sent_at, recipient) rows: the same table without the join."""
    return (edges.filter(F.col("sent_at").isNotNull())
                 .groupBy("sender", "recipient", week_bucket("sent_at").alias("week"))
                 .agg(F.count(F.lit(1)).alias("n")))


# ----------------------------------------------------------------- filters

def date_window_filter(df: DataFrame, col: str, lo: str | None, hi: str | None) -> DataFrame:
    """inclusive window; NULL dates never pass."""
    c = F.col(col)
    cond = c.isNotNull()
    if lo is not None:
        cond = cond & (c >= F.lit(lo).cast("date"))
    if hi is not None:
        cond = cond & (c <= F.lit(hi).cast("date"))
    return df.filter(cond)


def keyword_prefilter(df: DataFrame, words: Iterable[str], subject: str = "subject",
                      body: str = "body") -> DataFrame:
    """any word as a case-insensitive substring of subject or of body; a
    word that only the two joined would form does not count."""
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    words = list(words)
    return df.filter(any_substring(low(subject), words) | any_substring(low(body), words))


def is_internal(addr: str | Column, suffix: str) -> Column:
    a = F.col(addr) if isinstance(addr, str) else addr
    return F.lower(a).endswith(suffix.lower())


def external_recipients(df: DataFrame, suffix: str, col: str = "addr") -> DataFrame:
    """not ending in the internal suffix (case-insensitive) and containing `@`;
    sub-domains of the company count as external."""
    return df.filter(~is_internal(col, suffix) & F.col(col).contains("@"))


def exclude_evidence_datasets(df: DataFrame, col: str = "dataset",
                              prefix: str = "analytics.") -> DataFrame:
    """drop evidence sets from estate audits."""
    return df.filter(~F.col(col).startswith(prefix))


def evidence_datasets(df: DataFrame, col: str = "dataset", prefix: str = "analytics.") -> DataFrame:
    """F4 inverse: only the evidence sets."""
    return df.filter(F.col(col).startswith(prefix))
