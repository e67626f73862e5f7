"""Messages and their recipients laid out for each other (J1, G1, H1x, H2).

Both tables are bucketed by message id, alike, and kept in folders by the year
they were sent: a join on the id reads bucket by bucket, without an exchange of
either side, and a window of dates reads its years' folders alone.  They are
external tables of the session's catalog over files in the shared folder.

`buckets` bounds how much of a table one task joins; a message's rows lie in
one bucket, and no message has a share of all recipients.  Messages without a
date are in a folder of their own (year 0), which no window reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR = "sent_year"


def bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, sent: str = "sent_at", dealt: bool = False) -> DataFrame:
    """`df` with its year, as a table bucketed by `key`; `dealt` if its
    partitions are by that key and as many already."""
    table = f"casefile_{name}_{uuid.uuid4().hex[:12]}"
    rows = df.withColumn(YEAR, F.coalesce(F.year(sent), F.lit(0)))
    ((rows if dealt else rows.repartition(buckets, key))
       .write.partitionBy(YEAR).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def in_window(lo: str, hi: str, sent: str = "sent_at") -> Column:
    """A window of dates that also names its years, so that folders are pruned."""
    first, last = F.lit(lo).cast("date"), F.lit(hi).cast("date")
    return (F.col(YEAR) >= int(lo[:4])) & (F.col(YEAR) <= int(hi[:4])) & F.col(sent).between(first, last)


def lay_out(spark: SparkSession, emails: DataFrame, edges: DataFrame, root: str, buckets: int,
            dealt: bool = False) -> tuple[DataFrame, DataFrame]:
    """(messages, recipients): `emails` by id, and (email_id, addr, sent_at) of
    the message edges by email_id; `dealt` as for `bucketed`."""
    lines = edges.select("email_id", F.col("recipient").alias("addr"), "sent_at")
    return (bucketed(emails, "messages", f"{root}/messages", "id", buckets, dealt=dealt),
            bucketed(lines, "recipients", f"{root}/recipients", "email_id", buckets, dealt=dealt))
