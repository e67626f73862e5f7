"""Bucketed tables: the same rows, no exchange in the join, only the window's folders."""

import datetime as dt

from casefile.operators import staging
from casefile.sources import colocated as C


def test_join_without_exchange_and_pruned_folders(spark, tmp_path):
    day = lambda i: None if i % 13 == 0 else dt.date(1995 + i % 7, 1 + i % 12, 1 + i % 28)
    emails = spark.createDataFrame([(i, f"m{i}", f"s{i % 9}", day(i), "body " * 50) for i in range(500)],
                                   "id long, msg_id string, sender string, sent_at date, body string")
    edges = spark.createDataFrame([(i % 500, f"s{i % 9}", day(i % 500), f"r{i}") for i in range(1500)],
                                  "email_id long, sender string, sent_at date, recipient string")
    messages, recipients = C.lay_out(spark, emails, edges, str(tmp_path), 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        join = staging.message_recipient_join(messages.select("id", "msg_id", "sender", "sent_at"), recipients.select("email_id", "addr"))
        plan = join._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
        want = staging.message_recipient_join(emails.select("id", "msg_id", "sender", "sent_at"),
                                              edges.selectExpr("email_id", "recipient AS addr"))
        assert join.count() == 1500 and join.exceptAll(want).count() == want.exceptAll(join).count() == 0
        window = C.in_window("1996-03-01", "1997-02-15")
        some = staging.message_recipient_join(messages.filter(window).select("id", "msg_id", "sender", "sent_at"),
                                              recipients.filter(window).select("email_id", "addr"))
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "PartitionFilters: [isnotnull(sent_year" in plan
        lo, hi = dt.date(1996, 3, 1), dt.date(1997, 2, 15)
        assert some.count() == 3 * sum(1 for i in range(500) if day(i) and lo <= day(i) <= hi)
        assert {f.split("sent_year=")[1][:4] for f in messages.filter(window).inputFiles() if "sent_year=" in f} >= {"1996", "1997"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
