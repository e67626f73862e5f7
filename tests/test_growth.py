"""What must not grow with the input: broadcasts, a task's rows, what a lookup or a hop shuffles."""

import datetime as dt

from pyspark.sql import functions as F

from casefile import session
from casefile.operators import ledger, phrase_lexicon, review


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_join_is_broadcast_for_the_size_of_its_files(spark, tmp_path):
    spark.range(300_000).withColumn("name", F.lit("one name in all rows")).write.parquet(f"{tmp_path}/t")
    session.ensure_session_settings(spark)
    t = spark.read.parquet(f"{tmp_path}/t")
    assert "BroadcastHashJoin" not in _plan(spark.range(10).join(t, "id"))
    assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") != "-1"


def test_shuffles_have_partitions_for_the_input(spark, tmp_path, monkeypatch):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                                                   "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    (tmp_path / "a.parquet").write_bytes(b"x" * 3000)
    (tmp_path / "b.parquet").mkdir()
    (tmp_path / "b.parquet" / "part-0.parquet").write_bytes(b"x" * 2000)
    try:
        monkeypatch.setattr(session, "PARTITION_INPUT", 100)
        session.size_shuffles(spark, str(tmp_path))
        assert session.partitions(spark) == 50
        monkeypatch.setattr(session, "PARTITION_INPUT", 100_000)
        session.size_shuffles(spark, str(tmp_path))
        assert session.partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keys_meet_the_names_that_hold_them_alone(spark):
    long = "abc" * 40
    names = [f"set{i:04d}" for i in range(300)] + [long, long[:70] + "!", "ab", "", None]
    sets = spark.createDataFrame([(n, n) for n in names], "entity string, hunt string")
    keys = [f"set{i:04d}" for i in range(300)] + ["set", "et0", "ab", "b", long, long[:66], long[:64] + "?", "", None]
    got = {r.key: r.n_matches for r in review.resolve_finding_keys(
        spark.createDataFrame([(k,) for k in keys], "key string"), sets, hunt_col="hunt").collect()}
    assert got == {k: len({n for n in names if k and n and k in n}) for k in keys}


def test_a_hop_reads_the_graph_without_an_exchange(spark, monkeypatch):
    io = spark.createDataFrame([(f"j{i}", d, f"d{i + (d == 'out')}") for i in range(6) for d in ("in", "out")],
                               "job string, direction string, dataset string")
    made = []
    plain = ledger._bucketed
    monkeypatch.setattr(ledger, "_bucketed", lambda df, key: made.append((plain(df, key), key)) or made[-1][0])
    got = {(r.dataset, r.depth, r.job) for r in ledger.lineage_walk_jobs(io, "d6").collect()}
    assert got == {("d6", 0, None), *((f"d{i}", 6 - i, f"j{i}") for i in range(6))}
    table, key = made[0]
    joined = spark.createDataFrame([("d1",)], "dataset string").join(table.hint("merge"), F.col("dataset") == F.col(key))
    assert _plan(joined).count("Exchange hashpartitioning") == 1


def test_few_words_meet_the_entries(spark):
    entries = phrase_lexicon.entries(spark.createDataFrame([("red fox",), ("red fox hunt",), ("one",)], "entity string"))
    emails = spark.createDataFrame([(1, "Red  fox", "hunt; red dog one"), (2, None, "red"), (3, "", None)],
                                   "id long, subject string, body string")
    found = phrase_lexicon.occurrences(emails, entries)
    assert {(r.id, r.entity, r.pos) for r in found.collect()} == {(1, "red fox", 0), (1, "red fox hunt", 0), (1, "one", 5)}
    # the words of a place are joined once, as a whole: no exchange by their first word
    assert "Exchange hashpartitioning(first" not in _plan(found.select("id"))


def test_emails_do_not_wait_for_the_recipient_lists(spark, sf_small):
    from casefile.sources.warehouse import Warehouse
    emails = _plan(Warehouse(spark, sf_small, materialize=False).emails().select("id", "subject", "body", "sent_at"))
    assert "orders.parquet" in emails and "lineitem.parquet" not in emails and "collect_list" not in emails


def test_buckets_are_made_without_a_second_exchange(spark, sf_small):
    from casefile.functions.text import safe_date
    from casefile.sources import testdata
    assert _plan(testdata.message_headers(spark, sf_small, 9)).count("Exchange hashpartitioning") == 2  # orders, documents
    lines = _plan(testdata.message_lines(spark, sf_small, safe_date, 9))
    assert lines.count(", 9), REPARTITION") == 2 and lines.count("Exchange hashpartitioning") == 4  # the suppliers' join too
    # a date is parsed once a message, before the lines
    assert lines.index("regexp_extract") > lines.index("SortMergeJoin")


def test_no_message_is_shuffled_by_its_week(spark):
    from casefile.operators import comms
    days = [dt.date(2000, 1, 3) + dt.timedelta(days=i % 21) for i in range(60)]
    emails = spark.createDataFrame([(i, f"m{i}", "a@x", d, "s", "body", "b", "f") for i, d in enumerate(days)],
                                   "id long, msg_id string, sender string, sent_at date, subject string, body string, mailbox string, folder string")
    recipients = spark.createDataFrame([(i, "b@x") for i in range(60)], "email_id long, addr string")
    registry = spark.createDataFrame([("a@x", "A"), ("b@x", "B")], "addr string, dept string")
    weeks = spark.createDataFrame([(dt.date(2000, 1, 10),), (dt.date(2000, 1, 10),), (None,)], "week date")
    out = comms.hunt_exhibits(emails, recipients, registry, group_a=["A"], group_b=["B"], weeks=weeks)
    assert "Exchange hashpartitioning(_week" not in _plan(out).split("BroadcastExchange")[0]
    assert {r.msg_id for r in out.collect()} == {f"m{i}" for i, d in enumerate(days) if dt.date(2000, 1, 10) <= d < dt.date(2000, 1, 17)}


def test_no_place_of_an_entry_is_shuffled(spark):
    entities = spark.createDataFrame([("red fox",), ("red fox hunt",), ("one",)], "entity string")
    emails = spark.createDataFrame([(i, f"s{i}", "Red  fox", "hunt; red fox one " * 3) for i in range(9)], "id long, sender string, subject string, body string")
    before = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")  # a lexicon that is too large to be sent
    try:
        out = phrase_lexicon.table_mentions(emails, phrase_lexicon.entries(entities), keep=("id", "sender"))
        assert sorted((r.id, r.sender, r.entity) for r in out.collect()) == [
            (i, f"s{i}", e) for i in range(9) for e in ("one", "red fox", "red fox hunt")]
        assert "Exchange" not in _plan(out)
        dealt = phrase_lexicon.table_mentions(emails, phrase_lexicon.entries(entities), keep=("id", "sender"), dealt=True)
        assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, out.collect()))
        # a row a message is dealt by its id, and meets what is dealt by it
        joined = _plan(dealt.join(spark.range(9).hint("merge"), "id"))
        assert joined.count("Exchange hashpartitioning(id") == 2 and joined.index("Generate explode(phrases") < joined.index("REPARTITION_BY_COL")
    finally:
        if before is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", before)
