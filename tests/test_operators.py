"""Operator-level fixtures: z-scores, ownership, review / incidents, lineage,
gate, repeats, alerts, and the skew-safe sequence helpers."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from casefile.functions.sequence import segmented_prev, segmented_row_number, sliced
from casefile.operators import comms, gate, governance, ledger, review, transcripts
from casefile.streaming import alerts

D = dt.date


def series(spark, rows):
    return spark.createDataFrame(rows, "week date, vol long")


def zs(spark, rows, baseline=("2000-01-01", "2000-12-31"), flag_from="2001-01-01"):
    out = comms.zscore_fixed_baseline(series(spark, rows), baseline=baseline, flag_from=flag_from, z=2.0)
    return {r.week: (r.zscore, r.flagged) for r in out.collect()}


def test_zscore_degenerate_baselines(spark):
    # one baseline week -> stddev NULL; constant baseline -> sigma 0; empty baseline
    one = zs(spark, [(D(2000, 1, 3), 5), (D(2001, 1, 1), 50)])
    const = zs(spark, [(D(2000, 1, 3), 5), (D(2000, 1, 10), 5), (D(2001, 1, 1), 50)])
    empty = zs(spark, [(D(2001, 1, 1), 50)])
    for res in (one, const, empty):
        assert res[D(2001, 1, 1)][0] is None and not res[D(2001, 1, 1)][1]


def test_flag_uses_unrounded_z(spark):
    # baseline 0, 10 -> mu 5, sigma 7.0711; vol 19.11 would be z=1.996; use counts:
    rows = [(D(2000, 1, 3), 0), (D(2000, 1, 10), 10)]
    base = comms.baseline_stats(series(spark, rows), "vol", "week", "2000-01-01", "2000-12-31").first()
    v = base.mu + 1.996 * base.sigma
    df = spark.createDataFrame([(D(2001, 1, 1), float(v))], "week date, vol double").unionByName(
        spark.createDataFrame([(w, float(x)) for w, x in rows], "week date, vol double"))
    out = comms.zscore_fixed_baseline(df, baseline=("2000-01-01", "2000-12-31"), flag_from="2001-01-01")
    r = out.filter(F.col("week") == D(2001, 1, 1)).first()
    assert r.zscore == 2.0 and r.flagged is False


def test_sparse_weeks_not_densified(spark):
    s = series(spark, [(D(2000, 1, 3), 1), (D(2000, 1, 17), 3)])
    b = comms.baseline_stats(s, "vol", "week", "2000-01-01", "2000-12-31").first()
    assert b.mu == 2.0


def catalog(spark, owners, users, tags=(), terms=()):
    ds = spark.createDataFrame([("part.a",), ("part.b",), ("part.c",), ("analytics.z",)], "dataset string")
    ds = ds.select("dataset", F.lit("p").alias("platform"), F.lit("").alias("description"),
                   F.lit(None).cast("string").alias("domain"))
    mk = lambda rows: spark.createDataFrame(list(rows), "dataset string, value string")
    u = spark.createDataFrame(list(users), "username string, display_name string, title string, "
                                           "active boolean, email string")
    return ds, mk(owners), u, mk(tags), mk(terms)


def test_ownership_rules(spark):
    ds, owners, users, tags, terms = catalog(
        spark,
        owners=[("part.b", "u_null"), ("part.c", "imp")],
        users=[("u_null", "n", "t", None, "e"), ("imp", "i", "t", True, "e")],
        tags=[("part.a", "certified"), ("part.c", "certified")])
    out = governance.hunt_orphaned_ownership(ds, owners, users, tags, terms, implicated=["imp"],
                                             material_term="Material", cert_tag="certified")
    got = {r.dataset: (r.flagged, r.reason) for r in out.collect()}
    assert "analytics.z" not in got
    assert got["part.a"] == (True, "nobody owns it")      # no owner + certified: flagged
    assert got["part.b"] == (False, None)                    # active NULL, not implicated
    assert got["part.c"] == (False, None)                    # implicated but certified


def events(spark, kinds, entity="analytics.e"):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(hours=i), entity, "TAG", "ADD", f"urn:li:tag:{k}", "u", "")
            for i, k in enumerate(kinds)]
    return spark.createDataFrame(rows, alerts.EVENT_SCHEMA)


def test_verdict_only_from_pending(spark):
    ev = events(spark, ["pending-review", "confirmed", "confirmed"])
    got = [r.effective for r in review.apply_verdict(ev).orderBy("event_id").collect()]
    assert got == [True, False]
    st = review.review_states(ev).first()
    assert st.state == "confirmed"


def test_incident_windows(spark):
    # record, accept, accept, reopen, accept -> raise, (ignored), resolve, raise
    ev = events(spark, ["pending-review", "confirmed", "confirmed", "pending-review", "confirmed"])
    acts = review.incident_actions(ev).orderBy("event_id").collect()
    assert [(a.action, a.effective) for a in acts] == [("raise", True), ("resolve", True), ("raise", True)]
    active = review.active_incidents(review.incident_actions(ev)).collect()
    assert len(active) == 1


def test_incident_raise_resolve_idempotent(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("d", "t", a, t + dt.timedelta(minutes=i), i)
            for i, a in enumerate(["raise", "raise", "resolve", "resolve"])]
    acts = spark.createDataFrame(rows, "dataset string, title string, action string, at timestamp, "
                                       "event_id long")
    eff = [r.effective for r in review.incident_effects(acts).orderBy("event_id").collect()]
    assert eff == [True, False, True, False]
    assert review.active_incidents(acts).count() == 0
    assert review.active_incidents(acts.filter("event_id < 2")).count() == 1


def test_lineage_cycle_terminates(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a")], "upstream string, downstream string")
    got = {r.dataset: r.depth for r in ledger.lineage_walk(edges, "a", "up", 10).collect()}
    assert got == {"a": 0, "b": 1, "c": 1}
    down = {r.dataset: r.depth for r in ledger.lineage_walk(edges, "c", "down", 10).collect()}
    assert down == {"c": 0, "a": 1, "b": 2}


def test_gate_failures_do_not_vanish(spark):
    checks = spark.createDataFrame([("g.a", "1"), ("g.b", "2")], "check string, got string")
    want = gate.expectations_table(spark, {"g.a": "1", "g.b": "3", "g.c": "4"})
    res = {r.check: (r.ok, r.detail) for r in gate.value_gate(checks, want).collect()}
    assert res["g.a"] == (True, "")
    assert res["g.b"][0] is False and res["g.c"] == (False, "missing evidence")
    agg = gate.gate_assertions(gate.value_gate(checks, want)).first()
    assert (agg.passed, agg.n_ok, agg.n_all) == (False, 1, 3)


def test_repeat_rule(spark):
    reads = [(1, t, "run_sql", "run_sql|s") for t in range(5)]
    writes = [(2, t, "materialize_evidence", "m|x") for t in range(6)]
    calls = spark.createDataFrame(reads + writes, "run_id long, turn long, tool string, signature string")
    out = transcripts.repeated_calls(calls, write_tools=["materialize_evidence"], budget_turn=100)
    got = sorted((r.run_id, r.occurrence) for r in out.collect())
    assert got == [(1, 3), (1, 4), (1, 5), (2, 3), (2, 6)]


def test_budget_first(spark):
    calls = spark.createDataFrame([(1, t, "run_sql", "s") for t in range(25)],
                                  "run_id long, turn long, tool string, signature string")
    out = {r.turn: r.flagged_as for r in transcripts.repeated_calls(calls, budget_turn=22).collect()}
    assert out[21] == "repeat" and out[22] == "budget" and out[24] == "budget"


def test_alert_filter(spark):
    ev = events(spark, ["confirmed", "other", "not-confirmed"])
    owner = spark.createDataFrame([(9, dt.datetime(2024, 1, 2), "e", "OWNER", "ADD", "urn:li:tag:confirmed", "u", "")],
                                  alerts.EVENT_SCHEMA)
    got = sorted(r.modifier for r in alerts.review_alerts(ev.unionByName(owner), ["confirmed"]).collect())
    assert got == ["urn:li:tag:confirmed", "urn:li:tag:not-confirmed"]  # substring test (C18)
    exact = alerts.review_alerts(ev, ["confirmed"], exact=True).collect()
    assert [r.modifier for r in exact] == ["urn:li:tag:confirmed"]


def test_segmented_helpers_equal_plain_windows(spark):
    # a third of all rows are one key's, all on one day and many at one time
    rows = [("hot", i // 9, i, i % 7) for i in range(700)] + [(f"k{j}", i, i, i) for j in range(200) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, t long, id long, v long")
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select("k", "id", F.lag("v").over(w).alias("prev_v"), F.row_number().over(w).cast("long").alias("rn"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = sliced(df, ["k"], ["t", "id"])
        assert parts.filter("k = 'hot'").select("_slice").distinct().count() >= 2
        assert parts.groupBy("_slice").count().agg(F.max("count")).first()[0] < 700
        a = segmented_prev(df, ["k"], ["t", "id"], ["v"]).select("k", "id", "prev_v")
        b = segmented_row_number(df, ["k"], ["t", "id"], "rn").select("k", "id", "rn")
        got = a.join(b, ["k", "id"])
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_intervals_and_effects_do_not_window_over_assets(spark):
    ev = events(spark, ["pending-review", "confirmed", "pending-review", "confirmed", "rejected", "pending-review", "confirmed"])
    entity = ev.first().entity
    assets = spark.createDataFrame([(entity, f"part.p{i}") for i in range(50)], "evidence_table string, asset string")
    acts = review.finding_actions(ev)
    spans = review.incident_intervals(acts, assets)
    got = {(r.opened_by, r.closed_by, r.message) for r in spans.collect()}
    assert got == {(1, 2, "reopened"), (3, 5, "reopened"), (6, None, None)} and spans.count() == 150
    plan = spans._jdf.queryExecution().optimizedPlan().toString()
    assert "asset" not in "".join(line for line in plan.splitlines() if "Window" in line)
    third = ev.orderBy("event_id").collect()[3]["at"]
    assert {r.dataset for r in review.incidents_as_of(spans, str(third)).collect()} == {f"part.p{i}" for i in range(50)}
    days = review.open_incidents_by_day(spans).orderBy("day").collect()
    assert sum(r.opened for r in days) == 150 and sum(r.closed for r in days) == 100 and days[-1].still_open == 50


def test_keys_by_pieces_of_any_length(spark):
    import random
    rng = random.Random(1)
    names = ["".join(rng.choices("ab.", k=rng.randint(0, 12))) for _ in range(60)] + ["analytics.unique_set", "é漢😀x"]
    sets = [(n, rng.choice([None, "hunt", "".join(rng.choices("abc", k=5))])) for n in names]
    keys = ["a", "b", "ab", "aba", "", None, "unique", "x", "漢😀", "zzz", "hunt", "analytics.unique_set", "c", "cab", *names[:20]]
    got = review.resolve_finding_keys(spark.createDataFrame([(k,) for k in keys], "key string"),
                                      spark.createDataFrame(sets, "entity string, hunt string"), hunt_col="hunt")
    for r in got.collect():
        hit = {n for n, h in sets if r.key and (r.key in n or (h and r.key in h))}
        assert r.n_matches == len(hit) and r.resolved == (min(hit) if len(hit) == 1 else None), r.key
    long = spark.createDataFrame([("x" * 2000 + str(i),) for i in range(3)], "entity string")
    assert review.resolve_finding_keys(spark.createDataFrame([("xx1",)], "key string"), long).first().resolved == "x" * 2000 + "1"


def test_malformed_delivery_kept_raw(spark):
    bodies = spark.createDataFrame([('{"event_id": 7, "entityUrn": "e", "category": "TAG"}',), ("not json",)],
                                   "value string")
    rows = {(r.event_id, r.raw) for r in alerts.parse_deliveries(bodies).collect()}
    assert rows == {(7, None), (None, "not json")}


def test_job_walk_equals_pair_walk(spark):
    io = spark.createDataFrame([("j1", "in", "a"), ("j1", "in", "b"), ("j1", "out", "c"),
                                ("j2", "in", "c"), ("j2", "out", "d"), ("j2", "out", "a"),
                                ("j3", "in", "d"), ("j3", "out", "e")],
                               "job string, direction string, dataset string")
    for start, direction in (("e", "up"), ("a", "down"), ("c", "up")):
        a = ledger.lineage_walk_jobs(io, start, direction, 10).drop("job")
        b = ledger.lineage_walk(ledger.lineage_edges(io), start, direction, 10)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_null_bucket_is_part_of_history(spark):
    # C11: the NULL-date bucket counts in the key's own mean / stddev
    from casefile.operators import surge
    rows = [("s", None)] * 9 + [("s", D(2001, 1, 1 + i)) for i in range(12)] + [("s", D(2001, 2, 1))] * 5
    df = spark.createDataFrame(rows, "sender string, d date").withColumn("subject", F.lit("x"))
    series = surge.sample_attribute_join(df, "sender", F.col("d"), "subject", "day")
    stats = surge.sender_stats_having(series, "sender", 12).first()
    assert stats.n_buckets == 14  # 12 single days + 2001-02-01 + the NULL bucket
    out = surge.zscore_per_key(df, "sender", F.col("d"), sample_col="subject", min_buckets=12, z=1.0,
                               bucket_name="day")
    assert {r.day for r in out.collect()} == {None, D(2001, 2, 1)}


def test_alert_stream_restart_appends_nothing_twice(spark, tmp_path):
    src, log, ckpt = (str(tmp_path / n) for n in ("events", "log", "ckpt"))
    events(spark, ["pending-review", "confirmed", "rejected"]).write.parquet(src)
    for _ in range(2):  # the second run resumes from the checkpoint: no new files, no duplicates
        alerts.alert_log_append(alerts.review_alerts_stream(spark, src, ["confirmed", "rejected",
                                                                         "pending-review"]), log, ckpt)
    assert alerts.load_alert_log(spark, log).count() == 3
    events(spark, ["confirmed"], entity="analytics.f").write.mode("append").parquet(src)
    alerts.alert_log_append(alerts.review_alerts_stream(spark, src, ["confirmed"]), log, ckpt)
    assert alerts.load_alert_log(spark, log).count() == 4


def test_reopen_leaves_the_effective_verdict(spark):
    ev = events(spark, ["pending-review", "confirmed", "rejected", "pending-review", "pending-review", "rejected"])
    got = [(r.event_id, r.from_state) for r in review.reopen_finding(ev).collect()]
    assert got == [(3, "confirmed")]
    refused = review.refused_verdicts(review.annotated_log(ev)).collect()
    assert [(r.event_id, r.verdict) for r in refused] == [(2, "rejected")] and refused[0].reviewer is not None


def test_a_removed_tag_is_no_verdict(spark):
    ev = events(spark, ["pending-review", "confirmed"]).withColumn(
        "operation", F.when(F.col("event_id") == 1, "REMOVE").otherwise("ADD"))
    assert review.review_states(ev).first().state == "pending-review" and review.apply_verdict(ev).count() == 0


def test_incidents_land_on_the_implicated_assets(spark):
    ev = events(spark, ["pending-review", "confirmed", "pending-review"])
    entity = ev.first().entity
    assets = spark.createDataFrame([(entity, "part.p1"), (entity, "part.p2")], "evidence_table string, asset string")
    acts = review.incident_actions(ev, assets)
    assert {r.dataset for r in review.raise_incidents(acts).collect()} == {"part.p1", "part.p2"}
    assert {r.message for r in review.resolve_incidents(acts).collect()} == {"reopened"}
    assert review.active_incidents(acts).count() == 0


def test_alert_log_skips_torn_and_blank_lines(spark, tmp_path):
    lines = ['{"event_id": 1, "entityUrn": "a"}', '{"event_id": 2, "entityU', "", '{"entityUrn": "b"}', "not json"]
    (tmp_path / "log.json").write_text("\n".join(lines))
    got = {(r.event_id, r.entityUrn) for r in alerts.load_alert_log(spark, str(tmp_path / "log.json")).collect()}
    assert got == {(1, "a"), (None, "b")}


def test_walk_goes_to_the_end_and_names_the_job(spark):
    io = spark.createDataFrame([(f"j{i}", d, f"d{i + (d == 'in')}") for i in range(14) for d in ("in", "out")],
                               "job string, direction string, dataset string")
    got = {r.dataset: (r.depth, r.job) for r in ledger.lineage_walk_jobs(io, "d0").collect()}
    assert len(got) == 15 and got["d14"] == (14, "j13") and got["d0"] == (0, None)


def test_whole_arguments_are_the_signature(spark):
    calls = spark.createDataFrame([(1, i, "query", "select " + "xyz"[i % 3]) for i in range(8)],
                                  "run_id long, turn long, tool string, args string")
    out = transcripts.repeated_calls(transcripts.call_signatures(calls), budget_turn=100).collect()
    assert {(r.turn, r.signature) for r in out} == {(6, "query|select x"), (7, "query|select y")}


def test_datasets_without_owner_do_not_meet_the_users(spark):
    ds = spark.createDataFrame([(f"d{i}",) for i in range(30)], "dataset string")
    own = spark.createDataFrame([("d1", "u1"), ("d1", "u2"), ("d2", "u9")], "dataset string, value string")
    users = spark.createDataFrame([("u1", "t", True), ("u2", "t", False)], "username string, title string, active boolean")
    none = spark.createDataFrame([], "dataset string, value string")
    got = governance.ownership_join(ds, own, users, none, none, "Material", "certified").collect()
    assert len(got) == 31 and sum(r.owner is None for r in got) == 28
    assert {(r.owner, r.owner_active) for r in got if r.owner} == {("u1", True), ("u2", False), ("u9", None)}


def test_a_prefilter_smaller_than_the_lexicon_leaves_messages_out(spark):
    from casefile.operators import lexicon, staging
    rows = [(1, "alpha and beta", None), (2, "beta", "gamma"), (3, None, "ALPHA gamma"), (4, "al", "pha beta gamma")]
    m = spark.createDataFrame([(i, s, b, None) for i, s, b in rows], "id long, subject string, body string, sent_at date")
    hits = lambda **k: sorted((r.id, r.entity) for r in lexicon.lexicon_mentions(m, ["alpha", "beta", "gamma"], **k).collect())
    assert len(hits()) == 8 and hits(prefilter=["alpha"]) == [(1, "alpha"), (1, "beta"), (3, "alpha"), (3, "gamma")]
    # a word that only subject and body together would form is in neither
    assert [r.id for r in staging.keyword_prefilter(m, ["al pha"]).collect()] == []
