"""Streams with memory: deduplication against the log, review state in any order."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casefile.operators import review as rv
from casefile.streaming import alerts as al
from casefile.streaming import review_state as rs

TAGS = ["pending-review", "confirmed", "rejected"]


def events(spark, rows):
    """rows: (event_id, at, entity, tag)"""
    return spark.createDataFrame([(i, at, e, "TAG", "ADD", f"urn:li:tag:{t}", "u", None) for i, at, e, t in rows], al.EVENT_SCHEMA)


def at(day, hour=0, micro=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour, microseconds=micro)


def deliver(spark, root, batch):
    batch.write.mode("append").parquet(f"{root}/events")
    al.alert_dedup_stream(al.review_alerts_stream(spark, f"{root}/events", TAGS), f"{root}/log", f"{root}/ckpt")


def logged(spark, root):
    return sorted(str(r.event_id) for r in al.load_alert_log(spark, f"{root}/log").collect())


def test_no_event_is_lost_or_logged_twice(spark, tmp_path):
    new = events(spark, [(0, at(50), "a", "confirmed"), (1, at(50, 1), "b", "rejected")])
    old = events(spark, [(10, at(3), "a", "confirmed"), (11, at(50, 2), "b", "rejected")])
    nameless = events(spark, [(None, at(50, 3, 1), "a", "confirmed"), (None, at(50, 3, 2), "a", "confirmed"), (None, None, "c", "rejected")])
    for batch in (new, old, new.unionByName(nameless), nameless, old.unionByName(new)):
        deliver(spark, tmp_path, batch)
    assert logged(spark, tmp_path) == ["0", "1", "10", "11", "None", "None", "None"]


def test_a_batch_that_failed_halfway_is_made_whole(spark, tmp_path):
    """What a first attempt has written stays, the rest is added; nothing twice."""
    batch = events(spark, [(i, at(i % 4, i), "a", "confirmed") for i in range(20)])
    root = f"{tmp_path}/log"
    spark.createDataFrame([], al.LOG_SCHEMA).write.partitionBy("day").json(root)
    rows = al.new_alerts(al.review_alerts(batch, TAGS), root).withColumn("received_at", F.current_timestamp())
    half = rows.filter("event_id % 2 = 0").write.mode("append").partitionBy("day").option("timestampFormat", al.TS_FORMAT)
    half.json(root)
    deliver(spark, tmp_path, batch)
    assert logged(spark, tmp_path) == sorted(map(str, range(20)))


def test_only_the_days_of_a_batch_are_read(spark, tmp_path):
    deliver(spark, tmp_path, events(spark, [(i, at(i), "a", "confirmed") for i in range(30)]))
    again = al.review_alerts(events(spark, [(7, at(7), "a", "confirmed"), (99, at(8), "a", "confirmed")]), TAGS)
    out = al.new_alerts(again, f"{tmp_path}/log")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan.replace("\n", "") or "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.event_id for r in out.collect()] == [99]


def run(spark, root, parts, horizon):
    for part in parts:
        part.write.mode("append").parquet(f"{root}/events")
        rs.run_available(spark, f"{root}/events", f"{root}/out", f"{root}/ckpt", horizon)
    return spark.read.schema(rs.DECISION).parquet(f"{root}/out")


def closing(spark, names):
    return spark.createDataFrame([(-1, at(5000), n, rs.CLOSING, "", "", "", "") for n in names], al.EVENT_SCHEMA)


def test_shuffled_batches_and_restarts_equal_the_batch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, at(rng.random() * 30), rng.choice("abcd"), rng.choice(TAGS)) for i in range(300)]
    rows += [(1000 + i, at(7), "a", t) for i, t in enumerate(TAGS * 3)]  # many at one time: the id decides
    parts = [[] for _ in range(5)]
    for r in rows:
        parts[min(4, int(((r[1] - at(0)).total_seconds() / 86400 + rng.random() * 2) // 7))].append(r)
    for p in parts:
        rng.shuffle(p)
    twice = rows[:5]
    got = run(spark, tmp_path, [*[events(spark, p + [r for r in twice if r in p]) for p in parts], closing(spark, "abcd")], 2)
    log = events(spark, rows)
    a = rv.annotated_log(log)
    acts = rv.finding_actions(log).select("event_id", "action", F.col("effective").alias("applied"))
    want = a.select("entity", "event_id", "kind", "effective", "from_state").join(acts, "event_id", "left")
    cols = ("entity", "event_id", "kind", "effective", "from_state", "action", "applied")
    key = lambda df: sorted(tuple(str(r[c]) if c != "applied" else bool(r[c]) for c in cols) for r in df.collect())
    assert key(got) == key(want) and got.filter("late").count() == 0


def test_late_events_leave_undecided(spark, tmp_path):
    parts = [events(spark, [(1, at(0), "a", "pending-review"), (2, at(10), "a", "confirmed")]),
             events(spark, [(3, at(20), "a", "rejected"), (4, at(0, 0, -5), "a", "rejected")]), closing(spark, ["a", "b"])]
    got = {r.event_id: r for r in run(spark, tmp_path, parts, 2).collect()}
    assert set(got) == {1, 2, 3, 4} and got[4].late and not got[4].effective and not any(got[i].late for i in (1, 2, 3))
    assert got[2].effective and got[2].action == "raise" and not got[3].effective


@pytest.mark.parametrize("n", [200, 2000])
def test_state_is_bounded_by_the_horizon(n):
    """A long history leaves no more in the state than a short one."""
    class State:
        exists, value = False, None

        def update(self, v):
            self.exists, self.value = True, v

        get = property(lambda self: self.value)

    import pandas as pd
    machine, state = rs.state_machine(1.0), State()
    for i in range(n):
        frame = pd.DataFrame({"us": [i * 3_600_000_000], "event_id": [i], "kind": [TAGS[i % 3]]})
        list(machine(("a",), iter([frame]), state))
    assert len(rs.json.loads(state.value[5])) == 24


def test_findings_share_a_group_and_keep_their_own_state(spark, tmp_path):
    """Many findings are few groups; a shard decides as its findings alone would."""
    rng = random.Random(5)
    rows = [(i, at(rng.random() * 20), f"f{rng.randrange(40)}", rng.choice(TAGS)) for i in range(400)]
    names = sorted({r[2] for r in rows})
    parts = [[r for r in rows if at(5 * i) <= r[1] < at(5 * i + 5)] for i in range(4)]
    calls = spark.sparkContext.accumulator(0)
    plain = rs.shard_machine

    def counted(horizon, shards):
        machine = plain(horizon, shards)

        def run(key, frames, state):
            calls.add(1)
            yield from machine(key, frames, state)
        return run

    got = []
    for shards in (1, 3):
        root = tmp_path / str(shards)
        rs.shard_machine = counted
        try:
            for part in [*[events(spark, p) for p in parts], closing(spark, names)]:
                part.write.mode("append").parquet(f"{root}/events")
                rs.run_available(spark, f"{root}/events", f"{root}/out", f"{root}/ckpt", 2, shards)
        finally:
            rs.shard_machine = plain
        got.append(sorted(map(str, spark.read.schema(rs.DECISION).parquet(f"{root}/out").collect())))
    assert calls.value <= 5 * (1 + 3)
    assert got[0] == got[1] and len(got[0]) == 400

    class State:
        exists, value = False, None

        def update(self, v):
            self.exists, self.value = True, v

        get = property(lambda self: self.value)

    import pandas as pd
    alone = []
    for name in names:
        state, machine = State(), rs.state_machine(2)
        for p in [*parts, None]:
            own = [r for r in p if r[2] == name] if p is not None else [(-1, at(5000), name, rs.CLOSING)]
            frame = pd.DataFrame({"us": [round((r[1] - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)) for r in own],
                                  "event_id": [r[0] for r in own], "kind": [r[3] for r in own]})
            alone += [tuple(r)[:2] + tuple(r)[3:] for f in machine((name,), iter([frame]), state) for r in f.itertuples(index=False)]
    out = spark.read.schema(rs.DECISION).parquet(f"{tmp_path}/3/out").drop("at").collect()
    assert sorted(map(str, alone)) == sorted(str(tuple(r)) for r in out)


def test_the_number_of_shards_stays_that_of_the_checkpoint():
    class State:
        exists, get = True, (4, "{}")

    with pytest.raises(ValueError, match="4 shards, not 5"):
        list(rs.shard_machine(2, 5)((0,), iter([]), State()))
