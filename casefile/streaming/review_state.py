"""Review state as a keyed state machine on the stream of tag events (L6-L8,
L11-L13).

Events of a finding come in any order.  State per finding: what the events up
to a position made of it (the previous state event, the last legal state,
whether its incident is open), and the events behind that position, which wait
until one arrives that is `horizon` later than they are; then they are taken
in order of (at, event_id) and their decisions leave.  So the state holds a
finding's events of one horizon, whatever its history, and the decisions are
those of the batch (`review.annotated_log`, `review.finding_actions`) as long
as no event comes more than `horizon` behind a later one.  An event before the
position cannot be taken in order any more: it leaves as `late`, undecided, and
changes nothing; no event is dropped.  An event of category CLOSING decides
all that waits before it.

Spark hands a group of rows to Python at a cost of milliseconds, however few
they are, so the groups are shards of findings, by a hash of their names, and a
shard's state is that of its findings.  `shards` bounds both: with one for some
sixty findings a group is worth its cost and the state written at a time is
some kilobytes.  A checkpoint keeps the number it began with.

Restarts go on from the checkpoint; a finding's events meet in one task, a
micro-batch at a time.  Defined cases: an event that is delivered twice while
it waits is decided once; events without entity or time are not read.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from casefile.functions.text import short_name
from casefile.operators.review import CONFIRMED, PENDING, VERDICTS
from casefile.streaming.alerts import EVENT_SCHEMA

CLOSING = "CLOSING"
DECISION = ("entity string, event_id long, at timestamp, kind string, effective boolean, from_state string, action string, "
            "applied boolean, late boolean")
COLUMNS = pd.Index([c.strip().split(" ")[0] for c in DECISION.split(",")])
#: What is known of a finding before its first event.
NOTHING = (None, None, False, None, None, ())
#: State of a shard: how many there are, and a JSON object of its findings.
SHARD_STATE = "shards int, findings string"
SHARDS = 256
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
STATE = "previous string, legal string, is_open boolean, at long, event_id long, waiting string"


def decide(kind: str, previous: str | None, legal: str | None, is_open: bool) -> tuple:
    """One event after (previous, legal, is_open): (effective, from_state,
    action, applied) and what is known then."""
    effective = kind in VERDICTS and previous == PENDING
    from_state = legal if kind == PENDING and legal in VERDICTS else None
    action = "resolve" if from_state else None if not effective else "raise" if kind == CONFIRMED else "resolve"
    applied = action is not None and (action == "raise") != is_open
    if kind == PENDING or effective:
        legal = kind
    return (effective, from_state, action, applied), (kind, legal, is_open != applied)


def advance(entity: str, events: Iterable[tuple], known: tuple | list, horizon: int) -> tuple[list[tuple], tuple]:
    """A finding's new events (us, event_id, kind) after what is known of it:
    the decisions that leave, and what is known then (STATE, waiting as a list)."""
    previous, legal, is_open, at, event_id, waiting = known
    waiting = {tuple(k): kind for k, kind in waiting}
    out, newest = [], max((k[0] for k in waiting), default=None)

    def row(k, kind, decision, late):
        return (entity, k[1], EPOCH + dt.timedelta(microseconds=k[0]), kind, *decision, late)

    for when, number, kind in events:
        k = (int(when), int(number))
        if kind == CLOSING:
            newest = max(k[0] + horizon, newest or 0)
        elif at is not None and k <= (at, event_id):
            out.append(row(k, kind, (False, None, None, False), True))
        else:
            waiting[k] = kind
            newest = max(k[0], newest or 0)
    for k in sorted(waiting):
        if k[0] > newest - horizon:
            break
        kind = waiting.pop(k)
        decision, (previous, legal, is_open) = decide(kind, previous, legal, is_open)
        at, event_id = k
        out.append(row(k, kind, decision, False))
    return out, (previous, legal, is_open, at, event_id, sorted([list(k), kind] for k, kind in waiting.items()))


def _micros(horizon_days: float) -> int:
    return int(horizon_days * 86_400_000_000)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(np.array(rows, dtype=object), columns=COLUMNS)


def state_machine(horizon_days: float):
    """Keyed by finding: frames of (us, event_id, kind)."""
    horizon = _micros(horizon_days)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = (*state.get[:5], json.loads(state.get[5])) if state.exists else NOTHING
        events = (e for f in frames for e in zip(f["us"].tolist(), f["event_id"].tolist(), f["kind"].tolist(), strict=True))
        out, known = advance(key[0], events, known, horizon)
        state.update((*known[:5], json.dumps(known[5])))
        if out:
            yield _frame(out)

    return run


def shard_machine(horizon_days: float, shards: int):
    """Keyed by shard: frames of (entity, us, event_id, kind), and the state of
    all of the shard's findings in one."""
    horizon = _micros(horizon_days)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        began, findings = state.get if state.exists else (shards, "{}")
        if began != shards:
            raise ValueError(f"this checkpoint has {began} shards, not {shards}")
        findings, arrived, out = json.loads(findings), {}, []
        for f in frames:
            for entity, *event in zip(f["entity"].tolist(), f["us"].tolist(), f["event_id"].tolist(), f["kind"].tolist(), strict=True):
                arrived.setdefault(entity, []).append(event)
        for entity, events in arrived.items():
            left, findings[entity] = advance(entity, events, findings.get(entity, NOTHING), horizon)
            out += left
        state.update((shards, json.dumps(findings)))
        if out:
            yield _frame(out)

    return run


def decisions(events: DataFrame, horizon_days: float, shards: int = SHARDS) -> DataFrame:
    """DECISION rows of a stream of tag events (EVENT_SCHEMA)."""
    tag = short_name("modifier")
    kind = F.when(F.col("category") == CLOSING, CLOSING).when(
        (F.col("category") == "TAG") & (F.col("operation") == "ADD") & tag.isin(PENDING, *VERDICTS), tag)
    log = (events.select("entity", "event_id", F.unix_micros("at").alias("us"), kind.alias("kind"))
           .filter(F.col("kind").isNotNull() & F.col("entity").isNotNull() & F.col("us").isNotNull() & F.col("event_id").isNotNull()))
    log = log.withColumn("shard", F.pmod(F.xxhash64("entity"), F.lit(shards)))
    return log.groupBy("shard").applyInPandasWithState(
        shard_machine(horizon_days, shards), DECISION, SHARD_STATE, "append", GroupStateTimeout.NoTimeout)


def run_available(spark: SparkSession, events_dir: str, out_dir: str, checkpoint: str, horizon_days: float,
                  shards: int = SHARDS) -> None:
    """Decides on what has arrived in `events_dir` since the last call, adds the
    decisions to `out_dir` (parquet) and stops."""
    stream = spark.readStream.schema(EVENT_SCHEMA).parquet(events_dir)
    query = (decisions(stream, horizon_days, shards).writeStream.format("parquet").outputMode("append")
             .option("path", out_dir).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
