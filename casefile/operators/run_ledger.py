"""The evidence ledger over many runs.

A run's rows are written under `<root>/<table>/attempt=<uuid>`, and only then
one row goes to `<root>/commits`: (run_id, seq, attempt, recorded_at).  Readers
take the attempts that the latest commit of each run names, so a run that
broke off is never seen, and recording a run again writes nothing (or, with
`replace`, puts its rows in place of the earlier ones).  Nothing is ever
overwritten: what an earlier run recorded of an evidence set stays in
`history`, while `current` is what the latest run that recorded the set says
of it.  Each recording also makes the set's review pending again: `recordings`
gives these events for the review log.

One writer at a time records runs; readers need no care.  Defined cases: an
empty ledger has empty tables; a run may record no findings; of several rows
for one set in a run all count; a set without fields, tags, terms or job rows
has none in `current`.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.operators.review import PENDING

#: Ledger tables and the column that names what a row is about.
TABLES = {
    "findings": ("hunt_id string, title string, narrative string, confidence string, sql_text string, evidence_table string, "
                 "job string, exhibit_of string, evidence_rows long", "evidence_table"),
    "fields": ("evidence_table string, ordinal int, field string, native_type string, logical_type string", "evidence_table"),
    "tags": ("evidence_table string, value string", "evidence_table"),
    "terms": ("evidence_table string, value string", "evidence_table"),
    "job_io": ("job string, direction string, dataset string", "job"),
    "assertions": ("group string, passed boolean, n_ok long, n_all long, results string, assertion_id string", "assertion_id"),
}
COMMIT = "run_id string, seq long, attempt string, recorded_at timestamp"


class RunLedger:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        # folders without rows, so that an empty ledger can be read
        spark.createDataFrame([], COMMIT).write.mode("ignore").parquet(f"{self.root}/commits")
        for name, (schema, _) in TABLES.items():
            spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{self.root}/{name}/attempt=none")

    def commits(self) -> DataFrame:
        """All commits; a run that was replaced has several."""
        return self.spark.read.schema(COMMIT).parquet(f"{self.root}/commits")

    def runs(self) -> DataFrame:
        """(run_id, seq, attempt, recorded_at): the latest commit of each run."""
        last = self.commits().groupBy("run_id").agg(F.max_by(F.struct("seq", "attempt", "recorded_at"), "seq").alias("c"))
        return last.select("run_id", "c.*")

    def record(self, run_id: str, records: dict[str, DataFrame], recorded_at: dt.datetime, replace: bool = False) -> bool:
        """Writes one run; False if it was recorded before and is not replaced."""
        # a row a commit: one aggregate of the commit table
        known = self.commits().agg(F.max("seq").alias("seq"), F.count_if(F.col("run_id") == run_id).alias("here")).first()
        if known["here"] and not replace:
            return False
        attempt = uuid.uuid4().hex
        for name, df in records.items():
            schema, _ = TABLES[name]
            columns = [c.split()[0] for c in schema.split(", ")]
            df.select(*columns).write.parquet(f"{self.root}/{name}/attempt={attempt}")
        commit = (run_id, (known["seq"] or 0) + 1, attempt, recorded_at)
        self.spark.createDataFrame([commit], COMMIT).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        return True

    def history(self, name: str) -> DataFrame:
        """Every row that a committed run recorded, with its run_id, seq and recorded_at."""
        schema, _ = TABLES[name]
        rows = self.spark.read.schema(f"{schema}, attempt string").option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}")
        return rows.join(self.runs(), "attempt").drop("attempt")

    def current(self, name: str) -> DataFrame:
        """The rows of the latest run that recorded what they are about: the
        evidence set, the job of one, or the assertion."""
        _, key = TABLES[name]
        by = {"job": "job", "assertion_id": "assertion_id"}.get(key, "evidence_table")
        owner = self.history("assertions" if by == "assertion_id" else "findings")
        latest = owner.groupBy(by).agg(F.max("seq").alias("seq"))
        return self.history(name).join(latest, [by, "seq"]).select(*[c.split()[0] for c in TABLES[name][0].split(", ")], "run_id", "seq")

    def findings(self) -> DataFrame:
        """The current findings, how often each set was recorded, and first when."""
        seen = self.history("findings").groupBy("evidence_table").agg(
            F.count_distinct("seq").alias("times_recorded"), F.min_by("run_id", "seq").alias("first_run"))
        return self.current("findings").join(seen, "evidence_table")

    def recordings(self) -> DataFrame:
        """A pending event for every recording of an evidence set, as rows of the
        review log; their ids are below zero, the run's number in each."""
        each = self.history("findings").select("evidence_table", "run_id", "seq", "recorded_at").distinct()
        return each.select(
            (-F.col("seq")).alias("event_id"), F.col("recorded_at").alias("at"), F.col("evidence_table").alias("entity"),
            F.lit("TAG").alias("category"), F.lit("ADD").alias("operation"), F.lit(f"urn:li:tag:{PENDING}").alias("modifier"),
            F.col("run_id").alias("actor"), F.lit("recorded").alias("note"))

    def earlier(self, run_id: str, tag: str | None = None, hunt_id: str | None = None) -> DataFrame:
        """What runs before `run_id` recorded, with a tag or of a hunt, and
        whether a later run of these has recorded the set again."""
        runs = self.runs()
        limit = runs.filter(F.col("run_id") == run_id).agg(F.max("seq").alias("limit"))
        before = self.history("findings").crossJoin(F.broadcast(limit)).filter(F.col("seq") < F.col("limit"))  # one row
        last = before.groupBy("evidence_table").agg(F.max("seq").alias("last_seq"))
        out = before.join(last, "evidence_table").withColumn("superseded", F.col("seq") < F.col("last_seq"))
        if hunt_id is not None:
            out = out.filter(F.col("hunt_id") == hunt_id)
        if tag is not None:
            tagged = self.history("tags").filter(F.col("value") == tag).select("evidence_table", "seq").distinct()
            out = out.join(tagged, ["evidence_table", "seq"], "left_semi")
        return out.select("run_id", "hunt_id", "evidence_table", "evidence_rows", "confidence", "superseded")
