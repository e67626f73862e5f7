"""Evidence ledger.

A finding is kept as rows in append-only ledger tables instead of catalog
aspects:
  findings(hunt_id, run_id, title, narrative, confidence, sql_text,
           evidence_table, evidence_rows, job, exhibit_of)
  fields(evidence_table, ordinal, field, native_type, logical_type)
  tags / terms(evidence_table, value)
  job_io(job, direction, dataset)
`record_finding` returns these rows as DataFrames; the evidence row count is
an aggregate over the evidence itself (no driver collect), and the field rows
come from the evidence schema.  `run_ledger.RunLedger` keeps them over runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.functions.text import safe_evidence_table, short_name, term_name
from casefile.session import partitions, work_path

LOGICAL = {"LongType": "number", "IntegerType": "number", "DoubleType": "number",
           "ShortType": "number", "FloatType": "number", "DecimalType": "number",
           "DateType": "date", "TimestampType": "date", "TimestampNTZType": "date",
           "BooleanType": "boolean"}



VERSION = "name string, version string, seq long, rows long"


def materialize_evidence(df: DataFrame, name: str, root: str) -> DataFrame:
    """S3: replace `<root>/<analytics.safe_name>` with `df`; returns (name, rows).

    The rows are written to a folder of their own and counted while they are;
    then one row in `<root>/versions` makes it the evidence that `read_evidence`
    reads.  A reader sees the whole old or the whole new rows, a write that
    fails changes nothing, and earlier versions stay."""
    spark = df.sparkSession
    safe = spark.range(1).select(safe_evidence_table(F.lit(name)).alias("n")).first()["n"]
    if safe is None:
        raise ValueError(f"could not derive a table name from {name!r}")
    root, version, seen = root.rstrip("/"), uuid.uuid4().hex, Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{root}/{safe}/{version}")
    rows = seen.get.get("rows", 0)
    spark.createDataFrame([], VERSION).write.mode("ignore").parquet(f"{root}/versions")
    last = spark.read.schema(VERSION).parquet(f"{root}/versions").agg(F.max("seq")).first()[0] or 0
    made = spark.createDataFrame([(safe, version, last + 1, rows)], VERSION)
    made.coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return made.select("name", "rows")


def evidence_versions(spark: SparkSession, root: str) -> DataFrame:
    """(name, version, seq, rows, current): every set that was materialized, with
    its row counts as observed when written."""
    v = spark.read.schema(VERSION).parquet(f"{root.rstrip('/')}/versions")
    return v.withColumn("current", F.col("seq") == F.max("seq").over(Window.partitionBy("name")))


def read_evidence(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The current rows of an evidence set (`analytics.<safe name>`)."""
    row = evidence_versions(spark, root).filter((F.col("name") == name) & F.col("current")).first()
    if row is None:
        raise ValueError(f"no evidence {name!r}")
    return spark.read.parquet(f"{root.rstrip('/')}/{name}/{row['version']}")


def schema_fields(spark: SparkSession, df: DataFrame, evidence_table: str) -> DataFrame:
    rows = [(evidence_table, i, f.name, f.dataType.simpleString(),
             LOGICAL.get(type(f.dataType).__name__, "string"))
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "evidence_table string, ordinal int, field string, "
                                       "native_type string, logical_type string")


FINDING_META = ("hunt_id", "run_id", "title", "narrative", "confidence", "sql_text",
                "evidence_table", "job", "exhibit_of")


def finding_spec(evidence: DataFrame, *, hunt_id: str, run_id: str, title: str, narrative: str,
                 sql: str, evidence_table: str, input_tables: Sequence[str],
                 terms: Sequence[str] = (), confidence: str | None = "medium",
                 tags: Sequence[str] | None = None, job: str | None = None,
                 exhibit_of: str | None = None) -> dict:
    """One finding to record (see `record_findings`)."""
    if tags is None:
        tags = ("risk-flagged", "pending-review", f"confidence-{confidence}")
    return {"evidence": evidence, "hunt_id": hunt_id, "run_id": run_id, "title": title,
            "narrative": narrative, "confidence": confidence, "sql_text": sql,
            "evidence_table": evidence_table, "job": job or hunt_id, "exhibit_of": exhibit_of,
            "input_tables": list(input_tables), "terms": list(terms), "tags": list(tags)}


def record_findings(specs: Sequence[dict]) -> dict[str, DataFrame]:
    """L1/L2 for a batch: one literal table per ledger table (metadata is a
    handful of rows per finding), and the evidence row counts as one union of
    aggregates over the evidence tables themselves."""
    spark = specs[0]["evidence"].sparkSession
    meta_schema = T.StructType([T.StructField(k, T.StringType()) for k in FINDING_META])
    meta = spark.createDataFrame([tuple(sp[k] for k in FINDING_META) for sp in specs], meta_schema)
    counts = [sp["evidence"].agg(F.count(F.lit(1)).alias("evidence_rows"))
                .select(F.lit(sp["evidence_table"]).alias("_t"), "evidence_rows") for sp in specs]
    n = counts[0]
    for c in counts[1:]:
        n = n.unionByName(c)
    findings = meta.join(F.broadcast(n), meta.evidence_table == n._t).drop("_t")
    fields = [(sp["evidence_table"], i, f.name, f.dataType.simpleString(),
               LOGICAL.get(type(f.dataType).__name__, "string"))
              for sp in specs for i, f in enumerate(sp["evidence"].schema.fields)]
    assoc = "evidence_table string, value string"
    return {
        "findings": findings,
        "fields": spark.createDataFrame(fields, "evidence_table string, ordinal int, field string, "
                                                "native_type string, logical_type string"),
        "tags": spark.createDataFrame([(sp["evidence_table"], t) for sp in specs for t in sp["tags"]], assoc),
        "terms": spark.createDataFrame([(sp["evidence_table"], t) for sp in specs for t in sp["terms"]], assoc),
        "job_io": spark.createDataFrame(
            [(sp["job"], "in", t) for sp in specs for t in sp["input_tables"]]
            + [(sp["job"], "out", sp["evidence_table"]) for sp in specs],
            "job string, direction string, dataset string"),
    }


def record_finding(evidence: DataFrame, *, hunt_id: str, run_id: str, title: str, narrative: str,
                   sql: str, evidence_table: str, input_tables: Sequence[str],
                   terms: Sequence[str] = (), confidence: str = "medium") -> dict[str, DataFrame]:
    """L1: ledger rows for one finding (tags risk-flagged, pending-review,
    confidence-<c>; job = hunt id; lineage inputs -> evidence)."""
    return record_findings([finding_spec(
        evidence, hunt_id=hunt_id, run_id=run_id, title=title, narrative=narrative, sql=sql,
        evidence_table=evidence_table, input_tables=input_tables, terms=terms, confidence=confidence)])


def exhibit_spec(exhibits: DataFrame, *, hunt_id: str, run_id: str, finding_table: str,
                 exhibits_table: str, title: str, description: str, sql: str,
                 input_tables: Sequence[str], tags: Sequence[str] = ("evidence", "exhibit")) -> dict:
    """L2: the exhibit set is recorded like a finding; the finding is itself an input."""
    ins = list(input_tables) if finding_table in input_tables else [*input_tables, finding_table]
    return finding_spec(exhibits, hunt_id=hunt_id, run_id=run_id, title=title, narrative=description,
                        sql=sql, evidence_table=exhibits_table, input_tables=ins, terms=(),
                        confidence=None, tags=tags, job=f"{hunt_id}_exhibits", exhibit_of=finding_table)


def record_exhibits(exhibits: DataFrame, **kw) -> dict[str, DataFrame]:
    """L2: ledger rows for an exhibit set (see `exhibit_spec`)."""
    return record_findings([exhibit_spec(exhibits, **kw)])


def lineage_edges(job_io: DataFrame) -> DataFrame:
    """L3: dataset -> dataset edges through the jobs (distinct)."""
    ins = job_io.filter(F.col("direction") == "in").select("job", F.col("dataset").alias("upstream"))
    outs = job_io.filter(F.col("direction") == "out").select("job", F.col("dataset").alias("downstream"))
    return ins.join(outs, "job").select("upstream", "downstream").distinct()


def lineage_walk(edges: DataFrame, start: str, direction: str = "up", max_depth: int | None = None) -> DataFrame:
    """L4 over dataset edges: nodes reachable from `start` with their hop
    distance (start = 0); see `lineage_walk_jobs`."""
    src, dst = ("downstream", "upstream") if direction == "up" else ("upstream", "downstream")
    e = edges.select(F.col(src).alias("_from"), F.col(dst).alias("_to")).distinct()
    hop = lambda frontier: (frontier.join(e, frontier.dataset == e._from)
                            .select(F.col("_to").alias("dataset")).distinct())
    return _walk(edges.sparkSession.createDataFrame([(start,)], "dataset string"), hop, max_depth)


def lineage_walk_jobs(job_io: DataFrame, start: str, direction: str = "up", max_depth: int | None = None) -> DataFrame:
    """L4 over the job graph itself: dataset -> producing job -> its inputs
    (upstream), or dataset -> consuming job -> its outputs (downstream), with
    the least job that reached each dataset first.

    Reaches what `lineage_walk(lineage_edges(job_io), ...)` reaches but never
    builds the input x output pairs of a job: each hop is two equi-joins on
    `job_io` with the frontier reduced to distinct jobs in between.  The two
    sides are written once, bucketed by what a hop joins them on, so a round
    shuffles its frontier and what that reaches, never the graph.
    """
    near, far = ("out", "in") if direction == "up" else ("in", "out")
    hop_in = _bucketed(job_io.filter(F.col("direction") == near).select("job", F.col("dataset").alias("_from")), "_from")
    hop_out = _bucketed(job_io.filter(F.col("direction") == far).select("job", F.col("dataset").alias("_to")), "job")

    def hop(frontier: DataFrame) -> DataFrame:
        jobs = frontier.join(hop_in, frontier.dataset == hop_in._from).select("job").distinct()
        return jobs.join(hop_out, "job").groupBy(F.col("_to").alias("dataset")).agg(F.min("job").alias("job"))

    first = job_io.sparkSession.createDataFrame([(start, None)], "dataset string, job string")
    return _walk(first, hop, max_depth)


def lineage_reach(job_io: DataFrame, starts: DataFrame, direction: str = "down", max_depth: int | None = None,
                  jobs: DataFrame | None = None) -> DataFrame:
    """L4 for many starts at once: (source, dataset, depth, job), every dataset
    that each of `starts` (dataset) reaches, with the least job of a shortest
    way; with `jobs` (job, sql_text) also what that job ran.

    One frontier for all sources: each round joins its distinct (dataset) with
    the jobs and only then spreads to the sources, so a dataset that many
    sources reach is expanded once.  A hub's rows are spread by AQE's split of
    skewed joins; nothing is kept per source but its visited datasets.
    """
    near, far = ("out", "in") if direction == "up" else ("in", "out")
    hop_in = job_io.filter(F.col("direction") == near).select("job", F.col("dataset").alias("_from")).distinct()
    hop_out = job_io.filter(F.col("direction") == far).select("job", F.col("dataset").alias("_to")).distinct()

    def hop(frontier: DataFrame) -> DataFrame:
        at = frontier.select(F.col("dataset").alias("_from")).distinct()
        # the steps from the frontier's datasets, whichever sources stand there
        step = at.join(hop_in, "_from").join(hop_out, "job").groupBy("_from", "_to").agg(F.min("job").alias("job"))
        return (frontier.select("source", F.col("dataset").alias("_from")).join(step, "_from")
                .groupBy("source", F.col("_to").alias("dataset")).agg(F.min("job").alias("job")))

    first = starts.select(F.col("dataset").alias("source")).distinct().select(
        "source", F.col("source").alias("dataset"), F.lit(None).cast("string").alias("job"))
    out = _walk(first, hop, max_depth, ("source", "dataset"))
    return out if jobs is None else out.join(jobs.select("job", "sql_text"), "job", "left")


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """`df`, written, bucketed by `key`; an external table of the session's catalog."""
    name, n = f"casefile_walk_{uuid.uuid4().hex[:12]}", partitions(df.sparkSession)
    (df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
       .option("path", work_path(df.sparkSession, "walk", name)).saveAsTable(name))
    return df.sparkSession.table(name)


def _walk(first: DataFrame, hop, max_depth: int | None, node: Sequence[str] = ("dataset",)) -> DataFrame:
    """Breadth-first until the frontier is empty (or `max_depth` hops): each
    round drops the visited nodes by an anti-join, so cycles end and a node
    appears once.  A round writes its frontier to a folder of its own under
    spark.checkpoint.dir; the visited nodes are the folders so far, and no row
    is written twice."""
    spark = first.sparkSession
    root = work_path(spark, "walk", uuid.uuid4().hex)

    def written(df: DataFrame, depth: int) -> DataFrame:
        df.write.parquet(f"{root}/{depth}")
        return spark.read.schema(first.schema).parquet(f"{root}/{depth}").withColumn("depth", F.lit(depth))

    visited = frontier = written(first, 0)
    depth = 0
    while max_depth is None or depth < max_depth:
        depth += 1
        frontier = written(hop(frontier.select(*node)).join(visited.select(*node), list(node), "left_anti").select(first.columns), depth)
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


def verify_trails(findings: DataFrame, fields: DataFrame, tags: DataFrame, job_io: DataFrame,
                  states: Sequence[str] = ("pending-review", "confirmed", "rejected")) -> DataFrame:
    """Per finding — rows > 0, SQL present, lineage in -> out, schema
    present, review state present."""
    f = findings.select("evidence_table", "job", "evidence_rows", "sql_text")
    io = job_io.groupBy("job").agg(F.count_if(F.col("direction") == "in").alias("_n_in"))
    made = (job_io.filter(F.col("direction") == "out").select("job", F.col("dataset").alias("evidence_table"))
                  .distinct().withColumn("_made", F.lit(True)))
    fl = fields.groupBy("evidence_table").agg(F.count(F.lit(1)).alias("_n_fields"))
    st = (tags.filter(F.col("value").isin(*states)).select("evidence_table").distinct()
              .withColumn("_state", F.lit(True)))
    j = (f.join(io, "job", "left").join(made, ["job", "evidence_table"], "left").join(fl, "evidence_table", "left")
          .join(st, "evidence_table", "left"))
    return j.select(
        "evidence_table",
        (F.col("evidence_rows") > 0).alias("has_rows"),
        (F.coalesce(F.length("sql_text"), F.lit(0)) > 0).alias("has_sql"),
        ((F.coalesce(F.col("_n_in"), F.lit(0)) > 0)
         & F.coalesce("_made", F.lit(False))).alias("has_lineage"),
        (F.coalesce(F.col("_n_fields"), F.lit(0)) > 0).alias("has_schema"),
        F.coalesce(F.col("_state"), F.lit(False)).alias("has_review_state"))


def prior_findings(findings: DataFrame, tags: DataFrame, tag: str | None = None,
                   hunt_id: str | None = None) -> DataFrame:
    """Earlier findings carrying `tag` and / or produced by `hunt_id`."""
    f = findings
    if hunt_id is not None:
        f = f.filter(F.col("hunt_id") == hunt_id)
    if tag is not None:
        t = tags.filter(F.col("value") == tag).select("evidence_table").distinct()
        f = f.join(t, "evidence_table", "left_semi")
    return f


def dataset_urn(table: str | F.Column, platform: str = "parquet") -> F.Column:
    """`urn:casefile:dataset:<platform>:<table>`."""
    t = F.lit(table) if isinstance(table, str) else table
    return F.concat(F.lit(f"urn:casefile:dataset:{platform}:"), t)


def job_urn(job: F.Column) -> F.Column:
    return F.concat(F.lit("urn:casefile:job:"), job)


def user_urn(name: F.Column) -> F.Column:
    return F.concat(F.lit("urn:casefile:user:"), name)


def term_urn(path: F.Column, term: F.Column) -> F.Column:
    """A glossary term below the path of its node."""
    return F.concat(F.lit("urn:casefile:term:"), path, F.lit("."), term)


def entity_names(names: DataFrame) -> DataFrame:
    """(kind, path, name) with its urn and what the urn is parsed back to,
    for jobs, owners and terms (below a path)."""
    name = F.col("name")
    urn = (F.when(F.col("kind") == "job", job_urn(name)).when(F.col("kind") == "owner", user_urn(name))
            .when(F.col("kind") == "term", term_urn(F.col("path"), name)))
    parsed = F.when(F.col("kind") == "term", term_name(urn)).otherwise(short_name(urn))
    return names.select("kind", "name", urn.alias("urn"), parsed.alias("parsed"))


def urn_table(urn: F.Column) -> F.Column:
    """The table name inside a dataset urn (after the last ':')."""
    return F.element_at(F.split(urn, ":"), -1)


def catalog_names(df: DataFrame, entity_col: str = "entity", modifier_col: str = "modifier") -> DataFrame:
    """Build dataset urns from table names and parse tags back to short names."""
    urn = dataset_urn(F.col(entity_col))
    return df.select("*", urn.alias("dataset_urn"), urn_table(urn).alias("table_name"),
                     short_name(modifier_col).alias("short_name"))


def export_ledger(findings: DataFrame, states: DataFrame, path: str) -> DataFrame:
    """One JSON object per finding (title, narrative, evidence dataset,
    producing job, property map) under `<path>/findings`, by hunt, and its SQL
    as a text file of its own under `<path>/sql`, by hunt and job; returns both
    as read back."""
    props = F.map_from_entries(F.array(
        F.struct(F.lit("review_state"), F.coalesce(F.col("state"), F.lit("unknown"))),
        F.struct(F.lit("evidence_rows"), F.col("evidence_rows").cast("string")),
        F.struct(F.lit("confidence"), F.coalesce(F.col("confidence"), F.lit("")))))
    j = findings.join(states.select(F.col("entity").alias("evidence_table"), "state"),
                      "evidence_table", "left")
    out = j.select("hunt_id", F.col("title"), F.col("narrative"),
                   dataset_urn(F.col("evidence_table")).alias("evidence_dataset"),
                   job_urn(F.col("job")).alias("producing_task"),
                   props.alias("evidence_properties"))
    out.write.mode("overwrite").partitionBy("hunt_id").json(f"{path}/findings")
    sql = findings.select("hunt_id", "job", F.coalesce("sql_text", F.lit("")).alias("sql_text"))
    sql.write.mode("overwrite").partitionBy("hunt_id", "job").text(f"{path}/sql")
    spark = findings.sparkSession
    kinds = "title string, narrative string, evidence_dataset string, producing_task string, evidence_properties map<string,string>, hunt_id string"
    back = spark.read.schema(kinds).json(f"{path}/findings")
    # a file a finding, whole; the writer ends it with a line feed
    texts = spark.read.schema("value string, hunt_id string, job string").text(f"{path}/sql", wholetext=True)
    texts = texts.select(job_urn(F.col("job")).alias("producing_task"), F.regexp_replace("value", r"\n\z", "").alias("sql_text"))
    props = F.col("evidence_properties")
    return back.join(texts, "producing_task").select(
        "hunt_id", "title", "narrative", "evidence_dataset", "producing_task", props["review_state"].alias("review_state"),
        props["evidence_rows"].cast("long").alias("evidence_rows"), props["confidence"].alias("confidence"), "sql_text")
