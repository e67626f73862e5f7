"""Review-tag alerts as Structured Streaming jobs.

Change events arrive as files (Kafka in production: swap the source for
`format("kafka")`, the rest is unchanged).  The alert filter keeps category
TAG and a modifier containing a review tag (a substring test, C18); the sink
is an append-only JSON log with a checkpoint, so a restarted or re-run query
resumes where it stopped.  `trigger(availableNow=True)` drains what is there
and stops, which is also how the tests run it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.functions.text import short_name

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("entity", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("modifier", T.StringType()),
    T.StructField("actor", T.StringType()),
    T.StructField("note", T.StringType()),
])

# microsecond timestamps in the log (the JSON default keeps milliseconds only)
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

ALERT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("at", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("entityUrn", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("modifier", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
])

#: The deduplicated log: a folder a day of the events.
LOG_SCHEMA = T.StructType([*ALERT_SCHEMA.fields, T.StructField("day", T.DateType())])


def alert_condition(tags: Sequence[str], exact: bool = False) -> Column:
    """TAG events whose modifier mentions a review tag (substring by default)."""
    m = F.coalesce(F.col("modifier"), F.lit(""))
    hit = short_name(m).isin(*tags) if exact else F.exists(
        F.array(*[F.lit(t) for t in tags]), lambda t: F.instr(m, t) > 0)
    return (F.col("category") == "TAG") & hit


def review_alerts(events: DataFrame, tags: Sequence[str], exact: bool = False) -> DataFrame:
    """The alert payloads (works on a batch or a streaming DataFrame)."""
    return (events.filter(alert_condition(tags, exact))
                  .select("event_id", "at", F.lit("tag-events").alias("source"),
                          F.lit("tag_change").alias("event_type"),
                          F.col("entity").alias("entityUrn"), "category", "operation", "modifier"))


def review_alerts_stream(spark: SparkSession, events_dir: str, tags: Sequence[str],
                         fmt: str = "parquet") -> DataFrame:
    """Streaming read of the event folder -> alert payloads."""
    src = spark.readStream.schema(EVENT_SCHEMA).format(fmt).load(events_dir)
    return review_alerts(src, tags)


def alert_key(alerts: DataFrame) -> Column:
    """What a delivery and its repetition have in common: the event's id, or a
    digest of an event without one."""
    payload = [c for c in alerts.columns if c not in ("received_at", "day")]
    return F.coalesce(F.col("event_id").cast("string"),
                      F.sha2(F.to_json(F.struct(*payload), {"timestampFormat": TS_FORMAT}), 256))


def new_alerts(batch: DataFrame, log_dir: str) -> DataFrame:
    """The alerts of a batch that are not in the log yet, each once, with their
    `day`.  Only the log's folders of the batch's own days are read."""
    spark = batch.sparkSession
    keyed = (batch.withColumn("day", F.coalesce(F.to_date("at"), F.lit("1970-01-01").cast("date")))
             .withColumn("_key", alert_key(batch)).dropDuplicates(["day", "_key"]))
    days = [r["day"] for r in keyed.select("day").distinct().collect()]  # days of one micro-batch
    log = spark.read.schema(LOG_SCHEMA).option("timestampFormat", TS_FORMAT).json(log_dir).filter(F.col("day").isin(days))
    known = log.select("day", alert_key(log).alias("_key"))
    return keyed.join(known, ["day", "_key"], "left_anti").drop("_key")


def alert_dedup_stream(alerts: DataFrame, log_dir: str, checkpoint: str) -> None:
    """Appends to a JSON log with a folder a day; an event that is in the log
    is not added again, however late its repetition comes.

    No state is kept beside the log: a batch is compared with the log's folders
    of its own days, since a repetition has its event's time.  A batch that is
    repeated after a failure adds only what its first attempt did not, so every
    event is in the log exactly once.  Takes what has arrived, and stops.
    """
    spark = alerts.sparkSession
    spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").partitionBy("day").json(log_dir)

    def add(batch: DataFrame, batch_id: int) -> None:
        rows = new_alerts(batch, log_dir).withColumn("received_at", F.current_timestamp())
        rows.write.mode("append").partitionBy("day").option("timestampFormat", TS_FORMAT).json(log_dir)

    query = (alerts.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def alert_log_append(alerts: DataFrame, log_dir: str, checkpoint: str,
                     available_now: bool = True):
    """Stamp the arrival time and append to the JSON log; returns the
    finished (availableNow) or running query.  A drained query is waited for
    without a limit, and its failure is raised, so a half-written log is never
    taken for a whole one."""
    q = (alerts.withColumn("received_at", F.current_timestamp())
               .writeStream.format("json").outputMode("append").option("timestampFormat", TS_FORMAT)
               .option("path", log_dir).option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="5 seconds")
    started = q.start()
    if available_now:
        started.awaitTermination()
    return started


DELIVERY_SCHEMA = T.StructType([f for f in ALERT_SCHEMA.fields if f.name != "received_at"])


def parse_deliveries(bodies: DataFrame, body_col: str = "value") -> DataFrame:
    """Incoming request bodies (text) -> alert rows.  A body that is
    not a JSON object is kept under `raw` instead of being dropped, so the
    sink never loses a delivery.  Works on batch and streaming input."""
    parsed = F.from_json(F.col(body_col), DELIVERY_SCHEMA, {"mode": "PERMISSIVE"})
    ok = F.col(body_col).rlike(r"^\s*\{") & F.col("_p").isNotNull()
    return (bodies.select(F.col(body_col), parsed.alias("_p"))
                  .select(*[F.when(ok, F.col(f"_p.{f.name}")).alias(f.name) for f in DELIVERY_SCHEMA.fields],
                          F.when(~ok, F.col(body_col)).alias("raw")))


def load_alert_log(spark: SparkSession, path: str) -> DataFrame:
    """Read the JSON-lines log; blank and malformed lines are skipped,
    whole lines without an event id are kept."""
    return (spark.read.schema(ALERT_SCHEMA).option("mode", "DROPMALFORMED")
                 .option("timestampFormat", TS_FORMAT).json(path))


def alert_feed(alerts: DataFrame) -> DataFrame:
    """Newest first: time, category / operation, short tag, asset, whether
    the arrival was stamped, and the number of all alerts."""
    total = F.broadcast(alerts.agg(F.count(F.lit(1)).alias("total")))  # one row
    return (alerts.crossJoin(total)
                  .select(F.col("at").cast("timestamp_ntz").alias("at"), "event_id",
                          F.concat_ws(" / ", "category", "operation").alias("event"),
                          short_name("modifier").alias("tag"), F.col("entityUrn").alias("asset"),
                          F.col("received_at").isNotNull().alias("received"), "total")
                  .orderBy(F.desc("at"), F.desc("event_id")))
