"""Adapters from the driver's TESTDATA tables to the investigation data model.

Rules are in FIXTURES.md §2.  Everything is a DataFrame expression over the
parquet tables, so Catalyst prunes columns and pushes filters into the scans.
Joins to tables that grow with the data (supplier, customer, documents) carry
no broadcast hint: AQE broadcasts them at runtime only when they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.functions.sequence import segmented_row_number

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    # 25 x 5 rows by the TPC-H spec: a fixed bound, broadcast explicitly
    return F.broadcast(
        n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
         .select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("nation"),
                 F.col("r_name").alias("region")))


def supplier_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(suppkey, addr, name, title, dept, acctbal)."""
    s = read(spark, sf_dir, "supplier")
    nr = nation_region(spark, sf_dir)
    key = F.col("s_suppkey").cast("string")
    addr = F.when(F.col("s_nationkey") % 5 == 0, F.concat(F.lit("s"), key, F.lit("@corp.example"))) \
            .otherwise(F.concat(F.lit("s"), key, F.lit("@"), F.lower("nation"), F.lit(".example")))
    return (s.join(nr, s.s_nationkey == nr.nationkey)
             .select(F.col("s_suppkey").alias("suppkey"), addr.alias("addr"),
                     F.col("s_name").alias("name"), F.col("nation").alias("title"),
                     F.col("region").alias("dept"), F.col("s_acctbal").alias("acctbal")))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address registry (addr, name, title, dept): customers plus suppliers."""
    c = read(spark, sf_dir, "customer")
    nr = nation_region(spark, sf_dir)
    cust = (c.join(nr, c.c_nationkey == nr.nationkey)
             .select(F.concat(F.lit("c"), F.col("c_custkey").cast("string"),
                              F.lit("@corp.example")).alias("addr"),
                     F.col("c_name").alias("name"), F.col("nation").alias("title"),
                     F.col("region").alias("dept")))
    sup = supplier_addresses(spark, sf_dir).select("addr", "name", "title", "dept")
    return cust.unionByName(sup)


def _date_text(key: Column) -> Column:
    """The raw date text: NULL when id % 89 = 0, garbage when id % 97 = 0."""
    return (F.when(key % 89 == 0, F.lit(None).cast("string"))
             .when(key % 97 == 0, F.lit("not a date"))
             .otherwise(F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd")))


def _sender(custkey: Column) -> Column:
    return F.concat(F.lit("c"), custkey.cast("string"), F.lit("@corp.example"))


def _dealt(df: DataFrame, key: str, partitions: int | None) -> DataFrame:
    return df if partitions is None else df.repartition(partitions, key)


def message_headers(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Raw messages without the recipient list (id ... folder); with
    `partitions`, dealt by id into that many."""
    o = _dealt(read(spark, sf_dir, "orders"), "o_orderkey", partitions)
    docs = _dealt(read(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text").alias("body")), "doc_id", partitions)
    key = F.col("o_orderkey")
    return (o.join(docs, o.o_orderkey == docs.doc_id, "left")
             .select(key.alias("id"),
                     F.concat(F.lit("<o"), key.cast("string"), F.lit("@corp.example>")).alias("msg_id"),
                     _sender(F.col("o_custkey")).alias("sender"),
                     _date_text(key).alias("date"),
                     F.col("o_orderpriority").alias("subject"),
                     F.col("body"),
                     F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("mailbox"),
                     F.col("o_orderstatus").alias("folder")))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages: id, msg_id, sender, date (text), subject, body, mailbox,
    folder, recipients (comma list) — the source format.  The list is built
    per order (TPC-H caps an order at 7 lines); the staged tables do not use
    it, they come from `message_lines`."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    sa = supplier_addresses(spark, sf_dir).select("suppkey", "addr")
    lines = li.join(sa, li.l_suppkey == sa.suppkey)
    rec = (lines.groupBy("l_orderkey")
                .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "addr"))).alias("_l"))
                .select(F.col("l_orderkey").alias("_rid"),
                        F.array_join(F.transform("_l", lambda x: x["addr"]), ", ").alias("_rec")))
    h = message_headers(spark, sf_dir)
    return (h.join(rec, h.id == rec._rid, "left")
             .withColumn("recipients", F.when(F.col("id") % 53 == 0, F.lit("undisclosed-recipients"))
                                        .otherwise(F.col("_rec")))
             .drop("_rid", "_rec"))


def message_lines(spark: SparkSession, sf_dir: str, date_parser, partitions: int | None = None) -> DataFrame:
    """One row per (message, recipient) — (email_id, sender, sent_at,
    recipient) — straight from the line items: the same rows as exploding the
    raw recipient lists (duplicates kept; `undisclosed-recipients` has no `@`
    and yields none), without building the lists.  A date is parsed once a
    message; with `partitions`, rows are dealt by message into that many."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    sa = supplier_addresses(spark, sf_dir).select("suppkey", "addr")
    key = F.col("o_orderkey")
    o = _dealt(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", date_parser(_date_text(key)).alias("sent_at")),
               "o_orderkey", partitions)
    lines = _dealt(li.filter(F.col("l_orderkey") % 53 != 0).join(sa, li.l_suppkey == sa.suppkey), "l_orderkey", partitions)
    return (lines.join(o, lines.l_orderkey == o.o_orderkey)
                 .select(key.alias("email_id"), _sender(F.col("o_custkey")).alias("sender"), "sent_at",
                         F.col("addr").alias("recipient")))


# ----------------------------------------------------------------- catalog

def dataset_name(partkey: Column) -> Column:
    """`part.p<k>`, or `analytics.x<k>` when k % 50 = 0 (an evidence set)."""
    k = partkey.cast("string")
    return F.when(partkey % 50 == 0, F.concat(F.lit("analytics.x"), k)) \
            .otherwise(F.concat(F.lit("part.p"), k))


def catalog_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(dataset_name(F.col("p_partkey")).alias("dataset"),
                    F.lit("parquet").alias("platform"),
                    F.concat(F.lit("part "), F.col("p_name")).alias("description"),
                    F.lower(F.col("p_type")).alias("domain"))


def catalog_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.filter(F.col("p_size") >= 25).select(
        dataset_name(F.col("p_partkey")).alias("dataset"), F.lit("certified").alias("value"))


def catalog_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.filter(F.col("p_type").isin("PROMO", "LARGE")).select(
        dataset_name(F.col("p_partkey")).alias("dataset"), F.lit("Material").alias("value"))


def catalog_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, ordinal, field, native_type): the remainder of the size by five
    gives the number of fields; every fifth dataset has no schema."""
    p = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 5).cast("int").alias("n")).filter("n > 0")
    kinds = F.array(*[F.lit(k) for k in ("bigint", "string", "date", "double")])
    return p.select(dataset_name(F.col("p_partkey")).alias("dataset"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("ordinal"),
                    F.lit("f").alias("field"), kinds.alias("kinds")).select(
        "dataset", "ordinal", F.concat("field", F.col("ordinal").cast("string")).alias("field"),
        F.get("kinds", F.col("ordinal")).alias("native_type"))


def catalog_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return (li.filter((F.col("l_linenumber") == 1) & (F.col("l_quantity") > 45))
              .select(dataset_name(F.col("l_partkey")).alias("dataset"),
                      F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("value"))
              .distinct())


def catalog_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    sa = supplier_addresses(spark, sf_dir)
    return sa.select(F.concat(F.lit("s"), F.col("suppkey").cast("string")).alias("username"),
                     F.col("name").alias("display_name"), F.col("title"),
                     (F.col("acctbal") >= 2000).alias("active"), F.col("addr").alias("email"))


def catalog_job_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job, direction, dataset): line 1 of a finished order is the job's
    output, its other lines are inputs."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    job = F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))
    outs = (li.filter(F.col("l_linenumber") == 1)
              .join(o.filter(F.col("o_orderstatus") == "F"), F.col("l_orderkey") == F.col("o_orderkey"),
                    "left_semi")
              .select(job.alias("job"), F.lit("out").alias("direction"),
                      dataset_name(F.col("l_partkey")).alias("dataset")))
    ins = (li.filter(F.col("l_linenumber") != 1)
             .select(job.alias("job"), F.lit("in").alias("direction"),
                     dataset_name(F.col("l_partkey")).alias("dataset")))
    return outs.unionByName(ins)


def catalog_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job, sql_text): what each job ran."""
    key = F.col("o_orderkey").cast("string")
    return read(spark, sf_dir, "orders").select(F.concat(F.lit("o"), key).alias("job"),
                                                F.concat(F.lit("select * from lineitem where l_orderkey = "), key).alias("sql_text"))


def entity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry of named entities (entity, disclosed): two to four words of
    every document, from its sixth on; disclosed if no odd document has them."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[0-9a-z_]+"), F.lit(0))
    named = F.array_join(F.slice(words, F.lit(6), (F.col("doc_id") % 3 + 2).cast("int")), " ")
    return (read(spark, sf_dir, "documents").filter(F.col("text").isNotNull() & (F.size(words) > 8))
            .select(named.alias("entity"), (F.col("doc_id") % 2 == 0).alias("_even"))
            .groupBy("entity").agg(F.bool_and("_even").alias("disclosed")))


# ----------------------------------------------------------------- review / transcripts

REVIEW_MAP = {"purchase": "confirmed", "error": "rejected", "view": "pending-review",
              "click": "risk-flagged"}


EVIDENCE_SETS = ("analytics.group_surge", "analytics.outside_terms", "analytics.term_web",
                 "analytics.ownership_audit", "analytics.lineage_audit",
                 "analytics.volume_control")


def review_tag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag-change events (event_id, at, entity, category, operation, modifier,
    actor, note).  The first users review the six evidence sets, the others
    sets of their own; every eleventh event takes a tag away."""
    ev = read(spark, sf_dir, "events")
    sets = F.array(*[F.lit(t) for t in EVIDENCE_SETS])
    et = F.col("event_type")
    tag = F.coalesce(*[F.when(et == k, F.lit(v)) for k, v in REVIEW_MAP.items()])
    return ev.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("at"),
        F.coalesce(F.get(sets, F.col("user_id")), F.concat(F.lit("analytics.x"), F.col("user_id").cast("string"))
                   ).alias("entity"),
        F.when(et == "signup", F.lit("OWNER")).otherwise(F.lit("TAG")).alias("category"),
        F.when(F.col("event_id") % 11 == 0, F.lit("REMOVE")).otherwise(F.lit("ADD")).alias("operation"),
        F.when(et == "signup", F.concat(F.lit("owner:u"), F.col("user_id").cast("string")))
         .otherwise(F.concat(F.lit("urn:li:tag:"), tag)).alias("modifier"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("actor"),
        F.col("event_type").alias("note"),
    )


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, turn, tool, args): a user's events are one run's calls, in order."""
    ev = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "props")
    ev = segmented_row_number(ev, ["user_id"], ["ts", "event_id"], "turn")
    return ev.select(F.col("user_id").alias("run_id"), "turn", F.col("event_type").alias("tool"),
                     F.col("props").alias("args"))


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, turn, tool, text): one conversation is one investigator run."""
    c = read(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("run_id"), F.col("turn"),
                    F.col("role").alias("tool"), F.col("text"))
