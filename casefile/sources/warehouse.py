"""The staged warehouse over one TESTDATA directory.

Mirrors the layering of the investigations: raw -> staging (emails,
recipients, message edges) -> curated (weekly comm edges).  Staged tables are
written once per application as parquet under the shared checkpoint folder
(`spark.checkpoint.dir`) and read back, which cuts lineage: a lost executor
re-reads the written files instead of recomputing the adapters, and every
investigation over the same directory reuses the same staged files.

Emails are staged from the message headers and do not wait for the recipient
lists, which only the raw source has; that one is a table of its own, written
when it is asked for.  The emails are written sorted by `sent_at` within each file, so the
date windows of the hunts skip row groups through parquet min/max statistics,
and in row groups of bounded bytes: the text scans (lexicon regexes) are
CPU-bound, and a split can only start at a row-group border.  No file is cut
by rows.

The evidence layer (`evidence`) keeps each investigation's result the way the
investigations do: written once, then read by the reports, the ledger and the
gate instead of being recomputed by each of them.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.functions.text import safe_date
from casefile.operators.staging import (EMAIL_COLUMNS, explode_recipients, stage_messages,
                                        weekly_edges_from_edges)
from casefile.session import ensure_session_settings, partitions, size_shuffles, work_path
from casefile.sources import testdata as td
from casefile.sources.colocated import lay_out

_CACHE: dict[tuple[str, str], "Warehouse"] = {}


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize = materialize
        self._tables: dict[str, DataFrame] = {}
        self._made: dict[str, object] = {}
        tag = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:12]
        self._root = work_path(spark, "warehouse", tag) if materialize else None

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        ensure_session_settings(spark)  # UTC dates and AQE, whatever session calls us
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        wh = _CACHE.get(key)
        size_shuffles(spark, sf_dir)
        if wh is None:
            wh = _CACHE[key] = cls(spark, sf_dir)
        return wh

    # raw driver tables -------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        return td.read(self.spark, self.sf_dir, name)

    def raw_messages(self) -> DataFrame:
        """The raw message source (comma recipient lists included); S1 and T1
        run over it."""
        return self._staged("raw_messages", lambda: td.raw_messages(self.spark, self.sf_dir), row_group_bytes=16 << 20)

    # staged ---------------------------------------------------------------
    def _staged(self, name: str, build, sort_by: str | None = None,
                row_group_bytes: int = 128 << 20) -> DataFrame:
        if name in self._tables:
            return self._tables[name]
        df = build()
        if self.materialize:
            path = f"{self._root}/{name}"
            w = df.sortWithinPartitions(sort_by) if sort_by else df
            w.write.mode("overwrite").option("parquet.block.size", row_group_bytes).option("compression", "zstd").parquet(path)
            df = self.spark.read.parquet(path)
        self._tables[name] = df
        return df

    def emails(self) -> DataFrame:
        """staging.emails: the typed columns of the messages."""
        build = lambda: stage_messages(td.message_headers(self.spark, self.sf_dir)).select(*EMAIL_COLUMNS)
        return self._staged("emails", build, "sent_at", row_group_bytes=16 << 20)

    def recipients(self) -> DataFrame:
        """staging.recipients (email_id, addr): a projection of the staged
        message edges, which hold exactly the exploded recipient tokens."""
        if not self.materialize:
            return explode_recipients(self.raw_messages())
        return self.message_edges().select("email_id", F.col("recipient").alias("addr"))

    def message_edges(self) -> DataFrame:
        """(email_id, sender, sent_at, recipient) from the line items."""
        build = lambda: td.message_lines(self.spark, self.sf_dir, safe_date)
        return self._staged("message_edges", build, "sent_at")

    def comm_edges(self) -> DataFrame:
        return self._staged("comm_edges", lambda: weekly_edges_from_edges(self.message_edges()))

    def registry(self) -> DataFrame:
        return self._staged("registry", lambda: td.registry(self.spark, self.sf_dir))

    def evidence(self, name: str, build) -> DataFrame:
        """An investigation result, written once under evidence/<name>."""
        return self._staged(f"evidence/{name}", build)

    def colocated(self, buckets: int = 32) -> tuple[DataFrame, DataFrame]:
        """Messages and recipients bucketed by message id, in folders by year,
        in more buckets than `buckets` where a shuffle has more partitions.
        Made from the source itself, whose joins are dealt as the buckets are:
        no text is shuffled twice or staged in between."""
        def build() -> tuple[DataFrame, DataFrame]:
            n = max(buckets, partitions(self.spark))
            emails = stage_messages(td.message_headers(self.spark, self.sf_dir, n)).select(*EMAIL_COLUMNS)
            edges = td.message_lines(self.spark, self.sf_dir, safe_date, n)
            return lay_out(self.spark, emails, edges, work_path(self.spark, "colocated", uuid.uuid4().hex), n, dealt=True)
        return self.once("colocated", build)

    def once(self, name: str, build):
        """Something that is built once an application and folder, as a ledger."""
        if name not in self._made:
            self._made[name] = build()
        return self._made[name]

    def job_io(self) -> DataFrame:
        """The catalog's job inputs and outputs, joined from raw once."""
        return self._staged("job_io", lambda: td.catalog_job_io(self.spark, self.sf_dir))

    # catalog / review / transcripts (cheap column maps over the raw tables) ----
    def catalog(self) -> dict[str, DataFrame]:
        s, d = self.spark, self.sf_dir
        return {
            "datasets": td.catalog_datasets(s, d),
            "fields": td.catalog_fields(s, d),
            "tags": td.catalog_tags(s, d),
            "terms": td.catalog_terms(s, d),
            "owners": td.catalog_owners(s, d),
            "users": td.catalog_users(s, d),
            "job_io": self.job_io(),
        }

    def tool_calls(self) -> DataFrame:
        """The runs' calls, numbered once."""
        return self._staged("tool_calls", lambda: td.tool_calls(self.spark, self.sf_dir))

    def review_events(self) -> DataFrame:
        return td.review_tag_events(self.spark, self.sf_dir)

    def transcripts(self) -> DataFrame:
        return td.transcripts(self.spark, self.sf_dir)
