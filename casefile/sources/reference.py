"""Literal reference tables (S2) and the investigation parameters.

Two parameter sets exist: the TESTDATA set that maps the investigations onto
the driver's generated tables (FIXTURES.md §2), and the defaults of the
operators' own signatures.  Both are plain data; operators take them as
keyword arguments.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the published investigation settings for TESTDATA)
# ---------------------------------------------------------------------------
# group A departments: AFRICA, AMERICA; group B departments: ASIA
# baseline window 1996-01-01 .. 1999-12-31, flag from 2000-01-01, z >= 2.0
# disclosure events: 2000-06-01, 2000-10-16, 2001-02-01, 2001-06-15
# leakage lexicon: que, der, elle, und; sent 1995-01-01 .. 2000-05-31;
#   internal suffix @corp.example
# co-mention lexicon: the, and, that, for, this, with, que, der, die, und, elle,
#   pour, con, para; known entities: the, for, que; threshold 20; prefilter:
#   que, der, und, elle
# surge: key user_id, bucket = day of ts, z >= 2.5, at least 12 buckets
# certified tag: certified; material term: Material; implicated owners: s1, s3
# review tags: confirmed, risk-flagged, rejected, pending-review
# known aliases: que; glossary terms: Material, PII, Para
# transcript marker words: the, und, que
# repeat limit 3; budget turn 22; trace cut 600
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    group_a: tuple[str, ...] = ("AFRICA", "AMERICA")
    group_b: tuple[str, ...] = ("ASIA",)
    direction_labels: tuple[str, str] = ("A -> B", "B -> A")
    baseline: tuple[str, str] = ("1996-01-01", "1999-12-31")
    flag_from: str = "2000-01-01"
    spike_z: float = 2.0
    event_dates: tuple[str, ...] = ("2000-06-01", "2000-10-16", "2001-02-01", "2001-06-15")
    leak_lexicon: tuple[str, ...] = ("que", "der", "elle", "und")
    leak_window: tuple[str, str] = ("1995-01-01", "2000-05-31")
    internal_suffix: str = "@corp.example"
    web_lexicon: tuple[str, ...] = ("the", "and", "that", "for", "this", "with", "que", "der",
                                    "die", "und", "elle", "pour", "con", "para")
    web_prefilter: tuple[str, ...] = ("que", "der", "und", "elle")
    web_known: tuple[str, ...] = ("the", "for", "que")
    web_aliases: tuple[str, ...] = ("que",)
    glossary: tuple[str, ...] = ("Material", "PII", "Para")
    web_threshold: int = 20
    surge_z: float = 2.5
    surge_min_buckets: int = 12
    cert_tag: str = "certified"
    material_term: str = "Material"
    implicated: tuple[str, ...] = ("s1", "s3")
    review_tags: tuple[str, ...] = ("confirmed", "risk-flagged", "rejected", "pending-review")
    marker_words: tuple[str, ...] = ("the", "und", "que")
    repeat_limit: int = 3
    budget_turn: int = 22
    trace_cut: int = 600
    lineage_start: str = "part.p1"
    extra: dict = field(default_factory=dict)


TESTDATA = Params()


def events_table(spark: SparkSession, dates=TESTDATA.event_dates) -> DataFrame:
    """Disclosure events as a literal table (event_date DATE, event STRING)."""
    rows = [(dt.date.fromisoformat(d), f"event {i + 1}") for i, d in enumerate(dates)]
    schema = T.StructType([T.StructField("event_date", T.DateType()),
                           T.StructField("event", T.StringType())])
    return spark.createDataFrame(rows, schema)


def lexicon_table(spark: SparkSession, words, known=(), disclosed=()) -> DataFrame:
    """Entity lexicon (entity, known, disclosed) as a literal table."""
    rows = [(w, w in known, w in disclosed) for w in words]
    schema = T.StructType([T.StructField("entity", T.StringType()),
                           T.StructField("known", T.BooleanType()),
                           T.StructField("disclosed", T.BooleanType())])
    return spark.createDataFrame(rows, schema)


def web_entities(spark: SparkSession, params: Params = TESTDATA) -> DataFrame:
    """Co-mention lexicon; `known` marks the entities classified in the table
    itself (the aliases are added separately by `known_entities`)."""
    table_known = [w for w in params.web_known if w not in params.web_aliases]
    return lexicon_table(spark, params.web_lexicon, known=table_known)


def glossary_table(spark: SparkSession, terms=TESTDATA.glossary) -> DataFrame:
    """Glossary terms (name, definition)."""
    return spark.createDataFrame([(t, f"{t} data of the estate") for t in terms], "name string, definition string")
