"""Named investigation queries over a TESTDATA directory.

Each entry is `fn(spark, sf_dir) -> DataFrame` and binds one operator of the
library to the TESTDATA parameters (`casefile.sources.reference.TESTDATA`).
`casefile.plans.oracles.ORACLES` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casefile.operators import comms, staging
from casefile.sources import testdata as td
from casefile.sources.colocated import in_window
from casefile.sources.reference import TESTDATA as P
from casefile.sources.reference import events_table
from casefile.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.of(spark, sf_dir)


# ------------------------------------------------------------------ hunt 1

def spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wh(spark, sf_dir)
    return comms.hunt_comm_spikes(w.comm_edges(), w.registry(), events_table(spark),
                                  group_a=P.group_a, group_b=P.group_b, baseline=P.baseline,
                                  flag_from=P.flag_from, z=P.spike_z)


@query("hunt_comm_spikes")
def q_hunt_comm_spikes(spark, d):
    return spikes(spark, d)


# ------------------------------------------------------------------ staging (S*, T*, F*, J1, G1)
from casefile.functions.text import (address_domain, address_user, message_excerpt,  # noqa: E402
                                     search_text, week_bucket)
from casefile.operators import governance as gov  # noqa: E402
from casefile.operators import lexicon as lex  # noqa: E402
from casefile.operators import phrase_lexicon as plex  # noqa: E402
from casefile.operators import surge  # noqa: E402
from casefile.sources.reference import glossary_table, web_entities  # noqa: E402


@query("stage_messages")
def q_stage_messages(spark, d):
    return staging.stage_messages(wh(spark, d).raw_messages())


@query("explode_recipients")
def q_explode_recipients(spark, d):
    return staging.explode_recipients(wh(spark, d).raw_messages())


@query("reference_tables")
def q_reference_tables(spark, d):
    return td.registry(spark, d)


@query("search_text")
def q_search_text(spark, d):
    e = wh(spark, d).emails()
    return e.select("id", search_text("subject", "body").alias("txt"))


@query("message_excerpt")
def q_message_excerpt(spark, d):
    e = wh(spark, d).emails().filter(F.col("body").isNotNull())
    return e.select("id", message_excerpt("body", 500).alias("excerpt"))


@query("address_domain")
def q_address_domain(spark, d):
    r = wh(spark, d).recipients()
    return r.select("email_id", "addr", address_domain("addr").alias("domain"),
                    address_user("addr").alias("username"))


@query("week_bucket")
def q_week_bucket(spark, d):
    e = wh(spark, d).emails()
    return e.select("id", "sent_at", week_bucket("sent_at").alias("week"))


@query("direction_label")
def q_direction_label(spark, d):
    w = wh(spark, d)
    x = comms.cross_group_filter(w.message_edges(), w.registry(), P.group_a, P.group_b)
    return x.select("email_id", "sender", "recipient",
                    comms.direction_label(F.col("sender_in_a"), P.direction_labels).alias("direction"))


@query("date_window_filter")
def q_date_window_filter(spark, d):
    e = wh(spark, d).emails().select("id", "sent_at")
    return staging.date_window_filter(e, "sent_at", *P.leak_window)


@query("keyword_prefilter")
def q_keyword_prefilter(spark, d):
    e = wh(spark, d).emails()
    return staging.keyword_prefilter(e, P.web_lexicon).select("id")


@query("external_recipients")
def q_external_recipients(spark, d):
    return staging.external_recipients(wh(spark, d).recipients(), P.internal_suffix)


@query("exclude_evidence_datasets")
def q_exclude_evidence_datasets(spark, d):
    return staging.exclude_evidence_datasets(td.catalog_datasets(spark, d).select("dataset"))


@query("message_recipient_join")
def q_message_recipient_join(spark, d):
    w = wh(spark, d)
    e = w.emails().select("id", "msg_id", "sender", "sent_at")
    return staging.message_recipient_join(e, w.recipients())


@query("weekly_edges")
def q_weekly_edges(spark, d):
    w = wh(spark, d)
    return staging.weekly_edges(w.emails(), w.recipients())


@query("colocated_join")
def q_colocated_join(spark, d):
    messages, recipients = wh(spark, d).colocated()
    return staging.message_recipient_join(messages.select("id", "msg_id", "sender", "sent_at"), recipients.select("email_id", "addr"))


@query("colocated_weekly_edges")
def q_colocated_weekly_edges(spark, d):
    messages, recipients = wh(spark, d).colocated()
    window = in_window("1996-01-01", "1999-12-31")
    return staging.weekly_edges(messages.filter(window), recipients.filter(window).select("email_id", "addr"))


@query("colocated_leakage")
def q_colocated_leakage(spark, d):
    messages, recipients = wh(spark, d).colocated()
    window = in_window(*P.leak_window)
    return lex.hunt_external_leakage(messages.filter(window), recipients.filter(window).select("email_id", "addr"), events_table(spark),
                                     P.leak_lexicon, window=P.leak_window, suffix=P.internal_suffix)


# ------------------------------------------------------------------ comms (J2, G2, G3, J5, A1, J6, J7, H1x, S5)

def xseries(spark, d):
    w = wh(spark, d)
    return comms.cross_group_volume(w.comm_edges(), w.registry(), P.group_a, P.group_b)


@query("cross_group_edges")
def q_cross_group_edges(spark, d):
    w = wh(spark, d)
    return comms.cross_group_edges(w.comm_edges(), w.registry(), P.group_a, P.group_b)


@query("cross_group_volume")
def q_cross_group_volume(spark, d):
    return xseries(spark, d)


@query("baseline_stats")
def q_baseline_stats(spark, d):
    s = comms.baseline_stats(xseries(spark, d), "vol", "week", *P.baseline)
    return s.select(F.round("mu", 6).alias("mu"), F.round("sigma", 6).alias("sigma"))


@query("baseline_cross_join")
def q_baseline_cross_join(spark, d):
    s = xseries(spark, d)
    b = comms.baseline_stats(s, "vol", "week", *P.baseline)
    return s.crossJoin(F.broadcast(b)).select("week", "vol", F.round("mu", 6).alias("mu"),
                                              F.round("sigma", 6).alias("sigma"))


@query("zscore_fixed_baseline")
def q_zscore_fixed_baseline(spark, d):
    z = comms.zscore_fixed_baseline(xseries(spark, d), "vol", "week", baseline=P.baseline,
                                    flag_from=P.flag_from, z=P.spike_z)
    return z.select("week", "vol", "zscore", "flagged")


@query("nearest_event_days")
def q_nearest_event_days(spark, d):
    s = xseries(spark, d).select("week")
    return comms.nearest_event_days(s, "week", events_table(spark))


@query("first_event_scalar")
def q_first_event_scalar(spark, d):
    e = wh(spark, d).emails().filter(F.col("sent_at").isNotNull()).select("id", "sent_at")
    return comms.first_event_scalar(e, "sent_at", events_table(spark))


def exhibits(spark, d):
    w = wh(spark, d)
    flagged = ev(spark, d, "spikes").filter(F.col("flagged")).select("week")
    return comms.hunt_exhibits(w.emails(), w.recipients(), w.registry(), group_a=P.group_a,
                               group_b=P.group_b, weeks=flagged, labels=P.direction_labels)


@query("hunt_exhibits")
def q_hunt_exhibits(spark, d):
    return exhibits(spark, d)


# ------------------------------------------------------------------ lexicon (X*, J3, J4, U1, G5-G7, H2, H3, P5, P6)

def web(spark, d):
    return lex.hunt_entity_web(wh(spark, d).emails(), web_entities(spark), P.web_lexicon,
                               aliases=P.web_aliases)


def leakage(spark, d):
    w = wh(spark, d)
    return lex.hunt_external_leakage(w.emails(), w.recipients(), events_table(spark),
                                     P.leak_lexicon, window=P.leak_window, suffix=P.internal_suffix)


@query("lexicon_mentions")
def q_lexicon_mentions(spark, d):
    return lex.lexicon_mentions(wh(spark, d).emails(), P.web_lexicon)


@query("co_mention_edges")
def q_co_mention_edges(spark, d):
    return lex.co_mention_edges(wh(spark, d).emails(), P.web_lexicon)


@query("co_mention_self_join")
def q_co_mention_self_join(spark, d):
    return lex.co_mention_self_join(lex.lexicon_mentions(wh(spark, d).emails(), P.web_lexicon))


@query("known_entities")
def q_known_entities(spark, d):
    # entities are the words of the public items; those in eight or more are known
    words = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("entity")
    entities = (td.read(spark, d, "benchmark").select(words).filter(F.col("entity") != "").groupBy("entity")
                  .agg((F.count(F.lit(1)) >= 8).alias("known")))
    return lex.known_entities(entities, P.web_aliases)


@query("known_flag_existence")
def q_known_flag_existence(spark, d):
    edges = lex.co_mention_edges(wh(spark, d).emails(), P.web_lexicon)
    return lex.known_flag_existence(edges, lex.known_entities(web_entities(spark), P.web_aliases))


@query("lexicon_mentions_prefiltered")
def q_lexicon_mentions_prefiltered(spark, d):
    return lex.lexicon_mentions(wh(spark, d).emails(), P.web_lexicon, prefilter=P.web_prefilter)


@query("entity_web_prefiltered")
def q_entity_web_prefiltered(spark, d):
    return lex.hunt_entity_web(wh(spark, d).emails(), web_entities(spark), P.web_lexicon, aliases=P.web_aliases,
                               prefilter=P.web_prefilter)


@query("hunt_entity_web")
def q_hunt_entity_web(spark, d):
    return web(spark, d)


@query("shadow_candidates")
def q_shadow_candidates(spark, d):
    return lex.shadow_candidates(ev(spark, d, "web"), P.web_threshold)


@query("classification_proposals")
def q_classification_proposals(spark, d):
    return lex.classification_proposals(ev(spark, d, "web"), glossary_table(spark), P.web_threshold)


@query("unknown_right_side")
def q_unknown_right_side(spark, d):
    return lex.unknown_right_side(ev(spark, d, "web"), 10)


@query("hunt_external_leakage")
def q_hunt_external_leakage(spark, d):
    return leakage(spark, d)


def table_lexicon(spark, d):
    """The undisclosed entities of the registry, keyed by their first words."""
    undisclosed = td.entity_table(spark, d).filter(~F.col("disclosed"))
    return wh(spark, d).evidence("lexicon", lambda: plex.entries(undisclosed))


@query("table_lexicon")
def q_table_lexicon(spark, d):
    return table_lexicon(spark, d)


@query("table_mentions")
def q_table_mentions(spark, d):
    return plex.table_mentions(wh(spark, d).emails(), table_lexicon(spark, d))


@query("table_leakage")
def q_table_leakage(spark, d):
    w = wh(spark, d)
    hits = plex.table_mentions(w.emails(), table_lexicon(spark, d), window=P.leak_window,
                               keep=("id", "sent_at", "sender", "subject"), dealt=True)
    return lex.sent_outside(hits, w.recipients(), events_table(spark), P.internal_suffix)


@query("leak_distinct_counts")
def q_leak_distinct_counts(spark, d):
    return lex.leak_distinct_counts(ev(spark, d, "leakage"))


@query("leak_domains")
def q_leak_domains(spark, d):
    return lex.leak_domains(ev(spark, d, "leakage"), 6)


@query("leak_domain_rows")
def q_leak_domain_rows(spark, d):
    return lex.leak_domain_rows(ev(spark, d, "leakage"), 12)


# ------------------------------------------------------------------ surge

def _events(spark, d):
    return td.read(spark, d, "events").select("user_id", "ts", "event_type")


def _day(c="ts"):
    return F.to_date(F.col(c))


@query("sample_attribute_join")
def q_sample_attribute_join(spark, d):
    return surge.sample_attribute_join(_events(spark, d), "user_id", _day(), "event_type",
                                       "day", "sample_event_type")


@query("sender_stats_having")
def q_sender_stats_having(spark, d):
    s = surge.sample_attribute_join(_events(spark, d), "user_id", _day(), "event_type", "day")
    st = surge.sender_stats_having(s, "user_id", P.surge_min_buckets)
    return st.select("user_id", "n_buckets", F.round("mu", 6).alias("mu"),
                     F.round("sigma", 6).alias("sigma"))


@query("stats_join")
def q_stats_join(spark, d):
    s = surge.sample_attribute_join(_events(spark, d), "user_id", _day(), "event_type", "day")
    st = surge.sender_stats_having(s, "user_id", P.surge_min_buckets)
    return surge.stats_join(s.select("user_id", "day", "vol"), st, "user_id").select(
        "user_id", "day", "vol", F.round("mu", 6).alias("mu"), F.round("sigma", 6).alias("sigma"))


@query("zscore_per_key")
def q_zscore_per_key(spark, d):
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    return surge.zscore_per_key(_events(spark, d), "user_id", hour, sample_col="event_type",
                                min_buckets=P.surge_min_buckets, z=P.surge_z,
                                bucket_name="hour", sample_name="sample_event_type")


def decoy(spark, d):
    return surge.zscore_per_key(_events(spark, d), "user_id", _day(), sample_col="event_type",
                                min_buckets=P.surge_min_buckets, z=P.surge_z,
                                bucket_name="day", sample_name="sample_event_type")


def ev(spark, d, name: str) -> DataFrame:
    """An investigation's evidence table (written once, then read)."""
    builders = {"spikes": spikes, "leakage": leakage, "web": web, "orphaned": orphaned,
                "provenance": provenance, "decoy": decoy, "exhibits": exhibits}
    return wh(spark, d).evidence(name, lambda: builders[name](spark, d))


@query("hunt_volume_decoy")
def q_hunt_volume_decoy(spark, d):
    return decoy(spark, d)


@query("top_surge")
def q_top_surge(spark, d):
    return surge.top_surge(ev(spark, d, "decoy"), "user_id", "day")


# ------------------------------------------------------------------ governance

def catalog(spark, d):
    return wh(spark, d).catalog()


def orphaned(spark, d):
    c = catalog(spark, d)
    return gov.hunt_orphaned_ownership(c["datasets"], c["owners"], c["users"], c["tags"], c["terms"],
                                       implicated=P.implicated, material_term=P.material_term,
                                       cert_tag=P.cert_tag)


def provenance(spark, d):
    c = catalog(spark, d)
    return gov.hunt_provenance_gaps(c["datasets"], c["job_io"], c["tags"], c["terms"],
                                    material_term=P.material_term, cert_tag=P.cert_tag)


@query("ownership_join")
def q_ownership_join(spark, d):
    c = catalog(spark, d)
    return gov.ownership_join(c["datasets"], c["owners"], c["users"], c["tags"], c["terms"],
                              P.material_term, P.cert_tag)


@query("hunt_orphaned_ownership")
def q_hunt_orphaned_ownership(spark, d):
    return orphaned(spark, d)


@query("unmatched_implicated")
def q_unmatched_implicated(spark, d):
    # the list as given plus a misspelled entry, the way a renamed account goes unnoticed
    return gov.unmatched_implicated(catalog(spark, d)["users"], P.implicated + ("s_3",))


@query("documented_outputs")
def q_documented_outputs(spark, d):
    return gov.documented_outputs(catalog(spark, d)["job_io"])


@query("producer_existence")
def q_producer_existence(spark, d):
    c = catalog(spark, d)
    return gov.producer_existence(c["datasets"].select("dataset"), c["job_io"])


@query("hunt_provenance_gaps")
def q_hunt_provenance_gaps(spark, d):
    return provenance(spark, d)


@query("catalog_bootstrap")
def q_catalog_bootstrap(spark, d):
    return gov.catalog_bootstrap(catalog(spark, d))


@query("catalog_entities")
def q_catalog_entities(spark, d):
    return gov.catalog_entities(wh(spark, d).registry(), glossary_table(spark), catalog(spark, d)["datasets"])


@query("catalog_completeness")
def q_catalog_completeness(spark, d):
    return gov.catalog_completeness(catalog(spark, d))


@query("material_assets")
def q_material_assets(spark, d):
    c = catalog(spark, d)
    return gov.material_assets(c["terms"], c["owners"], P.material_term)


# ------------------------------------------------------------------ profiles and reports (P*, K*, G8-G10, J10)
import datetime as dt  # noqa: E402
import uuid  # noqa: E402

from casefile.operators import gate as gt  # noqa: E402
from casefile.operators import ledger as lg  # noqa: E402
from casefile.operators import profile as pf  # noqa: E402
from casefile.operators import review as rv  # noqa: E402
from casefile.operators import transcripts as tr  # noqa: E402
from casefile.operators.run_ledger import RunLedger  # noqa: E402
from casefile.plans.expectations import expectations_for, shadow_list_for  # noqa: E402
from casefile.session import work_path  # noqa: E402
from casefile.streaming import alerts as al  # noqa: E402
from casefile.streaming import review_state as rs  # noqa: E402

PLAUSIBLE = ("1995-01-01", "2001-12-31")


def evidence(spark, d) -> dict[str, DataFrame]:
    """The six evidence sets under their evidence-table names."""
    return {
        "analytics.group_surge": ev(spark, d, "spikes"),
        "analytics.outside_terms": ev(spark, d, "leakage"),
        "analytics.term_web": ev(spark, d, "web"),
        "analytics.ownership_audit": ev(spark, d, "orphaned"),
        "analytics.lineage_audit": ev(spark, d, "provenance"),
        "analytics.volume_control": ev(spark, d, "decoy"),
    }


@query("date_range_profile")
def q_date_range_profile(spark, d):
    return pf.date_range_profile(wh(spark, d).emails(), *PLAUSIBLE)


@query("bad_date_senders")
def q_bad_date_senders(spark, d):
    return pf.bad_date_senders(wh(spark, d).emails(), *PLAUSIBLE)


@query("registry_distribution")
def q_registry_distribution(spark, d):
    return pf.registry_distribution(wh(spark, d).registry())


@query("unregistered_senders")
def q_unregistered_senders(spark, d):
    w = wh(spark, d)
    # the registry that the profile asks holds customers in credit and suppliers
    left = td.read(spark, d, "customer").filter(F.col("c_acctbal") < 0).select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@corp.example")).alias("addr"))
    return pf.unregistered_senders(w.emails(), w.recipients(), w.registry().join(left, "addr", "left_anti"))


@query("top_senders")
def q_top_senders(spark, d):
    w = wh(spark, d)
    return pf.top_senders(w.emails(), "sender", 10).unionByName(
        pf.top_senders(w.recipients(), "addr", 10, role="recipient"))


@query("table_row_counts")
def q_table_row_counts(spark, d):
    w = wh(spark, d)
    tables = {"staging.emails": w.emails(), "staging.recipients": w.recipients(),
              "staging.registry": w.registry(), "curated.comm_edges": w.comm_edges()}
    tables.update({f"catalog.{k}": v for k, v in w.catalog().items()})
    return pf.table_row_counts(tables)


@query("exhibit_counts")
def q_exhibit_counts(spark, d):
    return pf.exhibit_counts(ev(spark, d, "exhibits"))


@query("exhibit_members")
def q_exhibit_members(spark, d):
    return pf.exhibit_members(ev(spark, d, "exhibits"))


@query("message_dossier")
def q_message_dossier(spark, d):
    return pf.message_dossier(ev(spark, d, "exhibits"))


@query("flagged_peaks")
def q_flagged_peaks(spark, d):
    return pf.flagged_peaks(ev(spark, d, "spikes"))


@query("spike_series")
def q_spike_series(spark, d):
    return pf.spike_series(ev(spark, d, "spikes"))


@query("flag_totals")
def q_flag_totals(spark, d):
    return pf.flag_totals({"analytics.ownership_audit": ev(spark, d, "orphaned"),
                           "analytics.lineage_audit": ev(spark, d, "provenance")})


@query("headline_stats")
def q_headline_stats(spark, d):
    return pf.headline_stats(ev(spark, d, "spikes"), ev(spark, d, "exhibits"), P.flag_from)


@query("board_summary")
def q_board_summary(spark, d):
    counts = pf.evidence_row_counts(evidence(spark, d))
    return pf.board_summary(counts, rv.review_states(wh(spark, d).review_events()))


# ------------------------------------------------------------------ ledger

_TITLES = {
    "group_surge": ("analytics.group_surge", "Cross-group weekly communication surge", "medium"),
    "outside_terms": ("analytics.outside_terms", "External transmission of restricted terms", "medium"),
    "term_web": ("analytics.term_web", "Unclassified entities in the co-mention web", "high"),
    "ownership_audit": ("analytics.ownership_audit", "Datasets with departed or implicated owners", "high"),
    "lineage_audit": ("analytics.lineage_audit", "Material datasets with no documented provenance", "high"),
    "volume_control": ("analytics.volume_control", "Per-key volume surge (control)", "low"),
}
_INPUTS = {
    "group_surge": ["curated.comm_edges", "staging.registry", "reference.events"],
    "outside_terms": ["staging.emails", "staging.recipients", "reference.events"],
    "term_web": ["staging.emails", "reference.web_entities"],
    "ownership_audit": ["catalog.datasets", "catalog.owners", "catalog.users"],
    "lineage_audit": ["catalog.datasets", "catalog.job_io"],
    "volume_control": ["raw.events"],
}
RUN_ID = "run-1"


def ledger_records(spark, d) -> dict[str, DataFrame]:
    tables = evidence(spark, d)
    specs = [lg.finding_spec(
        tables[table], hunt_id=hunt, run_id=RUN_ID, title=title, narrative=f"{title}.",
        sql=f"casefile:{hunt}", evidence_table=table, input_tables=_INPUTS[hunt],
        terms=["Material"] if hunt in ("ownership_audit", "lineage_audit") else [],
        confidence=conf) for hunt, (table, title, conf) in _TITLES.items()]
    specs.append(lg.exhibit_spec(
        ev(spark, d, "exhibits"), hunt_id="group_surge", run_id=RUN_ID,
        finding_table="analytics.group_surge", exhibits_table="analytics.group_surge_messages",
        title="Messages of the surge", description="The messages behind the flagged weeks.",
        sql="casefile:hunt_exhibits", input_tables=["staging.emails", "staging.recipients"]))
    return lg.record_findings(specs)


#: The recorded runs of the multi-run ledger: when, and which part of the evidence.
RUN_TIMES = {"run-1": dt.datetime(2024, 1, 3), "run-2": dt.datetime(2024, 1, 15), "run-3": dt.datetime(2024, 1, 28)}


def _second_run(spark, d) -> dict[str, DataFrame]:
    """Three hunts again, on their flagged rows alone."""
    tables = evidence(spark, d)
    return lg.record_findings([lg.finding_spec(
        tables[_TITLES[hunt][0]].filter("flagged"), hunt_id=hunt, run_id="run-2", title=f"{_TITLES[hunt][1]}, flagged",
        narrative="Flagged rows alone.", sql=f"casefile:{hunt}?flagged", evidence_table=_TITLES[hunt][0],
        input_tables=[*_INPUTS[hunt], _TITLES[hunt][0]], terms=["Material"] if hunt == "lineage_audit" else [], confidence="high")
        for hunt in ("group_surge", "ownership_audit", "lineage_audit")])


def _third_run(spark, d) -> dict[str, DataFrame]:
    """One hunt again, and findings that lack a part each."""
    tables = evidence(spark, d)
    leak, decoy_rows = tables["analytics.outside_terms"], tables["analytics.volume_control"]

    def spec(name, df, **parts):
        given = {"sql": f"casefile:{name}", "input_tables": ["raw.events"], "tags": ["pending-review"], **parts}
        return lg.finding_spec(df, hunt_id=name, run_id="run-3", title=name, narrative=name, evidence_table=f"analytics.{name}",
                               confidence=None, **given)

    return lg.record_findings([
        lg.finding_spec(leak.filter("days_before_disclosure > 0"), hunt_id="outside_terms", run_id="run-3", title=_TITLES["outside_terms"][1],
                        narrative="Before disclosure.", sql="casefile:outside_terms?before", evidence_table="analytics.outside_terms",
                        input_tables=_INPUTS["outside_terms"], confidence="low"),
        spec("no_rows", decoy_rows.filter("vol < 0")), spec("no_sql", decoy_rows, sql=""),
        spec("no_inputs", decoy_rows, input_tables=[]), spec("no_fields", decoy_rows.select()), spec("no_state", decoy_rows, tags=["evidence"])])


def ledger(spark, d) -> RunLedger:
    """Three runs, the first of them recorded twice; written once an application."""
    def build() -> RunLedger:
        book = RunLedger(spark, work_path(spark, "ledger", uuid.uuid4().hex))
        first = ledger_records(spark, d)
        want = expectations(spark, d)
        first["assertions"] = gt.gate_assertions(gt.value_gate(checks(spark, d), want))
        second = _second_run(spark, d)
        moved = want.withColumn("want", F.when(F.col("check") == "surge.peak_volume", "0").otherwise(F.col("want")))
        second["assertions"] = gt.gate_assertions(gt.value_gate(checks(spark, d), moved)).filter(F.col("group").isin("surge", "web"))
        for run, records in (("run-1", first), ("run-2", second), ("run-1", first), ("run-3", _third_run(spark, d))):
            book.record(run, records, RUN_TIMES[run])
        return book
    return wh(spark, d).once("ledger", build)


@query("ledger_runs")
def q_ledger_runs(spark, d):
    book = ledger(spark, d)
    found = book.history("findings").groupBy("seq").agg(F.count(F.lit(1)).alias("findings"))
    return book.runs().join(found, "seq").select("run_id", "seq", F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"), "findings")


@query("ledger_history")
def q_ledger_history(spark, d):
    return ledger(spark, d).history("findings").select("run_id", "seq", "hunt_id", "evidence_table", "evidence_rows", "confidence")


@query("ledger_current")
def q_ledger_current(spark, d):
    return ledger(spark, d).findings().select("evidence_table", "run_id", "hunt_id", "title", "evidence_rows", "confidence",
                                              "times_recorded", "first_run")


@query("ledger_fields")
def q_ledger_fields(spark, d):
    return ledger(spark, d).current("fields").select("evidence_table", "ordinal", "field", "native_type", "logical_type")


@query("ledger_tags")
def q_ledger_tags(spark, d):
    return ledger(spark, d).current("tags").select("evidence_table", "value")


@query("ledger_terms")
def q_ledger_terms(spark, d):
    return ledger(spark, d).current("terms").select("evidence_table", "value")


@query("ledger_job_io")
def q_ledger_job_io(spark, d):
    return ledger(spark, d).current("job_io").select("job", "direction", "dataset")


@query("ledger_states")
def q_ledger_states(spark, d):
    events = review_log(spark, d).unionByName(ledger(spark, d).recordings())
    sets = ledger(spark, d).current("findings").select(F.col("evidence_table").alias("entity"))
    return rv.review_states(events.join(sets, "entity", "left_semi"))


@query("earlier_findings")
def q_earlier_findings(spark, d):
    return ledger(spark, d).earlier("run-3", tag="confidence-high")


@query("assertion_states")
def q_assertion_states(spark, d):
    return ledger(spark, d).current("assertions").drop("seq")


@query("materialize_evidence")
def q_materialize_evidence(spark, d):
    return lg.materialize_evidence(spikes(spark, d), "group_surge", work_path(spark, "evidence", uuid.uuid4().hex))


@query("evidence_versions")
def q_evidence_versions(spark, d):
    """A set that is materialized twice, another in between, as read back."""
    root = work_path(spark, "evidence", uuid.uuid4().hex)
    tables = evidence(spark, d)
    surge, web = tables["analytics.group_surge"], tables["analytics.term_web"]
    for name, rows in (("group_surge", surge), ('"my".`term_web`', web), ("Analytics.group_surge", surge.filter("flagged"))):
        lg.materialize_evidence(rows, name, root)
    read = [lg.read_evidence(spark, n, root).agg(F.count(F.lit(1)).alias("read")).select(F.lit(n).alias("name"), "read")
            for n in ("analytics.group_surge", "analytics.term_web")]
    return lg.evidence_versions(spark, root).join(pf.union_all(read), "name").select("name", "seq", "rows", "current", "read")


@query("record_finding")
def q_record_finding(spark, d):
    return ledger_records(spark, d)["findings"].filter(F.col("exhibit_of").isNull())


@query("record_exhibits")
def q_record_exhibits(spark, d):
    return ledger_records(spark, d)["findings"].filter(F.col("exhibit_of").isNotNull())


@query("lineage_edges")
def q_lineage_edges(spark, d):
    return lg.lineage_edges(catalog(spark, d)["job_io"])


@query("lineage_walk")
def q_lineage_walk(spark, d):
    return lg.lineage_walk_jobs(wh(spark, d).job_io(), P.lineage_start, "up")


@query("blast_radius")
def q_blast_radius(spark, d):
    """What stands within two jobs downstream of every material dataset."""
    c = catalog(spark, d)
    starts = c["terms"].filter(F.col("value") == P.material_term).select("dataset")
    return lg.lineage_reach(c["job_io"], starts, "down", 2, td.catalog_jobs(spark, d))


@query("verify_trails")
def q_verify_trails(spark, d):
    book = ledger(spark, d)
    return lg.verify_trails(*(book.current(t) for t in ("findings", "fields", "tags", "job_io")))


@query("prior_findings")
def q_prior_findings(spark, d):
    r = ledger_records(spark, d)
    return lg.prior_findings(r["findings"], r["tags"], tag="confidence-high").select(
        "hunt_id", "evidence_table", "evidence_rows")


@query("export_ledger")
def q_export_ledger(spark, d):
    r = ledger_records(spark, d)
    # states are needed only for the recorded evidence sets: semi-join the log first
    sets = r["findings"].select(F.col("evidence_table").alias("entity"))
    states = rv.review_states(wh(spark, d).review_events().join(sets, "entity", "left_semi"))
    return lg.export_ledger(r["findings"], states, work_path(spark, "export", uuid.uuid4().hex))


@query("catalog_names")
def q_catalog_names(spark, d):
    events = wh(spark, d).review_events().select("event_id", "entity", "modifier")
    return lg.catalog_names(events)


@query("catalog_entity_names")
def q_catalog_entity_names(spark, d):
    c = catalog(spark, d)
    row = lambda df, kind, path, name: df.select(F.lit(kind).alias("kind"), path.alias("path"), F.col(name).alias("name")).distinct()
    terms = c["terms"].join(c["datasets"], "dataset").select(F.col("domain"), F.col("value"))
    return lg.entity_names(pf.union_all([row(c["job_io"], "job", F.lit(""), "job"), row(c["owners"], "owner", F.lit(""), "value"),
                                         row(terms, "term", F.concat(F.lit("estate."), "domain"), "value")]))


# ------------------------------------------------------------------ review

def review_log(spark, d):
    return wh(spark, d).review_events()


@query("review_states")
def q_review_states(spark, d):
    return rv.review_states(review_log(spark, d))


def annotated(spark, d):
    return wh(spark, d).evidence("review_annotated", lambda: rv.annotated_log(review_log(spark, d)))


@query("apply_verdict")
def q_apply_verdict(spark, d):
    return rv.verdicts(annotated(spark, d))


@query("refused_verdicts")
def q_refused_verdicts(spark, d):
    return rv.refused_verdicts(annotated(spark, d))


@query("reopen_finding")
def q_reopen_finding(spark, d):
    return rv.reopens(annotated(spark, d))


@query("resolve_finding_keys")
def q_resolve_finding_keys(spark, d):
    log = review_log(spark, d)
    keys = (td.read(spark, d, "events").filter(F.col("event_type") == "signup")
              .select(F.concat(F.lit("x"), F.col("user_id").cast("string")).alias("key")))
    sets = log.select("entity").unionByName(
        staging.evidence_datasets(td.catalog_datasets(spark, d)).select(F.col("dataset").alias("entity")))
    return rv.resolve_finding_keys(keys, sets)


@query("resolve_hunt_keys")
def q_resolve_hunt_keys(spark, d):
    """By the set's name or its hunt's id, over the current findings and the
    catalog's long descriptions; short and long keys from their own words."""
    parts = td.catalog_datasets(spark, d).select(F.col("dataset").alias("entity"), F.col("description").alias("hunt"))
    sets = parts.unionByName(ledger(spark, d).current("findings").select(F.col("evidence_table").alias("entity"), F.col("hunt_id").alias("hunt")))
    words = td.read(spark, d, "part").select(F.col("p_name").alias("key")).unionByName(
        sets.select(F.explode(F.split(F.concat_ws(" ", "entity", "hunt"), "[ ._]")).alias("key")))
    return rv.resolve_finding_keys(words.filter("key <> ''"), sets, hunt_col="hunt")


@query("implicated_assets")
def q_implicated_assets(spark, d):
    parts = [rv.implicated_assets(df, name) for name, df in evidence(spark, d).items()]
    return pf.union_all(parts)


def assets(spark, d):
    return wh(spark, d).evidence("implicated", lambda: q_implicated_assets(spark, d))


def finding_actions(spark, d):
    return wh(spark, d).evidence("finding_actions", lambda: rv.finding_actions(review_log(spark, d), annotated(spark, d)))


def incident_actions(spark, d):
    """Incidents land on the assets that the reviewed evidence set implicates."""
    return rv.landed(finding_actions(spark, d), assets(spark, d))


def intervals(spark, d):
    return rv.incident_intervals(finding_actions(spark, d), assets(spark, d))


@query("incident_intervals")
def q_incident_intervals(spark, d):
    return intervals(spark, d)


@query("incidents_as_of")
def q_incidents_as_of(spark, d):
    return rv.incidents_as_of(intervals(spark, d), "2024-01-16 12:00:00")


@query("open_incidents_by_day")
def q_open_incidents_by_day(spark, d):
    return rv.open_incidents_by_day(intervals(spark, d))


@query("raise_incidents")
def q_raise_incidents(spark, d):
    return rv.raise_incidents(incident_actions(spark, d))


@query("resolve_incidents")
def q_resolve_incidents(spark, d):
    return rv.resolve_incidents(incident_actions(spark, d))


@query("active_incidents")
def q_active_incidents(spark, d):
    return rv.active_incidents(incident_actions(spark, d))


# ------------------------------------------------------------------ gate

MUST_INCLUDE = ("nation_1.example", "nation_2.example", "nation_3.example")


def checks(spark, d):
    return gt.gate_checks(ev(spark, d, "spikes"), ev(spark, d, "exhibits"), ev(spark, d, "leakage"), ev(spark, d, "web"),
                          ev(spark, d, "orphaned"), ev(spark, d, "provenance"), threshold=P.web_threshold,
                          must_include_domains=MUST_INCLUDE)


def expectations(spark, d) -> DataFrame:
    return gt.expectations_table(spark, expectations_for(spark, d))


def gate_results(spark, d):
    return gt.value_gate(checks(spark, d), expectations(spark, d))


@query("value_gate")
def q_value_gate(spark, d):
    return gate_results(spark, d)


@query("gate_assertions")
def q_gate_assertions(spark, d):
    return gt.gate_assertions(gate_results(spark, d))


def slice_tables(spark, d):
    w = wh(spark, d)
    return gt.extract_slice(w.comm_edges(), w.registry(), P.group_a, P.group_b,
                            work_path(spark, "slice", uuid.uuid4().hex))


@query("extract_slice")
def q_extract_slice(spark, d):
    return slice_tables(spark, d)["comm_edges"]


@query("recompute_check")
def q_recompute_check(spark, d):
    return gt.recompute_check(slice_tables(spark, d), events_table(spark), ev(spark, d, "spikes"),
                              group_a=P.group_a, group_b=P.group_b, baseline=P.baseline,
                              flag_from=P.flag_from, z=P.spike_z)


@query("set_compare")
def q_set_compare(spark, d):
    want = spark.createDataFrame([(w,) for w in shadow_list_for(spark, d)], "value string")
    got = lex.shadow_candidates(ev(spark, d, "web"), P.web_threshold).select(F.col("candidate").alias("value"))
    return gt.set_compare(got, want)


# ------------------------------------------------------------------ streaming alerts

def _alert_run(spark, d, dedup: bool = False, redeliver: bool = False):
    """Write the review events as the event folder, run the alert stream with
    availableNow into a JSON log, and return the log folder."""
    root = work_path(spark, "alerts", uuid.uuid4().hex)
    events = review_log(spark, d)
    deliveries = [events]
    if redeliver:  # a part, then every event (the part again), then another part, each its own run
        late = F.pmod(F.xxhash64("event_id"), F.lit(3))
        deliveries = [events.filter(late == 0), events, events.filter(late == 1)]
    for arrived in deliveries:
        arrived.write.mode("append").parquet(f"{root}/events")
        alerts = al.review_alerts_stream(spark, f"{root}/events", P.review_tags)
        if dedup:
            al.alert_dedup_stream(alerts, f"{root}/log", f"{root}/checkpoint")
        else:
            al.alert_log_append(alerts, f"{root}/log", f"{root}/checkpoint")
    return f"{root}/log"


#: Days that an event may come behind a later one, and days of a delivery.
HORIZON, DELIVERY = 3, 8


@query("review_state_stream")
def q_review_state_stream(spark, d):
    """The review log in deliveries that mix up to two days, each a run of its
    own from the checkpoint of the one before; closed at the end."""
    root = work_path(spark, "review-state", uuid.uuid4().hex)
    events = review_log(spark, d)
    delay = F.pmod(F.xxhash64("event_id"), F.lit(3))
    number = F.floor((F.datediff("at", F.lit("2024-01-01")) + delay) / DELIVERY).cast("int")
    numbered = events.withColumn("_n", F.greatest(number, F.lit(0)))
    size = numbered.agg(F.max("_n").alias("last"), F.approx_count_distinct("entity").alias("findings")).first()
    last, shards = size["last"] or 0, max(rs.SHARDS, size["findings"] // 64)
    closing = events.select("entity").distinct().select(
        F.lit(-1).cast("long").alias("event_id"), F.lit("2099-01-01").cast("timestamp").alias("at"), "entity",
        F.lit(rs.CLOSING).alias("category"), *[F.lit("").alias(c) for c in ("operation", "modifier", "actor", "note")])
    for part in [*[numbered.filter(F.col("_n") == i).drop("_n") for i in range(last + 1)], closing]:
        part.write.mode("append").parquet(f"{root}/events")
        rs.run_available(spark, f"{root}/events", f"{root}/decisions", f"{root}/checkpoint", HORIZON, shards)
    return spark.read.schema(rs.DECISION).parquet(f"{root}/decisions").withColumn("at", F.col("at").cast("timestamp_ntz"))


def _payload(df):
    return df.select("event_id", F.col("at").cast("timestamp_ntz").alias("at"), "entityUrn",
                     "category", "operation", "modifier")


@query("review_alerts_stream")
def q_review_alerts_stream(spark, d):
    return _payload(al.load_alert_log(spark, _alert_run(spark, d)))


@query("alert_log_append")
def q_alert_log_append(spark, d):
    log = al.load_alert_log(spark, _alert_run(spark, d))
    return log.select("event_id", "entityUrn", F.col("received_at").isNotNull().alias("stamped"))


@query("alert_feed")
def q_alert_feed(spark, d):
    return al.alert_feed(al.load_alert_log(spark, _alert_run(spark, d)))


@query("alert_dedup_stream")
def q_alert_dedup_stream(spark, d):
    return _payload(al.load_alert_log(spark, _alert_run(spark, d, dedup=True, redeliver=True)))


@query("load_alert_log")
def q_load_alert_log(spark, d):
    # The log's lines as another writer leaves them: the first of each day's
    # alerts is torn in the middle, a blank line behind it, and a line without
    # an id is whole.  The folder has no sink metadata, so every line is read.
    lines = spark.read.text(_alert_run(spark, d))
    path = work_path(spark, "alerts", uuid.uuid4().hex, "lines")
    event_id = F.get_json_object("value", "$.event_id").cast("long")
    torn = F.when(event_id % 100 == 0, F.substring("value", 1, 40))
    blank = F.when(event_id % 100 == 1, F.lit(""))
    nameless = F.when(event_id % 100 == 2, F.regexp_replace("value", '"event_id":[0-9]+,', ""))
    kept = F.when(event_id % 100 != 0, F.col("value"))
    lines.select(F.explode(F.array_compact(F.array(torn, blank, kept, nameless))).alias("value")).write.text(path)
    return _payload(al.load_alert_log(spark, path))


# ------------------------------------------------------------------ transcripts

#: Event types that stand for the tools that write.
WRITE_TOOLS = ("view", "click")


def msgs(spark, d):
    return wh(spark, d).transcripts()


def markers(spark, d):
    return tr.transcript_markers(msgs(spark, d), P.marker_words)


@query("transcript_markers")
def q_transcript_markers(spark, d):
    return markers(spark, d)


@query("run_reliability")
def q_run_reliability(spark, d):
    return tr.run_reliability(markers(spark, d), msgs(spark, d), "und")


@query("repeated_calls")
def q_repeated_calls(spark, d):
    return tr.repeated_calls(tr.call_signatures(wh(spark, d).tool_calls()), limit=P.repeat_limit,
                             budget_turn=P.budget_turn, write_tools=WRITE_TOOLS)


@query("budget_breaches")
def q_budget_breaches(spark, d):
    return tr.budget_breaches(wh(spark, d).tool_calls(), turn=P.budget_turn, write_tools=WRITE_TOOLS)


@query("artifact_manifest")
def q_artifact_manifest(spark, d):
    return tr.artifact_manifest(markers(spark, d))


@query("transcript_trace")
def q_transcript_trace(spark, d):
    return tr.transcript_trace(msgs(spark, d), P.trace_cut)


@query("normalized_tool_calls")
def q_normalized_tool_calls(spark, d):
    # the adapter's rule: a text's first word is the table name; texts of odd turns come as CREATE statements
    text = F.when(F.col("turn") % 2 == 1, F.concat(F.lit("Create or Replace VIEW v AS\n "), "text", F.lit(" ;\n"))
                  ).otherwise(F.col("text"))
    m = msgs(spark, d).select("run_id", "turn", F.split_part("text", F.lit(" "), F.lit(1)).alias("table_arg"),
                              text.alias("sql_arg"))
    return tr.normalized_tool_calls(m)
