"""DuckDB oracle SQL for every registered query (same column names)."""

from __future__ import annotations

from casefile.plans.oracle_ctes import CTES, _cte, with_ctes

ORACLES: dict[str, str] = {}


def oracle(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = with_ctes(body, *ctes)


oracle("hunt_comm_spikes", "SELECT * FROM comm_spikes", "comm_spikes")

# ------------------------------------------------------------------ staging
oracle("stage_messages", "SELECT * FROM emails", "emails")
oracle("explode_recipients", "SELECT * FROM recipients", "recipients")
oracle("reference_tables", "SELECT * FROM registry", "registry")
oracle("search_text", "SELECT id, lower(coalesce(subject, '') || ' ' || coalesce(body, '')) AS txt FROM emails",
       "emails")
oracle("message_excerpt", r"""
SELECT id, substr(regexp_replace(body, '\s+', ' ', 'g'), 1, 500) AS excerpt
FROM emails WHERE body IS NOT NULL""", "emails")
oracle("address_domain", """
SELECT email_id, addr, lower(split_part(addr, '@', 2)) AS domain, split_part(addr, '@', 1) AS username
FROM recipients""", "recipients")
oracle("week_bucket", "SELECT id, sent_at, CAST(date_trunc('week', sent_at) AS DATE) AS week FROM emails",
       "emails")
oracle("direction_label", "SELECT email_id, sender, recipient, direction FROM crossing", "crossing")
oracle("date_window_filter", """
SELECT id, sent_at FROM emails WHERE sent_at BETWEEN DATE '1995-01-01' AND DATE '2000-05-31'""", "emails")
_WEB_WORDS = ("the", "and", "that", "for", "this", "with", "que", "der", "die", "und", "elle", "pour",
              "con", "para")
oracle("keyword_prefilter", "SELECT id FROM emails WHERE "
       + " OR ".join(f"subject ILIKE '%{w}%' OR body ILIKE '%{w}%'" for w in _WEB_WORDS), "emails")
oracle("external_recipients", """
SELECT email_id, addr FROM recipients WHERE lower(split_part(addr, '@', -1)) <> 'corp.example'""",
       "recipients")
oracle("exclude_evidence_datasets", "SELECT dataset FROM cat_datasets WHERE dataset NOT LIKE 'analytics.%'",
       "cat_datasets")
oracle("message_recipient_join", """
SELECT e.id, e.msg_id, e.sender, e.sent_at, r.addr FROM emails e JOIN recipients r ON r.email_id = e.id""",
       "emails", "recipients")
oracle("weekly_edges", "SELECT * FROM comm_edges", "comm_edges")

oracle("colocated_join", """
SELECT e.id, e.msg_id, e.sender, e.sent_at, r.addr FROM emails e JOIN recipients r ON r.email_id = e.id""", "emails", "recipients")
oracle("colocated_weekly_edges", """
SELECT e.sender, r.addr AS recipient, CAST(date_trunc('week', e.sent_at) AS DATE) AS week, count(*) AS n
FROM emails e JOIN recipients r ON r.email_id = e.id WHERE e.sent_at BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
GROUP BY ALL""", "emails", "recipients")
oracle("colocated_leakage", "SELECT * FROM external_leakage", "external_leakage")

# ------------------------------------------------------------------ comms
_CROSS_EDGES = """
SELECT sender, recipient, week, count(*) AS n FROM crossing WHERE week IS NOT NULL GROUP BY ALL"""
oracle("cross_group_edges", _CROSS_EDGES, "crossing")
oracle("cross_group_volume", "SELECT * FROM xgroup_series", "xgroup_series")
oracle("baseline_stats", "SELECT round(mu, 6) AS mu, round(sigma, 6) AS sigma FROM baseline", "baseline")
oracle("baseline_cross_join", """
SELECT x.week, x.vol, round(b.mu, 6) AS mu, round(b.sigma, 6) AS sigma FROM xgroup_series x, baseline b""",
       "xgroup_series", "baseline")
oracle("zscore_fixed_baseline", "SELECT week, vol, zscore, flagged FROM comm_spikes", "comm_spikes")
oracle("nearest_event_days", "SELECT week, days_to_event FROM comm_spikes", "comm_spikes")
oracle("first_event_scalar", """
SELECT e.id, e.sent_at, (f.first_day - e.sent_at)::BIGINT AS days_before_disclosure
FROM emails e, (SELECT min(event_date) AS first_day FROM events_ref) f WHERE e.sent_at IS NOT NULL""", "emails", "events_ref")
oracle("hunt_exhibits", "SELECT * FROM exhibits", "exhibits")

# ------------------------------------------------------------------ lexicon
oracle("lexicon_mentions", "SELECT * FROM web_mentions", "web_mentions")
oracle("co_mention_edges", "SELECT * FROM web_edges", "web_edges")
oracle("co_mention_self_join", "SELECT * FROM web_edges", "web_edges")
ORACLES["known_entities"] = r"""
SELECT w AS entity FROM (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS w FROM benchmark)
GROUP BY w HAVING count(*) >= 8
UNION ALL SELECT 'que'"""
oracle("lexicon_mentions_prefiltered", "SELECT * FROM web_mentions SEMI JOIN web_prefiltered USING (id)",
       "web_mentions", "web_prefiltered")
oracle("entity_web_prefiltered", """
SELECT entity_a, entity_b, count(*) AS co_mentions, bool_and(entity_a IN ('for', 'que', 'the')) AS a_known,
       bool_and(entity_b IN ('for', 'que', 'the')) AS b_known
FROM (SELECT x.entity AS entity_a, y.entity AS entity_b
      FROM web_mentions x JOIN web_mentions y USING (id) SEMI JOIN web_prefiltered USING (id) WHERE x.entity < y.entity)
GROUP BY ALL""", "web_mentions", "web_prefiltered")
oracle("known_flag_existence", "SELECT * FROM web", "web")
oracle("hunt_entity_web", "SELECT * FROM web", "web")
oracle("shadow_candidates", "SELECT * FROM shadow", "shadow")
oracle("classification_proposals", """
SELECT candidate AS term, total AS support, 'pending-review' AS status FROM shadow
WHERE candidate NOT IN (SELECT lower(n) FROM (VALUES ('Material'), ('PII'), ('Para')) g(n))""", "shadow")
oracle("unknown_right_side", """
SELECT entity_b, CAST(sum(co_mentions) AS BIGINT) AS total FROM web WHERE NOT b_known
GROUP BY 1 ORDER BY total DESC, entity_b LIMIT 10""", "web")
oracle("hunt_external_leakage", "SELECT * FROM external_leakage", "external_leakage")
_cte("entity_registry", r"""
SELECT entity, bool_and(doc_id % 2 = 0) AS disclosed FROM (
  SELECT doc_id, array_to_string(list_slice(w, 6, 7 + doc_id % 3), ' ') AS entity
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z_]+') AS w FROM documents WHERE text IS NOT NULL) WHERE len(w) > 8)
GROUP BY entity
""")
_cte("entity_places", r"""
SELECT t.id, t.sent_at, t.sender, t.subject, r.entity, t.i, t.i + k AS e
FROM (SELECT id, sent_at, sender, subject, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
      FROM (SELECT *, regexp_extract_all(lower(coalesce(subject, '') || ' ' || coalesce(body, '')), '[0-9a-z_]+') AS w FROM emails),
           (VALUES (2), (3), (4)) v(k), unnest(range(1, len(w) - k + 2)) r(i)) t
JOIN entity_registry r ON r.entity = t.phrase AND NOT r.disclosed
""", "emails", "entity_registry")
_cte("entity_mentions", """
SELECT DISTINCT id, sent_at, sender, subject, entity FROM entity_places a
WHERE NOT EXISTS (SELECT 1 FROM entity_places b WHERE b.id = a.id AND b.i <= a.i AND b.e >= a.e AND b.e - b.i > a.e - a.i)
""", "entity_places")
oracle("table_lexicon", """
SELECT entity AS phrase, CAST(len(string_split(entity, ' ')) AS INTEGER) AS n_words, entity, split_part(entity, ' ', 1) AS first
FROM entity_registry WHERE NOT disclosed""", "entity_registry")
oracle("table_mentions", "SELECT id, entity FROM entity_mentions", "entity_mentions")
oracle("table_leakage", """
SELECT m.id AS email_id, m.sent_at, m.sender, m.subject, m.entity, r.addr AS external_recipient,
       lower(split_part(r.addr, '@', 2)) AS external_domain,
       ((SELECT min(event_date) FROM events_ref) - m.sent_at)::BIGINT AS days_before_disclosure
FROM entity_mentions m JOIN recipients r ON r.email_id = m.id AND lower(split_part(r.addr, '@', -1)) <> 'corp.example'
WHERE m.sent_at BETWEEN DATE '1995-01-01' AND DATE '2000-05-31'""", "entity_mentions", "recipients", "events_ref")
oracle("leak_distinct_counts", """
SELECT count(DISTINCT email_id) AS distinct_emails, count(DISTINCT external_recipient) AS distinct_addresses,
       count(DISTINCT email_id) FILTER (WHERE days_before_disclosure > 0) AS predisclosure_emails,
       count(DISTINCT external_recipient) FILTER (WHERE days_before_disclosure > 0) AS predisclosure_addresses
FROM external_leakage""", "external_leakage")
oracle("leak_domains", """
SELECT external_domain, count(DISTINCT email_id) AS n FROM external_leakage
GROUP BY 1 ORDER BY n DESC, external_domain LIMIT 6""", "external_leakage")
oracle("leak_domain_rows", """
SELECT external_domain, count(*) AS n FROM external_leakage
GROUP BY 1 ORDER BY n DESC, external_domain LIMIT 12""", "external_leakage")

# ------------------------------------------------------------------ surge
oracle("sample_attribute_join", "SELECT * FROM surge_series", "surge_series")
oracle("sender_stats_having", """
SELECT user_id, n_buckets, round(mu, 6) AS mu, round(sigma, 6) AS sigma FROM surge_stats""", "surge_stats")
oracle("stats_join", """
SELECT s.user_id, s.day, s.vol, round(t.mu, 6) AS mu, round(t.sigma, 6) AS sigma
FROM surge_series s JOIN surge_stats t ON s.user_id = t.user_id""", "surge_series", "surge_stats")
oracle("zscore_per_key", """
WITH hs AS (SELECT user_id, date_trunc('hour', ts) AS hour, CAST(count(*) AS BIGINT) AS vol,
                   min(event_type) AS sample_event_type FROM events GROUP BY 1, 2),
     st AS (SELECT user_id, CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS mu,
                   sqrt(CAST(n * ss - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) AS sigma
            FROM (SELECT user_id, CAST(sum(vol) AS HUGEINT) AS s, CAST(sum(vol * vol) AS HUGEINT) AS ss,
                         count(*) AS n FROM hs GROUP BY 1) t
            WHERE n >= 12 AND n * ss - s * s > 0)
SELECT hs.user_id, hs.hour, hs.vol, floor((hs.vol - st.mu) / st.sigma * 100 + 0.5) / 100 AS zscore,
       hs.sample_event_type
FROM hs JOIN st ON hs.user_id = st.user_id WHERE (hs.vol - st.mu) / st.sigma >= 2.5""")
oracle("hunt_volume_decoy", "SELECT * FROM decoy", "decoy")
oracle("top_surge", "SELECT * FROM decoy ORDER BY zscore DESC, user_id, day LIMIT 1", "decoy")

# ------------------------------------------------------------------ governance
oracle("ownership_join", "SELECT * FROM ownership", "ownership")
oracle("hunt_orphaned_ownership", "SELECT * FROM orphaned", "orphaned")
oracle("documented_outputs", "SELECT * FROM outputs", "outputs")
oracle("unmatched_implicated", """
SELECT name FROM (VALUES ('s1'), ('s3'), ('s_3')) t(name)
WHERE name NOT IN (SELECT username FROM cat_users)""", "cat_users")
oracle("producer_existence", """
SELECT dataset, dataset IN (SELECT dataset FROM outputs) AS has_documented_lineage FROM cat_datasets""",
       "cat_datasets", "outputs")
oracle("hunt_provenance_gaps", "SELECT * FROM provenance", "provenance")
oracle("catalog_bootstrap", """
SELECT dataset, 'platform' AS aspect, platform AS value FROM cat_datasets
UNION ALL SELECT dataset, 'domain', domain FROM cat_datasets WHERE domain IS NOT NULL
UNION ALL SELECT dataset, 'field', concat_ws(':', ordinal, field, native_type) FROM cat_fields
UNION ALL SELECT dataset, 'owner', value FROM cat_owners
UNION ALL SELECT dataset, 'tag', value FROM cat_tags
UNION ALL SELECT dataset, 'term', value FROM cat_terms
UNION ALL SELECT dataset, concat('job_', direction), job FROM cat_job_io""",
       "cat_datasets", "cat_fields", "cat_owners", "cat_tags", "cat_terms", "cat_job_io")
oracle("catalog_completeness", """
SELECT dataset, has_schema, has_domain, has_owner, has_tags, has_terms, has_producer,
       concat_ws(', ', CASE WHEN NOT has_schema THEN 'schema' END, CASE WHEN NOT has_domain THEN 'domain' END,
                 CASE WHEN NOT has_owner THEN 'owner' END,
                 CASE WHEN NOT has_tags THEN 'tags' END, CASE WHEN NOT has_terms THEN 'terms' END,
                 CASE WHEN NOT has_producer THEN 'producer' END) AS missing
FROM (SELECT dataset, domain IS NOT NULL AS has_domain,
             dataset IN (SELECT dataset FROM cat_fields) AS has_schema,
             dataset IN (SELECT dataset FROM cat_owners) AS has_owner,
             dataset IN (SELECT dataset FROM cat_tags) AS has_tags,
             dataset IN (SELECT dataset FROM cat_terms) AS has_terms,
             dataset IN (SELECT dataset FROM outputs) AS has_producer
      FROM cat_datasets) x""", "cat_datasets", "cat_fields", "cat_owners", "cat_tags", "cat_terms", "outputs")
oracle("catalog_entities", """
SELECT 'user' AS kind, split_part(addr, '@', 1) AS name, concat(name, ', ', title, ' (', dept, '), ', addr) AS detail FROM registry
UNION ALL SELECT 'term', n, n || ' data of the estate' FROM (VALUES ('Material'), ('PII'), ('Para')) g(n)
UNION ALL SELECT 'domain', domain, CAST(count(DISTINCT dataset) AS VARCHAR) FROM cat_datasets WHERE domain IS NOT NULL GROUP BY domain""",
       "registry", "cat_datasets")
oracle("catalog_entity_names", """
SELECT 'job' AS kind, job AS name, 'urn:casefile:job:' || job AS urn, job AS parsed FROM (SELECT DISTINCT job FROM cat_job_io)
UNION ALL SELECT 'owner', value, 'urn:casefile:user:' || value, value FROM (SELECT DISTINCT value FROM cat_owners)
UNION ALL SELECT 'term', value, concat('urn:casefile:term:estate.', domain, '.', value), value
FROM (SELECT DISTINCT d.domain, t.value FROM cat_terms t JOIN cat_datasets d USING (dataset))""",
       "cat_job_io", "cat_owners", "cat_terms", "cat_datasets")
oracle("material_assets", """
SELECT t.dataset, o.value AS owner FROM (SELECT DISTINCT dataset FROM cat_terms WHERE value = 'Material') t
LEFT JOIN (SELECT DISTINCT dataset, value FROM cat_owners) o ON o.dataset = t.dataset""",
       "cat_terms", "cat_owners")

# ------------------------------------------------------------------ profiles and reports
oracle("date_range_profile", """
SELECT count(*) AS rows, min(sent_at) AS min_date, max(sent_at) AS max_date,
       count(*) FILTER (WHERE sent_at IS NULL) AS null_dates,
       count(*) FILTER (WHERE sent_at < DATE '1995-01-01' OR sent_at > DATE '2001-12-31') AS outside_range
FROM emails""", "emails")
oracle("bad_date_senders", """
SELECT sender, count(*) FILTER (WHERE sent_at IS NULL OR sent_at < DATE '1995-01-01'
                                  OR sent_at > DATE '2001-12-31') AS bad_dates,
       count(*) AS messages
FROM emails GROUP BY sender HAVING bad_dates > 0""", "emails")
oracle("registry_distribution", "SELECT dept, count(*) AS n FROM registry GROUP BY dept", "registry")
oracle("unregistered_senders", """
SELECT role, addr, n FROM (
  SELECT 'sender' AS role, sender AS addr, count(*) AS n FROM emails WHERE sender IS NOT NULL GROUP BY sender
  UNION ALL SELECT 'recipient', addr, count(*) FROM recipients GROUP BY addr) x
WHERE n >= 1 AND addr NOT IN (
  SELECT addr FROM registry
  EXCEPT SELECT format('c{}@corp.example', c_custkey) FROM customer WHERE c_acctbal < 0)""", "emails", "recipients", "registry")
oracle("top_senders", """
SELECT * FROM (SELECT sender AS addr, count(*) AS n, 'sender' AS role FROM emails GROUP BY 1
               ORDER BY n DESC, addr LIMIT 10) a
UNION ALL
SELECT * FROM (SELECT addr, count(*) AS n, 'recipient' AS role FROM recipients GROUP BY 1
               ORDER BY n DESC, addr LIMIT 10) b""", "emails", "recipients")
oracle("table_row_counts", """
SELECT 'staging.emails' AS "table", count(*) AS rows FROM emails
UNION ALL SELECT 'staging.recipients', count(*) FROM recipients
UNION ALL SELECT 'staging.registry', count(*) FROM registry
UNION ALL SELECT 'curated.comm_edges', count(*) FROM comm_edges
UNION ALL SELECT 'catalog.datasets', count(*) FROM cat_datasets
UNION ALL SELECT 'catalog.fields', count(*) FROM cat_fields
UNION ALL SELECT 'catalog.tags', count(*) FROM cat_tags
UNION ALL SELECT 'catalog.terms', count(*) FROM cat_terms
UNION ALL SELECT 'catalog.owners', count(*) FROM cat_owners
UNION ALL SELECT 'catalog.users', count(*) FROM cat_users
UNION ALL SELECT 'catalog.job_io', count(*) FROM cat_job_io""",
       "emails", "recipients", "registry", "comm_edges", "cat_datasets", "cat_fields", "cat_tags", "cat_terms",
       "cat_owners", "cat_users", "cat_job_io")
oracle("exhibit_counts", """
SELECT count(*) AS edges, count(DISTINCT msg_id) AS distinct_messages,
       count(DISTINCT recipient) AS distinct_recipients, count(DISTINCT sender) AS distinct_senders
FROM exhibits""", "exhibits")
oracle("exhibit_members", """
SELECT 'sender' AS role, sender AS addr FROM exhibits
UNION SELECT 'recipient', recipient FROM exhibits""", "exhibits")
oracle("message_dossier", """
SELECT msg_id, min(sent_at) AS sent_at, min(sender) AS sender,
       string_agg(DISTINCT recipient, ', ' ORDER BY recipient) AS recipients,
       min(subject) AS subject, min(excerpt) AS excerpt
FROM exhibits GROUP BY msg_id""", "exhibits")
oracle("flagged_peaks", """
SELECT week, vol, zscore, week = (SELECT week FROM peak) AS is_peak FROM comm_spikes WHERE flagged""",
       "comm_spikes", "peak")
oracle("spike_series", "SELECT week, vol, zscore FROM comm_spikes", "comm_spikes")
oracle("flag_totals", """
SELECT 'analytics.ownership_audit' AS evidence_table, count(*) FILTER (WHERE flagged) AS flagged,
       count(*) AS audited FROM orphaned
UNION ALL
SELECT 'analytics.lineage_audit', count(*) FILTER (WHERE flagged), count(*) FROM provenance""",
       "orphaned", "provenance")
oracle("headline_stats", """
SELECT b.baseline_mean, x.exhibit_edges, x.exhibit_messages, p.week AS peak_week, p.vol AS peak_volume,
       p.zscore AS peak_zscore, p.days_to_event
FROM (SELECT round(avg(vol)) AS baseline_mean FROM comm_spikes WHERE week < DATE '2000-01-01') b
CROSS JOIN (SELECT count(*) AS exhibit_edges, count(DISTINCT msg_id) AS exhibit_messages FROM exhibits) x
LEFT JOIN peak p ON true""", "comm_spikes", "exhibits", "peak")
oracle("board_summary", """
SELECT e.hunts, e.evidence_rows, s.reviewed, s.confirmed
FROM (SELECT count(*) AS hunts, CAST(sum(rows) AS BIGINT) AS evidence_rows FROM evidence_counts) e,
     (SELECT count(*) AS reviewed, count(*) FILTER (WHERE state = 'confirmed') AS confirmed
      FROM review_states) s""", "evidence_counts", "review_states")

# ------------------------------------------------------------------ ledger
_FINDINGS = [
    ("group_surge", "analytics.group_surge", "Cross-group weekly communication surge",
     "medium", "comm_spikes"),
    ("outside_terms", "analytics.outside_terms", "External transmission of restricted terms",
     "medium", "external_leakage"),
    ("term_web", "analytics.term_web", "Unclassified entities in the co-mention web", "high", "web"),
    ("ownership_audit", "analytics.ownership_audit",
     "Datasets with departed or implicated owners", "high", "orphaned"),
    ("lineage_audit", "analytics.lineage_audit",
     "Material datasets with no documented provenance", "high", "provenance"),
    ("volume_control", "analytics.volume_control", "Per-key volume surge (control)", "low", "decoy"),
]


def _finding_sql(hunt, table, title, conf, src, exhibit_of=None, job=None, sql=None):
    ex = "CAST(NULL AS VARCHAR)" if exhibit_of is None else f"'{exhibit_of}'"
    narrative = f"{title}." if exhibit_of is None else "The messages behind the flagged weeks."
    conf_sql = "CAST(NULL AS VARCHAR)" if conf is None else f"'{conf}'"
    return (f"SELECT '{hunt}' AS hunt_id, 'run-1' AS run_id, '{title}' AS title, '{narrative}' AS narrative, "
            f"{conf_sql} AS confidence, '{sql or 'casefile:' + hunt}' AS sql_text, '{table}' AS evidence_table, "
            f"'{job or hunt}' AS job, {ex} AS exhibit_of, count(*) AS evidence_rows FROM {src}")


_EXHIBIT_FINDING = _finding_sql("group_surge", "analytics.group_surge_messages", "Messages of the surge", None,
                                "exhibits", exhibit_of="analytics.group_surge",
                                job="group_surge_exhibits", sql="casefile:hunt_exhibits")
_ALL_FINDINGS = "\nUNION ALL ".join([_finding_sql(*f) for f in _FINDINGS] + [_EXHIBIT_FINDING])
_FINDING_CTES = ("comm_spikes", "external_leakage", "web", "orphaned", "provenance", "decoy", "exhibits")

oracle("materialize_evidence",
       "SELECT 'analytics.group_surge' AS name, count(*) AS rows FROM comm_spikes", "comm_spikes")
oracle("evidence_versions", """
SELECT 'analytics.group_surge' AS name, 1::BIGINT AS seq, count(*) AS rows, false AS current, count(*) FILTER (WHERE flagged) AS read FROM comm_spikes
UNION ALL SELECT 'analytics.term_web', 2, count(*), true, count(*) FROM web
UNION ALL SELECT 'analytics.group_surge', 3, count(*), true, count(*) FROM comm_spikes WHERE flagged""", "comm_spikes", "web")
oracle("record_finding", "\nUNION ALL ".join(_finding_sql(*f) for f in _FINDINGS), *_FINDING_CTES[:-1])
oracle("record_exhibits", _EXHIBIT_FINDING, "exhibits")
oracle("lineage_edges", """
SELECT DISTINCT i.dataset AS upstream, o.dataset AS downstream
FROM cat_job_io i JOIN cat_job_io o ON i.job = o.job WHERE i.direction = 'in' AND o.direction = 'out'""",
       "cat_job_io")
oracle("lineage_walk", """
, hop AS (SELECT o.dataset AS made, i.dataset AS used, min(i.job) AS job
          FROM cat_job_io i JOIN cat_job_io o ON i.job = o.job
          WHERE i.direction = 'in' AND o.direction = 'out' GROUP BY ALL)
SELECT * FROM (
  WITH RECURSIVE walk(dataset, depth, job) USING KEY (dataset) AS (
    SELECT 'part.p1', 0, NULL::VARCHAR
    UNION
    SELECT h.used, min(w.depth + 1), min(h.job)
    FROM walk w JOIN hop h ON h.made = w.dataset
    WHERE NOT EXISTS (SELECT 1 FROM recurring.walk seen WHERE seen.dataset = h.used) GROUP BY h.used)
  SELECT dataset, depth, job FROM walk)""", "cat_job_io")
oracle("prior_findings", f"""
SELECT hunt_id, evidence_table, evidence_rows FROM ({_ALL_FINDINGS}) f WHERE confidence = 'high'""",
       *_FINDING_CTES)
oracle("export_ledger", f"""
SELECT f.hunt_id, f.title, f.narrative,
       concat('urn:casefile:dataset:parquet:', f.evidence_table) AS evidence_dataset,
       concat('urn:casefile:job:', f.job) AS producing_task,
       coalesce(s.state, 'unknown') AS review_state, f.evidence_rows, coalesce(f.confidence, '') AS confidence, f.sql_text
FROM ({_ALL_FINDINGS}) f LEFT JOIN review_states s ON s.entity = f.evidence_table""",
       *_FINDING_CTES, "review_states")
oracle("catalog_names", """
SELECT event_id, entity, modifier,
       concat('urn:casefile:dataset:parquet:', entity) AS dataset_urn,
       entity AS table_name, string_split(modifier, ':')[-1] AS short_name
FROM review_events""", "review_events")

oracle("blast_radius", """
, hop AS (SELECT i.dataset AS used, o.dataset AS made, min(i.job) AS job
          FROM cat_job_io i JOIN cat_job_io o ON i.job = o.job WHERE i.direction = 'in' AND o.direction = 'out' GROUP BY ALL),
  starts AS (SELECT DISTINCT dataset AS source FROM cat_terms WHERE value = 'Material'),
  one AS (SELECT s.source, h.made AS dataset, min(h.job) AS job FROM starts s JOIN hop h ON h.used = s.source
          WHERE h.made <> s.source GROUP BY ALL),
  two AS (SELECT a.source, h.made AS dataset, min(h.job) AS job FROM one a JOIN hop h ON h.used = a.dataset
          WHERE h.made <> a.source GROUP BY ALL),
  walk AS (SELECT source, source AS dataset, CAST(NULL AS VARCHAR) AS job, 0 AS depth FROM starts
           UNION ALL SELECT *, 1 FROM one UNION ALL SELECT *, 2 FROM two ANTI JOIN one USING (source, dataset))
SELECT source, dataset, job, depth, 'select * from lineitem where l_orderkey = ' || substr(job, 2) AS sql_text FROM walk""",
       "cat_job_io", "cat_terms")

# ------------------------------------------------------------------ the ledger over runs
_SOURCE = {table: src for _, table, _, _, src in _FINDINGS} | {"analytics.group_surge_messages": "exhibits"}
_THIRD = ("no_rows", "no_sql", "no_inputs", "no_fields", "no_state")


def _again(hunt: str, run: str, where: str, confidence: str, title: str, sql: str) -> str:
    table, src = next((t, s) for h, t, _, _, s in _FINDINGS if h == hunt)
    return (f"SELECT '{hunt}' AS hunt_id, '{run}' AS run_id, '{title}' AS title, '{confidence}' AS confidence, '{sql}' AS sql_text, "
            f"'{table}' AS evidence_table, '{hunt}' AS job, CAST(NULL AS VARCHAR) AS exhibit_of, count(*) AS evidence_rows FROM {src} WHERE {where}")


_TITLE = {h: title for h, _, title, _, _ in _FINDINGS}
_cte("ledger_rows", "SELECT *, CAST(right(run_id, 1) AS BIGINT) AS seq FROM (\n" + "\nUNION ALL BY NAME ".join([
    f"SELECT * EXCLUDE (narrative) FROM ({_ALL_FINDINGS})",
    *[_again(h, "run-2", "flagged", "high", f"{_TITLE[h]}, flagged", f"casefile:{h}?flagged")
      for h in ("group_surge", "ownership_audit", "lineage_audit")],
    _again("outside_terms", "run-3", "days_before_disclosure > 0", "low", _TITLE["outside_terms"], "casefile:outside_terms?before"),
    *[f"SELECT '{n}' AS hunt_id, 'run-3' AS run_id, '{n}' AS title, CAST(NULL AS VARCHAR) AS confidence, "
      f"'{'' if n == 'no_sql' else 'casefile:' + n}' AS sql_text, 'analytics.{n}' AS evidence_table, '{n}' AS job, "
      f"CAST(NULL AS VARCHAR) AS exhibit_of, count(*) AS evidence_rows FROM decoy{' WHERE vol < 0' if n == 'no_rows' else ''}" for n in _THIRD],
]) + ")", *_FINDING_CTES)
_cte("ledger_now", "SELECT * FROM ledger_rows QUALIFY seq = max(seq) OVER (PARTITION BY evidence_table)", "ledger_rows")


def _described(table: str, src: str) -> str:
    """The columns of an evidence set, as the engine itself describes them."""
    rows = f"SELECT row_number() OVER () - 1 AS i, * FROM (DESCRIBE {with_ctes(f'SELECT * FROM {src}', src)})"
    return (f"SELECT '{table}' AS evidence_table, CAST(i AS INTEGER) AS ordinal, column_name AS field, "
            "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS native_type, "
            "CASE WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'number' WHEN column_type IN ('DATE', 'TIMESTAMP') THEN 'date' "
            f"WHEN column_type = 'BOOLEAN' THEN 'boolean' ELSE 'string' END AS logical_type FROM ({rows})")


_cte("ledger_field_rows", "\nUNION ALL ".join(
    _described(t, src) for t, src in [*_SOURCE.items(), *[(f"analytics.{n}", "decoy") for n in _THIRD if n != "no_fields"]]))
_cte("ledger_tag_rows", """
SELECT evidence_table, unnest(CASE WHEN hunt_id = 'no_state' THEN ['evidence'] WHEN hunt_id LIKE 'no@_%' ESCAPE '@' THEN ['pending-review']
  WHEN exhibit_of IS NOT NULL THEN ['evidence', 'exhibit'] ELSE ['risk-flagged', 'pending-review', 'confidence-' || confidence] END) AS value
FROM ledger_now""", "ledger_now")
_cte("ledger_io_rows", """
SELECT n.job, 'out' AS direction, n.evidence_table AS dataset FROM ledger_now n
UNION ALL SELECT n.job, 'in', unnest(CASE n.job
    WHEN 'group_surge' THEN ['curated.comm_edges', 'staging.registry', 'reference.events']
    WHEN 'group_surge_exhibits' THEN ['staging.emails', 'staging.recipients', 'analytics.group_surge']
    WHEN 'outside_terms' THEN ['staging.emails', 'staging.recipients', 'reference.events']
    WHEN 'term_web' THEN ['staging.emails', 'reference.web_entities']
    WHEN 'ownership_audit' THEN ['catalog.datasets', 'catalog.owners', 'catalog.users']
    WHEN 'lineage_audit' THEN ['catalog.datasets', 'catalog.job_io']
    WHEN 'no_inputs' THEN [] ELSE ['raw.events'] END) FROM ledger_now n
UNION ALL SELECT job, 'in', evidence_table FROM ledger_now WHERE run_id = 'run-2'""", "ledger_now")
_cte("ledger_events", """
SELECT * FROM review_events
UNION ALL BY NAME SELECT DISTINCT -seq AS event_id, CASE seq WHEN 1 THEN TIMESTAMP '2024-01-03' WHEN 2 THEN TIMESTAMP '2024-01-15'
  ELSE TIMESTAMP '2024-01-28' END AS "at", evidence_table AS entity, 'TAG' AS category, 'ADD' AS operation, '' AS modifier,
  run_id AS actor, 'view' AS note FROM ledger_rows""", "review_events", "ledger_rows")
_cte("ledger_folded", CTES["folded"][0].replace("review_events", "ledger_events"), "ledger_events")

oracle("ledger_runs", """
SELECT run_id, seq, CASE seq WHEN 1 THEN TIMESTAMP '2024-01-03' WHEN 2 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-01-28' END AS recorded_at,
       count(*) AS findings FROM ledger_rows GROUP BY ALL""", "ledger_rows")
oracle("ledger_history", "SELECT run_id, seq, hunt_id, evidence_table, evidence_rows, confidence FROM ledger_rows", "ledger_rows")
oracle("ledger_current", """
SELECT evidence_table, run_id, hunt_id, title, evidence_rows, confidence, times_recorded, first_run
FROM ledger_now JOIN (SELECT evidence_table, count(*) AS times_recorded, arg_min(run_id, seq) AS first_run FROM ledger_rows
                      GROUP BY evidence_table) USING (evidence_table)""", "ledger_now", "ledger_rows")
oracle("ledger_fields", "SELECT * FROM ledger_field_rows", "ledger_field_rows")
oracle("ledger_tags", "SELECT * FROM ledger_tag_rows", "ledger_tag_rows")
oracle("ledger_terms", """
SELECT evidence_table, 'Material' AS value FROM ledger_now
WHERE hunt_id = 'lineage_audit' OR (hunt_id = 'ownership_audit' AND run_id = 'run-1')""", "ledger_now")
oracle("ledger_job_io", "SELECT * FROM ledger_io_rows", "ledger_io_rows")
oracle("ledger_states", f"""
SELECT * FROM ({CTES["review_states"][0].replace("folded", "ledger_folded")}) SEMI JOIN ledger_now ON entity = evidence_table""",
       "ledger_folded", "ledger_now")
oracle("earlier_findings", """
SELECT run_id, hunt_id, evidence_table, evidence_rows, confidence, superseded FROM (
  SELECT *, seq < max(seq) OVER (PARTITION BY evidence_table) AS superseded FROM ledger_rows WHERE seq < 3)
WHERE confidence = 'high'""", "ledger_rows")
oracle("verify_trails", """
SELECT n.evidence_table, n.evidence_rows > 0 AS has_rows, n.sql_text <> '' AS has_sql,
       count(DISTINCT io.direction) = 2 AS has_lineage, count(f.field) > 0 AS has_schema,
       count(t.value) FILTER (WHERE t.value IN ('pending-review', 'confirmed', 'rejected')) > 0 AS has_review_state
FROM ledger_now n LEFT JOIN ledger_io_rows io USING (job) LEFT JOIN ledger_field_rows f ON f.evidence_table = n.evidence_table
LEFT JOIN ledger_tag_rows t ON t.evidence_table = n.evidence_table GROUP BY ALL""",
       "ledger_now", "ledger_io_rows", "ledger_field_rows", "ledger_tag_rows")

# ------------------------------------------------------------------ review
oracle("review_states", "SELECT * FROM review_states", "review_states")
oracle("apply_verdict", "SELECT * FROM verdicts", "verdicts")
oracle("refused_verdicts", "SELECT * EXCLUDE (effective) FROM verdicts WHERE NOT effective", "verdicts")
oracle("reopen_finding", "SELECT * FROM reopens", "reopens")
oracle("resolve_finding_keys", """
, keys AS (SELECT DISTINCT concat('x', user_id) AS key FROM events WHERE event_type = 'signup'),
  sets AS (SELECT entity AS name FROM review_events
           UNION SELECT dataset FROM cat_datasets WHERE dataset LIKE 'analytics.%'),
  m AS (SELECT k.key, count(s.name) AS n_matches, min(s.name) AS any_name
        FROM keys k LEFT JOIN sets s ON contains(s.name, k.key) GROUP BY k.key)
SELECT key, n_matches, CASE WHEN n_matches = 1 THEN any_name END AS resolved,
       CASE WHEN n_matches = 1 THEN 'resolved' WHEN n_matches = 0 THEN 'unmatched' ELSE 'ambiguous' END AS status
FROM m""", "review_events", "cat_datasets")
oracle("resolve_hunt_keys", """
, sets AS (SELECT dataset AS name, description AS hunt FROM cat_datasets UNION SELECT evidence_table, hunt_id FROM ledger_now),
  keys AS (SELECT DISTINCT key FROM (SELECT p_name AS key FROM part
             UNION SELECT unnest(regexp_split_to_array(name || ' ' || hunt, '[ ._]')) FROM sets) WHERE key <> ''),
  m AS (SELECT k.key, count(DISTINCT s.name) AS n_matches, min(s.name) AS any_name
        FROM keys k LEFT JOIN sets s ON contains(s.name, k.key) OR contains(s.hunt, k.key) GROUP BY k.key)
SELECT key, n_matches, CASE WHEN n_matches = 1 THEN any_name END AS resolved,
       CASE WHEN n_matches = 1 THEN 'resolved' WHEN n_matches = 0 THEN 'unmatched' ELSE 'ambiguous' END AS status
FROM m""", "cat_datasets", "ledger_now")
oracle("implicated_assets", """
SELECT t AS evidence_table, t AS asset FROM (VALUES ('analytics.group_surge'),
  ('analytics.outside_terms'), ('analytics.term_web'), ('analytics.volume_control')) v(t)
UNION ALL SELECT DISTINCT 'analytics.ownership_audit', dataset FROM orphaned
  WHERE flagged AND dataset IS NOT NULL
UNION ALL SELECT DISTINCT 'analytics.lineage_audit', dataset FROM provenance
  WHERE flagged AND dataset IS NOT NULL""", "orphaned", "provenance")
oracle("raise_incidents", """
SELECT dataset, title, "at", event_id, message FROM incident_actions WHERE action = 'raise' AND effective""",
       "incident_actions")
oracle("resolve_incidents", """
SELECT dataset, title, "at", event_id, message FROM incident_actions WHERE action = 'resolve' AND effective""",
       "incident_actions")
oracle("active_incidents", """
SELECT dataset, title, "at" AS raised_at FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, title ORDER BY "at" DESC, event_id DESC) AS rn
  FROM incident_actions) x WHERE rn = 1 AND action = 'raise'""", "incident_actions")

_cte("incident_spans", """
SELECT dataset, title, "at" AS opened_at, event_id AS opened_by,
       lead("at") OVER w AS closed_at, lead(event_id) OVER w AS closed_by, lead(message) OVER w AS message, action
FROM incident_actions WHERE effective WINDOW w AS (PARTITION BY dataset, title ORDER BY "at", event_id)
QUALIFY action = 'raise'
""", "incident_actions")
oracle("incident_intervals", "SELECT * EXCLUDE (action) FROM incident_spans", "incident_spans")
oracle("incidents_as_of", """
SELECT dataset, title, "at" AS opened_at FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, title ORDER BY "at" DESC, event_id DESC) AS rn
  FROM incident_actions WHERE effective AND "at" <= TIMESTAMP '2024-01-16 12:00:00') x WHERE rn = 1 AND action = 'raise'""",
       "incident_actions")
oracle("open_incidents_by_day", """
SELECT day, opened, closed, CAST(sum(opened - closed) OVER (ORDER BY day) AS BIGINT) AS still_open FROM (
  SELECT CAST("at" AS DATE) AS day, count(*) FILTER (WHERE action = 'raise') AS opened, count(*) FILTER (WHERE action = 'resolve') AS closed
  FROM incident_actions WHERE effective GROUP BY 1)""", "incident_actions")

# ------------------------------------------------------------------ gate (expectations for sf0.01)
from casefile.plans.expectations import EXPECTATIONS, SHADOW_LISTS  # noqa: E402



def _gate_sql(scale: str, moved: dict[str, str] | None = None) -> str:
    want = ", ".join(f"('{k}', '{v}')" for k, v in sorted((EXPECTATIONS[scale] | (moved or {})).items()))
    return f"""
SELECT coalesce(c."check", w."check") AS "check", c.got, w.want, coalesce(c.got = w.want, false) AS ok,
       CASE WHEN coalesce(c.got = w.want, false) THEN '' WHEN c.got IS NULL THEN 'missing evidence'
            WHEN w.want IS NULL THEN 'no expectation' ELSE concat('got ', c.got, ' want ', w.want) END AS detail
FROM gate_checks c FULL OUTER JOIN (VALUES {want}) w("check", want) ON c."check" = w."check"
"""


def _assertions_sql(scale: str, moved: dict[str, str] | None = None) -> str:
    return f"""
SELECT split_part("check", '.', 1) AS "group", bool_and(ok) AS passed, count(*) FILTER (WHERE ok) AS n_ok,
       count(*) AS n_all,
       string_agg(concat("check", '=', CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END), '; '
                  ORDER BY concat("check", '=', CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END)) AS results,
       concat('gate-', split_part("check", '.', 1)) AS assertion_id
FROM ({_gate_sql(scale, moved)}) g GROUP BY 1"""


def _set_compare_sql(scale: str) -> str:
    want = ", ".join(f"('{w}')" for w in SHADOW_LISTS[scale])
    return f"""
SELECT coalesce(g.value, w.value) AS value, g.value IS NOT NULL AS in_got, w.value IS NOT NULL AS in_want
FROM (SELECT candidate AS value FROM shadow) g
FULL OUTER JOIN (VALUES {want}) w(value) ON g.value = w.value"""


def scale_oracles(scale: str) -> dict[str, str]:
    """The oracles whose checked-in expectations depend on the TESTDATA scale."""
    return {"value_gate": with_ctes(_gate_sql(scale), "gate_checks"),
            "gate_assertions": with_ctes(_assertions_sql(scale), "gate_checks"),
            "assertion_states": with_ctes(f"""
SELECT *, 'run-1' AS run_id FROM ({_assertions_sql(scale)}) WHERE "group" NOT IN ('surge', 'web')
UNION ALL SELECT *, 'run-2' FROM ({_assertions_sql(scale, {"surge.peak_volume": "0"})}) WHERE "group" IN ('surge', 'web')""", "gate_checks"),
            "set_compare": with_ctes(_set_compare_sql(scale), "shadow")}


ORACLES.update(scale_oracles("sf0.01"))  # the driver's correctness scale

oracle("extract_slice", _CROSS_EDGES, "crossing")
oracle("recompute_check", """
SELECT f.flagged_weeks,
       NOT EXISTS (SELECT week, sum(n) FROM (""" + _CROSS_EDGES + """) GROUP BY week
                   EXCEPT SELECT week, vol FROM comm_spikes) AS matches_full, p.week AS peak_week, p.vol AS peak_volume, p.zscore AS peak_zscore
FROM (SELECT count(*) AS flagged_weeks FROM comm_spikes WHERE flagged) f LEFT JOIN peak p ON true""",
       "comm_spikes", "peak", "crossing")
# ------------------------------------------------------------------ streaming alerts
_ALERTS = """
FROM review_events WHERE category = 'TAG'
  AND (modifier LIKE '%confirmed%' OR modifier LIKE '%risk-flagged%' OR modifier LIKE '%rejected%'
       OR modifier LIKE '%pending-review%')"""
_PAYLOAD = 'SELECT event_id, "at", entity AS entityUrn, category, operation, modifier' + _ALERTS
oracle("review_alerts_stream", _PAYLOAD, "review_events")
oracle("alert_log_append", "SELECT event_id, entity AS entityUrn, true AS stamped" + _ALERTS, "review_events")
oracle("alert_feed", """
SELECT "at", event_id, concat_ws(' / ', category, operation) AS event, string_split(modifier, ':')[-1] AS tag,
       entity AS asset, true AS received, count(*) OVER () AS total""" + _ALERTS, "review_events")
oracle("alert_dedup_stream", _PAYLOAD, "review_events")
oracle("load_alert_log", f"""
SELECT * FROM ({_PAYLOAD}) WHERE event_id % 100 <> 0
UNION ALL SELECT NULL, * EXCLUDE (event_id) FROM ({_PAYLOAD}) WHERE event_id % 100 = 2""", "review_events")

oracle("review_state_stream", """
, d AS (
  SELECT entity, event_id, "at", kind, i, kind <> 'pending-review' AND before = 'pending-review' AS effective,
         CASE WHEN kind = 'pending-review' AND before IN ('confirmed', 'rejected') THEN before END AS from_state
  FROM folded),
  a AS (SELECT *, CASE WHEN from_state IS NOT NULL THEN 'resolve' WHEN effective AND kind = 'confirmed' THEN 'raise'
                       WHEN effective THEN 'resolve' END AS action FROM d),
  eff AS (SELECT entity, event_id, action <> coalesce(lag(action) OVER (PARTITION BY entity ORDER BY i), 'resolve') AS applied
          FROM a WHERE action IS NOT NULL)
SELECT entity, event_id, "at", kind, effective, from_state, action, coalesce(applied, false) AS applied, false AS late
FROM a LEFT JOIN eff USING (entity, event_id)""", "folded")

# ------------------------------------------------------------------ transcripts
_MARK = r"'\b(the|und|que)[\t\n\f\r ]+([0-9A-Za-z_]+)'"
_MARKERS = f"""
, markers AS (
  SELECT run_id, turn, tool, unnest(m) AS marker, unnest(a) AS artifact FROM (
    SELECT conv_id AS run_id, turn, role AS tool,
           regexp_extract_all(lower(text), {_MARK}, 1) AS m,
           regexp_extract_all(lower(text), {_MARK}, 2) AS a
    FROM conversations) x)"""
ORACLES["transcript_markers"] = "WITH x0 AS (SELECT 1)" + _MARKERS + "\nSELECT * FROM markers"
ORACLES["run_reliability"] = "WITH x0 AS (SELECT 1)" + _MARKERS + """
, per AS (
  SELECT r.run_id, CAST(coalesce(f.findings, 0) AS BIGINT) AS findings, coalesce(f.findings, 0) >= 1 AS passed
  FROM (SELECT DISTINCT conv_id AS run_id FROM conversations) r
  LEFT JOIN (SELECT run_id, count(*) AS findings FROM markers WHERE marker = 'und' GROUP BY 1) f
    ON f.run_id = r.run_id)
SELECT per.*, (SELECT round(avg(CAST(passed AS DOUBLE)), 4) FROM per) AS pass_rate FROM per"""
ORACLES["artifact_manifest"] = "WITH x0 AS (SELECT 1)" + _MARKERS + """
SELECT marker, artifact, count(DISTINCT run_id) AS runs, count(*) AS mentions FROM markers GROUP BY 1, 2"""
_CALLS = """
WITH calls AS (
  SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS turn,
         event_type AS tool, event_type IN ('view', 'click') AS writes, event_type || '|' || coalesce(props, '') AS signature
  FROM events)"""
ORACLES["repeated_calls"] = _CALLS + """
SELECT run_id, turn, tool, signature, occurrence, flagged_as FROM (
  SELECT *, count(*) OVER (PARTITION BY run_id, signature ORDER BY turn) AS occurrence,
         CASE WHEN NOT writes AND turn >= 22 THEN 'budget'
              WHEN writes AND occurrence % 3 = 0 OR NOT writes AND occurrence >= 3 THEN 'repeat' END AS flagged_as
  FROM calls)
WHERE flagged_as IS NOT NULL"""
ORACLES["budget_breaches"] = _CALLS + " SELECT run_id, turn, tool FROM calls WHERE turn >= 22 AND NOT writes"
ORACLES["transcript_trace"] = """
SELECT conv_id AS run_id, turn, role AS kind, role AS tool, substr(text, 1, 600) AS content FROM conversations"""
_WS = r"[\t\n\f\r ]"
_Q = r"[`\"\[\]]"
_TRIM = "regexp_replace({x}, '^" + _WS + "+|" + _WS + "+$', '', 'g')"
_UNQ = "regexp_replace({x}, '^" + _Q + "+|" + _Q + "+$', '', 'g')"


def _t(x):
    return _TRIM.format(x=x)


def _u(x):
    return _UNQ.format(x=x)


_LAST = "string_split(" + _t(_u(_t("coalesce(table_arg, '')"))) + ", '.')[-1]"
_SAFE = ("regexp_replace(regexp_replace(" + _u(_t(_LAST)) + ", '[^A-Za-z0-9_]', '_', 'g'), '^_+|_+$', '', 'g')")
_S = "regexp_replace(" + _t("coalesce(sql_arg, '')") + r", '[;\t\n\f\r ]+$', '')"
# a statement is wrapped if its first words open a table or view and it holds a word AS; the rest is the query
_TAIL = "regexp_replace(lower(s), '^create\\s+or\\s+replace\\s', 'create ')"
_AFTER_AS = r"regexp_extract(s, '(?is)\bas\s+(.*)$', 1)"
_WRAPPED = (f"string_split_regex({_TAIL}, '\\s+')[1] = 'create' AND "
            f"coalesce(regexp_extract(string_split_regex({_TAIL}, '\\s+')[2], '^[a-z0-9_]*') IN ('table', 'view'), false) "
            r"AND regexp_matches(s, '(?is)\bas\s')")
ORACLES["normalized_tool_calls"] = f"""
WITH c AS (SELECT conv_id AS run_id, turn, split_part(text, ' ', 1) AS table_arg,
                  CASE WHEN turn % 2 = 1 THEN 'Create or Replace VIEW v AS' || chr(10) || ' ' || text || ' ;' || chr(10)
                       ELSE text END AS sql_arg
           FROM conversations),
n AS (SELECT run_id, turn, {_SAFE} AS safe, {_S} AS s FROM c)
SELECT run_id, turn, CASE WHEN safe <> '' THEN concat('analytics.', safe) END AS safe_table,
       safe <> '' AS is_valid,
       CASE WHEN {_WRAPPED} THEN regexp_replace({_t(_AFTER_AS)}, '[;\\t\\n\\f\\r ]+$', '')
            ELSE s END AS select_sql,
       {_WRAPPED} AS was_wrapped
FROM n"""
