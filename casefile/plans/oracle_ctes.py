"""DuckDB CTEs that restate the TESTDATA adapter rules (FIXTURES.md §2).

The oracle side of the correctness check runs in DuckDB over the raw driver
tables, so every adapter the Spark side builds with DataFrames is repeated here
as plain SQL.  ``with_ctes(body, *names)`` pulls in the named CTEs plus their
dependencies, in dependency order.
"""

from __future__ import annotations

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql.strip(), deps)


_cte("nation_region", """
SELECT n.n_nationkey AS nationkey, n.n_name AS nation, r.r_name AS region
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
""")

_cte("supplier_addr", """
SELECT s.s_suppkey AS suppkey,
       CASE WHEN s.s_nationkey % 5 = 0 THEN concat('s', s.s_suppkey, '@corp.example')
            ELSE concat('s', s.s_suppkey, '@', lower(nr.nation), '.example') END AS addr,
       s.s_name AS name, nr.nation AS title, nr.region AS dept
FROM supplier s JOIN nation_region nr ON nr.nationkey = s.s_nationkey
""", "nation_region")

_cte("registry", """
SELECT concat('c', c.c_custkey, '@corp.example') AS addr, c.c_name AS name,
       nr.nation AS title, nr.region AS dept
FROM customer c JOIN nation_region nr ON nr.nationkey = c.c_nationkey
UNION ALL
SELECT addr, name, title, dept FROM supplier_addr
""", "nation_region", "supplier_addr")

_cte("order_recipients", """
SELECT l.l_orderkey AS id,
       string_agg(sa.addr, ', ' ORDER BY l.l_linenumber, sa.addr) AS recipients
FROM lineitem l JOIN supplier_addr sa ON sa.suppkey = l.l_suppkey
GROUP BY l.l_orderkey
""", "supplier_addr")

_cte("raw_messages", """
SELECT o.o_orderkey AS id,
       concat('<o', o.o_orderkey, '@corp.example>') AS msg_id,
       concat('c', o.o_custkey, '@corp.example') AS sender,
       CASE WHEN o.o_orderkey % 89 = 0 THEN NULL
            WHEN o.o_orderkey % 97 = 0 THEN 'not a date'
            ELSE strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') END AS date,
       o.o_orderpriority AS subject,
       d.text AS body,
       concat('c', o.o_custkey) AS mailbox,
       o.o_orderstatus AS folder,
       CASE WHEN o.o_orderkey % 53 = 0 THEN 'undisclosed-recipients'
            ELSE orr.recipients END AS recipients
FROM orders o
LEFT JOIN documents d ON d.doc_id = o.o_orderkey
LEFT JOIN order_recipients orr ON orr.id = o.o_orderkey
""", "order_recipients")

# one row per order: who sent it and when (orders on the two date traps have no day)
_cte("sent", """
SELECT o_orderkey AS id, concat('c', o_custkey) AS mailbox, o_orderpriority AS subject, o_orderstatus AS folder,
       CASE WHEN o_orderkey % 89 <> 0 AND o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END AS day
FROM orders
""")

_cte("emails", """
SELECT s.id, format('<o{}@corp.example>', s.id) AS msg_id, s.mailbox || '@corp.example' AS sender,
       s.day AS sent_at, s.subject, d.text AS body, s.mailbox, s.folder
FROM sent s LEFT JOIN documents d ON d.doc_id = s.id
""", "sent")

# a line of an order is a recipient of its message, unless they are undisclosed
_cte("message_edges", """
SELECT l.l_orderkey AS email_id, s.mailbox || '@corp.example' AS sender, s.day AS sent_at, sa.addr AS recipient
FROM lineitem l JOIN sent s ON s.id = l.l_orderkey JOIN supplier_addr sa ON sa.suppkey = l.l_suppkey
WHERE l.l_orderkey % 53 <> 0
""", "sent", "supplier_addr")

_cte("recipients", "SELECT email_id, recipient AS addr FROM message_edges", "message_edges")

_cte("comm_edges", """
SELECT sender, recipient, sent_at - CAST(isodow(sent_at) - 1 AS INTEGER) AS week, count(sent_at) AS n
FROM message_edges GROUP BY ALL HAVING count(sent_at) > 0
""", "message_edges")

_cte("events_ref", """
SELECT * FROM (VALUES
  (DATE '2000-06-01', 'event 1'),
  (DATE '2000-10-16', 'event 2'),
  (DATE '2001-02-01', 'event 3'),
  (DATE '2001-06-15', 'event 4')) AS t(event_date, event)
""")

_cte("group_a", "SELECT addr FROM registry WHERE dept IN ('AFRICA', 'AMERICA')", "registry")
_cte("group_b", "SELECT addr FROM registry WHERE dept IN ('ASIA')", "registry")

_cte("crossing", """
SELECT e.email_id, e.sender, e.recipient, e.sent_at,
       e.sent_at - CAST(isodow(e.sent_at) - 1 AS INTEGER) AS week, if(f.in_a, 'A -> B', 'B -> A') AS direction
FROM message_edges e JOIN group_lookup f ON f.addr = e.sender JOIN group_lookup t ON t.addr = e.recipient
WHERE f.in_a AND t.in_b OR f.in_b AND t.in_a
""", "message_edges", "group_lookup")

_cte("xgroup_series", """
SELECT week, count(*) AS vol FROM crossing WHERE week IS NOT NULL GROUP BY week
""", "crossing")

_cte("comm_spikes", """
WITH scored AS (
  SELECT week, vol, CASE WHEN sigma <> 0 THEN (vol - mu) / sigma END AS z FROM xgroup_series CROSS JOIN baseline),
near AS (
  SELECT s.week, min(greatest(s.week - e.event_date, e.event_date - s.week)) AS days
  FROM scored s CROSS JOIN events_ref e GROUP BY s.week)
SELECT week, vol, floor(z * 100 + 0.5) / 100 AS zscore, days AS days_to_event,
       z >= 2.0 AND week >= DATE '2000-01-01' AS flagged
FROM scored JOIN near USING (week)
""", "xgroup_series", "events_ref", "baseline")

# hunt-2 lexicon (fixed values for TESTDATA): que, der, elle, und
# the words of a message, cut wherever a character is no ASCII word character
_cte("message_words", r"""
SELECT id, list_distinct(string_split_regex(lower(concat(subject, ' ', body)), '[^0-9a-z_]+')) AS words FROM emails
""", "emails")

_cte("leak_hits", """
SELECT e.id, e.sent_at, e.sender, e.subject, unnest(list_intersect(w.words, ['que', 'der', 'elle', 'und'])) AS entity
FROM message_words w JOIN emails e ON e.id = w.id
WHERE e.sent_at >= DATE '1995-01-01' AND e.sent_at < DATE '2000-06-01'
""", "message_words", "emails")

_cte("external_leakage", """
WITH outside AS (
  SELECT email_id, recipient, lower(substr(recipient, strpos(recipient, '@') + 1)) AS domain FROM message_edges),
first AS (SELECT min(event_date) AS day FROM events_ref)
SELECT o.email_id, h.sent_at, h.sender, h.subject, h.entity, o.recipient AS external_recipient,
       o.domain AS external_domain, first.day - h.sent_at AS days_before_disclosure
FROM outside o JOIN leak_hits h ON h.id = o.email_id CROSS JOIN first
WHERE o.domain <> 'corp.example'
""", "leak_hits", "message_edges", "events_ref")

_cte("group_lookup", """
SELECT addr, bool_or(dept IN ('AFRICA', 'AMERICA')) AS in_a, bool_or(dept IN ('ASIA')) AS in_b
FROM registry WHERE dept IN ('AFRICA', 'AMERICA', 'ASIA') GROUP BY addr
""", "registry")

_cte("baseline", """
SELECT CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS mu,
       CASE WHEN n > 1 THEN sqrt(CAST(n * ss - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) END AS sigma
FROM (SELECT CAST(sum(vol) AS HUGEINT) AS s, CAST(sum(vol * vol) AS HUGEINT) AS ss, count(vol) AS n
      FROM xgroup_series WHERE week BETWEEN DATE '1996-01-01' AND DATE '1999-12-31') t
""", "xgroup_series")

# co-mention lexicon (fixed values for TESTDATA)
_cte("web_mentions", """
SELECT id, unnest(list_intersect(words, ['the', 'and', 'that', 'for', 'this', 'with', 'que', 'der', 'die', 'und',
                                         'elle', 'pour', 'con', 'para'])) AS entity
FROM message_words
""", "message_words")

_cte("web_prefiltered", """
SELECT id FROM emails, (VALUES ('que'), ('der'), ('und'), ('elle')) AS v(w)
GROUP BY id HAVING bool_or(contains(lower(subject), w)) OR bool_or(contains(lower(body), w))
""", "emails")

_cte("web_known", "SELECT unnest(['for', 'que', 'the']) AS entity")

_cte("web_edges", """
WITH sorted AS (SELECT list(entity ORDER BY entity) AS m FROM web_mentions GROUP BY id),
pair AS (SELECT m[i] AS entity_a, unnest(m[i + 1:]) AS entity_b FROM sorted, unnest(range(1, len(m))) AS r(i))
SELECT entity_a, entity_b, count(*) AS co_mentions FROM pair GROUP BY ALL
""", "web_mentions")

_cte("web", """
SELECT e.entity_a, e.entity_b, e.co_mentions, a.entity IS NOT NULL AS a_known, b.entity IS NOT NULL AS b_known
FROM web_edges e LEFT JOIN web_known a ON a.entity = e.entity_a LEFT JOIN web_known b ON b.entity = e.entity_b
""", "web_edges", "web_known")

_cte("shadow", """
SELECT candidate, CAST(sum(co_mentions) AS BIGINT) AS total
FROM (SELECT entity_a AS candidate, co_mentions FROM web WHERE b_known AND NOT a_known
      UNION ALL SELECT entity_b, co_mentions FROM web WHERE a_known AND NOT b_known)
GROUP BY candidate HAVING total >= 20
""", "web")

_cte("surge_series", """
SELECT user_id, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS vol,
       min(event_type) AS sample_event_type
FROM events GROUP BY 1, 2
""")

_cte("surge_stats", """
SELECT user_id, n AS n_buckets, CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS mu,
       sqrt(CAST(n * ss - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) AS sigma
FROM (SELECT user_id, CAST(sum(vol) AS HUGEINT) AS s, CAST(sum(vol * vol) AS HUGEINT) AS ss, count(*) AS n
      FROM surge_series GROUP BY 1) t
WHERE n >= 12 AND n * ss - s * s > 0
""", "surge_series")

_cte("decoy", """
SELECT user_id, day, vol, floor(z * 100 + 0.5) / 100 AS zscore, sample_event_type
FROM (
  SELECT *, count(*) OVER u AS n, CAST(sum(vol) OVER u AS HUGEINT) AS s, CAST(sum(vol * vol) OVER u AS HUGEINT) AS ss,
         (vol - CAST(s AS DOUBLE) / CAST(n AS DOUBLE)) / sqrt(CAST(n * ss - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) AS z
  FROM surge_series WINDOW u AS (PARTITION BY user_id))
WHERE n >= 12 AND n * ss > s * s AND z >= 2.5
""", "surge_series")

# catalog adapters
_DS = "CASE WHEN {k} % 50 = 0 THEN concat('analytics.x', {k}) ELSE concat('part.p', {k}) END"

_cte("cat_datasets", f"""
SELECT {_DS.format(k='p_partkey')} AS dataset, 'parquet' AS platform,
       concat('part ', p_name) AS description, lower(p_type) AS domain
FROM part
""")

_cte("cat_tags", f"SELECT {_DS.format(k='p_partkey')} AS dataset, 'certified' AS value FROM part WHERE p_size >= 25")

_cte("cat_terms", f"""
SELECT {_DS.format(k='p_partkey')} AS dataset, 'Material' AS value FROM part
WHERE p_type IN ('PROMO', 'LARGE')
""")

_cte("cat_fields", f"""
SELECT {_DS.format(k='p_partkey')} AS dataset, CAST(i AS INTEGER) AS ordinal, 'f' || i AS field,
       ['bigint', 'string', 'date', 'double'][i + 1] AS native_type
FROM part, unnest(range(0, p_size % 5)) AS r(i)
""")

_cte("cat_owners", f"""
SELECT DISTINCT {_DS.format(k='l_partkey')} AS dataset, concat('s', l_suppkey) AS value
FROM lineitem WHERE l_linenumber = 1 AND l_quantity > 45
""")

_cte("cat_users", """
SELECT concat('s', suppkey) AS username, name AS display_name, title,
       (s.s_acctbal >= 2000) AS active, addr AS email
FROM supplier_addr sa JOIN supplier s ON s.s_suppkey = sa.suppkey
""", "supplier_addr")

_cte("cat_job_io", f"""
SELECT concat('o', l.l_orderkey) AS job, 'out' AS direction, {_DS.format(k='l.l_partkey')} AS dataset
FROM lineitem l WHERE l.l_linenumber = 1
  AND l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL
SELECT concat('o', l.l_orderkey), 'in', {_DS.format(k='l.l_partkey')}
FROM lineitem l WHERE l.l_linenumber <> 1
""")

_cte("estate", """
SELECT d.dataset,
       coalesce(d.dataset IN (SELECT dataset FROM cat_terms WHERE value = 'Material'), false)
         AS financially_material,
       coalesce(d.dataset IN (SELECT dataset FROM cat_tags WHERE value = 'certified'), false)
         AS certified
FROM (SELECT DISTINCT dataset FROM cat_datasets) d
WHERE d.dataset NOT LIKE 'analytics.%'
""", "cat_datasets", "cat_terms", "cat_tags")

_cte("ownership", """
SELECT e.dataset, o.value AS owner, u.title AS owner_title, u.active AS owner_active,
       e.financially_material, e.certified
FROM estate e
LEFT JOIN (SELECT DISTINCT dataset, value FROM cat_owners) o ON o.dataset = e.dataset
LEFT JOIN cat_users u ON u.username = o.value
""", "estate", "cat_owners", "cat_users")

_cte("orphaned", """
SELECT dataset, owner, owner_title, owner_active, implicated, financially_material, certified,
       flagged,
       CASE WHEN owner IS NULL THEN 'nobody owns it'
            WHEN flagged THEN concat_ws('; ',
                CASE WHEN implicated THEN 'owner is on the implicated list' END,
                CASE WHEN owner_active = false THEN 'owner has left' END,
                CASE WHEN financially_material THEN 'carries the material term' END,
                'no certification') END AS reason
FROM (
  SELECT dataset, owner, owner_title, owner_active,
         coalesce(owner IN ('s1', 's3'), false) AS implicated,
         CASE WHEN owner IS NULL THEN false ELSE financially_material END AS financially_material,
         certified,
         CASE WHEN owner IS NULL THEN true
              ELSE (owner IN ('s1', 's3') OR coalesce(owner_active = false, false)) AND NOT certified
         END AS flagged
  FROM ownership) x
""", "ownership")

_cte("outputs", "SELECT DISTINCT dataset FROM cat_job_io WHERE direction = 'out'", "cat_job_io")

_cte("provenance", """
SELECT e.dataset, e.financially_material, e.certified,
       e.dataset IN (SELECT dataset FROM outputs) AS has_documented_lineage,
       e.financially_material AND NOT (e.dataset IN (SELECT dataset FROM outputs)) AS flagged,
       CASE WHEN e.financially_material AND NOT (e.dataset IN (SELECT dataset FROM outputs))
            THEN 'carries the material term and no job produces it' END AS reason
FROM estate e
""", "estate", "outputs")


_cte("exhibits", r"""
SELECT e.msg_id, e.sent_at, c.sender, c.recipient, c.direction, e.subject,
       left(regexp_replace(e.body, '\s+', ' ', 'g'), 500) AS excerpt, e.mailbox, e.folder
FROM comm_spikes f JOIN crossing c ON c.week = f.week JOIN emails e ON e.id = c.email_id
WHERE f.flagged
""", "crossing", "emails", "comm_spikes")

_cte("review_events", """
SELECT event_id, CAST(ts AS TIMESTAMP) AS "at",
       CASE user_id WHEN 0 THEN 'analytics.group_surge' WHEN 1 THEN 'analytics.outside_terms'
            WHEN 2 THEN 'analytics.term_web' WHEN 3 THEN 'analytics.ownership_audit'
            WHEN 4 THEN 'analytics.lineage_audit' WHEN 5 THEN 'analytics.volume_control'
            ELSE concat('analytics.x', user_id) END AS entity,
       CASE WHEN event_type = 'signup' THEN 'OWNER' ELSE 'TAG' END AS category,
       CASE WHEN event_id % 11 = 0 THEN 'REMOVE' ELSE 'ADD' END AS operation,
       CASE WHEN event_type = 'signup' THEN concat('owner:u', user_id)
            ELSE concat('urn:li:tag:', CASE event_type WHEN 'purchase' THEN 'confirmed'
                 WHEN 'error' THEN 'rejected' WHEN 'view' THEN 'pending-review'
                 WHEN 'click' THEN 'risk-flagged' END) END AS modifier,
       concat('u', user_id) AS actor, event_type AS note
FROM events
""")

# the state machine, one event of every entity at a time
_cte("folded", """
WITH RECURSIVE seq AS (
  SELECT entity, event_id, "at", actor, note,
         CASE note WHEN 'view' THEN 'pending-review' WHEN 'purchase' THEN 'confirmed' ELSE 'rejected' END AS kind,
         row_number() OVER (PARTITION BY entity ORDER BY "at", event_id) AS i
  FROM review_events WHERE operation = 'ADD' AND note IN ('view', 'purchase', 'error')),
step(entity, i, event_id, "at", actor, note, kind, before, state, since) AS (
  SELECT DISTINCT entity, 0::BIGINT, NULL::BIGINT, NULL::TIMESTAMP, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR,
         NULL::VARCHAR, 'unknown', NULL::TIMESTAMP FROM seq
  UNION ALL
  SELECT s.entity, s.i, s.event_id, s."at", s.actor, s.note, s.kind, f.state,
         CASE WHEN s.kind = 'pending-review' OR f.state = 'pending-review' THEN s.kind ELSE f.state END,
         CASE WHEN s.kind = 'pending-review' OR f.state = 'pending-review' THEN s."at" ELSE f.since END
  FROM step f JOIN seq s ON s.entity = f.entity AND s.i = f.i + 1)
SELECT * FROM step WHERE i > 0
""", "review_events")

_cte("verdicts", """
SELECT event_id, entity, "at", kind AS verdict, actor AS reviewer, note, before = 'pending-review' AS effective
FROM folded WHERE kind <> 'pending-review'
""", "folded")

_cte("reopens", """
SELECT event_id, entity, "at", before AS from_state FROM folded
WHERE kind = 'pending-review' AND before IN ('confirmed', 'rejected')
""", "folded")

_cte("review_states", """
SELECT entity, state, since AS state_at, state_events,
       list_position(['confirmed', 'rejected', 'pending-review', 'unknown'], state) - 1 AS state_rank
FROM (SELECT entity, arg_max(state, i) AS state, max(since) AS since, count(*) AS state_events FROM folded GROUP BY entity)
""", "folded")

_cte("implicated", """
SELECT 'analytics.ownership_audit' AS entity, dataset FROM orphaned WHERE flagged GROUP BY dataset
UNION ALL SELECT 'analytics.lineage_audit', dataset FROM provenance WHERE flagged GROUP BY dataset
""", "orphaned", "provenance")

# an incident is open or not; each action of a finding reaches all its assets
_cte("incident_actions", """
WITH acts AS (
  SELECT entity, event_id, "at", if(verdict = 'confirmed', 'raise', 'resolve') AS action,
         format('{} by {}', verdict, reviewer) AS message FROM verdicts WHERE effective
  UNION ALL SELECT entity, event_id, "at", 'resolve', 'reopened' FROM reopens),
landed AS (
  SELECT coalesce(i.dataset, a.entity) AS dataset, concat('investigation: ', a.entity) AS title, a.*
  FROM acts a LEFT JOIN implicated i ON i.entity = a.entity)
SELECT dataset, title, action, "at", event_id, message,
       coalesce(lag(action) OVER (PARTITION BY dataset, title ORDER BY "at", event_id), 'resolve') <> action AS effective
FROM landed
""", "verdicts", "reopens", "implicated")

_cte("decoy_all", "SELECT * FROM decoy", "decoy")

_cte("evidence_counts", """
SELECT 'analytics.group_surge' AS evidence_table, count(*) AS rows FROM comm_spikes
UNION ALL SELECT 'analytics.outside_terms', count(*) FROM external_leakage
UNION ALL SELECT 'analytics.term_web', count(*) FROM web
UNION ALL SELECT 'analytics.ownership_audit', count(*) FROM orphaned
UNION ALL SELECT 'analytics.lineage_audit', count(*) FROM provenance
UNION ALL SELECT 'analytics.volume_control', count(*) FROM decoy
""", "comm_spikes", "external_leakage", "web", "orphaned", "provenance", "decoy")

_cte("peak", """
SELECT week, vol, zscore, days_to_event FROM comm_spikes WHERE flagged ORDER BY zscore DESC, week LIMIT 1
""", "comm_spikes")


def _fp(name: str, col: str, src: str) -> str:
    return (f"SELECT '{name}' AS \"check\", concat('n=', count(*), ';h=', "
            f"coalesce(sum(CAST(('0x' || substr(md5(v), 1, 15)) AS BIGINT)), 0)) AS got "
            f"FROM (SELECT DISTINCT CAST({col} AS VARCHAR) AS v FROM {src} WHERE {col} IS NOT NULL) s")


_cte("gate_checks", "\nUNION ALL ".join([
    "SELECT 'surge.flagged_weeks' AS \"check\", CAST(count(*) AS VARCHAR) AS got FROM comm_spikes WHERE flagged",
    "SELECT 'surge.peak_week', strftime(max(week), '%Y-%m-%d') FROM peak",
    "SELECT 'surge.peak_volume', CAST(max(vol) AS VARCHAR) FROM peak",
    "SELECT 'surge.peak_zscore', CAST(max(zscore) AS VARCHAR) FROM peak",
    "SELECT 'exhibits.edges', CAST(count(*) AS VARCHAR) FROM exhibits",
    "SELECT 'exhibits.distinct_messages', CAST(count(DISTINCT msg_id) AS VARCHAR) FROM exhibits",
    _fp("exhibits.senders", "sender", "exhibits"),
    _fp("exhibits.recipients", "recipient", "exhibits"),
    "SELECT 'terms.predisclosure_emails', CAST(count(DISTINCT email_id) AS VARCHAR) FROM external_leakage "
    "WHERE days_before_disclosure > 0",
    "SELECT 'terms.external_addresses', CAST(count(DISTINCT external_recipient) AS VARCHAR) "
    "FROM external_leakage WHERE days_before_disclosure > 0",
    "SELECT 'terms.top_domain', max(external_domain) FROM (SELECT external_domain, count(DISTINCT email_id) AS n "
    "FROM external_leakage GROUP BY 1 ORDER BY n DESC, external_domain LIMIT 1) t",
    *[f"SELECT 'terms.domain[{d}]', CAST(count(*) FILTER (WHERE external_domain = '{d}') > 0 AS VARCHAR) "
      f"FROM (SELECT DISTINCT external_domain FROM external_leakage) t"
      for d in ("nation_1.example", "nation_2.example", "nation_3.example")],
    _fp("web.candidates", "candidate", "shadow"),
    "SELECT 'owners.flagged_datasets', CAST(count(*) AS VARCHAR) FROM orphaned WHERE flagged",
    _fp("owners.datasets", "dataset", "(SELECT * FROM orphaned WHERE flagged)"),
    _fp("owners.owners", "owner", "(SELECT * FROM orphaned WHERE flagged)"),
    "SELECT 'lineage.flagged_datasets', CAST(count(*) AS VARCHAR) FROM provenance WHERE flagged",
    _fp("lineage.datasets", "dataset", "(SELECT * FROM provenance WHERE flagged)"),
]), "comm_spikes", "peak", "exhibits", "external_leakage", "shadow", "orphaned", "provenance")


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
