"""The registry projection: the relations of a document-evidence registry, derived from the star-schema tables.

Every relation is one SELECT that both engines read alike. AS_OF stands for today in all queries.
"""

from __future__ import annotations

AS_OF = "DATE '1998-08-02'"

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)

RELATIONS: dict[str, str] = {
    "item": """
SELECT 'P' || CAST(p_partkey AS STRING) AS item_ref, p_partkey AS item_no, p_name || ' ' || p_type AS item_name, p_brand AS manufacturer_raw,
       CASE WHEN p_partkey % 9 <> 0 THEN p_brand || '-' || CAST(p_partkey % 400 AS STRING) END AS mfr_ref,
       CASE p_size % 3 WHEN 1 THEN true WHEN 2 THEN false END AS md_flag,
       CASE p_size % 8 WHEN 0 THEN 'I' WHEN 1 THEN 'Is' WHEN 2 THEN 'Im' WHEN 3 THEN 'Ir' WHEN 4 THEN 'IIa' WHEN 5 THEN 'IIb' WHEN 6 THEN 'III' END AS product_class,
       'C' || CAST(p_partkey % 6 AS STRING) AS catalogue, CAST(p_partkey % 17 AS BIGINT) AS mirror_rev
FROM part""",
    "document": """
SELECT o_orderkey AS doc_id,
       CASE o_orderkey % 4 WHEN 0 THEN 'DoC' WHEN 1 THEN 'EC' WHEN 2 THEN 'IFU' ELSE 'ISO' END AS type,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'MDR' WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'MDD' ELSE 'n.a.' END AS regulation,
       CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS validity_from,
       CASE WHEN o_orderkey % 3 = 0 THEN @plus_days(CAST(o_orderdate AS DATE), o_orderkey % 1500) END AS validity_to,
       CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 5 = 0 THEN o_orderkey + 1 END AS cert_doc_id,
       CASE o_orderstatus WHEN 'F' THEN 'production' WHEN 'P' THEN 'superseded' ELSE 'staged' END AS status,
       CASE o_orderkey % 3 WHEN 0 THEN 'group' WHEN 1 THEN 'manufacturer' ELSE 'item' END AS coverage_scope,
       'Brand#' || CAST(1 + o_custkey % 25 AS STRING) AS manufacturer, o_custkey, o_totalprice,
       CASE WHEN o_orderkey % 4 IN (1, 3) THEN CASE o_orderkey % 3 WHEN 0 THEN 'SX ' ELSE 'HZ ' END || CAST(o_custkey AS STRING) || CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' R0' || CAST(o_orderkey % 4 AS STRING) ELSE ' Rev. ' || CAST(o_orderkey % 4 AS STRING) END END AS certificate_number
FROM orders""",
    "link": """
SELECT item_ref, doc_id, match_basis, status FROM (
  SELECT 'P' || CAST(l_partkey AS STRING) AS item_ref, l_orderkey AS doc_id,
         min(CASE l_returnflag WHEN 'R' THEN 'ref-list' WHEN 'A' THEN 'mfr-scope' ELSE 'fetch-context' END) AS match_basis,
         CASE WHEN max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) = 1 THEN 'production' ELSE 'staged' END AS status
  FROM lineitem WHERE (l_orderkey + l_partkey) % 12 = 0 GROUP BY l_partkey, l_orderkey) x""",
    "alias": """
SELECT DISTINCT p_brand AS raw_name, 'Maker ' || CAST(CAST(substr(p_brand, 7) AS INT) % 10 AS STRING) AS canonical_name FROM part WHERE CAST(substr(p_brand, 7) AS INT) % 7 <> 5""",
    "member": """
SELECT CAST(CAST(substr(p_brand, 7) AS INT) * 10 + p_partkey % 10 AS BIGINT) AS group_id, 'P' || CAST(p_partkey AS STRING) AS item_ref, p_brand AS manufacturer_raw FROM part WHERE p_partkey % 8 <> 7""",
    "discovery": """
SELECT event_id AS log_id, CAST(user_id + 10 AS BIGINT) AS group_id, CASE event_id % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'known_url' WHEN 2 THEN 'register' ELSE 'manual' END AS source,
       CASE event_type WHEN 'purchase' THEN 'hit' WHEN 'error' THEN 'miss' WHEN 'signup' THEN 'handoff' ELSE 'skipped' END AS outcome, ts AS seen_at, CAST(@json(props, k) AS BIGINT) AS detail_k
FROM events""",
    "job": """
SELECT event_id AS id, CASE event_type WHEN 'purchase' THEN 'fetch.url' WHEN 'error' THEN 'validate' WHEN 'signup' THEN 'extract' WHEN 'view' THEN 'gate' ELSE 'report' END AS type,
       CASE event_id % 7 WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'failed' WHEN 3 THEN 'dead' ELSE 'done' END AS status,
       CASE event_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'normal' ELSE 'low' END AS priority, CAST(event_id % 6 AS BIGINT) AS attempts, CAST(5 AS BIGINT) AS max_attempts,
       event_type || ':' || CAST(user_id AS STRING) AS dedupe_key, ts AS created_at, CASE WHEN event_id % 7 > 3 THEN ts + INTERVAL '90' SECOND END AS finished_at, ts + INTERVAL '5' MINUTE AS run_after,
       CASE WHEN event_id % 7 IN (2, 3) THEN CASE event_id % 5 WHEN 0 THEN 'Timeout after 30 s' WHEN 1 THEN 'Name or service not known' WHEN 2 THEN '' WHEN 3 THEN 'KeyError: ref' ELSE 'HTTP 503' END END AS error,
       CASE WHEN event_id % 10 <> 0 THEN event_id - event_id % 10 + (event_id % 10 - 1) END AS caused_by, user_id
FROM events""",
    "evidence": """
SELECT l_orderkey AS doc_id, l_linenumber AS line, CASE l_linenumber % 4 WHEN 0 THEN 'type' WHEN 1 THEN 'regulation' WHEN 2 THEN 'coverage_scope' ELSE 'ref_list' END AS field,
       CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_suppkey % 5 AS STRING) END AS value, 1.0 - l_discount AS confidence,
       CASE l_returnflag WHEN 'R' THEN 'T0' WHEN 'A' THEN 'T1' ELSE 'T2' END AS tier, 'P' || CAST(l_partkey AS STRING) AS printed_ref
FROM lineitem""",
    "register_certificate": """
SELECT 'C' || CAST(c_custkey AS STRING) AS row_id, CASE c_custkey % 2 WHEN 0 THEN 'SX ' ELSE 'HZ ' END || CAST(c_custkey AS STRING) || CASE c_custkey % 6 WHEN 0 THEN 'A' ELSE '' END AS certificate_number,
       CASE WHEN c_custkey % 5 <> 0 THEN 'Rev. 0' || CAST(c_custkey % 4 AS STRING) END AS revision_number, 'XX-MF-' || lpad(CAST(c_custkey % 25 AS STRING), 9, '0') AS actor_srn,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'issued' WHEN 'BUILDING' THEN 'suspended' WHEN 'AUTOMOBILE' THEN 'withdrawn' WHEN 'FURNITURE' THEN 'amended' ELSE 'restricted' END AS certificate_status
FROM customer""",
    "actor": """
SELECT 'Brand#' || CAST(n_nationkey + 1 AS STRING) AS canonical_name, 'XX-MF-' || lpad(CAST(n_nationkey AS STRING), 9, '0') AS srn,
       CASE n_nationkey % 4 WHEN 0 THEN 'auto' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'suggested' ELSE 'rejected' END AS status, CAST(n_nationkey % 10 AS DOUBLE) / 10 AS match_score
FROM nation""",
    "register_device": """
SELECT 'U' || CAST(ps.p_partkey AS STRING) AS udi_di, 'XX-MF-' || lpad(CAST(CAST(substr(p_brand, 7) AS INT) - 1 AS STRING), 9, '0') AS actor_srn,
       CASE ps.p_partkey % 4 WHEN 0 THEN p_brand || '-' || CAST(p_partkey % 400 AS STRING) WHEN 1 THEN p_brand || '-' || CAST(p_partkey % 400 AS STRING) || '.K1' WHEN 2 THEN 'N' || CAST(p_partkey AS STRING) END AS reference,
       p_name AS trade_name, @plus_days(DATE '1998-01-01', ps.p_partkey % 300) AS first_seen, @plus_days(DATE '1998-02-01', ps.p_partkey % 250) AS last_seen,
       CASE ps.p_partkey % 3 WHEN 0 THEN 'on-market' WHEN 1 THEN 'withdrawn' ELSE 'planned' END AS device_status
FROM part ps""",
    "task": """
SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN 'review' WHEN 1 THEN 'dead-job' ELSE 'missing' END AS kind, CASE WHEN event_id % 5 < 2 THEN 'open' WHEN event_id % 5 = 2 THEN 'claimed' ELSE 'done' END AS status,
       ts AS created_at, CAST(event_id % 15000 AS BIGINT) AS doc_id, event_type AS reason, CAST(user_id + 10 AS BIGINT) AS group_id
FROM events""",
    "expiry": """
SELECT d.doc_id, d.type, d.status, d.validity_to AS own_to, c.validity_to AS cert_to, CASE WHEN d.type = 'DoC' THEN CAST(d.validity_from + INTERVAL '60' MONTH AS DATE) END AS stale_to,
       least(d.validity_to, c.validity_to, CASE WHEN d.type = 'DoC' THEN CAST(d.validity_from + INTERVAL '60' MONTH AS DATE) END) AS expires,
       d.validity_to IS NULL AND c.validity_to IS NOT NULL AS inherited,
       CASE WHEN d.validity_to IS NOT NULL AND d.validity_to <= least(c.validity_to, CASE WHEN d.type = 'DoC' THEN CAST(d.validity_from + INTERVAL '60' MONTH AS DATE) END) THEN 'stated'
            WHEN d.validity_to IS NOT NULL AND c.validity_to IS NULL AND (d.type <> 'DoC' OR d.validity_from IS NULL) THEN 'stated'
            WHEN c.validity_to IS NOT NULL AND c.validity_to <= coalesce(CASE WHEN d.type = 'DoC' THEN CAST(d.validity_from + INTERVAL '60' MONTH AS DATE) END, c.validity_to) THEN 'inherited'
            WHEN d.type = 'DoC' AND d.validity_from IS NOT NULL THEN 'staleness' END AS basis
FROM document d LEFT JOIN document c ON @sparse_key(c.doc_id, d.cert_doc_id, d.doc_id) AND c.status IN ('production', 'superseded')""",
    "history": f"""
SELECT l.item_ref, l.doc_id, l.match_basis, d.type, d.regulation, d.validity_from, d.status AS doc_status, e.expires, e.basis,
       rank() OVER (PARTITION BY l.item_ref, d.type ORDER BY CASE WHEN d.regulation = 'MDR' THEN 0 ELSE 1 END, CASE WHEN d.validity_from <= {AS_OF} THEN d.validity_from END DESC NULLS LAST) = 1 AS current
FROM link l JOIN document d ON d.doc_id = l.doc_id JOIN expiry e ON e.doc_id = d.doc_id
WHERE l.status = 'production' AND d.status IN ('production', 'superseded')""",
    "current_link": "SELECT item_ref, doc_id, match_basis, type, regulation, validity_from, doc_status, expires, basis FROM history WHERE current",
    "document_current": """
SELECT doc_id FROM current_link UNION SELECT d.doc_id FROM document d WHERE d.status = 'production' AND NOT EXISTS (SELECT 1 FROM link l WHERE l.doc_id = d.doc_id AND l.status = 'production')""",
    # a trailing R-code is dropped; only what follows "Rev" is a revision, which is reported as it is printed
    "held_certificate": """
SELECT DISTINCT d.doc_id, d.type, d.status, d.manufacturer, @replace_all(@replace_all(d.certificate_number, ' +R[0-9]+$', ''), ' *[Rr][Ee][Vv][.]? *[0-9]+$', '') AS base_number,
       nullif(@extract(d.certificate_number, '([Rr][Ee][Vv][.]? *[0-9]+)$', 1), '') AS revision
FROM document d JOIN link l ON l.doc_id = d.doc_id AND l.status = 'production'
WHERE d.type IN ('EC', 'ISO') AND d.certificate_number IS NOT NULL""",
    "trusted_actor": "SELECT canonical_name, srn FROM actor WHERE status IN ('auto', 'confirmed')",
}
