"""Application queries: coverage, review, expiry, findings, failures, schedules."""

from __future__ import annotations

from ledgerlight.plans.projection import AS_OF

SQL: dict[str, str] = {
    "q01_coverage": f"""
WITH live AS (SELECT item_ref, bool_or(true) AS any_doc, bool_or(regulation IN ('MDR', 'MDD')) AS device, bool_or(type = 'DoC') AS declared FROM current_link WHERE expires IS NULL OR expires >= {AS_OF} GROUP BY 1),
i AS (SELECT i.item_ref, i.md_flag, coalesce(l.any_doc, false) AS any_doc, coalesce(l.device, false) AS device, coalesce(l.declared, false) AS declared FROM item i LEFT JOIN live l ON l.item_ref = i.item_ref),
s AS (SELECT count(*) FILTER (WHERE md_flag) AS total, count(*) FILTER (WHERE md_flag IS NOT FALSE) AS total_p, count(*) FILTER (WHERE md_flag AND any_doc) AS strict, count(*) FILTER (WHERE md_flag IS NOT FALSE AND any_doc) AS processed,
             count(*) FILTER (WHERE md_flag AND device) AS device, count(*) FILTER (WHERE md_flag AND declared) AS declared FROM i),
t AS (SELECT @explode(@array('strict', 'processed', 'device', 'declared')) AS line, * FROM s),
u AS (SELECT line, CASE line WHEN 'strict' THEN strict WHEN 'processed' THEN processed WHEN 'device' THEN device ELSE declared END AS covered, CASE line WHEN 'processed' THEN total_p ELSE total END AS total FROM t)
SELECT line, covered, total, round(100.0 * CAST(covered AS DOUBLE) / nullif(total, 0), 1) AS pct FROM u""",
    "q02_declarations_by_trusted_basis": """
WITH d AS (SELECT DISTINCT item_ref FROM current_link WHERE type = 'DoC' AND match_basis IN ('ref-list', 'ref-item', 'basic-udi-di', 'map-supplier'))
SELECT count(*) AS total, count(d.item_ref) AS covered, coalesce(round(100.0 * CAST(count(d.item_ref) AS DOUBLE) / nullif(count(*), 0), 1), 0.0) AS pct FROM item i LEFT JOIN d ON d.item_ref = i.item_ref WHERE i.md_flag""",
    "q03_match_basis": "SELECT match_basis, count(*) AS n FROM link WHERE status = 'production' GROUP BY 1",
    "q04_missing_ref_rate": "SELECT count(*) AS total, count(*) FILTER (WHERE mfr_ref IS NULL) AS missing, round(100.0 * CAST(count(*) FILTER (WHERE mfr_ref IS NULL) AS DOUBLE) / nullif(count(*), 0), 1) AS pct FROM item WHERE md_flag",
    "q05_staging_queue": "SELECT (SELECT count(*) FROM document WHERE status = 'staged') AS docs, (SELECT count(*) FROM link WHERE status = 'staged') AS links, (SELECT count(*) FROM task WHERE status = 'open') AS tasks, (SELECT min(validity_from) FROM document WHERE status = 'staged') AS oldest",
    "q06_tasks_and_jobs": "SELECT 'task' AS what, kind AS key, status, count(*) AS n FROM task GROUP BY 2, 3 UNION ALL SELECT 'job', type, status, count(*) FROM job GROUP BY 2, 3",
    "q07_spend": """
WITH price AS (SELECT 'T0' AS tier, 0.1 AS rate UNION ALL SELECT 'T1', 0.5)
SELECT e.tier, count(*) AS calls, count(*) FILTER (WHERE p.rate IS NULL) AS unpriced, round(sum(CAST(e.line AS DOUBLE) * CAST(p.rate AS DOUBLE)) * 0.92, 2) AS eur FROM evidence e LEFT JOIN price p ON p.tier = e.tier GROUP BY 1""",
    "q08_review_summary": """
WITH staged AS (SELECT doc_id, manufacturer, validity_from FROM document WHERE status = 'staged'), by_link AS (SELECT s.doc_id, min(i.manufacturer_raw) AS maker FROM staged s JOIN link l ON l.doc_id = s.doc_id JOIN item i ON i.item_ref = l.item_ref GROUP BY 1)
SELECT maker, n, oldest FROM (SELECT coalesce(b.maker, s.manufacturer) AS maker, count(*) AS n, min(s.validity_from) AS oldest, row_number() OVER (ORDER BY count(*) DESC, coalesce(b.maker, s.manufacturer)) AS rn FROM staged s LEFT JOIN by_link b ON b.doc_id = s.doc_id GROUP BY 1) x WHERE rn <= 3""",
    "q09_expiring_counts": f"""
WITH lapsing AS (SELECT e.doc_id, e.expires, e.basis FROM expiry e JOIN document_current c ON c.doc_id = e.doc_id WHERE e.expires IS NOT NULL)
SELECT count(*) FILTER (WHERE expires >= {AS_OF} AND @days({AS_OF}, expires) <= 90) AS soon, count(*) FILTER (WHERE expires < {AS_OF} AND @days(expires, {AS_OF}) <= 90) AS recent, count(*) FILTER (WHERE basis = 'staleness' AND expires < {AS_OF}) AS review FROM lapsing""",
    "q10_expiry_board": f"""
WITH affected AS (SELECT doc_id, count(DISTINCT item_ref) AS items, min(item_ref) AS sample FROM current_link GROUP BY 1)
SELECT e.doc_id, e.expires, e.basis, coalesce(a.items, 0) AS items, a.sample, e.expires < {AS_OF} AS lapsed, CAST(@days({AS_OF}, e.expires) AS BIGINT) AS days_left FROM expiry e JOIN document_current c ON c.doc_id = e.doc_id LEFT JOIN affected a ON a.doc_id = e.doc_id WHERE e.expires IS NOT NULL AND e.expires <= @plus_days({AS_OF}, 180)""",
    "q11_expiring_documents": f"SELECT e.doc_id, e.type, e.expires, e.expires < {AS_OF} AS lapsed FROM expiry e JOIN document_current c ON c.doc_id = e.doc_id WHERE e.expires < @plus_days({AS_OF}, 30)",
    "q12_renewal_letters": f"""
SELECT d.manufacturer, count(DISTINCT d.doc_id) AS documents, count(DISTINCT l.item_ref) AS items, min(e.expires) AS first_expiry FROM document d JOIN expiry e ON e.doc_id = d.doc_id JOIN current_link l ON l.doc_id = d.doc_id
WHERE e.expires BETWEEN {AS_OF} AND @plus_days({AS_OF}, 60) GROUP BY 1""",
    "q13_coverage_gaps": """
WITH held AS (SELECT item_ref, bool_or(type = 'DoC') AS has_doc, bool_or(regulation IN ('MDR', 'MDD')) AS regime FROM current_link GROUP BY 1)
SELECT i.item_ref, CASE WHEN h.item_ref IS NULL THEN 'none' WHEN NOT h.has_doc THEN 'no-declaration' ELSE 'no-regime' END AS gap FROM item i LEFT JOIN held h ON h.item_ref = i.item_ref WHERE i.md_flag IS NOT FALSE AND (h.item_ref IS NULL OR NOT h.has_doc OR NOT h.regime)""",
    "q14_discovery_states": """
WITH g AS (SELECT group_id, count(*) FILTER (WHERE i.md_flag) AS md FROM member m JOIN item i ON i.item_ref = m.item_ref GROUP BY 1), l AS (SELECT group_id, bool_or(outcome = 'hit') AS hit, bool_or(outcome = 'handoff') AS handoff FROM discovery GROUP BY 1)
SELECT CASE WHEN l.group_id IS NULL THEN 'never' WHEN l.hit THEN 'found' WHEN l.handoff THEN 'handoff' ELSE 'empty' END AS state, count(*) AS n_groups, CAST(sum(g.md) AS BIGINT) AS md_items FROM g LEFT JOIN l ON l.group_id = g.group_id GROUP BY 1""",
    "q15_uncovered_groups": """
WITH covered AS (SELECT DISTINCT m.group_id FROM member m JOIN current_link c ON c.item_ref = m.item_ref), seen AS (SELECT group_id, max(seen_at) AS last_at FROM discovery GROUP BY 1)
SELECT g.group_id, s.last_at, g.members FROM (SELECT group_id, count(*) AS members FROM member GROUP BY 1) g LEFT JOIN seen s ON s.group_id = g.group_id WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.group_id = g.group_id)""",
    # over half of at least five attempts of a manufacturer's groups in the trailing 30 days; every outcome is an attempt
    "q16_failure_spikes": """
WITH g AS (SELECT DISTINCT m.group_id, coalesce(a.canonical_name, m.manufacturer_raw) AS manufacturer FROM member m LEFT JOIN alias a ON a.raw_name = m.manufacturer_raw),
x AS (SELECT g.manufacturer, count(*) AS total, count(*) FILTER (WHERE d.outcome = 'miss') AS misses FROM discovery d JOIN g ON g.group_id = d.group_id
      WHERE d.seen_at >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL '30' DAY GROUP BY g.manufacturer)
SELECT manufacturer, total, misses, round(CAST(misses AS DOUBLE) / total, 4) AS rate FROM x WHERE total >= 5 AND CAST(misses AS DOUBLE) / total > 0.5""",
    "q17_items_board": f"""
WITH c AS (SELECT item_ref, count(*) AS docs, min(CASE WHEN regulation IN ('MDR', 'MDD') THEN expires END) AS next_expiry FROM current_link GROUP BY 1), s AS (SELECT item_ref, count(*) AS staged FROM link WHERE status = 'staged' GROUP BY 1)
SELECT i.item_ref, coalesce(c.docs, 0) AS docs, coalesce(s.staged, 0) AS staged, c.next_expiry FROM item i LEFT JOIN c ON c.item_ref = i.item_ref LEFT JOIN s ON s.item_ref = i.item_ref""",
    "q18_documents_board": "SELECT d.doc_id, d.type, d.status, count(l.item_ref) AS links, count(*) FILTER (WHERE l.status = 'production') AS live, count(*) FILTER (WHERE l.status = 'staged') AS staged FROM document d LEFT JOIN link l ON l.doc_id = d.doc_id GROUP BY 1, 2, 3",
    "q19_review_rows": "SELECT doc_id, manufacturer, group_size, pos, first_date FROM (SELECT doc_id, manufacturer, count(*) OVER (PARTITION BY manufacturer) AS group_size, CAST(row_number() OVER (PARTITION BY manufacturer ORDER BY doc_id) AS BIGINT) AS pos, min(validity_from) OVER (PARTITION BY manufacturer) AS first_date FROM document WHERE status = 'staged') x WHERE pos <= 20",
    "q20_task_search": "SELECT id FROM task WHERE status = 'open' AND reason = 'error' UNION SELECT t.id FROM task t JOIN document d ON d.doc_id = t.doc_id WHERE t.status = 'open' AND d.type = 'ISO' AND d.status = 'staged'",
    "q21_audit_board": "SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS size FROM conversations WHERE role <> 'system' AND (contains(lower(text), 'the') OR turn = 0)",
    "q22_anomaly_board": "SELECT error AS kind, type AS subject, count(*) AS seen_count, min(id) AS first_id, max(id) AS last_id FROM job WHERE error IS NOT NULL AND error <> '' GROUP BY 1, 2",
    "q23_global_search": "(SELECT 'item' AS section, item_ref AS ref FROM item WHERE contains(lower(item_name), 'blue') ORDER BY item_no LIMIT 5) UNION ALL (SELECT 'document', CAST(doc_id AS STRING) AS ref FROM document WHERE contains(coalesce(certificate_number, ''), '77') ORDER BY doc_id LIMIT 5) UNION ALL (SELECT 'maker', raw_name AS ref FROM alias WHERE contains(raw_name, '#1') ORDER BY raw_name LIMIT 5) UNION ALL (SELECT 'job', CAST(id AS STRING) AS ref FROM job WHERE contains(dedupe_key, 'error:1') ORDER BY id LIMIT 5)",
    "q24_manufacturer_rows": "SELECT a.canonical_name, @set(a.raw_name, ',') AS spellings, count(DISTINCT i.item_ref) AS items, count(DISTINCT c.doc_id) AS documents FROM alias a LEFT JOIN item i ON i.manufacturer_raw = a.raw_name LEFT JOIN current_link c ON c.item_ref = i.item_ref GROUP BY 1",
    "q27_certificate_findings": """
WITH m AS (SELECT DISTINCT h.doc_id, h.base_number, a.srn, r.row_id FROM held_certificate h LEFT JOIN trusted_actor a ON a.canonical_name = h.manufacturer LEFT JOIN register_certificate r ON r.actor_srn = a.srn AND r.certificate_number = h.base_number)
SELECT count(DISTINCT base_number) AS held, count(DISTINCT CASE WHEN row_id IS NOT NULL THEN base_number END) AS matched, count(DISTINCT CASE WHEN row_id IS NULL AND srn IS NOT NULL THEN base_number END) AS unmatched, count(DISTINCT CASE WHEN srn IS NULL THEN base_number END) AS unattributable FROM m""",
    # each side is counted before it meets the other, so that no actor has devices times certificates
    "q28_register_digest": """
WITH d AS (SELECT a.canonical_name, count(DISTINCT x.udi_di) AS n FROM actor a JOIN register_device x ON x.actor_srn = a.srn GROUP BY 1),
c AS (SELECT a.canonical_name, count(DISTINCT r.row_id) AS n FROM actor a JOIN register_certificate r ON r.actor_srn = a.srn GROUP BY 1)
SELECT a.canonical_name, coalesce(d.n, 0) AS devices, coalesce(c.n, 0) AS certificates FROM (SELECT DISTINCT canonical_name FROM actor) a LEFT JOIN d ON d.canonical_name = a.canonical_name LEFT JOIN c ON c.canonical_name = a.canonical_name""",
    "q29_confirm_queue": "SELECT canonical_name, srn, match_score FROM actor WHERE status = 'suggested' ORDER BY match_score DESC, canonical_name LIMIT 20",
    "q30_onboarding_queue": "SELECT i.manufacturer_raw, count(DISTINCT i.item_ref) AS items FROM item i WHERE NOT EXISTS (SELECT 1 FROM alias a WHERE a.raw_name = i.manufacturer_raw) GROUP BY 1",
    "q31_missing_cards": "SELECT m.group_id, count(*) AS members, max(s.last_at) AS last_search FROM member m LEFT JOIN (SELECT group_id, max(seen_at) AS last_at FROM discovery GROUP BY 1) s ON s.group_id = m.group_id WHERE NOT EXISTS (SELECT 1 FROM current_link c WHERE c.item_ref = m.item_ref) GROUP BY 1",
    "q32_failed_split": """
WITH dead AS (SELECT id, type, dedupe_key, coalesce(error, '') AS error FROM job WHERE status = 'dead'), newer AS (SELECT dedupe_key, max(id) AS done_id FROM job WHERE status = 'done' GROUP BY 1)
SELECT CASE WHEN d.error = '' THEN 'developer' WHEN @matches(lower(d.error), 'time.?out') AND d.type = 'fetch.url' THEN 'timeout' WHEN @matches(d.error, 'not known') AND d.type = 'fetch.url' THEN 'dead-address' ELSE 'developer' END AS class, coalesce(n.done_id > d.id, false) AS redone, count(*) AS n FROM dead d LEFT JOIN newer n ON n.dedupe_key = d.dedupe_key GROUP BY 1, 2""",
    "q33_dead_groups": "SELECT type, substr(coalesce(error, ''), 1, 10) AS signature, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM job WHERE status = 'dead' GROUP BY 1, 2",
    "q35_catalogue_summary": "SELECT i.catalogue, count(DISTINCT i.item_ref) AS items, count(DISTINCT c.doc_id) AS documents FROM item i LEFT JOIN current_link c ON c.item_ref = i.item_ref GROUP BY 1",
    "q36_item_fields": f"""
WITH now AS (SELECT i.item_ref, coalesce(bool_or(c.type = 'DoC' AND (c.expires IS NULL OR c.expires >= {AS_OF})), false) AS valid_doc, coalesce(bool_or(c.type = 'EC'), false) AS has_ce, max(c.doc_id) AS url_doc FROM item i LEFT JOIN current_link c ON c.item_ref = i.item_ref GROUP BY 1),
pushed AS (SELECT item_ref, item_no % 4 = 0 AS valid_doc, item_no % 6 = 0 AS has_ce FROM item WHERE item_no % 5 <> 0)
SELECT n.item_ref, n.valid_doc, n.has_ce, n.url_doc, CASE WHEN p.item_ref IS NULL THEN 'new' ELSE 'changed' END AS reason FROM now n LEFT JOIN pushed p ON p.item_ref = n.item_ref WHERE p.item_ref IS NULL OR p.valid_doc IS DISTINCT FROM n.valid_doc OR p.has_ce IS DISTINCT FROM n.has_ce""",
    "q37_health": """
SELECT 'stalled' AS condition, type AS subject, count(*) AS n FROM job WHERE status = 'running' AND created_at < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 2 UNION ALL
SELECT 'silent', source, count(*) FROM discovery GROUP BY 2 HAVING max(seen_at) < TIMESTAMP '2024-01-30 23:50:00'""",
    "q38_gap_letters": "SELECT m.group_id, @set(i.mfr_ref, ',') AS refs FROM member m JOIN item i ON i.item_ref = m.item_ref LEFT JOIN current_link c ON c.item_ref = m.item_ref WHERE c.item_ref IS NULL AND i.mfr_ref IS NOT NULL GROUP BY 1",
    "q39_reextract_selection": "SELECT doc_id, CASE WHEN status = 'superseded' THEN 'superseded' WHEN validity_from IS NULL THEN 'undated' WHEN regulation = 'n.a.' THEN 'no-regime' ELSE 'selected' END AS decision FROM document WHERE type = 'DoC'",
    "q40_revalidate_by_name": "SELECT d.doc_id, a.canonical_name FROM document d JOIN alias a ON a.raw_name = d.manufacturer JOIN (SELECT doc_id, kind, row_number() OVER (PARTITION BY doc_id ORDER BY created_at DESC, id DESC) AS rn FROM task) t ON t.doc_id = d.doc_id AND t.rn = 1 WHERE t.kind = 'review' AND d.status = 'staged'",
    "q41_repair_plan": "SELECT d.doc_id, d.validity_to, @plus_days(d.validity_from, 1825) AS proposed FROM document d WHERE d.type = 'IFU' AND d.validity_to IS NOT NULL AND d.validity_to IS DISTINCT FROM @plus_days(d.validity_from, 1825)",
    "q42_corpus_profile": "SELECT lang, source, count(*) AS docs, count(*) FILTER (WHERE n_chars < 100) AS short_docs, CAST(sum(n_chars) AS BIGINT) AS chars, count(*) FILTER (WHERE @matches(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}')) AS dated FROM documents GROUP BY 1, 2",
    "q43_weekly_report": """
SELECT 'documents' AS line, count(*) AS n FROM document WHERE status = 'production' UNION ALL SELECT 'links', count(*) FROM link WHERE status = 'production' UNION ALL SELECT 'open tasks', count(*) FROM task WHERE status = 'open' UNION ALL
SELECT 'dead jobs', count(*) FROM job WHERE status = 'dead' UNION ALL SELECT 'uncovered items', count(*) FROM item i WHERE NOT EXISTS (SELECT 1 FROM current_link c WHERE c.item_ref = i.item_ref)""",
    "q44_family_plan": "SELECT @at(@split(i.item_name, ' '), 1) AS family, count(DISTINCT i.item_ref) AS items, count(DISTINCT c.doc_id) AS documents, count(DISTINCT CASE WHEN c.type = 'DoC' THEN c.doc_id END) AS declarations FROM item i LEFT JOIN current_link c ON c.item_ref = i.item_ref GROUP BY 1",
    "q45_drift_compare": "WITH a AS (SELECT n_name AS name, @md5(n_name) AS f FROM nation WHERE n_nationkey % 6 <> 1), b AS (SELECT n_name AS name, @md5(CASE WHEN n_nationkey % 7 = 2 THEN lower(n_name) ELSE n_name END) AS f FROM nation WHERE n_nationkey % 5 <> 3) SELECT coalesce(a.name, b.name) AS name, CASE WHEN a.name IS NULL THEN 'extra' WHEN b.name IS NULL THEN 'missing' ELSE 'changed' END AS drift FROM a FULL JOIN b ON a.name = b.name WHERE a.f IS DISTINCT FROM b.f",
    "q46_scheduler_board": "SELECT type, id, status, CASE WHEN status = 'dead' THEN 'failed' WHEN status IN ('pending', 'running') THEN 'under way' ELSE 'ok' END AS verdict FROM (SELECT type, id, status, row_number() OVER (PARTITION BY type ORDER BY created_at DESC, id DESC) AS rn FROM job) x WHERE rn = 1",
    "q47_inbound_board": "SELECT user_id, count(*) FILTER (WHERE type = 'fetch.url') AS fetched, count(*) FILTER (WHERE type = 'extract') AS uploaded, min(created_at) AS first_at FROM job GROUP BY 1",
    "q48_draft_board": "SELECT t.id, t.kind, count(l.item_ref) AS items, d.manufacturer FROM task t JOIN document d ON d.doc_id = t.doc_id LEFT JOIN link l ON l.doc_id = d.doc_id WHERE t.status = 'claimed' GROUP BY 1, 2, 4",
    "q49_item_documents": "SELECT c.item_ref, c.doc_id, c.type, e.printed_ref FROM current_link c LEFT JOIN (SELECT doc_id, printed_ref, row_number() OVER (PARTITION BY doc_id ORDER BY line DESC, printed_ref) AS rn FROM evidence) e ON e.doc_id = c.doc_id AND e.rn = 1",
    "q50_maker_device_class": "SELECT coalesce(a.canonical_name, i.manufacturer_raw) AS maker, count(*) FILTER (WHERE i.md_flag) AS md, count(*) FILTER (WHERE NOT i.md_flag) AS not_md, count(*) FILTER (WHERE i.md_flag IS NULL) AS unknown FROM item i LEFT JOIN alias a ON a.raw_name = i.manufacturer_raw GROUP BY 1",
    "q51_rule_drift": "WITH f AS (SELECT raw_name AS slug, canonical_name AS v FROM alias WHERE raw_name <> 'Brand#1'), s AS (SELECT raw_name AS slug, CASE WHEN raw_name = 'Brand#2' THEN 'other' ELSE canonical_name END AS v FROM alias WHERE raw_name <> 'Brand#3') SELECT coalesce(f.slug, s.slug) AS slug, CASE WHEN s.slug IS NULL THEN 'file-only' WHEN f.slug IS NULL THEN 'stored-only' ELSE 'differs' END AS delta FROM f FULL JOIN s ON f.slug = s.slug WHERE f.v IS DISTINCT FROM s.v",
    "q52_rule_validation": "SELECT canonical_name, count(*) AS codes FROM alias GROUP BY 1 HAVING count(*) > 1",
    "q53_probe_summary": "WITH a AS (SELECT page_id, @size(@found(html, '<a [^>]*href')) AS anchors, @size(@found(html, '[.]pdf')) AS files FROM pages) SELECT CASE WHEN files > 0 THEN 'documents' WHEN anchors > 0 THEN 'links-only' ELSE 'empty' END AS verdict, count(*) AS pages_n, CAST(sum(anchors) AS BIGINT) AS anchors FROM a GROUP BY 1",
    "q54_reminders": "SELECT id, group_id, CASE WHEN @seconds(created_at, TIMESTAMP '2024-01-31 00:00:00') >= 14 * 86400 * 2 THEN 'escalate' ELSE 'remind' END AS step FROM task WHERE status = 'open' AND @seconds(created_at, TIMESTAMP '2024-01-31 00:00:00') >= 14 * 86400",
    "q55_status_counts": "WITH s AS (SELECT 'pending' AS status, 0 AS pos UNION ALL SELECT 'running', 1 UNION ALL SELECT 'failed', 2 UNION ALL SELECT 'dead', 3 UNION ALL SELECT 'done', 4 UNION ALL SELECT 'cancelled', 5) SELECT s.status, CAST(s.pos AS BIGINT) AS pos, count(j.id) AS n FROM s LEFT JOIN job j ON j.status = s.status GROUP BY 1, 2",
    "q56_services_pulse": "SELECT source, seen_at, @seconds(seen_at, TIMESTAMP '2024-02-01 00:00:00') AS age FROM (SELECT source, seen_at, row_number() OVER (PARTITION BY source ORDER BY seen_at DESC, log_id DESC) AS rn FROM discovery) x WHERE rn = 1",
    "q57_staged_links": "SELECT d.doc_id, d.status, count(*) AS staged, @all(l.item_ref, ',') AS items FROM link l JOIN document d ON d.doc_id = l.doc_id WHERE l.status = 'staged' AND d.status = 'production' GROUP BY 1, 2",
    "q58_document_detail": "SELECT d.doc_id, d.type, e.n_evidence, l.n_links, t.n_tasks FROM document d LEFT JOIN (SELECT doc_id, count(*) AS n_evidence FROM evidence GROUP BY 1) e ON e.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n_links FROM link GROUP BY 1) l ON l.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n_tasks FROM task GROUP BY 1) t ON t.doc_id = d.doc_id WHERE d.status = 'staged'",
    "q59_register_sync": "WITH fresh AS (SELECT udi_di, reference, device_status, last_seen FROM register_device WHERE last_seen >= DATE '1998-05-01'), old AS (SELECT udi_di, reference, CASE WHEN length(udi_di) % 2 = 0 THEN 'planned' ELSE device_status END AS device_status, first_seen FROM register_device WHERE first_seen < DATE '1998-08-01') SELECT coalesce(f.udi_di, o.udi_di) AS udi_di, coalesce(o.first_seen, f.last_seen) AS first_seen, CASE WHEN o.udi_di IS NULL THEN 'insert' WHEN f.udi_di IS NULL THEN 'keep' WHEN f.device_status IS DISTINCT FROM o.device_status THEN 'update' ELSE 'same' END AS action FROM fresh f FULL JOIN old o ON f.udi_di = o.udi_di",
    "q60_upload_intake": "WITH h AS (SELECT doc_id, @sha256(text) AS content_hash FROM documents) SELECT content_hash, min(doc_id) AS doc_id, count(*) AS copies FROM h GROUP BY 1",
    # --- matching --------------------------------------------------------------------------------------------------
    "r02_alias_canonicalise": "SELECT upper(@replace_all(raw_name, '[^0-9A-Za-z]', '')) AS fold, @first_by(canonical_name, raw_name) AS canonical_name, count(DISTINCT canonical_name) AS candidates FROM alias GROUP BY 1",
    "r03_ref_gate": """
WITH printed AS (SELECT DISTINCT doc_id, 'Brand#' || CAST(1 + line % 25 AS STRING) || '-' || substr(printed_ref, 2) AS ref, printed_ref FROM evidence),
hit AS (SELECT p.doc_id, i.item_ref, 2 AS ord, 'ref-list' AS basis FROM printed p JOIN item i ON i.mfr_ref = p.ref UNION ALL SELECT p.doc_id, i.item_ref, 3, 'ref-item' FROM printed p JOIN item i ON i.item_ref = p.printed_ref)
SELECT doc_id, item_ref, basis FROM (SELECT doc_id, item_ref, basis, row_number() OVER (PARTITION BY doc_id, item_ref ORDER BY ord) AS rn FROM hit) x WHERE rn = 1""",
    "r04_unscoped_gate": "WITH e AS (SELECT DISTINCT trim(mfr_ref) AS ref, manufacturer_raw FROM item WHERE length(trim(mfr_ref)) >= 6 AND NOT contains(mfr_ref, '!')) SELECT ref, count(DISTINCT manufacturer_raw) AS holders, CASE WHEN count(DISTINCT manufacturer_raw) = 1 THEN 'ref-catalogue' ELSE 'multi-manufacturer-ref' END AS outcome FROM e GROUP BY 1",
    "r05_newer_or_older": f"""
WITH cur AS (SELECT l.item_ref, d.type, d.regulation, max(CASE WHEN d.validity_from <= {AS_OF} THEN d.validity_from END) AS held_from FROM link l JOIN document d ON d.doc_id = l.doc_id WHERE l.status = 'production' AND d.status = 'production' GROUP BY 1, 2, 3)
SELECT l.item_ref, d.doc_id, CASE WHEN c.item_ref IS NULL THEN 'none' WHEN d.validity_from IS NULL OR c.held_from IS NULL THEN 'uncomparable' WHEN d.validity_from > c.held_from THEN 'newer' WHEN d.validity_from < c.held_from THEN 'older' ELSE 'equal' END AS verdict
FROM link l JOIN document d ON d.doc_id = l.doc_id AND d.status = 'staged' LEFT JOIN cur c ON c.item_ref = l.item_ref AND c.type = d.type AND c.regulation = d.regulation""",
    "r06_related_regulation": "SELECT d.doc_id, max(o.doc_id) AS related FROM document d JOIN document o ON o.manufacturer = d.manufacturer AND o.type = d.type AND o.regulation <> d.regulation AND o.validity_from = d.validity_from GROUP BY 1",
    "r07_cited_certificate": "WITH c AS (SELECT doc_id, certificate_number, @replace_all(certificate_number, ' R[0-9]+$', '') AS base FROM document WHERE certificate_number IS NOT NULL AND status = 'production') SELECT d.doc_id, max(CASE WHEN x.certificate_number = d.certificate_number THEN x.doc_id END) AS exact_doc, max(x.doc_id) AS base_doc FROM document d JOIN c x ON x.base = @replace_all(d.certificate_number, ' R[0-9]+$', '') AND x.doc_id <> d.doc_id GROUP BY 1",
    "r08_device_enumeration": "SELECT doc_id, CAST(@size(@found(text, '[0-9]{3,}')) AS BIGINT) AS numbers, CAST(@matches(text, '[|]') AS INT) + CAST(@size(@found(text, '[0-9]{3,}')) >= 3 AS INT) + CAST(@size(@split(text, ',')) > 30 AS INT) >= 2 AS enumeration FROM documents",
    "r09_date_sanity": f"SELECT doc_id, CASE WHEN validity_from IS NULL THEN 'undated' WHEN validity_to < validity_from THEN 'inverted' WHEN validity_to = validity_from THEN 'equal' WHEN validity_from > {AS_OF} THEN 'future-start' WHEN @days(validity_from, validity_to) > 365 * 4 THEN 'long' ELSE 'ok' END AS flag FROM document",
    "r10_subcontractors": "WITH rule AS (SELECT 'Brand#3' AS maker, 'Brand#4' AS sub UNION ALL SELECT 'Brand#10', 'Brand#11') SELECT d.doc_id, r.maker FROM document d JOIN rule r ON r.sub = d.manufacturer WHERE d.type = 'DoC'",
    # at least three of a document's articles are held by one manufacturer and by no other, and these are four fifths of all known ones
    "r11_name_suggestion": """
WITH printed AS (SELECT DISTINCT doc_id, printed_ref FROM evidence), carried AS (SELECT item_ref AS ref, manufacturer_raw FROM item UNION SELECT mfr_ref, manufacturer_raw FROM item WHERE mfr_ref IS NOT NULL),
holder AS (SELECT ref, min(manufacturer_raw) AS maker, count(*) AS makers FROM carried GROUP BY ref),
per AS (SELECT p.doc_id, h.maker, count(*) FILTER (WHERE h.makers = 1) AS n, CAST(sum(count(*)) OVER (PARTITION BY p.doc_id) AS BIGINT) AS total FROM printed p JOIN holder h ON h.ref = p.printed_ref GROUP BY p.doc_id, h.maker)
SELECT doc_id, maker AS manufacturer_raw, n, total FROM per WHERE n >= 3 AND n >= 0.8 * total""",
    "r13_item_search": "SELECT item_ref, CASE WHEN @starts(item_ref, 'P12') THEN 2 WHEN contains(item_ref, '12') THEN 1 ELSE 0 END AS score FROM item WHERE contains(item_ref, '12') OR contains(lower(item_name), 'ring')",
    "r14_pick_check": "WITH pick AS (SELECT 'P' || CAST(doc_id % 2500 AS STRING) AS item_ref, doc_id, manufacturer FROM document WHERE status = 'staged') SELECT p.doc_id, p.item_ref, CASE WHEN i.item_ref IS NULL THEN 'unknown' WHEN i.manufacturer_raw <> p.manufacturer THEN 'other-manufacturer' WHEN l.status IS NOT NULL THEN 'linked' ELSE 'ok' END AS verdict FROM pick p LEFT JOIN item i ON i.item_ref = p.item_ref LEFT JOIN link l ON l.item_ref = p.item_ref AND l.doc_id = p.doc_id",
    "r16_crossref_tiers": "WITH x AS (SELECT d.manufacturer, i.manufacturer_raw, count(*) AS n FROM link l JOIN document d ON d.doc_id = l.doc_id JOIN item i ON i.item_ref = l.item_ref GROUP BY 1, 2), t AS (SELECT *, CAST(sum(n) OVER (PARTITION BY manufacturer) AS BIGINT) AS total FROM x) SELECT manufacturer, manufacturer_raw, n, CASE WHEN n >= 5 AND n >= 0.1 * total THEN 'CONFIRMED' WHEN n >= 3 THEN 'LIKELY' ELSE 'WEAK' END AS tier FROM t",
    "r17_match_key_analysis": "SELECT k, count(DISTINCT item_ref) AS items, count(DISTINCT manufacturer_raw) AS makers FROM (SELECT item_ref, manufacturer_raw, @replace_all(mfr_ref, '^[^-]*-', '') AS k FROM item WHERE mfr_ref IS NOT NULL) x GROUP BY 1 HAVING count(DISTINCT manufacturer_raw) > 1",
    "r18_overlap_replay": """
WITH docs AS (SELECT doc_id, manufacturer FROM document WHERE type = 'DoC'), refs AS (SELECT DISTINCT e.doc_id, e.printed_ref FROM evidence e JOIN docs d ON d.doc_id = e.doc_id), scoped AS (SELECT r.doc_id, i.item_ref, i.manufacturer_raw = d.manufacturer AS own FROM refs r JOIN docs d ON d.doc_id = r.doc_id JOIN item i ON i.item_ref = r.printed_ref),
per AS (SELECT doc_id, count(*) AS matched, count(*) FILTER (WHERE own) AS own FROM scoped GROUP BY 1)
SELECT d.doc_id, coalesce(p.matched, 0) AS matched, coalesce(p.own, 0) AS own, CASE WHEN p.doc_id IS NULL THEN 'no-ref-overlap' WHEN p.own > 0 THEN 'group' ELSE 'catalogue' END AS gate FROM docs d LEFT JOIN per p ON p.doc_id = d.doc_id""",
    "r19_vendor_diff": "WITH o AS (SELECT s_suppkey AS code, s_name AS name FROM supplier WHERE s_suppkey % 9 <> 2), n AS (SELECT s_suppkey AS code, CASE WHEN s_suppkey % 8 = 3 THEN upper(s_name) ELSE s_name END AS name FROM supplier WHERE s_suppkey % 7 <> 4) SELECT coalesce(o.code, n.code) AS code, CASE WHEN o.code IS NULL THEN 'added' WHEN n.code IS NULL THEN 'disappeared' WHEN o.name <> n.name THEN 'renamed' ELSE 'unchanged' END AS change FROM o FULL JOIN n ON o.code = n.code",
    "r20_link_checks": "SELECT i.manufacturer_raw, count(*) AS links, count(*) FILTER (WHERE d.manufacturer <> i.manufacturer_raw) AS crossing, count(*) FILTER (WHERE a.raw_name IS NULL) AS unowned FROM link l JOIN item i ON i.item_ref = l.item_ref JOIN document d ON d.doc_id = l.doc_id LEFT JOIN alias a ON a.raw_name = i.manufacturer_raw GROUP BY 1",
    "r21_mined_addresses": "SELECT address, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc FROM (SELECT doc_id, @explode(@found(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+[.][a-z]+')) AS address FROM documents) x GROUP BY 1",
    "r22_annex_pairing": "SELECT manufacturer, regulation, count(*) AS n, CASE WHEN count(*) = 1 THEN 'paired' ELSE 'ambiguous' END AS outcome, min(doc_id) AS canonical FROM document WHERE type = 'DoC' AND validity_from >= DATE '2001-05-01' GROUP BY 1, 2",
    # --- extraction, scoring ---------------------------------------------------------------------------------------
    "x09_coverage_scope": "SELECT doc_id, CASE WHEN type = 'ISO' THEN 'manufacturer' WHEN type = 'EC' THEN 'manufacturer' ELSE coverage_scope END AS scope, CAST(least(CASE WHEN type IN ('ISO', 'EC') THEN 0.9 ELSE 0.8 END, 0.85) AS DOUBLE) AS conf FROM document",
    "x13_needs_escalation": "SELECT doc_id, @set(CASE WHEN value IS NULL OR confidence < 0.93 THEN field END, ',') AS fields FROM evidence GROUP BY 1",
    "x14_agreement": "SELECT a.doc_id, a.field, upper(trim(a.value)) = upper(trim(b.value)) AS agree, count(*) AS pairs FROM evidence a JOIN evidence b ON b.doc_id = a.doc_id AND b.field = a.field AND b.tier > a.tier WHERE a.value IS NOT NULL AND b.value IS NOT NULL GROUP BY 1, 2, 3",
    "x16_rejected_nomenclature": "SELECT doc_id, @array_text(@sorted(@distinct(@found(text, '[0-9]{13,}'))), ',') AS numbers FROM documents",
    "x17_integrity_flags": "SELECT doc_id, count(*) AS reads, count(*) FILTER (WHERE value IS NULL) AS blank, CASE WHEN count(*) >= 7 THEN 'list-at-cap' WHEN count(*) FILTER (WHERE value IS NULL) > 0 THEN 'blank-field' ELSE '' END AS flag FROM evidence GROUP BY 1",
    "x18_calibrate": "SELECT doc_id, line, round(greatest(0.0, least(1.0, confidence * CASE tier WHEN 'T0' THEN 1.05 WHEN 'T1' THEN 0.95 ELSE 0.9 END)), 4) AS calibrated FROM (SELECT doc_id, line, CAST(confidence AS DOUBLE) AS confidence, tier, row_number() OVER (PARTITION BY doc_id, line ORDER BY printed_ref, tier, confidence) AS rn FROM evidence) x WHERE rn = 1",
    "x20_harvest_cache_key": "SELECT page_id, @sha256(CAST(page_id AS STRING) || ':' || url) AS cache_key FROM pages",
    "g03_disposition": f"""
WITH s AS (SELECT doc_id, min(c) AS score FROM (SELECT doc_id, field, max(CAST(confidence AS DOUBLE)) AS c FROM evidence WHERE field <> 'ref_list' GROUP BY 1, 2) x GROUP BY 1), l AS (SELECT doc_id, count(*) AS links FROM link GROUP BY 1),
f AS (SELECT d.doc_id, coalesce(s.score, 0.0) AS score, coalesce(l.links, 0) AS links, d.coverage_scope, d.status = 'superseded' AS superseding, d.validity_to < d.validity_from AS blocking, d.validity_from > {AS_OF} AS gating FROM document d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN l ON l.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN superseding AND NOT coalesce(blocking, false) AND score >= 0.92 THEN 'superseded' WHEN score >= 0.92 AND links > 0 AND NOT coalesce(gating, false) AND NOT coalesce(blocking, false) THEN 'production'
  WHEN score >= 0.75 AND NOT coalesce(blocking, false) AND links = 0 AND coverage_scope <> 'manufacturer' THEN 'filed' WHEN score >= 0.75 AND NOT coalesce(blocking, false) THEN 'staged' ELSE 'manual' END AS disposition FROM f""",
    "g04_out_of_catalogue": "SELECT d.doc_id, count(i.item_ref) = 0 AS out_of_catalogue FROM document d JOIN evidence e ON e.doc_id = d.doc_id LEFT JOIN item i ON i.item_ref = e.printed_ref AND i.md_flag GROUP BY 1",
    "g05_link_status": "SELECT l.item_ref, l.doc_id, CASE WHEN l.match_basis IN ('ref-list', 'ref-item', 'basic-udi-di', 'map-supplier') AND d.status = 'production' AND d.o_totalprice >= 200000 THEN 'production' ELSE 'staged' END AS status FROM link l JOIN document d ON d.doc_id = l.doc_id",
    "g06_evidence_complete": "SELECT doc_id, count(DISTINCT field) AS fields, CASE WHEN count(DISTINCT field) < 3 THEN 'error' WHEN count(*) FILTER (WHERE value IS NULL) > 0 THEN 'page-missing' ELSE 'complete' END AS verdict FROM evidence GROUP BY 1",
    "g07_manufacturer_binding": "SELECT d.doc_id, CASE WHEN a.canonical_name IS NULL THEN 'filed' WHEN count(i.item_ref) = 0 THEN 'staged' ELSE 'bound' END AS outcome, count(i.item_ref) AS items FROM document d LEFT JOIN alias a ON a.raw_name = d.manufacturer LEFT JOIN item i ON i.manufacturer_raw = a.raw_name AND i.md_flag WHERE d.coverage_scope = 'manufacturer' AND d.type = 'EC' GROUP BY d.doc_id, a.canonical_name",
    "g08_decisions": """
WITH log AS (SELECT doc_id, id, CASE event WHEN 0 THEN 'approve' WHEN 1 THEN 'reject' ELSE 'reopen' END AS decision FROM (SELECT doc_id, id, id % 3 AS event FROM task) x), last AS (SELECT doc_id, decision, row_number() OVER (PARTITION BY doc_id ORDER BY id DESC) AS rn, count(*) OVER (PARTITION BY doc_id) AS decisions FROM log)
SELECT d.doc_id, d.status AS before_status, CASE l.decision WHEN 'approve' THEN CASE WHEN d.validity_from IS NULL THEN d.status ELSE 'production' END WHEN 'reject' THEN 'rejected' ELSE CASE WHEN d.status = 'superseded' THEN 'staged' ELSE d.status END END AS after_status, l.decisions FROM document d JOIN last l ON l.doc_id = d.doc_id AND l.rn = 1""",
    "g09_chain_identity": "SELECT d.doc_id, c.doc_id AS successor, d.regulation = c.regulation AND d.manufacturer = c.manufacturer AS same FROM document d JOIN document c ON c.doc_id = d.doc_id + 4 WHERE d.status = 'superseded'",
    # --- merges ----------------------------------------------------------------------------------------------------
    "m01_mirror_upsert": """
WITH old AS (SELECT item_ref, item_name, mfr_ref, md_flag, mirror_rev FROM item WHERE item_no % 11 <> 0), new AS (SELECT item_ref, CASE WHEN item_no % 10 = 1 THEN item_name || '*' ELSE item_name END AS item_name, mfr_ref, CASE WHEN item_no % 20 = 2 THEN NULL ELSE md_flag END AS md_flag FROM item WHERE item_no % 13 <> 0)
SELECT count(*) FILTER (WHERE n.item_ref IS NOT NULL) AS seen, count(*) FILTER (WHERE o.item_ref IS NULL) AS added, count(*) FILTER (WHERE n.item_ref IS NULL) AS missing, count(*) FILTER (WHERE o.item_ref IS NOT NULL AND n.item_ref IS NOT NULL AND (o.item_name IS DISTINCT FROM n.item_name OR o.mfr_ref IS DISTINCT FROM n.mfr_ref OR o.md_flag IS DISTINCT FROM n.md_flag)) AS changed,
       count(*) FILTER (WHERE o.item_name IS NOT DISTINCT FROM n.item_name AND o.mfr_ref IS NOT DISTINCT FROM n.mfr_ref AND o.md_flag IS NOT DISTINCT FROM n.md_flag) AS unchanged FROM old o FULL JOIN new n ON o.item_ref = n.item_ref""",
    "m02_sticky_link_upsert": "WITH new AS (SELECT item_ref, doc_id, 'staged' AS status, 'fetch-context' AS match_basis FROM link WHERE doc_id % 3 = 0) SELECT l.item_ref, l.doc_id, CASE WHEN n.doc_id IS NULL OR l.status IN ('production', 'rejected') THEN l.status ELSE n.status END AS status, CASE WHEN n.doc_id IS NULL OR l.status IN ('production', 'rejected') THEN l.match_basis ELSE n.match_basis END AS match_basis FROM link l LEFT JOIN new n ON n.item_ref = l.item_ref AND n.doc_id = l.doc_id",
    "m03_first_seen": "SELECT udi_di, least(first_seen, last_seen) AS first_seen, greatest(last_seen, DATE '1998-08-02') AS last_seen FROM register_device",
    "m04_counter_upsert": "SELECT type, error, CAST(sum(n) AS BIGINT) AS seen_count FROM (SELECT type, error, count(*) AS n FROM job WHERE id % 2 = 0 AND error IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT type, error, count(*) FROM job WHERE id % 2 = 1 AND error IS NOT NULL GROUP BY 1, 2) x GROUP BY 1, 2",
    "m05_insert_if_absent": "SELECT id, dedupe_key FROM (SELECT n.id, n.dedupe_key, row_number() OVER (PARTITION BY n.dedupe_key ORDER BY n.id) AS rn FROM job n WHERE n.id >= 5000 AND NOT EXISTS (SELECT 1 FROM job a WHERE a.dedupe_key = n.dedupe_key AND a.id < 5000 AND a.status IN ('pending', 'running', 'failed'))) x WHERE rn = 1",
    "m06_request_union": "SELECT manufacturer, doc_id FROM document WHERE status = 'staged' AND doc_id < 9000 UNION SELECT manufacturer, doc_id FROM document WHERE status = 'staged' AND doc_id > 8000",
    "m07_retract_unsupported": "SELECT l.item_ref, l.doc_id, CASE WHEN l.status = 'staged' AND e.doc_id IS NULL THEN 'retracted' ELSE l.status END AS status FROM link l LEFT JOIN (SELECT DISTINCT doc_id, printed_ref FROM evidence WHERE value IS NOT NULL) e ON e.doc_id = l.doc_id AND e.printed_ref = l.item_ref",
    "m08_document_upsert": "SELECT d.doc_id, coalesce(CASE WHEN d.doc_id % 7 = 0 THEN d.regulation END, n.regulation) AS regulation, coalesce(n.validity_to, d.validity_to) AS validity_to FROM document d JOIN document n ON n.doc_id = d.doc_id + 8",
    "m09_back_resolve": "SELECT d.doc_id, d.cert_doc_id AS stated, max(c.doc_id) AS resolved FROM document d JOIN document c ON c.certificate_number = 'HZ ' || CAST(d.o_custkey AS STRING) WHERE d.type = 'DoC' AND d.cert_doc_id IS NULL GROUP BY 1, 2",
    "m10_latest_revision": "SELECT dedupe_key, id AS rev_id, CAST(rn AS BIGINT) AS back FROM (SELECT dedupe_key, id, row_number() OVER (PARTITION BY dedupe_key ORDER BY id DESC) AS rn FROM job) x WHERE rn <= 2",
    "m11_rename_cascade": "WITH moved AS (SELECT 'Brand#7' AS old, 'Brand#8' AS new) SELECT m.group_id AS old_group, coalesce(m.group_id - 70 + 80, m.group_id) AS new_group, count(*) AS n FROM member m JOIN moved r ON r.old = m.manufacturer_raw GROUP BY 1",
    "m12_alias_seed": "SELECT raw_name, canonical_name, CASE WHEN CAST(substr(raw_name, 7) AS INT) % 3 = 0 THEN 'drift' ELSE 'same' END AS class FROM alias",
    "m13_repair_plan": "SELECT item_ref, doc_id, match_basis, 'over-bind' AS reason FROM link WHERE match_basis = 'mfr-scope' AND status = 'production' AND doc_id IN (SELECT doc_id FROM document WHERE coverage_scope = 'item')",
    # --- schedule and queue ----------------------------------------------------------------------------------------
    "z01_enqueue": "SELECT min(id) AS id, dedupe_key FROM job WHERE status IN ('pending', 'running', 'failed') GROUP BY dedupe_key",
    "z02_claim": "SELECT id, CAST(attempts + 1 AS BIGINT) AS attempts FROM job WHERE (status IN ('pending', 'failed') AND run_after <= TIMESTAMP '2024-01-20 00:00:00') OR (status = 'running' AND created_at < TIMESTAMP '2024-01-19 23:30:00') ORDER BY CASE priority WHEN 'high' THEN 0 WHEN 'normal' THEN 1 ELSE 2 END, run_after, id LIMIT 100",
    "z03_fail_backoff": "SELECT id, CASE WHEN attempts >= max_attempts THEN 'dead' ELSE 'failed' END AS status, CAST(least(5 * power(2, greatest(attempts, 1) - 1), 3600) AS BIGINT) AS delay_s FROM job WHERE status = 'failed'",
    "z04_defer": "SELECT id, CAST(greatest(attempts - 1, 0) AS BIGINT) AS attempts FROM job WHERE status = 'running'",
    "z06_finish_closes_tasks": "SELECT t.id FROM task t WHERE t.kind = 'dead-job' AND t.status = 'open' AND EXISTS (SELECT 1 FROM job j WHERE j.status = 'done' AND j.user_id + 10 = t.group_id AND j.id > t.id)",
    "z07_tick_ledger": "SELECT type, @week(@day(created_at)) AS period, min(id) AS first_id, count(*) AS runs FROM job GROUP BY 1, 2",
    "z08_expiry_scan": f"SELECT manufacturer, period, doc_id FROM (SELECT d.manufacturer, @week(e.expires) AS period, d.doc_id, row_number() OVER (PARTITION BY d.manufacturer, @week(e.expires) ORDER BY d.doc_id) AS rn FROM document d JOIN expiry e ON e.doc_id = d.doc_id WHERE e.expires BETWEEN {AS_OF} AND @plus_days({AS_OF}, 30)) x WHERE rn = 1",
    "z09_coverage_tick": "SELECT m.group_id, @month(DATE '1998-08-02') AS period FROM member m WHERE NOT EXISTS (SELECT 1 FROM discovery d WHERE d.group_id = m.group_id AND d.outcome = 'hit') GROUP BY 1",
    "z10_reply_matching": "SELECT r.conv_id, r.turn, q.turn AS answers FROM conversations r JOIN conversations q ON q.conv_id = r.conv_id AND q.turn = r.turn - 1 AND q.role = 'user' WHERE r.role = 'assistant'",
    "z11_fetch_decision": "WITH h AS (SELECT page_id, url, @extract(lower(url), '://([^/:?#]+)', 1) AS host, @sha256(html) AS content_hash FROM pages), f AS (SELECT *, min(page_id) OVER (PARTITION BY content_hash) AS first_page FROM h) SELECT page_id, CASE WHEN @starts(host, 'm.') THEN 'leased' WHEN page_id % 9 = 0 THEN 'fresh' WHEN contains(url, '/es/') THEN 'refused' WHEN first_page < page_id THEN 'duplicate' ELSE 'archive' END AS decision FROM f",
    "z12_discover_ladder": "SELECT group_id, source, outcome FROM (SELECT group_id, source, outcome, row_number() OVER (PARTITION BY group_id ORDER BY CASE WHEN outcome = 'hit' THEN 0 ELSE 1 END, CASE source WHEN 'known_url' THEN 0 WHEN 'register' THEN 1 WHEN 'search' THEN 2 ELSE 3 END, log_id) AS rn FROM discovery) x WHERE rn = 1",
    "z13_deferred_batches": "SELECT CAST(doc_id % 50 AS BIGINT) AS batch, count(*) AS reads, count(*) FILTER (WHERE tier = 'T2') AS waiting FROM evidence GROUP BY 1",
    "z14_epoch": "SELECT manufacturer, CAST(max(doc_id) AS BIGINT) AS epoch FROM document GROUP BY 1",
    # --- scalar functions ------------------------------------------------------------------------------------------
    "t03_key": "SELECT item_ref, upper(@replace_all(item_name || coalesce(mfr_ref, ''), '[^0-9A-Za-z]', '')) AS k FROM item",
    "t04_compact": "SELECT item_ref, lower(@replace_all(item_name, '[ ]', '')) AS compact FROM item",
    "t05_fold_accents": "SELECT doc_id, translate(lower(text), 'äöüéèêáíóúñç', 'aoueeeaiounc') AS folded FROM documents",
    "t07_normalise_url": "SELECT page_id, @replace_all(@replace_all(lower(@extract(url, '^([A-Za-z]+://[^/?#]*)', 1)), ':(80|443)$', '') || @replace_all(@extract(url, '^[A-Za-z]+://[^/?#]*([^#]*)', 1), '^/$', ''), '[ ]', '') AS normal FROM pages",
    "t08_domain": "WITH h AS (SELECT page_id, @extract(lower(url), '://([^/:?#]+)', 1) AS host FROM pages) SELECT page_id, host, @extract(host, '([^.]+)[.][^.]+$', 1) AS label FROM h",
    "t11_dates_in": "SELECT doc_id, @array_text(@sorted(@distinct(@found(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}'))), ',') AS dates FROM documents",
    "t13_period_keys": "SELECT doc_id, @month(validity_from) AS month, @week(validity_from) AS week, CAST(floor(CAST(@days(DATE '1970-01-01', validity_from) AS DOUBLE) / 90) AS BIGINT) AS bucket FROM document WHERE validity_from IS NOT NULL",
    "t16_highlight_tail": "SELECT item_ref, @extract(mfr_ref, '^(.*?)([0-9A-Za-z][^0-9A-Za-z]*[0-9A-Za-z])$', 1) AS head, @extract(mfr_ref, '^(.*?)([0-9A-Za-z][^0-9A-Za-z]*[0-9A-Za-z])$', 2) AS tail FROM item WHERE mfr_ref IS NOT NULL",
    "t17_device_class": "WITH s AS (SELECT item_ref, CASE WHEN md_flag THEN 'RAZRED ' || coalesce(product_class, '') WHEN NOT md_flag THEN 'NI MP' ELSE '' END AS raw FROM item) SELECT item_ref, CASE WHEN @starts(raw, 'RAZRED') THEN true WHEN raw = 'NI MP' THEN false END AS md, nullif(@extract(raw, '^RAZRED (III|II[ab]|I[a-z]?)$', 1), '') AS class FROM s",
    "t18_prose_ref": "SELECT item_ref, contains(coalesce(mfr_ref, '') || CASE WHEN item_no % 50 = 0 THEN '!' ELSE '' END, '!') AS prose FROM item",
    "t19_small_helpers": "SELECT doc_id, replace(replace(certificate_number, '%', '!%'), '_', '!_') AS escaped, nullif(trim(certificate_number), '') AS clean, @date(substr('1998-08-0' || CAST(doc_id % 10 AS STRING), 1, 10)) AS day FROM document",
    "t23_addresses": "SELECT doc_id, address, CASE WHEN @matches(address, '^(info|sales|office|contact)@') THEN 'role' WHEN @matches(address, '[0-9]') THEN 'machine' ELSE 'person' END AS verdict FROM (SELECT doc_id, @explode(@found(lower(text), '[a-z0-9._]+@[a-z0-9.]+[.][a-z]+')) AS address FROM documents) x",
    "t28_content_hash": "SELECT doc_id, @sha256(text) AS content_hash FROM documents",
    "t29_text_functions": "SELECT item_ref, split_part(item_name, ' ', 1) AS first_word, left(item_name, 4) AS head, lpad(item_ref, 8, '0') AS padded, CAST(instr(item_name, ' ') AS BIGINT) AS gap, CAST(length(item_name) AS BIGINT) AS size FROM item",
    "t30_json_path": "SELECT event_id, CAST(@json(props, k) AS BIGINT) AS k, @json(props, absent) IS NULL AS no_key FROM events",
    "t31_array_functions": "SELECT item_ref, @has(@split(item_name, ' '), 'red') AS has_red, @size(@split(item_name, ' ')) AS words, @at(@split(item_name, ' '), 1) AS first_word FROM item",
    "t32_least_greatest": "SELECT doc_id, least(validity_from, validity_to) AS low, greatest(validity_from, validity_to) AS high FROM document",
    "t33_date_arithmetic": "SELECT doc_id, @plus_days(validity_from, 30) AS later, CAST(@days(validity_from, validity_to) AS BIGINT) AS span FROM document",
    "t34_token_cost": "WITH price AS (SELECT 'T0' AS tier, CAST(0.0000100 AS DECIMAL(12, 7)) AS rate UNION ALL SELECT 'T1', CAST(0.0000300 AS DECIMAL(12, 7))) SELECT e.tier, count(*) AS calls, CAST(sum(CAST(e.line AS DECIMAL(12, 0)) * 100 * p.rate) AS DOUBLE) AS cost FROM evidence e LEFT JOIN price p ON p.tier = e.tier GROUP BY 1",
    "t35_week_label": "SELECT DISTINCT @week(validity_from) AS label FROM document WHERE validity_from IS NOT NULL",
    "t36_filename_rules": "SELECT page_id, CASE WHEN @matches(url, '[.]html$') THEN 'page' WHEN @matches(url, '[?]') THEN 'query' ELSE 'folder' END AS kind, @extract(url, '/(en|de|fr|es)/', 1) AS companion FROM pages",
}

SQL |= {
    "t14_renewal_period": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN @week(validity_from) ELSE CAST(extract(YEAR FROM validity_from) AS STRING) || '-P' || lpad(CAST(CAST(floor((extract(DOY FROM validity_from) - 1) / 10) AS BIGINT) AS STRING), 3, '0') END AS period FROM document WHERE validity_from IS NOT NULL",
    "t21_page_numbers": "SELECT page_id, url || '&p=' || CAST(n AS STRING) AS page_url FROM (SELECT page_id, url, @explode(@range(1, CAST(1 + page_id % 4 AS INT))) AS n FROM pages WHERE contains(url, '?')) x",
}
