"""Registry views: expiry, currency, certificates, register gaps, and the relational building blocks."""

from __future__ import annotations

from ledgerlight.plans.projection import AS_OF

SQL: dict[str, str] = {
    # --- views -----------------------------------------------------------------------------------------------------
    "v01_group_refs": """
SELECT m.group_id, count(i.mfr_ref) AS n_refs, nullif(@all(i.mfr_ref, ','), '') AS refs FROM member m JOIN item i ON i.item_ref = m.item_ref GROUP BY m.group_id""",
    "v02_extraction_spend": """
SELECT tier, CASE WHEN doc_id % 4 = 0 THEN 'model-a' WHEN doc_id % 4 = 1 THEN 'model-b' ELSE 'model-c' END AS model, doc_id % 2 = 0 AS batch, count(*) AS calls,
       CAST(sum(line * 100) AS BIGINT) AS tokens_in, count(*) FILTER (WHERE doc_id % 4 > 1) AS unpriced FROM evidence GROUP BY 1, 2, 3""",
    "v03_effective_expiry": "SELECT doc_id, own_to, cert_to, stale_to, expires, basis, inherited FROM expiry",
    "v04_item_class_check": """
SELECT item_ref, stated, product_class, CASE WHEN product_class IS NULL THEN 'fillable' WHEN stated = product_class THEN 'agree' WHEN @extract(stated, '^(I+)', 1) = @extract(product_class, '^(I+)', 1) THEN 'agree-family' ELSE 'conflict' END AS verdict
FROM (SELECT i.item_ref, i.product_class, CASE e.line % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'IIa' WHEN 2 THEN 'IIb' ELSE 'III' END AS stated, row_number() OVER (PARTITION BY i.item_ref ORDER BY e.doc_id DESC, e.line DESC) AS rn
      FROM item i JOIN evidence e ON e.printed_ref = i.item_ref) x WHERE rn = 1""",
    "v05_item_document_history": "SELECT item_ref, doc_id, type, regulation, validity_from, expires, basis, match_basis, current AS is_current FROM history",
    "v06_item_document_production": "SELECT item_ref, doc_id, match_basis, type, regulation, expires FROM current_link",
    "v07_document_current": "SELECT doc_id FROM document_current",
    "v08_held_certificate": "SELECT doc_id, type, status, manufacturer, base_number, revision FROM held_certificate",
    "v09_trusted_actor": "SELECT canonical_name, srn FROM trusted_actor",
    "v10_certificate_drift": """
SELECT DISTINCT h.doc_id, h.base_number, h.revision AS held_revision, r.revision_number AS register_revision
FROM held_certificate h JOIN trusted_actor a ON a.canonical_name = h.manufacturer JOIN register_certificate r ON r.actor_srn = a.srn AND r.certificate_number = h.base_number
WHERE CAST(nullif(@replace_all(h.revision, '[^0-9]', ''), '') AS INT) IS DISTINCT FROM CAST(nullif(@replace_all(r.revision_number, '[^0-9]', ''), '') AS INT)""",
    "v11_certificate_near_miss": """
SELECT DISTINCT h.doc_id, h.base_number, r.certificate_number, CASE WHEN h.base_number || 'A' = r.certificate_number THEN 'trailing-letter' ELSE 'prefix' END AS rule
FROM held_certificate h JOIN trusted_actor a ON a.canonical_name = h.manufacturer JOIN register_certificate r ON r.actor_srn = a.srn
WHERE h.base_number <> r.certificate_number AND (h.base_number || 'A' = r.certificate_number OR @replace_all(h.base_number, '^SX', 'HZ') = r.certificate_number OR @replace_all(r.certificate_number, '^SX', 'HZ') = h.base_number)""",
    "v12_certificate_status_alert": """
SELECT DISTINCT h.doc_id, r.certificate_number, r.certificate_status FROM held_certificate h JOIN register_certificate r ON r.certificate_number = h.base_number
WHERE r.certificate_status IN ('suspended', 'withdrawn', 'restricted', 'expired')""",
    "v13_certificate_gap": """
SELECT a.canonical_name, r.certificate_number FROM trusted_actor a JOIN register_certificate r ON r.actor_srn = a.srn
WHERE NOT EXISTS (SELECT 1 FROM held_certificate h WHERE h.manufacturer = a.canonical_name AND h.base_number = r.certificate_number)""",
    "v14_sweep_due": f"""
WITH state AS (SELECT canonical_name, srn, @plus_days(DATE '1998-07-20', CAST(substr(canonical_name, 7) AS INT)) AS due FROM actor WHERE status <> 'rejected'),
n AS (SELECT actor_srn, count(*) AS devices FROM register_device GROUP BY actor_srn)
SELECT s.canonical_name, s.due, coalesce(n.devices, 0) AS devices FROM state s LEFT JOIN n ON n.actor_srn = s.srn WHERE s.due <= {AS_OF}""",
    "v18_sweep_delta": """
SELECT d.actor_srn, count(*) FILTER (WHERE d.first_seen > DATE '1998-07-01') AS fresh, count(*) FILTER (WHERE d.last_seen > DATE '1998-07-01' AND d.first_seen <= DATE '1998-07-01') AS changed
FROM register_device d GROUP BY 1 HAVING count(*) FILTER (WHERE d.first_seen > DATE '1998-07-01') > 0 OR count(*) FILTER (WHERE d.last_seen > DATE '1998-07-01') > 0""",
    # --- filters and predicates ------------------------------------------------------------------------------------
    "p01_tri_state": "SELECT catalogue, count(*) FILTER (WHERE md_flag IS TRUE) AS yes, count(*) FILTER (WHERE md_flag IS NOT FALSE) AS not_no, count(*) FILTER (WHERE md_flag IS NULL) AS unknown FROM item GROUP BY 1",
    "p02_literal_search": "SELECT item_ref, item_name FROM item i WHERE contains(lower(item_name), 'red') OR contains(lower(coalesce(mfr_ref, '')), '#1-1') OR EXISTS (SELECT 1 FROM evidence e WHERE e.printed_ref = i.item_ref AND e.value = '4' AND e.line = 7)",
    "p03_optional_filter": "SELECT doc_id, type, status FROM document WHERE ('' = '' OR type = '') AND ('MDR' = '' OR regulation = 'MDR')",
    "p04_dynamic_clauses": "SELECT id, type, status FROM job WHERE type = 'validate' AND status IN ('failed', 'dead') AND (id = 22 OR dedupe_key = '22' OR contains(dedupe_key, '22'))",
    "p05_reason_chips": """
WITH f AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN @without(@array('x'), 'x') ELSE @array(CASE WHEN doc_id % 2 = 0 THEN 'no-ref-overlap' ELSE 'expired' END, CASE WHEN doc_id % 3 = 0 THEN 'date-insane' ELSE 'other-' || CAST(doc_id % 4 AS STRING) END) END AS flags FROM document)
SELECT doc_id, @size(flags) AS n, @overlap(flags, @array('expired', 'date-insane')) AS chip, @size(flags) = 0 AS plain FROM f""",
    "p06_null_safe_inequality": "SELECT a.doc_id FROM document a JOIN document b ON b.doc_id = a.doc_id + 1 WHERE a.validity_to IS DISTINCT FROM b.validity_to AND a.type = 'DoC'",
    "p07_regex_filter": "SELECT srn FROM actor WHERE @matches(srn, '^[A-Z]{2}-MF-[0-9]{8}[1-5]$')",
    "p08_recency": f"SELECT doc_id, validity_from >= @plus_days({AS_OF}, -365) AS fresh FROM document WHERE validity_from IS NOT NULL",
    "p09_same_day": "SELECT id FROM job WHERE created_at >= date_trunc('day', TIMESTAMP '2024-01-15 13:00:00') AND created_at < TIMESTAMP '2024-01-16 00:00:00'",
    "p10_json_key": "SELECT event_id FROM events WHERE @json(props, k) IS NOT NULL AND CAST(@json(props, k) AS BIGINT) >= 90",
    "p11_eligible_refs": "SELECT item_ref, trim(mfr_ref) AS ref FROM item WHERE length(trim(mfr_ref)) >= 10 AND NOT contains(mfr_ref, '!')",
    "p12_exclude_patterns": "SELECT CASE WHEN @matches(url, '/es/') THEN 'es' WHEN @matches(url, 'utm_') THEN 'utm' WHEN @matches(url, '[.]html$') THEN 'html' END AS pattern, count(*) AS n FROM pages GROUP BY 1",
    "p13_machine_actor": "SELECT role, count(*) AS n FROM conversations WHERE role LIKE 'sys%' OR role LIKE 'assist%' GROUP BY role",
    "p14_personal_address": """
WITH m AS (SELECT doc_id, @explode(@found(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+[.][a-z]+')) AS address FROM documents)
SELECT doc_id, address, NOT @overlap(@split(lower(address), '@'), @array('info', 'sales', 'office')) AS personal FROM m""",
    # --- joins -----------------------------------------------------------------------------------------------------
    "j01_inner": "SELECT l.item_ref, i.item_name, d.type, e.expires FROM link l JOIN item i ON i.item_ref = l.item_ref JOIN document d ON d.doc_id = l.doc_id JOIN expiry e ON e.doc_id = d.doc_id",
    "j02_left_outer": "SELECT i.item_ref, c.doc_id FROM item i LEFT JOIN current_link c ON c.item_ref = i.item_ref",
    "j03_count_after_left": "SELECT a.canonical_name, count(DISTINCT i.item_ref) AS items, count(DISTINCT c.doc_id) AS docs FROM alias a LEFT JOIN item i ON i.manufacturer_raw = a.raw_name LEFT JOIN current_link c ON c.item_ref = i.item_ref GROUP BY 1",
    "j04_exists_in_filter": "SELECT i.catalogue, count(*) AS items, count(*) FILTER (WHERE h.item_ref IS NOT NULL) AS held FROM item i LEFT JOIN (SELECT DISTINCT item_ref FROM current_link) h ON h.item_ref = i.item_ref GROUP BY 1",
    "j05_anti": "SELECT i.item_ref FROM item i WHERE NOT EXISTS (SELECT 1 FROM link l WHERE l.item_ref = i.item_ref)",
    "j06_semi": "SELECT doc_id, type FROM document WHERE doc_id IN (SELECT doc_id FROM link WHERE status = 'production')",
    "j07_self_inequality": "SELECT d.id, min(n.id) AS newer FROM job d JOIN job n ON n.dedupe_key = d.dedupe_key AND n.id > d.id WHERE d.status = 'dead' GROUP BY d.id",
    "j08_theta_as_union": """
SELECT i.item_ref, d.udi_di FROM item i JOIN register_device d ON d.reference = i.mfr_ref UNION SELECT i.item_ref, d.udi_di FROM item i JOIN register_device d ON @replace_all(d.reference, '[.]K[0-9]+$', '') = i.mfr_ref""",
    "j09_latest_child": "SELECT id, group_id, outcome FROM (SELECT log_id AS id, group_id, outcome, row_number() OVER (PARTITION BY group_id ORDER BY seen_at DESC, log_id DESC) AS rn FROM discovery) x WHERE rn = 1",
    "j10_any_of": "SELECT i.item_ref, i.product_class FROM item i WHERE i.item_ref IN (SELECT @explode(@array('P1', 'P22', 'P333', 'P4444')))",
    "j11_trigram_candidates": """
WITH w AS (SELECT DISTINCT item_name AS name FROM item), p AS (SELECT name, '  ' || lower(name) || ' ' AS s FROM w), n AS (SELECT name, s, @explode(@range(1, CAST(length(s) AS INT) - 2)) AS k FROM p),
g AS (SELECT DISTINCT name, substr(s, CAST(k AS INT), 3) AS gram FROM n), f AS (SELECT gram, count(*) AS names FROM g GROUP BY 1),
-- names that share 12 grams share one of the rarest that are left when each leaves out 11
r AS (SELECT g.name, g.gram, row_number() OVER (PARTITION BY g.name ORDER BY f.names, g.gram) AS rn, count(*) OVER (PARTITION BY g.name) AS size FROM g JOIN f ON f.gram = g.gram), kept AS (SELECT name, gram FROM r WHERE rn <= size - 11),
c AS (SELECT DISTINCT a.name AS left_name, b.name AS right_name FROM kept a JOIN kept b ON a.gram = b.gram AND a.name < b.name)
SELECT c.left_name, c.right_name, count(*) AS shared FROM c JOIN g x ON x.name = c.left_name JOIN g y ON y.name = c.right_name AND y.gram = x.gram GROUP BY 1, 2 HAVING count(*) >= 12""",
    "j12_suffix_join": """
WITH p AS (SELECT DISTINCT doc_id, substr(printed_ref, 2) AS tail FROM evidence WHERE length(printed_ref) >= 5), r AS (SELECT mfr_ref, item_ref, @split(mfr_ref, '-') AS parts FROM item WHERE mfr_ref IS NOT NULL)
SELECT p.doc_id, r.item_ref FROM p JOIN (SELECT item_ref, @at(parts, 2) AS t FROM r) r ON r.t = substr(p.tail, 2)""",
    "j13_scalar_beside": "SELECT i.item_ref, t.n FROM item i, (SELECT count(*) AS n FROM document_current) t",
    "j14_scalar_decorrelated": "SELECT i.item_ref, coalesce(x.n, 0) AS docs FROM item i LEFT JOIN (SELECT item_ref, count(*) AS n FROM current_link GROUP BY 1) x ON x.item_ref = i.item_ref",
    "j15_alias_fallback": "SELECT i.item_ref, coalesce(a.canonical_name, i.manufacturer_raw) AS manufacturer FROM item i LEFT JOIN alias a ON a.raw_name = i.manufacturer_raw",
    "j16_fold_key": "SELECT a.raw_name, i.item_ref FROM alias a JOIN item i ON upper(@replace_all(a.raw_name, '[^0-9A-Za-z]', '')) = upper(@replace_all(i.manufacturer_raw, '[^0-9A-Za-z]', ''))",
    "j17_null_safe_key": "SELECT a.item_ref, CAST(sum(b.n) AS BIGINT) AS peers FROM item a JOIN (SELECT mfr_ref, catalogue, count(*) AS n FROM item GROUP BY 1, 2) b ON a.mfr_ref IS NOT DISTINCT FROM b.mfr_ref AND a.catalogue = b.catalogue GROUP BY 1",
    "j18_soft_reference": "SELECT t.id, coalesce('doc:' || d.type, 'item:' || i.item_ref) AS subject FROM task t LEFT JOIN document d ON d.doc_id = t.doc_id AND t.kind = 'review' LEFT JOIN item i ON i.item_no = t.doc_id AND t.kind = 'missing'",
    "j19_phrase_containment": """
SELECT DISTINCT w.word, i.item_name FROM (SELECT DISTINCT item_name, @explode(@split(item_name, ' ')) AS word FROM item) i JOIN (SELECT DISTINCT @at(@split(p_name, ' '), 2) AS word FROM part) w ON w.word = i.word""",
    "j20_domain_join": """
WITH h AS (SELECT page_id, @extract(lower(url), '://([^/:?#]+)', 1) AS host FROM pages), n AS (SELECT host, count(*) AS n FROM h GROUP BY 1)
SELECT h.page_id, CAST(sum(n.n) AS BIGINT) AS same_host FROM h JOIN n ON n.host = h.host GROUP BY 1""",
    # --- aggregates ------------------------------------------------------------------------------------------------
    "a01_group": "SELECT type, status, count(*) AS n, min(validity_from) AS first_from, max(validity_to) AS last_to FROM document GROUP BY 1, 2",
    "a02_count_filter": "SELECT count(*) FILTER (WHERE md_flag) AS md, count(*) FILTER (WHERE mfr_ref IS NULL) AS no_ref, count(*) AS n FROM item",
    "a03_distinct_filter": "SELECT regulation, count(DISTINCT manufacturer) AS makers, count(DISTINCT manufacturer) FILTER (WHERE status = 'production') AS live FROM document GROUP BY 1",
    "a04_bool_or": "SELECT item_ref, bool_or(regulation = 'MDR') AS mdr, bool_or(type = 'DoC') AS declared FROM current_link GROUP BY 1",
    "a05_distinct_array": "SELECT item_ref, @set(type, ',') AS types FROM current_link GROUP BY 1",
    "a06_ordered_slice": "SELECT type, id FROM (SELECT type, id, row_number() OVER (PARTITION BY type ORDER BY id DESC) AS rn FROM job) x WHERE rn <= 3",
    "a07_string_agg": "SELECT manufacturer_raw, @set(product_class, '|') AS classes FROM item GROUP BY 1",
    "a08_having": "SELECT mfr_ref, count(*) AS n FROM item WHERE mfr_ref IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "a09_group_by_expression": "SELECT substr(coalesce(error, ''), 1, 8) AS signature, count(*) AS n FROM job GROUP BY 1",
    "a10_two_levels": "SELECT n_docs, count(*) AS items FROM (SELECT item_ref, count(*) AS n_docs FROM current_link GROUP BY 1) x GROUP BY 1",
    "a11_ratio": "SELECT catalogue, round(100.0 * CAST(count(*) FILTER (WHERE mfr_ref IS NULL) AS DOUBLE) / nullif(count(*), 0), 1) AS pct FROM item GROUP BY 1",
    "a12_json_aggregate": "SELECT item_ref, '{' || @all('\"' || CAST(doc_id AS STRING) || '\":\"' || status || '\"', ',') || '}' AS documents FROM link GROUP BY 1",
    "a13_mode": "SELECT manufacturer_raw, product_class FROM (SELECT manufacturer_raw, product_class, row_number() OVER (PARTITION BY manufacturer_raw ORDER BY count(*) DESC, product_class NULLS LAST) AS rn FROM item GROUP BY 1, 2) x WHERE rn = 1",
    "a14_argmax": "SELECT type, @last_by(doc_id, o_totalprice) AS dearest, @first_by(doc_id, o_totalprice) AS cheapest FROM document GROUP BY 1",
    # of a count, a sum and an exclusive or of row hashes, so that no group is ever one text
    "a16_fingerprint": "SELECT type, count(*) AS n, CAST(sum(h % 1000003) AS BIGINT) AS total, bit_xor(h) AS mark FROM (SELECT type, @hash48(CAST(doc_id AS STRING)) AS h FROM document) x GROUP BY 1",
    "a17_set_difference": """
WITH o AS (SELECT item_ref, item_name FROM item WHERE item_no % 10 <> 3), n AS (SELECT item_ref, CASE WHEN item_no % 10 = 4 THEN item_name || ' II' ELSE item_name END AS item_name FROM item WHERE item_no % 10 <> 5)
SELECT CASE WHEN o.item_ref IS NULL THEN 'added' WHEN n.item_ref IS NULL THEN 'gone' WHEN o.item_name <> n.item_name THEN 'renamed' ELSE 'same' END AS change, count(*) AS n_items FROM o FULL JOIN n ON o.item_ref = n.item_ref GROUP BY 1""",
    # --- windows, order, sets --------------------------------------------------------------------------------------
    "w01_rank_current": "SELECT item_ref, type, count(*) AS ties FROM current_link GROUP BY 1, 2 HAVING count(*) > 1",
    "w02_named_window": "SELECT id, count(*) OVER w AS n, min(id) OVER w AS first_id, CAST(row_number() OVER (PARTITION BY dedupe_key ORDER BY id) AS BIGINT) AS pos FROM job WINDOW w AS (PARTITION BY dedupe_key)",
    "w03_total_beside_page": """
SELECT doc_id, (SELECT count(*) FROM document WHERE type = 'ISO') AS total FROM (SELECT doc_id FROM document WHERE type = 'ISO' ORDER BY doc_id LIMIT 20 OFFSET 20) x""",
    "w04_positions": "SELECT n_name, CAST(row_number() OVER (ORDER BY n_name) AS BIGINT) AS pos FROM nation",
    "w05_top_n": "SELECT type, doc_id, CAST(rn AS BIGINT) AS rn FROM (SELECT type, doc_id, row_number() OVER (PARTITION BY type ORDER BY o_totalprice DESC, doc_id) AS rn FROM document) x WHERE rn <= 5",
    "w06_top_one": "SELECT group_id, outcome, seen_at FROM (SELECT group_id, outcome, seen_at, row_number() OVER (PARTITION BY group_id, outcome ORDER BY seen_at DESC, log_id DESC) AS rn FROM discovery) x WHERE rn = 1",
    "w07_durations": "SELECT type, count(*) AS n, max(@seconds(created_at, finished_at)) AS longest FROM job WHERE finished_at IS NOT NULL GROUP BY 1",
    "l01_null_order": "SELECT doc_id, validity_to FROM document ORDER BY validity_to ASC NULLS FIRST, doc_id LIMIT 50",
    "l02_page": "SELECT doc_id, type FROM document ORDER BY doc_id LIMIT 25 OFFSET 50",
    "l03_custom_order": "SELECT doc_id, status FROM document ORDER BY CASE status WHEN 'staged' THEN 0 WHEN 'production' THEN 1 ELSE 2 END, doc_id LIMIT 40",
    "l04_boolean_order": "SELECT item_ref, mfr_ref FROM item ORDER BY (mfr_ref IS NULL) DESC, item_no LIMIT 40",
    "l05_threshold_top_k": "SELECT type, doc_id FROM (SELECT type, doc_id, row_number() OVER (PARTITION BY type ORDER BY o_totalprice DESC, doc_id) AS rn FROM document WHERE o_totalprice >= 300000) x WHERE rn <= 3",
    "l06_neighbours": "(SELECT item_no, item_ref FROM item WHERE item_no < 100 ORDER BY item_no DESC LIMIT 10) UNION ALL (SELECT item_no, item_ref FROM item WHERE item_no > 102 ORDER BY item_no LIMIT 10)",
    "l07_capped_with_total": """
SELECT group_id, (SELECT count(DISTINCT group_id) FROM member) AS total FROM (SELECT DISTINCT group_id FROM member ORDER BY group_id LIMIT 20) x""",
    "l08_never_seen_first": "SELECT m.group_id, max(d.seen_at) AS last_at FROM member m LEFT JOIN discovery d ON d.group_id = m.group_id GROUP BY 1 ORDER BY last_at ASC NULLS FIRST, m.group_id LIMIT 30",
    "u01_union": "SELECT item_ref AS subject FROM current_link UNION SELECT item_ref FROM item WHERE md_flag",
    "u02_union_all": "SELECT 'doc' AS kind, CAST(doc_id AS STRING) AS ref FROM document WHERE status = 'staged' UNION ALL SELECT 'item', item_ref FROM item WHERE md_flag IS NULL",
    "u03_pipeline": "WITH live AS (SELECT DISTINCT item_ref FROM current_link), md AS (SELECT item_ref, manufacturer_raw FROM item WHERE md_flag), both_ AS (SELECT md.manufacturer_raw, live.item_ref FROM md LEFT JOIN live ON live.item_ref = md.item_ref) SELECT manufacturer_raw, count(*) AS items, count(item_ref) AS covered FROM both_ GROUP BY 1",
    "u06_extra_intersect": "SELECT item_ref FROM current_link INTERSECT SELECT item_ref FROM item WHERE md_flag",
    "u06_extra_except": "SELECT item_ref FROM item EXCEPT SELECT item_ref FROM link",
}
