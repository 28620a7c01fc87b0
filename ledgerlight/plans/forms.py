"""Texts that Spark runs in place of those of views.py and boards.py: the same rows, without all pairs on the way. The checks stay as they are."""

from __future__ import annotations

SQL: dict[str, str] = {
    # the three ways to be near are equalities, so each side gives its keys and meets the other by them
    "v11_certificate_near_miss": """
WITH h AS (SELECT h.doc_id, h.base_number, a.srn, @explode(@array('=' || h.base_number || 'A', '=' || @replace_all(h.base_number, '^SX', 'HZ'), '~' || h.base_number)) AS k FROM held_certificate h JOIN trusted_actor a ON a.canonical_name = h.manufacturer),
r AS (SELECT actor_srn, certificate_number, @explode(@array('=' || certificate_number, '~' || @replace_all(certificate_number, '^SX', 'HZ'))) AS k FROM register_certificate)
SELECT /*+ MERGE(r) */ DISTINCT h.doc_id, h.base_number, r.certificate_number, CASE WHEN h.base_number || 'A' = r.certificate_number THEN 'trailing-letter' ELSE 'prefix' END AS rule
FROM h JOIN r ON r.actor_srn = h.srn AND r.k = h.k WHERE h.base_number <> r.certificate_number""",
    # items are counted once a manufacturer, not once a document
    "g07_manufacturer_binding": """
WITH n AS (SELECT manufacturer_raw, count(item_ref) AS n FROM item WHERE md_flag GROUP BY 1)
SELECT d.doc_id, CASE WHEN a.canonical_name IS NULL THEN 'filed' WHEN coalesce(sum(n.n), 0) = 0 THEN 'staged' ELSE 'bound' END AS outcome, CAST(coalesce(sum(n.n), 0) AS BIGINT) AS items
FROM document d LEFT JOIN alias a ON a.raw_name = d.manufacturer LEFT JOIN n ON n.manufacturer_raw = a.raw_name WHERE d.coverage_scope = 'manufacturer' AND d.type = 'EC' GROUP BY d.doc_id, a.canonical_name""",
    # each pair comes out at its least common reference only, so that pairs needn't be made distinct
    "j08_theta_as_union": """
WITH i AS (SELECT item_ref, collect_set(mfr_ref) AS refs FROM item WHERE mfr_ref IS NOT NULL GROUP BY 1),
d AS (SELECT udi_di, array_distinct(flatten(collect_set(@array(reference, @replace_all(reference, '[.]K[0-9]+$', ''))))) AS refs FROM register_device WHERE reference IS NOT NULL GROUP BY 1),
x AS (SELECT item_ref, refs, @explode(refs) AS ref FROM i), y AS (SELECT udi_di, refs, @explode(refs) AS ref FROM d)
SELECT /*+ MERGE(y) */ x.item_ref, y.udi_di FROM x JOIN y ON y.ref = x.ref WHERE size(x.refs) = 1 OR size(y.refs) = 1 OR x.ref = array_min(array_intersect(x.refs, y.refs))""",
}
