"""Queries over a device register and over the completeness of items. The register's checks don't fold references: they know the numbers that these are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.operators.articles import article_status, declaration_gap, gap_summary
from ledgerlight.operators.completeness import BY_CLASS, EVIDENCE, OPEN_CLASS, SCORED, item_completeness, maker_completeness
from ledgerlight.plans.dialect import duck_sql, run
from ledgerlight.plans.projection import AS_OF

_CODE = "'RC' || CAST(p_partkey % 30 AS STRING) || '.314.' || lpad(CAST(p_partkey % 40 AS STRING), 3, '0')"
_MAKER = "CAST(CAST(substr(p_brand, 7) AS INT) % 10 AS STRING)"
ITEMS = """SELECT 'P' || CAST(p_partkey AS STRING) AS item_ref, p_partkey % 3 <> 0 AS md_flag, CASE p_partkey % 4 WHEN 0 THEN '314  RC' || CAST(p_partkey % 30 AS STRING) || ' ' || CAST(p_partkey % 40 AS STRING)
  WHEN 1 THEN ' rc' || CAST(p_partkey % 30 AS STRING) || '.314.' || CAST(p_partkey % 40 AS STRING) WHEN 2 THEN 'Q' || CAST(p_partkey AS STRING) END AS mfr_ref FROM part"""
MEMBERS = "SELECT CAST(substr(p_brand, 7) AS BIGINT) AS group_id, 'P' || CAST(p_partkey AS STRING) AS item_ref FROM part WHERE p_partkey % 13 <> 5"
GROUPS = f"SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) AS group_id, 'Maker ' || {_MAKER} AS canonical_name FROM part"
ACTORS = f"SELECT DISTINCT 'Maker ' || {_MAKER} AS canonical_name, 'XX-MF-' || p_brand AS srn FROM part WHERE {_MAKER} <> '9'"
RULES = f"SELECT DISTINCT 'Maker ' || {_MAKER} AS canonical_name, CASE WHEN {_MAKER} IN ('0', '2', '4', '6', '8') THEN 'reorder-shank-figure-size' ELSE 'none' END AS strategy FROM part WHERE {_MAKER} <> '5'"
DEVICES = f"""SELECT CASE WHEN p_partkey % 11 <> 0 THEN 'B' || CAST(p_partkey % 9 AS STRING) END AS basic_udi_di, p_name AS trade_name, 'XX-MF-' || p_brand AS srn,
  CASE p_partkey % 5 WHEN 0 THEN {_CODE} || '.K2' WHEN 1 THEN {_CODE} WHEN 2 THEN 'Q' || CAST(p_partkey AS STRING) WHEN 3 THEN 'P' || CAST(p_partkey AS STRING) END AS reference FROM part"""
LINKS = "SELECT item_ref, doc_id, CASE WHEN doc_id % 7 = 0 THEN 'retracted' ELSE status END AS status FROM link"
DOCUMENTS = "SELECT doc_id, type, status, coverage_scope FROM document"


def v15_article_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medical articles of registered manufacturers: registered, declared, staged."""
    return article_status(*[run(spark, sf_dir, text) for text in (ITEMS, MEMBERS, GROUPS, ACTORS, RULES, DEVICES, LINKS, DOCUMENTS)])


SCOPED = f"""SELECT DISTINCT g.canonical_name FROM ({DOCUMENTS}) d JOIN ({LINKS}) l ON l.doc_id = d.doc_id AND l.status <> 'retracted' JOIN ({MEMBERS}) m ON m.item_ref = l.item_ref JOIN ({GROUPS}) g ON g.group_id = m.group_id
WHERE d.coverage_scope = 'manufacturer' AND d.status = 'production'"""


def v16_declaration_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarations that are missing, by basic identifier."""
    return declaration_gap(v15_article_status(spark, sf_dir), run(spark, sf_dir, SCOPED))


def v17_gap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap_summary(v15_article_status(spark, sf_dir))


_SPELT = "lpad(CAST(p_partkey % 40 AS VARCHAR), 3, '0')"
#: r: the manufacturer has the rule; codes are pairs of numbers where it has, texts where it hasn't.
V15_SQL = f"""
WITH p AS (SELECT *, CAST(substr(p_brand, 7) AS INTEGER) % 10 AS m FROM part),
o AS (SELECT 'P' || p_partkey AS item_ref, m, CASE WHEN p_partkey % 4 < 2 AND m % 2 = 0 THEN printf('%d/%d', p_partkey % 30, p_partkey % 40) WHEN p_partkey % 4 = 0 THEN printf('314  RC%d %d', p_partkey % 30, p_partkey % 40)
  WHEN p_partkey % 4 = 1 THEN printf(' rc%d.314.%d', p_partkey % 30, p_partkey % 40) WHEN p_partkey % 4 = 2 THEN 'Q' || p_partkey ELSE 'P' || p_partkey END AS k FROM p WHERE p_partkey % 3 <> 0 AND p_partkey % 13 <> 5 AND m <> 9),
d AS (SELECT m, CASE WHEN p_partkey % 11 <> 0 THEN 'B' || p_partkey % 9 END AS basic_udi_di, p_name, CASE WHEN p_partkey % 5 < 2 AND m % 2 = 0 THEN printf('%d/%d', p_partkey % 30, p_partkey % 40) WHEN p_partkey % 5 < 2 THEN printf('RC%d.314.%s', p_partkey % 30, {_SPELT}) || CASE p_partkey % 5 WHEN 0 THEN '.K2' ELSE '' END
  WHEN p_partkey % 5 = 2 THEN 'Q' || p_partkey WHEN p_partkey % 5 = 3 THEN 'P' || p_partkey END AS k FROM p),
f AS (SELECT item_ref, basic_udi_di, max(p_name) AS trade_name FROM o JOIN d USING (m, k) GROUP BY 1, 2),
h AS (SELECT o.item_ref, coalesce(bool_or(l.status = 'production' AND x.status IN ('production', 'superseded')), false) AS has_production, coalesce(bool_or(l.status = 'staged' AND x.doc_id IS NOT NULL), false) AS has_staged
  FROM o LEFT JOIN link l ON l.item_ref = o.item_ref AND l.doc_id % 7 <> 0 LEFT JOIN document x ON x.doc_id = l.doc_id AND x.type = 'DoC' GROUP BY 1)
SELECT o.item_ref, 'Maker ' || m AS canonical_name, f.basic_udi_di, f.trade_name, f.item_ref IS NOT NULL AS registered, has_production, has_staged FROM o LEFT JOIN f USING (item_ref) JOIN h USING (item_ref)"""
V16_SQL = f"""
SELECT a.canonical_name, basic_udi_di, count(*) FILTER (WHERE NOT has_production) AS articles, count(*) FILTER (WHERE NOT has_production AND has_staged) AS staged, a.canonical_name IN ({SCOPED}) AS mfr_scope_covered, max(trade_name) AS trade_name
FROM ({V15_SQL}) a WHERE registered GROUP BY 1, 2 HAVING count(*) FILTER (WHERE NOT has_production) > 0"""
V17_SQL = f"""
SELECT canonical_name, count(DISTINCT item_ref) FILTER (WHERE registered AND has_production) AS covered, count(DISTINCT item_ref) FILTER (WHERE registered AND NOT has_production AND has_staged) AS staged,
  count(DISTINCT item_ref) FILTER (WHERE registered AND NOT has_production AND NOT has_staged) AS missing, count(DISTINCT item_ref) FILTER (WHERE NOT registered) AS not_registered FROM ({V15_SQL}) a GROUP BY 1"""

# ---- completeness of items

CARDED = "SELECT item_ref, manufacturer_raw AS manufacturer, product_class, md_flag FROM item"
HOLDINGS = """
SELECT l.item_ref, l.doc_id, d.type, CASE WHEN h.current THEN 'production' WHEN h.current IS NOT NULL THEN 'superseded' ELSE d.status END AS doc_status, l.status AS link_status, l.match_basis, e.expires, e.basis AS expiry_basis,
  CASE WHEN d.cert_doc_id IS NOT NULL THEN 'CE ' || CAST(d.cert_doc_id AS STRING) END AS cert_number
FROM link l JOIN document d ON d.doc_id = l.doc_id JOIN expiry e ON e.doc_id = l.doc_id LEFT JOIN history h ON h.item_ref = l.item_ref AND h.doc_id = l.doc_id"""


def q25_item_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_completeness(run(spark, sf_dir, CARDED), run(spark, sf_dir, HOLDINGS), F.expr(AS_OF))


def q26_maker_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maker_completeness(q25_item_completeness(spark, sf_dir))


#: The matrix and the states as tables, joined; nothing held is the state "nothing".
Q25_SQL = f"""
WITH need(k, row, requirement) AS (VALUES {", ".join(f"('{k}', '{r}', '{x}')" for k, xs in {**BY_CLASS, "?": OPEN_CLASS}.items() for r, x in zip(SCORED, xs, strict=True))}, {", ".join(f"('{k}', '{r}', 'evidence')" for k in (*BY_CLASS, "?") for r in EVIDENCE)}),
hold AS (SELECT *, CASE WHEN doc_status = 'superseded' THEN 0 WHEN doc_status = 'production' AND link_status = 'production' THEN 3 - CAST(match_basis = 'mfr-scope' AS INT) ELSE 1 END AS worth FROM ({HOLDINGS}) h),
best AS (SELECT * FROM hold QUALIFY row_number() OVER (PARTITION BY item_ref, type ORDER BY worth DESC, doc_id) = 1),
answers AS (SELECT *, type AS row FROM best UNION ALL SELECT b.*, 'nb_number' FROM best b WHERE type = 'DoC' AND cert_number IS NOT NULL
  UNION ALL SELECT b.*, 'nb_number' FROM best b WHERE type = 'EC' AND NOT EXISTS (SELECT 1 FROM best d WHERE d.item_ref = b.item_ref AND d.type = 'DoC' AND d.cert_number IS NOT NULL)),
cell AS (SELECT i.item_ref, i.manufacturer, n.row, n.requirement, a.doc_id, CASE WHEN a.doc_id IS NULL THEN 'nothing' WHEN worth = 0 THEN 'superseded' WHEN worth = 1 THEN 'review' WHEN expires < {AS_OF} AND expiry_basis = 'staleness' THEN 'review-due' WHEN expires < {AS_OF} THEN 'expired'
    WHEN expires <= {AS_OF} + INTERVAL 30 DAY THEN 'expiring' WHEN worth = 2 THEN 'mfr-scope-only' ELSE 'held' END AS s
  FROM ({CARDED}) i JOIN need n ON n.k = coalesce(i.product_class, '?') LEFT JOIN answers a ON a.item_ref = i.item_ref AND a.row = n.row WHERE i.md_flag),
kind(s, requirement, state, severity, bucket) AS (VALUES ('nothing', 'required', 'missing', 'bad', 'none'), ('nothing', 'conditional', 'missing-exception-possible', 'warn', 'none'), ('nothing', 'unknown', 'class-unknown', 'warn', 'attention'),
  ('nothing', 'not-applicable', 'not-required', 'none', 'not_required'), ('nothing', 'evidence', 'missing', 'none', 'none'), ('superseded', 'evidence', 'superseded', 'warn', 'lapsed'), ('expired', 'evidence', 'expired', 'warn', 'lapsed'), ('mfr-scope-only', 'evidence', 'mfr-scope-only', 'warn', 'held'),
  ('superseded', NULL, 'superseded', 'bad', 'lapsed'), ('expired', NULL, 'expired', 'bad', 'lapsed'), ('mfr-scope-only', NULL, 'mfr-scope-only', 'warn', 'attention'), ('review', NULL, 'review', 'warn', 'attention'), ('review-due', NULL, 'review-due', 'warn', 'attention'),
  ('expiring', NULL, 'expiring', 'warn', 'attention'), ('held', NULL, 'held', 'ok', 'held'))
SELECT c.item_ref, c.manufacturer, c.row, c.requirement, c.requirement <> 'evidence' AS scored, c.doc_id, k.state, k.severity, k.bucket FROM cell c JOIN kind k ON k.s = c.s AND coalesce(k.requirement, c.requirement) = c.requirement
WHERE k.requirement IS NOT NULL OR NOT EXISTS (SELECT 1 FROM kind x WHERE x.s = c.s AND x.requirement = c.requirement)"""
Q26_SQL = f"""
SELECT manufacturer, row, count(*) FILTER (WHERE bucket = 'held') AS held, count(*) FILTER (WHERE bucket = 'attention') AS attention, count(*) FILTER (WHERE bucket = 'lapsed') AS lapsed, count(*) FILTER (WHERE bucket = 'none') AS none_n,
  count(*) FILTER (WHERE bucket = 'not_required') AS not_required, ['none', 'ok', 'warn', 'bad'][max(list_position(['none', 'ok', 'warn', 'bad'], severity))] AS severity FROM ({Q25_SQL}) c GROUP BY 1, 2"""

QUERIES = {
    "q25_item_completeness": q25_item_completeness, "q26_maker_completeness": q26_maker_completeness,
    "v15_article_status": v15_article_status, "v16_declaration_gap": v16_declaration_gap, "v17_gap_summary": v17_gap_summary,
}
ORACLES = {
    "q25_item_completeness": duck_sql(Q25_SQL), "q26_maker_completeness": duck_sql(Q26_SQL),
    "v15_article_status": duck_sql(V15_SQL), "v16_declaration_gap": duck_sql(V16_SQL), "v17_gap_summary": duck_sql(V17_SQL),
}
