"""Queries over printed references, dates and names; their checks are written apart, for DuckDB only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions import dates, identifiers, references, sql
from ledgerlight.plans.dialect import duck_sql, run
from ledgerlight.session import table

#: References in the spellings that catalogues and registers print.
REFS = """
SELECT p_partkey, CASE p_partkey % 7
  WHEN 0 THEN '31' || CAST(p_partkey % 10 AS STRING) || ' h' || CAST(p_partkey % 50 AS STRING) || '  ' || CAST(p_partkey % 400 AS STRING) WHEN 1 THEN ' rc' || CAST(p_partkey % 50 AS STRING) || '.314.' || CAST(p_partkey % 40 AS STRING)
  WHEN 2 THEN CAST(p_partkey % 9 AS STRING) || '.204.005' WHEN 3 THEN 'RC.070.0' || CAST(p_partkey % 20 AS STRING) || '.K' || CAST(p_partkey % 9 AS STRING)
  WHEN 4 THEN '104 H219A 023-' || CAST(p_partkey % 3 AS STRING) WHEN 5 THEN CAST(645000 + p_partkey AS STRING) || substr('DCABX', 1, CAST(p_partkey % 5 AS INT)) END AS ref FROM part"""

STRATEGY = "CASE p_partkey % 3 WHEN 1 THEN 'strip-trailing-letters' WHEN 2 THEN 'reorder-shank-figure-size' END"


def _folded(relation: str) -> str:
    """DuckDB: relation with the column folded, by words and by dots."""
    return f"""
SELECT *, CASE WHEN len(w) = 3 AND regexp_full_match(w[1], '[0-9]{{3}}') AND regexp_full_match(w[2], '[0-9A-Za-z]{{1,10}}') AND regexp_full_match(w[3], '[0-9]{{1,3}}') THEN upper(w[2]) || '.' || w[1] || '.' || right('00' || w[3], 3)
  WHEN len(d) = 3 AND regexp_full_match(d[1], '[A-Za-z]{{0,3}}[0-9]{{0,4}}') AND regexp_full_match(d[2], '[0-9]{{3}}') AND regexp_full_match(d[3], '[0-9]{{1,3}}') THEN upper(d[1]) || '.' || d[2] || '.' || right('00' || d[3], 3) ELSE ref END AS folded
FROM (SELECT *, regexp_split_to_array(trim(ref), '\\s+') AS w, string_split(trim(ref), '.') AS d FROM {relation}) y"""


def f01_fold_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, REFS).withColumn("folded", references.fold_code(F.col("ref")))


def f02_register_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, REFS).select("p_partkey", references.register_key(F.col("ref")).alias("ref_key"))


def t06_normalise_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, REFS).select("p_partkey", references.normalise_ref(F.col("ref"), F.expr(STRATEGY)).alias("normal"))


def f03_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folds as functions that SQL text calls, by a table of rules."""
    sql.register(spark)
    run(spark, sf_dir, f"SELECT *, {STRATEGY} AS strategy FROM ({REFS}) x").createOrReplaceTempView("printed_refs")
    return spark.sql("SELECT p_partkey, fold_code(ref) AS folded, register_key(ref) AS ref_key, normalise_ref(ref, strategy) AS normal FROM printed_refs")


F01_SQL = f"SELECT p_partkey, ref, folded FROM ({_folded(f'({REFS}) x')}) z"
F02_SQL = f"""SELECT p_partkey, folded AS ref_key FROM ({_folded(f'''(SELECT p_partkey, CASE WHEN len(s) > 1 AND regexp_full_match(s[-1], '[A-Za-z][0-9A-Za-z]{{0,2}}') THEN left(ref, length(ref) - length(s[-1]) - 1) ELSE ref END AS ref
FROM (SELECT *, string_split(ref, '.') AS s FROM ({REFS}) r) q) x''')}) z"""
T06_SQL = f"""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN ref WHEN 1 THEN CASE WHEN regexp_full_match(ref, '[0-9]+[A-Za-z]{{1,3}}') THEN rtrim(ref, 'ABCDX') ELSE ref END ELSE folded END AS normal
FROM ({_folded(f'({REFS}) x')}) z"""

F03_SQL = f"SELECT a.p_partkey, a.folded, b.ref_key, c.normal FROM ({F01_SQL}) a JOIN ({F02_SQL}) b USING (p_partkey) JOIN ({T06_SQL}) c USING (p_partkey)"

STORED = "SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 20 = 0 THEN 'n.d.' ELSE '199' || CAST(o_orderkey % 10 AS STRING) || '-' || lpad(CAST(o_orderkey % 14 AS STRING), 2, '0') || '-' || lpad(CAST(o_orderkey % 34 AS STRING), 2, '0') END AS stored FROM orders"


def t09_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, STORED).withColumn("parsed", dates.parse_date(F.col("stored")))


T09_SQL = f"""
SELECT doc_id, stored, coalesce(try_cast(stored AS DATE), CASE WHEN right(stored, 2) IN ('29', '30', '31') AND substr(stored, 6, 2) BETWEEN '01' AND '12' THEN CAST(date_trunc('month', CAST(left(stored, 7) || '-01' AS DATE)) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) END) AS parsed
FROM ({STORED}) x"""

_DAY = "CAST(1 + o_orderkey % 32 AS STRING)"
_YEAR = "CAST(1990 + o_orderkey % 20 AS STRING)"


def _month(names: str) -> str:
    return "CASE o_orderkey % 12 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names.split())) + " END"


PRINTED = f"""
SELECT o_orderkey AS doc_id, CASE o_orderkey % 7 WHEN 0 THEN {_DAY} || '.' || CAST(1 + o_orderkey % 12 AS STRING) || '. ' || {_YEAR} WHEN 1 THEN {_YEAR} || '-' || CAST(1 + o_orderkey % 12 AS STRING) || '-' || {_DAY}
  WHEN 2 THEN {_month("January February March April May June July August September October November December")} || ' ' || {_DAY} || 'th, ' || {_YEAR} || ' (issued)'
  WHEN 3 THEN {_DAY} || '. ' || {_month("Januar Februar März April Mai Juni Juli August September Oktober November Dezember")} || ' ' || {_YEAR}
  WHEN 4 THEN {_DAY} || '-' || {_month("JAN feb Mar apr may jun Jul aug SEPT oct nov dec")} || '-' || {_YEAR}
  WHEN 5 THEN {_DAY} || ' ' || {_month("jan fev marec abr maj junij julij avgust set out nov dez")} || '. ' || {_YEAR} ELSE 'they may attend in ' || {_YEAR} END AS printed FROM orders"""


def t10_parse_printed_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, PRINTED).withColumn("parsed", dates.parse_printed_date(F.col("printed")))


#: The numbers that the printed dates are made of.
T10_SQL = f"SELECT doc_id, printed, CASE WHEN doc_id % 7 < 6 THEN try_cast(printf('%04d-%02d-%02d', 1990 + doc_id % 20, 1 + doc_id % 12, 1 + doc_id % 32) AS DATE) END AS parsed FROM ({PRINTED}) x"

NUMBERED = """SELECT doc_id, source, text || ' (' || CASE doc_id % 5 WHEN 0 THEN 'BE-MF-' WHEN 1 THEN 'XDE-MF-' WHEN 2 THEN 'be-MF-' WHEN 3 THEN 'SI-MF-' ELSE 'DE-MF-0' END || lpad(CAST(doc_id % 400 AS STRING), 9, '0') || ')' AS content FROM documents"""


def t24_actor_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each registration number of a source, with the first document that prints it."""
    found = run(spark, sf_dir, NUMBERED).select("doc_id", "source", F.explode(references.registrations(F.col("content"))).alias("number"))
    return found.groupBy("source", "number").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("docs"))


T24_SQL = f"""SELECT source, substr(content, length(content) - 15, 15) AS number, min(doc_id) AS first_doc, count(*) AS docs FROM ({NUMBERED}) x
WHERE doc_id % 5 IN (0, 3) GROUP BY 1, 2"""

BASIC = "SELECT p_partkey, p_size, CASE p_partkey % 4 WHEN 0 THEN 'Basic UDI-DI: PRODUCT' ELSE p_name END AS before, '4' || CAST(p_partkey AS STRING) || 'AB' AS payload FROM part"


def x06_basic_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = run(spark, sf_dir, BASIC).withColumn("value", F.concat("payload", F.when(F.col("p_size") % 3 == 0, "22").otherwise(identifiers.check_pair(F.col("payload")))))
    content = F.concat(F.col("before"), F.lit("\nbasic udi di (model) "), F.when(F.col("p_size") % 7 == 0, "Document").otherwise(F.col("value")))
    found = parts.select("p_partkey", references.basic_identifier(content).alias("identifier"))
    return found.withColumn("conf", references.basic_confidence(F.col("identifier")))


PRINTED_REFS = """
SELECT DISTINCT d.manufacturer, CASE e.line % 4 WHEN 0 THEN '00' || substr(e.printed_ref, 2) WHEN 1 THEN d.manufacturer || '-' || substr(e.printed_ref, 2) WHEN 2 THEN 'REF ' || d.manufacturer || e.printed_ref ELSE '00 ' || e.printed_ref END AS printed_ref
FROM evidence e JOIN document d ON d.doc_id = e.doc_id WHERE d.coverage_scope = 'group'"""
ITEMS = "SELECT manufacturer_raw AS manufacturer, item_ref, mfr_ref FROM item"


def r12_near_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.near_matches(run(spark, sf_dir, PRINTED_REFS), run(spark, sf_dir, ITEMS))


R12_SQL = f"""
WITH p AS (SELECT *, upper(regexp_replace(printed_ref, '[^0-9A-Za-z]', '', 'g')) AS k FROM ({PRINTED_REFS}) a), i AS (SELECT manufacturer, item_ref, unnest([item_ref, mfr_ref]) AS own FROM ({ITEMS}) b),
n AS (SELECT manufacturer, item_ref, upper(regexp_replace(own, '[^0-9A-Za-z]', '', 'g')) AS b FROM i WHERE own IS NOT NULL),
m AS (SELECT p.manufacturer, printed_ref, item_ref, CASE WHEN k = b THEN 0 WHEN ltrim(k, '0') <> '' AND ltrim(k, '0') = ltrim(b, '0') THEN 1 WHEN length(k) >= 4 AND ends_with(b, k) THEN 2 WHEN length(b) >= 5 AND ends_with(k, b) THEN 2 END AS r
  FROM p JOIN n ON n.manufacturer = p.manufacturer WHERE b <> '' AND k <> '')
SELECT manufacturer, printed_ref, item_ref, ['exact', 'zeros', 'prefix'][min(r) + 1] AS kind FROM m WHERE r IS NOT NULL GROUP BY 1, 2, 3"""


def r15_actor_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    actors = table(spark, sf_dir, "customer").selectExpr(
        "CASE c_custkey % 4 WHEN 0 THEN concat('BRAND#', 1 + c_custkey % 60, ' GmbH') WHEN 1 THEN concat('Brands ', 1 + c_custkey % 60, ', Inc.') WHEN 2 THEN concat(1 + c_custkey % 60, ' Bränd A.G.') ELSE c_name END AS actor"
    )
    aliases = run(spark, sf_dir, "SELECT canonical_name AS canonical, raw_name AS alias FROM alias")
    return references.attribute_actors(actors, aliases)


QUERIES = {
    "f01_fold_code": f01_fold_code, "f02_register_key": f02_register_key, "f03_sql_functions": f03_sql_functions, "t06_normalise_ref": t06_normalise_ref, "t09_parse_date": t09_parse_date,
    "t10_parse_printed_date": t10_parse_printed_date, "t24_actor_numbers": t24_actor_numbers, "x06_basic_identifier": x06_basic_identifier,
    "r12_near_matches": r12_near_matches, "r15_actor_attribution": r15_actor_attribution,
}
ORACLES = {
    "f01_fold_code": F01_SQL, "f02_register_key": F02_SQL, "f03_sql_functions": F03_SQL, "t06_normalise_ref": T06_SQL, "t09_parse_date": T09_SQL, "t10_parse_printed_date": T10_SQL,
    "t24_actor_numbers": T24_SQL, "r12_near_matches": duck_sql(R12_SQL),
}
