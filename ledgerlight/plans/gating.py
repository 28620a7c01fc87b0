"""Queries over readings and how sure they are. The checks write each case out as arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.operators.gate import confidences, scores
from ledgerlight.plans.dialect import duck_sql, run

READINGS = """
SELECT o_orderkey AS doc_id, field, CASE WHEN (o_orderkey + k) % 17 <> 0 THEN 'v' END AS value, 'q' AS verbatim, CAST(50 + (o_orderkey * 7 + k * 13) % 50 AS DOUBLE) / 100 AS conf,
  CASE WHEN (o_orderkey + k) % 4 = 0 THEN 'T0' ELSE 'T1' END AS tier, CASE WHEN o_orderkey % 11 <> 0 THEN 1 END AS page, CASE (o_orderkey + k) % 4 WHEN 1 THEN 'm-half' WHEN 2 THEN 'm-one' WHEN 3 THEN 'm-type' END AS model_id,
  CASE WHEN (o_orderkey + 2 * k) % 3 = 0 THEN CAST(60 + (o_orderkey * 3 + k) % 40 AS DOUBLE) / 100 END AS agreed_conf, CASE WHEN (o_orderkey + 2 * k) % 3 = 0 THEN 'm-one' END AS agreed_model_id,
  CASE WHEN o_orderkey % 6 = 0 THEN 'citation' END AS proven, CASE WHEN o_orderkey % 5 = 0 THEN 'type' END AS follows
FROM orders CROSS JOIN (VALUES ('type', 1), ('regulation', 2), ('coverage_scope', 3)) AS f(field, k)"""
FACTORS = [("m-half", "*", 0.5), ("m-type", "*", 0.9), ("m-type", "type", 1.2)]


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confidences(run(spark, sf_dir, READINGS), spark.createDataFrame(FACTORS, "model_id string, field string, factor double"))


def g01_combined_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("doc_id", "field", F.round("scored", 6).alias("scored"), F.round("stored", 6).alias("stored"))


def g02_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's score, and whether its evidence is complete and cites its pages."""
    return scores(_judged(spark, sf_dir)).withColumn("score", F.round("score", 6))


_SCORED = f"""
SELECT *, CASE WHEN m = 0 THEN conf WHEN field = 'regulation' AND doc_id % 6 = 0 THEN 1.0 WHEN agreed_conf >= 0.7 AND own >= 0.7 THEN own + agreed_conf - own * agreed_conf ELSE own END AS scored,
  CASE WHEN m = 0 THEN conf WHEN field = 'regulation' AND doc_id % 6 = 0 THEN 1.0 WHEN agreed_conf >= 0.7 AND own >= 0.7 THEN conf + agreed_conf - conf * agreed_conf ELSE conf END AS stored
FROM (SELECT *, CASE m WHEN 1 THEN conf / 2 WHEN 3 THEN least(1.0, conf * CASE field WHEN 'type' THEN 1.2 ELSE 0.9 END) ELSE conf END AS own
  FROM (SELECT *, (doc_id + CASE field WHEN 'type' THEN 1 WHEN 'regulation' THEN 2 ELSE 3 END) % 4 AS m FROM ({READINGS}) r) s) t"""
G01_SQL = f"SELECT doc_id, field, round(scored, 6) AS scored, round(stored, 6) AS stored FROM ({_SCORED}) u"
G02_SQL = f"""
SELECT doc_id, round(min(scored) FILTER (WHERE field <> 'coverage_scope' OR doc_id % 5 <> 0), 6) AS score, bool_and((doc_id + CASE field WHEN 'type' THEN 1 WHEN 'regulation' THEN 2 ELSE 3 END) % 17 <> 0) AS complete,
  doc_id % 11 = 0 AND bool_or(m <> 0) AS page_missing FROM ({_SCORED}) u GROUP BY doc_id"""

QUERIES = {"g01_combined_confidence": g01_combined_confidence, "g02_score": g02_score}
ORACLES = {"g01_combined_confidence": duck_sql(G01_SQL), "g02_score": duck_sql(G02_SQL)}
