"""Queries over the operators that SQL can't express, or only at length."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions import identifiers, text, web
from ledgerlight.operators.evidence import merge_reads
from ledgerlight.operators.graph import components, roots
from ledgerlight.operators.merge import upsert
from ledgerlight.operators.resolve import resolve
from ledgerlight.plans.dialect import duck_sql, run
from ledgerlight.session import ready_checkpoints, table
from ledgerlight.streaming import incremental, leases

ROBOTS = """
User-agent: *
Disallow: /es/
Allow: /es/1
Disallow: /*.html$
Disallow: /*?page=
"""


def t01_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.fold_column(F.col("text")).alias("folded"))


def t02_fold_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat("s_name", F.lit(", Ltd.")).alias("name"))
    return names.select("s_suppkey", text.fold_actor_column(F.col("name")).alias("folded"))


def t15_check_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("4"), F.col("p_partkey").cast("string"), F.upper("p_type")).alias("payload"))
    value = F.concat("payload", F.when(F.col("p_partkey") % 3 == 0, F.lit("22")).otherwise(identifiers.check_pair(F.col("payload"))))
    return parts.select("p_partkey", value.alias("value")).select("p_partkey", "value", identifiers.agency(F.col("value")).alias("agency"), identifiers.verdict(F.col("value")).alias("verdict"))


def t20_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.harvest(table(spark, sf_dir, "pages"), same_host=True)


def t22_robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.robots_filter(table(spark, sf_dir, "pages").select("page_id", "url"), ROBOTS)


def t26_trigram_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("name"), "p_size").groupBy("name").agg(F.min("p_size").alias("size"))
    other = names.select(F.col("name").alias("other"), F.col("size").alias("size"))
    pairs = names.join(other, "size").where("name < other")
    return pairs.select("name", "other", F.round(text.trigram_similarity(F.col("name"), F.col("other")), 4).alias("similarity"))


def t27_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("name"), "p_size").groupBy("name").agg(F.min("p_size").alias("size"))
    pairs = names.join(names.select(F.col("name").alias("other"), "size"), "size").where("name < other")
    kinds = ("ratio", "token_sort_ratio", "token_set_ratio", "partial_ratio")
    return pairs.select("name", "other", *[F.round(text.ratio_column(k, F.col("name"), F.col("other")), 2).alias(k) for k in kinds])


def a18_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready_checkpoints(spark)
    edges = table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("a"), (F.col("o_orderkey") + 3).alias("b"))
    return components(edges.where("a % 50 < 40"))


#: Chains of a step of 3 that break where a % 50 >= 40 or the key is no order's: their starts by running sums.
A18_SQL = """
WITH e AS (SELECT o_orderkey AS a, o_orderkey + 3 AS b FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 50 < 40), n AS (SELECT a AS id FROM e UNION SELECT b FROM e),
s AS (SELECT n.id, e.a IS NULL AS starts FROM n LEFT JOIN e ON e.b = n.id)
SELECT id, max(CASE WHEN starts THEN id END) OVER (PARTITION BY id % 3 ORDER BY id) AS component FROM s
"""


def _lines_of_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roots(run(spark, sf_dir, "SELECT id, caused_by AS parent FROM job"))


def u05_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs that each first job has caused, and how many steps away the last one is."""
    return _lines_of_jobs(spark, sf_dir).groupBy("root").agg(F.count("*").alias("jobs"), F.max("depth").alias("depth"))


U05_SQL = """WITH RECURSIVE walk(id, root, depth) AS (SELECT id, id, 0 FROM job WHERE caused_by IS NULL UNION ALL SELECT j.id, w.root, w.depth + 1 FROM job j JOIN walk w ON j.caused_by = w.id) SELECT root, count(*) AS jobs, CAST(max(depth) AS BIGINT) AS depth FROM walk GROUP BY 1"""


def q34_upload_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the last job that each first job has caused stands."""
    last = _lines_of_jobs(spark, sf_dir).groupBy("root").agg(F.max("id").alias("id"), F.count("*").alias("steps"))
    jobs = run(spark, sf_dir, "SELECT id, type AS last_type, status FROM job")
    outcome = F.when(F.col("status") == "dead", "failed").when(F.col("status") == "done", "finished").otherwise("under way")
    return last.join(jobs, "id").select("root", "steps", "last_type", outcome.alias("outcome"))


Q34_SQL = """
WITH RECURSIVE walk(id, root) AS (SELECT id, id FROM job WHERE caused_by IS NULL UNION ALL SELECT j.id, w.root FROM job j JOIN walk w ON j.caused_by = w.id),
last AS (SELECT root, max(id) AS last_id, count(*) AS steps FROM walk GROUP BY 1)
SELECT l.root, l.steps, j.type AS last_type, CASE WHEN j.status = 'dead' THEN 'failed' WHEN j.status = 'done' THEN 'finished' ELSE 'under way' END AS outcome FROM last l JOIN job j ON j.id = l.last_id"""


def x12_merge_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = run(spark, sf_dir, "SELECT doc_id, field, CAST(line AS BIGINT) AS step, value, tier, CAST(confidence AS DOUBLE) AS conf FROM evidence")
    return merge_reads(reads)


def r01_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run(spark, sf_dir, "SELECT i.item_ref, i.item_no, i.manufacturer_raw AS manufacturer, i.item_name AS name, CASE WHEN i.item_no % 4 = 0 THEN 'U' || CAST(i.item_no % 300 AS STRING) END AS udi, m.group_id FROM item i LEFT JOIN member m ON m.item_ref = i.item_ref")
    members = rows.where("group_id is not null and item_no % 3 <> 0")
    return resolve(rows.select("item_ref", "manufacturer", "name", "udi"), members.select("group_id", "item_ref", "manufacturer", "name", "udi"))


def m02_upsert_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = run(spark, sf_dir, "SELECT item_ref, doc_id, status, match_basis FROM link WHERE doc_id % 5 <> 0")
    new = run(spark, sf_dir, "SELECT item_ref, doc_id, 'staged' AS status, match_basis FROM link WHERE doc_id % 7 <> 0")
    return upsert(old, new, ["item_ref", "doc_id"], ["status", "match_basis"], sticky=F.col("old_status").isin("production", "rejected"))


M02_SQL = """
WITH o AS (SELECT * FROM link WHERE doc_id % 5 <> 0), n AS (SELECT item_ref, doc_id, 'staged' AS status, match_basis FROM link WHERE doc_id % 7 <> 0)
SELECT coalesce(o.item_ref, n.item_ref) AS item_ref, coalesce(o.doc_id, n.doc_id) AS doc_id,
       CASE WHEN n.doc_id IS NULL OR o.status IN ('production', 'rejected') THEN o.status ELSE n.status END AS status, coalesce(o.match_basis, n.match_basis) AS match_basis,
       CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'missing' WHEN o.status = n.status THEN 'same' WHEN o.status IN ('production', 'rejected') THEN 'kept' ELSE 'update' END AS action
FROM o FULL JOIN n ON o.item_ref = n.item_ref AND o.doc_id = n.doc_id
"""


ASKED = "SELECT domain, id, at_ms FROM (SELECT @extract(lower(url), '://([^/:?#]+)', 1) AS domain, page_id AS id, page_id * 700 AS at_ms FROM pages) x WHERE domain <> ''"
FLOORS = "SELECT DISTINCT domain, 1500 * (length(domain) % 4) AS min_politeness_ms FROM (SELECT @extract(lower(url), '://([^/:?#]+)', 1) AS domain FROM pages) x WHERE domain <> ''"


def z05_domain_lease(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which requests to a host are granted, and how long its lease then runs."""
    asked = run(spark, sf_dir, ASKED).withColumnRenamed("at_ms", "at")
    return leases.grant_leases(asked, run(spark, sf_dir, FLOORS)).withColumnRenamed("at", "at_ms")


#: From each granted request on to the first one that its lease allows.
Z05_SQL = f"""
WITH RECURSIVE r AS (SELECT a.domain, a.id, a.at_ms, greatest(2000, f.min_politeness_ms) AS gap FROM ({ASKED}) a JOIN ({FLOORS}) f USING (domain)),
g AS (SELECT domain, min(at_ms) AS t, any_value(gap) AS gap FROM r GROUP BY domain UNION ALL SELECT g.domain, (SELECT min(r.at_ms) FROM r WHERE r.domain = g.domain AND r.at_ms >= g.t + g.gap) AS t, g.gap FROM g WHERE g.t IS NOT NULL)
SELECT r.domain, r.id, r.at_ms, g.t IS NOT NULL AS granted, (SELECT max(h.t) FROM g h WHERE h.domain = r.domain AND h.t <= r.at_ms) + r.gap AS leased_until FROM r LEFT JOIN g ON g.domain = r.domain AND g.t = r.at_ms"""


def z_stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming window counts, run to the end of what is there."""
    ready_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    counts = incremental.outcome_windows(incremental.read_events(spark, sf_dir))
    flat = counts.select(F.col("w.start").cast("date").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))
    q = flat.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(flat.schema).parquet(f"{folder}/out")


#: A window is written once the watermark, an hour behind the latest event, has passed its end.
Z_SQL = """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2
HAVING CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
"""

QUERIES = {
    "t01_fold": t01_fold, "t02_fold_actor": t02_fold_actor, "t15_check_pair": t15_check_pair, "t20_harvest": t20_harvest, "t22_robots": t22_robots,
    "t26_trigram_similarity": t26_trigram_similarity, "t27_ratios": t27_ratios, "a18_components": a18_components, "x12_merge_reads": x12_merge_reads,
    "u05_lineage": u05_lineage, "z05_domain_lease": z05_domain_lease, "q34_upload_outcomes": q34_upload_outcomes, "r01_resolve": r01_resolve, "m02_upsert_operator": m02_upsert_operator, "z_stream_windows": z_stream_windows,
}
ORACLES = {"z05_domain_lease": duck_sql(Z05_SQL), "u05_lineage": duck_sql(U05_SQL), "q34_upload_outcomes": duck_sql(Q34_SQL), "a18_components": A18_SQL, "m02_upsert_operator": duck_sql(M02_SQL), "z_stream_windows": Z_SQL}
