"""The thin queries over the operators of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import langid
from ledgerlight.llm.ann import search
from ledgerlight.llm.centroids import clustering
from ledgerlight.llm.decontaminate import digest, find_contamination
from ledgerlight.llm.exact_dedup import exact_duplicates
from ledgerlight.llm.line_dedup import dedup_lines
from ledgerlight.llm.lm_score import score_texts
from ledgerlight.llm.mixing import mix_sources
from ledgerlight.llm.ngram_join import ngram_groups
from ledgerlight.llm.phrases import collocations
from ledgerlight.llm.suffix_dedup import remove_repeats
from ledgerlight.llm.token_count import count_tokens, read_pieces
from ledgerlight.llm.url_filter import filter_urls, rules_table
from ledgerlight.session import table

#: Fixed by the contract of op2: (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

#: Relative target weights; sources that aren't named weigh 1.
MIX_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
MIX_SEED = 17

#: Where the vocabulary files of public tokenizers are.
TOKENIZERS = "/opt/tokenizers"


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), rules_table(spark, URL_RULES)).drop("n_possible")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mix_sources(docs, weights=MIX_WEIGHTS, seed=MIX_SEED)


OP2_SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
f AS (
  SELECT *, host = 'org' OR host LIKE '%.org' AS in_org, host = 'example.org' OR host LIKE '%.example.org' AS in_ex,
         host = 'com' OR host LIKE '%.com' AS in_com FROM u),
m AS (
  SELECT *, in_org AND starts_with(path, '/') AS r1, in_ex AND starts_with(path, '/es/') AS r2,
         in_ex AND starts_with(path, '/en/1') AS r3, in_com AND starts_with(path, '/fr/') AS r4, in_com AND starts_with(path, '/de/') AS r5 FROM f)
SELECT page_id, host, path,
       CASE WHEN r3 THEN 'example.org/en/1' WHEN r2 THEN 'example.org/es/' WHEN r1 THEN 'org/' WHEN r4 THEN 'com/fr/' WHEN r5 THEN 'com/de/' END AS rule,
       CASE WHEN r3 OR r2 OR r5 THEN 'block' ELSE 'allow' END AS verdict,
       CAST(r1::INT + r2::INT + r3::INT + r4::INT + r5::INT AS BIGINT) AS n_exact
FROM m
"""

_MIX_CASES = " ".join(f"WHEN source = '{k}' THEN {v}" for k, v in MIX_WEIGHTS.items())
OP4_SQL = f"""
WITH c AS (SELECT source, count(*) AS n, CASE {_MIX_CASES} ELSE 1.0 END::DOUBLE AS w FROM documents GROUP BY source),
r AS (SELECT source, w / (SELECT sum(w) FROM c) * (SELECT sum(n) FROM c)::DOUBLE / n AS rate FROM c),
p AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS pmf FROM r, range(0, 400) t(k) WHERE k <= ceil(rate + 12 * sqrt(rate) + 30)),
d AS (SELECT source, k, sum(pmf) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p),
h AS (SELECT *, CAST('0x' || substr(md5('{MIX_SEED}:' || doc_id), 1, 15) AS BIGINT) / 1152921504606846976.0::DOUBLE AS u FROM documents),
n AS (SELECT h.doc_id, any_value(h.text) AS text, any_value(h.lang) AS lang, h.source, any_value(h.n_chars) AS n_chars, count(*) FILTER (WHERE d.cdf <= h.u) AS n
      FROM h JOIN d ON h.source IS NOT DISTINCT FROM d.source GROUP BY h.doc_id, h.source),
e AS (SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(0, n)) AS INTEGER) AS copy FROM n WHERE n > 0)
SELECT *, CAST('0x' || substr(md5('{MIX_SEED}:' || doc_id || ':' || copy), 1, 15) AS BIGINT) AS mix_key FROM e
"""

def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


OP1_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
it AS (SELECT item_id, w, least(len(w), 13) AS n FROM iw WHERE len(w) > 0),
ix AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM it),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM ix),
lens AS (SELECT DISTINCT n FROM win),
dx AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n),
dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM dx),
hit AS (SELECT doc_id, n, i, item_id FROM dg JOIN win USING (n, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(t.ks, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len(d.w) AS contaminated
FROM dw d LEFT JOIN pos p USING (doc_id) LEFT JOIN its t USING (doc_id)
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"), 5, 0)
    model = langid.train(docs.where(~held))
    return langid.predict(docs.select("doc_id", "text", held.alias("held_out")), model, keep=["doc_id", "held_out"])


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"), 7, 2)
    scored = score_texts(docs.select("doc_id", "text", (F.col("doc_id").isNotNull() & ~held).alias("train")), train_col="train")
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_token_count(spark: SparkSession, sf_dir: str, model_file: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), read_pieces(model_file))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clustering(table(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return found.withColumn("centroid_sha256", F.sha2(digits.cast("binary"), 256)).drop("centroid")


def _op11_sql(clusters: int = 16, rounds: int = 3, dim: int = 64) -> str:
    apart = "list_sum(list_transform(range(1, %d), lambda i: (v[i] - c[i]) * (v[i] - c[i])))" % (dim + 1)
    nearest = "SELECT rid, vec_id, v, arg_min(k, (dist, k)) AS k, min(dist) AS dist FROM (SELECT rid, vec_id, v, k, CAST(%s AS BIGINT) AS dist FROM x, c%d) GROUP BY rid, vec_id, v"
    parts = [
        f"x AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {dim})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT v, sha256('1:' || CAST(vec_id AS VARCHAR)) AS h FROM x ORDER BY h, v LIMIT {clusters}))",
    ]
    for r in range(rounds):
        parts += [
            f"a{r} AS MATERIALIZED ({nearest % (apart, r)})",
            f"m{r} AS (SELECT k, list(CAST(floor_s AS BIGINT) ORDER BY i) AS c FROM (SELECT k, i, (s - ((s % n) + n) % n) // n AS floor_s FROM (SELECT k, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(range(1, {dim + 1})) AS i) GROUP BY k, i)) GROUP BY k)",
            f"c{r + 1} AS MATERIALIZED (SELECT c{r}.k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k))",
        ]
    return (
        "WITH " + ",\n".join(parts) + f",\nf AS MATERIALIZED ({nearest % (apart, rounds)})\n"
        "SELECT vec_id, CAST(k AS INTEGER) AS cluster, dist AS distance, CAST(sum(dist) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia,\n"
        f"  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM f JOIN c{rounds} USING (k)"
    )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


OP12_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(s) AS text_sha256
FROM t
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, string_split(phrase, ' ') AS w, phrase, f AS a FROM f WHERE k > 1),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS held
  FROM (SELECT lang, w, k, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k) GROUP BY ALL),
cuts AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS j FROM c),
s AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, j, x.f AS l, y.f AS r, n.n,
         CAST(1000 * CAST(cuts.a AS HUGEINT) * CAST(n.n AS HUGEINT) // (CAST(x.f AS HUGEINT) * CAST(y.f AS HUGEINT)) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:j], ' ')
    JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[j + 1:cuts.k], ' ') JOIN n ON n.lang = cuts.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
r AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, encode(b.phrase)) AS rank, b.phrase, b.a, b.l, b.r, CAST(b.n AS BIGINT) AS n, b.score
  FROM b LEFT JOIN inner_ USING (lang, phrase) WHERE held IS NULL OR held < b.a)
SELECT * FROM r WHERE rank <= 2000
"""


QUERIES = {
    "op10_ann": op10_ann,
    "op9_line_dedup": op9_line_dedup,
    "op7_token_count": op7_token_count,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op5_lm_score": op5_lm_score,
    "op8_ngram_join": op8_ngram_join,
    "op3_language_id": op3_language_id,
    "op1_decontaminate": op1_decontaminate,
    "op2_url_filter": op2_url_filter,
    "op4_mix_sources": op4_mix_sources,
    "op11_centroids": op11_centroids,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_collocations": op13_collocations,
}

ORACLES = {
    "op1_decontaminate": OP1_SQL,
    "op2_url_filter": OP2_SQL,
    "op4_mix_sources": OP4_SQL,
    "op11_centroids": _op11_sql(),
    "op12_exact_dedup": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
