"""URL filtering: a blocked Bloom filter of listed canonical URL prefixes in front of an exact hash join.

A rule lists a host and a path prefix with a verdict. It fits a URL when the URL's host is the rule's host or a
subdomain of it and the URL's path starts with the rule's path; of several the longest wins (length of host plus
path, then of host). Every URL yields its possible keys (host suffix, path prefix of a listed length). The filter, a
table of 256-bit blocks whose number is capped, and therefore safe to broadcast, drops the keys that no rule can
have; what remains goes to an exact hash join with the rules, which removes the filter's false positives.

Only DataFrame functions are used. Edge cases: a null URL, or one without "://", has an empty host and path and
fits no rule; an empty table gives an empty result; repeated rows each keep their own result row; further columns of
the input, whatever their names, are ignored; very long URLs are handled whole; equal rules listed twice count once
(of contradicting verdicts for the same rule "block" stands).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
WORDS_PER_BLOCK = 4


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL_PATTERN, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_PATTERN, 2)


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) triples as a table."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _block(host: Column, path: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(blocks))


def _masks(host: Column, path: Column) -> list[Column]:
    """The two bits that a key sets in each 64-bit word of its block."""
    bits = F.xxhash64(path, host, F.lit(7))
    one = F.lit(1).cast("long")
    take = lambda i: F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
    return [
        F.call_function("shiftleft", one, take(2 * i)).bitwiseOR(F.call_function("shiftleft", one, take(2 * i + 1)))
        for i in range(WORDS_PER_BLOCK)
    ]


def blocked_bloom(rules: DataFrame, blocks: int) -> DataFrame:
    """At most `blocks` rows (block, w0..w3): the filter."""
    keyed = rules.select(
        _block(F.col("host"), F.col("path"), blocks).alias("block"),
        *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("host"), F.col("path")))],
    )
    return keyed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS_PER_BLOCK)])


def filter_urls(
    urls: DataFrame,
    rules: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    keys_per_block: int = 16,
    max_blocks: int = 1 << 16,
) -> DataFrame:
    """One row for each row of `urls`: id, host, path, rule (null if none fits), verdict, n_possible, n_exact.

    n_possible counts the row's keys that passed the filter, n_exact those that the exact join kept. The filter is
    sized from the number of rules, up to max_blocks blocks of 40 bytes; beyond that it passes more keys and the
    exact join does more of the work, with the same result.
    """
    listed = (
        rules.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # "block" > "allow"
        .withColumn("rule", F.concat("host", "path"))
    )
    n_rules, lengths = listed.agg(F.count("*"), F.collect_set(F.length("path"))).first()
    blocks = 1
    while blocks < max_blocks and blocks * keys_per_block < n_rules:
        blocks *= 2
    parsed = urls.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(
            F.array(*[F.lit(int(n)) for n in sorted(lengths or [])]).cast("array<int>"),
            lambda n: n <= F.length("path"),
        ),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    keys = (
        parsed.where(F.col("host") != "")
        .select("id", "url", F.explode(suffixes).alias("h"), prefixes.alias("ps"))
        .select("id", "url", "h", F.explode("ps").alias("p"))
    )
    keys = keys.select("*", _block(F.col("h"), F.col("p"), blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks(F.col("h"), F.col("p")))])
    bloom = F.broadcast(blocked_bloom(listed, blocks))  # at most max_blocks rows of 40 bytes
    inside = F.lit(True)
    for i in range(WORDS_PER_BLOCK):
        inside = inside & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    possible = keys.join(bloom, "block").where(inside).select("id", "url", "h", "p")
    exact = possible.join(
        listed.select(F.col("host").alias("h"), F.col("path").alias("p"), "rule", "verdict"), ["h", "p"], "left"
    )
    best = exact.groupBy(F.col("id").alias("b_id"), F.col("url").alias("b_url")).agg(
        F.max(
            F.when(
                F.col("rule").isNotNull(),
                F.struct(F.length("rule").alias("n"), F.length("h").alias("hn"), "rule", "verdict"),
            )
        ).alias("best"),
        F.count("*").alias("n_possible"),
        F.count("rule").alias("n_exact"),
    )
    joined = parsed.join(best, parsed.id.eqNullSafe(best.b_id) & parsed.url.eqNullSafe(best.b_url), "left")
    return joined.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
        F.coalesce("n_possible", F.lit(0)).cast("long").alias("n_possible"),
        F.coalesce("n_exact", F.lit(0)).cast("long").alias("n_exact"),
    )
