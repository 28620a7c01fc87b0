"""Mixing sources to target weights by Poisson replication and a global shuffle.

Every document gets a uniform number from a seeded hash of its id. Inverting the Poisson distribution whose mean is
the source's target repetition rate turns that number into a copy count: 0 leaves the document out, k gives k copies.
The copies are dealt over the cluster by a second hash and sorted by it, which is a global random order that a
re-run, or a re-tried task, reproduces exactly.

The rate of a source is weight / sum of weights * documents / documents of the source, so a hot source only makes its
own rate small; rates come from partial counts and are a few bytes a source. They are broadcast only when the number
of sources, which is counted first, is at most `max_broadcast_sources`; beyond that a shuffled join is used, whose
hot keys adaptive execution splits.

Only DataFrame functions are used. Edge cases: null source is a source of its own; null doc_id is hashed as the text
"null"; null and empty texts are carried like any other; repeated rows (same doc_id) get the same count each, as
the hash sees only the id; an empty table gives an empty result; a weight of 0 leaves a source out; a column of the
input named like one of the added columns (copy, mix_key) is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.session import shuffle_width

HASH_BITS = 60


def uniform60(text: Column) -> Column:
    """The first 60 bits of the text's MD5 as a long."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until it is within rounding of 1; in logarithms, so that large rates work."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    zero = F.struct(F.lit(0.0).alias("ln_fact"), F.lit(0.0).alias("total"), F.array().cast("array<double>").alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        ln_fact = acc["ln_fact"] + F.when(k > 0, F.ln(k.cast("double"))).otherwise(F.lit(0.0))
        total = acc["total"] + F.exp(k * F.ln(rate) - rate - ln_fact)
        return F.struct(ln_fact.alias("ln_fact"), total.alias("total"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(0), top), zero, step, lambda acc: acc["cdf"])
    return F.when(rate > 0, cdf).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, source_col: str, weights: dict[str, float], default_weight: float) -> DataFrame:
    """(src, n_docs, rate) for each source."""
    counts = docs.groupBy(F.col(source_col).alias("src")).agg(F.count("*").alias("n_docs"))
    weight = F.lit(float(default_weight))
    for name, w in weights.items():
        weight = F.when(F.col("src") == name, F.lit(float(w))).otherwise(weight)
    weighted = counts.withColumn("weight", weight)
    totals = weighted.agg(F.sum("weight").alias("all_weight"), F.sum("n_docs").alias("all_docs"))
    return weighted.crossJoin(F.broadcast(totals)).select(  # totals is one row
        "src", "n_docs", (F.col("weight") / F.col("all_weight") * F.col("all_docs") / F.col("n_docs")).alias("rate")
    )


def mix_sources(
    docs: DataFrame,
    *,
    weights: dict[str, float] | None = None,
    default_weight: float = 1.0,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    max_broadcast_sources: int = 100_000,
) -> DataFrame:
    """All columns of docs, plus copy (from 0) and mix_key (the place in the global order), in shuffled order."""
    kept = [c for c in docs.columns if c not in ("copy", "mix_key")]
    docs = docs.select(*kept)
    rates = source_rates(docs, source_col, weights or {}, default_weight)
    rates = rates.select(F.col("src").alias("mix_src"), poisson_cdf(F.col("rate")).alias("mix_cdf"))
    if docs.select(source_col).distinct().limit(max_broadcast_sources + 1).count() <= max_broadcast_sources:
        rates = F.broadcast(rates)
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    u = uniform60(F.concat(F.lit(f"{seed}:"), name)) / F.lit(float(1 << HASH_BITS))
    counted = docs.join(rates, docs[source_col].eqNullSafe(rates["mix_src"])).withColumn(
        "mix_n", F.size(F.filter("mix_cdf", lambda c: c <= u))
    )
    copies = counted.where("mix_n > 0").select(*[docs[c] for c in kept], F.explode(F.sequence(F.lit(0), F.col("mix_n") - 1)).alias("copy"))
    keyed = copies.withColumn("mix_key", uniform60(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), F.col("copy").cast("string"))))
    width = shuffle_width(docs.sparkSession)
    return keyed.repartition(width, "mix_key").sortWithinPartitions("mix_key")
