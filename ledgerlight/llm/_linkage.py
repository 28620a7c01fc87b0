"""Exact connected groups from buckets of possible partners, without all pairs of a bucket.

Rows (bucket, id, pos) say that ids of one bucket may be linked; pos is the bucket's place among those of the id. First every id is checked against its bucket's pivot only,
the id of least weight w (the most typical one), and what links makes components; a large group of near copies is then
mostly one component. Pairs within a component need no check. What remains are, in buckets with several components,
the ids outside the bucket's largest component against all ids of other components: of these, pairs that `near` can't
rule out are checked one by one, so no link between components is lost. Of buckets with the same ids one is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.graph import components
from ledgerlight.session import cut


def shared_buckets(buckets: DataFrame, facts: DataFrame) -> DataFrame:
    """(bucket, id, pos, pivot, facts): the rows of buckets with several ids; of equal buckets that with least places."""
    ends = buckets.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    some = cut(buckets.join(ends.where("least < most").select("bucket"), "bucket")).join(facts, "id")
    marks = some.groupBy("bucket").agg(
        F.min(F.struct("w", "id")).alias("pivot"),
        F.sum("pos").alias("places"),
        F.count("*").alias("ids"),
        F.bit_xor(F.xxhash64("id")).alias("mark"),
        F.sum(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 31))).alias("total"),
    )
    one = marks.groupBy("ids", "mark", "total").agg(F.min(F.struct("places", "bucket", "pivot")).alias("x"))
    return cut(some.join(one.select("x.bucket", F.col("x.pivot.id").alias("pivot")), "bucket"))


def star_pairs(shared: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b: the pivot of a bucket and each other id of it."""
    return shared.where("id != pivot").select(F.least("pivot", "id").alias("a"), F.greatest("pivot", "id").alias("b")).distinct()


def rest_pairs(shared: DataFrame, labels: DataFrame, near: Callable[[str, str], Column]) -> DataFrame:
    """Distinct (a, b), a < b: pairs of a bucket from different components, the largest one only against others."""
    told = shared.join(labels, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component", "pivot")
    sizes = told.groupBy("bucket", "comp").agg(F.count("*").alias("n_comp"))
    mixed = sizes.groupBy("bucket").agg(F.count("*").alias("comps"), F.max(F.struct("n_comp", "comp")).alias("top")).where("comps > 1")
    told = told.join(mixed.select("bucket", F.col("top.comp").alias("top")), "bucket")
    minor = told.where("comp != top").select("bucket", *[F.col(c).alias(f"x_{c}") for c in told.columns if c not in ("bucket", "top")])
    pairs = minor.join(told, "bucket").where(
        (F.col("comp") != F.col("x_comp")) & ((F.col("comp") == F.col("top")) | (F.col("x_id") < F.col("id"))) & near("x_", "")
    )
    return pairs.select(F.least("x_id", "id").alias("a"), F.greatest("x_id", "id").alias("b")).distinct()


def linked_groups(
    buckets: DataFrame,
    facts: DataFrame,
    near: Callable[[str, str], Column],
    verify: Callable[[DataFrame], DataFrame],
    more_orders: list[DataFrame] | None = None,
) -> DataFrame:
    """(id, component) of all ids that have a link; verify keeps the linked ones of (a, b) pairs.

    facts: (id, w, ...) of every id; near(p, q): a condition on two ids' facts and places in a bucket, prefixed p and
    q, that all links meet in at least one bucket, the one with the least places.
    more_orders: further bucket tables; remaining pairs must share a bucket in every one of them.
    """
    shared = shared_buckets(buckets, facts)
    stars = star_pairs(shared)
    links = cut(verify(stars))
    labels = components(links)
    rest = cut(rest_pairs(shared, labels, near)).join(stars, ["a", "b"], "left_anti")  # those were looked at
    for other in more_orders or []:
        rest = rest.join(rest_pairs(shared_buckets(other, facts), labels, near), ["a", "b"], "left_semi")
    more = cut(verify(rest))
    if more.limit(1).count() == 0:
        return labels
    return components(links.unionByName(more))
