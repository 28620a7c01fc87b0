"""The resolve ladder: known link, then equal identifier, then similar names within the manufacturer.

The batch form of a serial rule: all items are judged against the groups as they are when the batch starts, so the
result doesn't depend on any order; items that open a group of their own in one batch can be joined in the next.
Candidates come from shared trigrams within a manufacturer, not from all pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlight.functions.text import ratio_column, trigrams


def resolve(items: DataFrame, members: DataFrame, *, accept: float = 0.9, suggest: float = 0.9, k: int = 20, least: float = 0.3) -> DataFrame:
    """(item_ref, group_id, rung, score) for each row of items.

    items: item_ref, manufacturer, name, udi. members: group_id, item_ref, manufacturer, name, udi.
    """
    # the least group of a number or identifier first, so that no item meets all members of a common one
    least_of = lambda key: members.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("group_id").alias("group_id"))
    linked = items.join(least_of("item_ref"), "item_ref").groupBy("item_ref").agg(F.min("group_id").alias("g_link"))
    equal = items.join(least_of("udi"), "udi").groupBy("item_ref").agg(F.min("group_id").alias("g_udi"))
    open_ = items.join(linked, "item_ref", "left_anti").join(equal, "item_ref", "left_anti")
    # many items and groups have the same name: each pair of a manufacturer's names is compared once
    grams = lambda df, name: df.select("manufacturer", F.col("name").alias(name)).distinct().withColumn("grams", trigrams(F.col(name)))
    left = grams(open_, "name").select("manufacturer", "name", F.size("grams").alias("n_left"), F.explode("grams").alias("gram")).hint("merge")
    right = grams(members, "other").select("manufacturer", "other", F.size("grams").alias("n_right"), F.explode("grams").alias("gram")).hint("merge")
    shared = left.join(right, ["manufacturer", "gram"]).groupBy("manufacturer", "name", "other", "n_left", "n_right").agg(F.count("*").alias("n"))
    similar = shared.withColumn("sim", F.col("n") / (F.col("n_left") + F.col("n_right") - F.col("n"))).where(F.col("sim") >= least)
    first = lambda *order: F.row_number().over(W.partitionBy("manufacturer", "name").orderBy(*order))
    # each name has a group at least, so the k best rows of names and groups are of the k best names
    near = similar.withColumn("rn", first(F.desc("sim"), "other")).where(F.col("rn") <= k).drop("rn")
    groups = members.select("manufacturer", F.col("name").alias("other"), "group_id").distinct()
    top = near.join(groups, ["manufacturer", "other"]).withColumn("rn", first(F.desc("sim"), "other", "group_id")).where(F.col("rn") <= k)
    pairs = top.select("name", "other").distinct().withColumn("score", ratio_column("token_set_ratio", F.lower("name"), F.lower("other")) / 100)
    scored = top.join(pairs, ["name", "other"])
    best = scored.groupBy("manufacturer", "name", "group_id").agg(F.max("score").alias("score")).groupBy("manufacturer", "name").agg(F.max(F.struct("score", (-F.col("group_id")).alias("minus"))).alias("x"))
    found = best.select("manufacturer", "name", (-F.col("x.minus")).alias("g_name"), F.col("x.score").alias("score"))
    named = open_.dropDuplicates(["item_ref"]).join(found, ["manufacturer", "name"]).select("item_ref", "g_name", "score")
    joined = items.join(linked, "item_ref", "left").join(equal, "item_ref", "left").join(named, "item_ref", "left")
    rung = (
        F.when(F.col("g_link").isNotNull(), "link").when(F.col("g_udi").isNotNull(), "identifier").when(F.col("score") >= accept, "name")
        .when(F.col("score") >= suggest, "suggestion").otherwise("singleton")
    )
    return joined.select(
        "item_ref", F.coalesce("g_link", "g_udi", F.when(F.col("score") >= suggest, F.col("g_name"))).alias("group_id"), rung.alias("rung"), F.round("score", 4).alias("score")
    )
