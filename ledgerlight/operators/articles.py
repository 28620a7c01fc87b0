"""How a catalogue's articles stand against a device register: what is registered, and what is declared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.references import fold_code, register_key

#: Fixed value: the strategy of manufacturers whose register spells a reference another way.
REORDER = "reorder-shank-figure-size"
#: A declaration's type, and the states of one that counts for a published link.
DECLARATION, PUBLISHED = "DoC", ("production", "superseded")


def own_key(ref: Column, strategy: Column) -> Column:
    return F.when(strategy == REORDER, fold_code(ref)).otherwise(ref)


def device_key(reference: Column, strategy: Column) -> Column:
    return F.when(strategy == REORDER, register_key(reference)).otherwise(reference)


def article_status(items: DataFrame, members: DataFrame, groups: DataFrame, actors: DataFrame, rules: DataFrame, devices: DataFrame, links: DataFrame, documents: DataFrame) -> DataFrame:
    """(item_ref, canonical_name, basic_udi_di, trade_name, registered, has_production, has_staged): medical articles of manufacturers with a trusted registration.

    items: (item_ref, mfr_ref, md_flag); members: (group_id, item_ref); groups: (group_id, canonical_name); actors: trusted
    (canonical_name, srn); rules: (canonical_name, strategy); devices: (basic_udi_di, reference, trade_name, srn); links: (item_ref,
    doc_id, status); documents: (doc_id, type, status).
    An article is looked for by its manufacturer's reference, or its own number without one, as the manufacturer's rule spells
    it, and has a row for each basic identifier that it is registered under, or one without. It is declared where a production link leads to a
    production or superseded declaration, staged where a staged link leads to a declaration of any state; retracted links count for nothing,
    and an article without links stays. Nulls match nothing, but a basic identifier may be null.
    """
    trusted = actors.select("canonical_name", "srn").where(F.col("canonical_name").isNotNull() & F.col("srn").isNotNull()).distinct()
    named = members.join(groups, "group_id").select("item_ref", "canonical_name").join(trusted.select("canonical_name").distinct(), "canonical_name", "left_semi")
    own = items.where(F.col("md_flag")).select("item_ref", "mfr_ref").join(named, "item_ref").distinct().join(rules, "canonical_name", "left")
    own = own.select("item_ref", "canonical_name", own_key(F.coalesce("mfr_ref", "item_ref"), F.col("strategy")).alias("key"))
    known = devices.join(trusted, "srn").join(rules, "canonical_name", "left").select("canonical_name", device_key(F.col("reference"), F.col("strategy")).alias("key"), "basic_udi_di", "trade_name")
    # devices of one article and basic identifier differ in their trade names only
    known = known.groupBy("canonical_name", "key", "basic_udi_di").agg(F.max("trade_name").alias("trade_name"))
    found = own.join(known, ["canonical_name", "key"]).groupBy("item_ref", "basic_udi_di").agg(F.max("trade_name").alias("trade_name"))
    declared = documents.where(F.col("type") == DECLARATION).select("doc_id", F.col("status").alias("doc_status"))
    held = links.where(F.col("status").isin("production", "staged")).join(declared, "doc_id").groupBy("item_ref").agg(
        F.max((F.col("status") == "production") & F.col("doc_status").isin(*PUBLISHED)).alias("has_production"), F.max(F.col("status") == "staged").alias("has_staged")
    )
    rows = own.select("item_ref", "canonical_name").distinct().join(found.withColumn("registered", F.lit(True)), "item_ref", "left").join(held, "item_ref", "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return rows.select("item_ref", "canonical_name", "basic_udi_di", "trade_name", flag("registered"), flag("has_production"), flag("has_staged"))


def declaration_gap(articles: DataFrame, scoped: DataFrame | None = None) -> DataFrame:
    """(canonical_name, basic_udi_di, articles, staged, mfr_scope_covered, trade_name): registered articles without a published declaration, by basic identifier.

    scoped: (canonical_name) of manufacturers with a published document for all that they make.
    """
    open_ = articles.where("registered").groupBy("canonical_name", "basic_udi_di").agg(
        F.count_if(~F.col("has_production")).alias("articles"), F.count_if(~F.col("has_production") & F.col("has_staged")).alias("staged"), F.max("trade_name").alias("trade_name")
    ).where("articles > 0")
    if scoped is None:
        return open_.select("canonical_name", "basic_udi_di", "articles", "staged", F.lit(False).alias("mfr_scope_covered"), "trade_name")
    marked = open_.join(scoped.select("canonical_name", F.lit(True).alias("scoped")).distinct(), "canonical_name", "left")
    return marked.select("canonical_name", "basic_udi_di", "articles", "staged", F.coalesce("scoped", F.lit(False)).alias("mfr_scope_covered"), "trade_name")


def gap_summary(articles: DataFrame) -> DataFrame:
    """(canonical_name, covered, staged, missing, not_registered): numbers of articles."""
    count = lambda c, name: F.countDistinct(F.when(F.expr(c), F.col("item_ref"))).alias(name)
    return articles.groupBy("canonical_name").agg(
        count("registered and has_production", "covered"), count("registered and not has_production and has_staged", "staged"), count("registered and not has_production and not has_staged", "missing"), count("not registered", "not_registered")
    )
