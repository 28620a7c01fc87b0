"""Printed references, registration numbers and basic identifiers, as Spark expressions and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.functions import identifiers, text
from ledgerlight.session import cut

#: The two spellings of one code (shank figure size; figure.shank.size), a variant suffix, a registration number of
#: manufacturers, and what stands before a basic identifier.
SPACED = r"^([0-9]{3})\s+([A-Za-z0-9]{1,10})\s+([0-9]{1,3})\z"
DOTTED = r"^([A-Za-z]{0,3}[0-9]{0,4})\.([0-9]{3})\.([0-9]{1,3})\z"
VARIANT = r"\.[A-Za-z][A-Za-z0-9]{0,2}\z"
REGISTRATION = r"\b[A-Z]{2}-MF-[0-9]{9}\b"
BASIC_LABEL = r"(?i)basic[\s-]*udi[\s-]*di\s*(?:\([^)]*\))?\s*:?\s*([A-Za-z0-9+]{6,40})"
BASIC_CONFIDENCE = {"VALID": 1.0, "UNSCORABLE": 0.9, "INVALID": 0.3}
#: The least length of the shorter side of two numbers that differ by a prefix.
LEAST_PRINTED, LEAST_OWN = 4, 5
KINDS = ("exact", "zeros", "prefix")


def fold_code(ref: Column) -> Column:
    """FIGURE.SHANK.SIZE with three digits of size for either spelling; anything else as it is."""
    bare = F.trim(ref)

    def code(pattern: str, figure: int, shank: int) -> Column:
        part = lambda n: F.regexp_extract(bare, pattern, n)
        return F.concat_ws(".", F.upper(part(figure)), part(shank), F.lpad(part(3), 3, "0"))

    return F.when(bare.rlike(SPACED), code(SPACED, 2, 1)).when(bare.rlike(DOTTED), code(DOTTED, 1, 2)).otherwise(ref)


def register_key(ref: Column) -> Column:
    """A register's spelling: fold_code() without a variant suffix, which begins with a letter."""
    return fold_code(F.regexp_replace(ref, VARIANT, ""))


def normalise_ref(ref: Column, strategy: Column, max_letters: int = 3) -> Column:
    """By a manufacturer's strategy: strip-trailing-letters, reorder-shank-figure-size, or (null, others) as it is."""
    digits = F.regexp_extract(ref, rf"^([0-9]+)[A-Za-z]{{1,{max_letters}}}\z", 1)
    return (
        F.when((strategy == "strip-trailing-letters") & (digits != ""), digits)
        .when(strategy == "reorder-shank-figure-size", fold_code(ref))
        .otherwise(ref)
    )


def registrations(content: Column) -> Column:
    """The distinct registration numbers of a text."""
    return F.array_distinct(F.regexp_extract_all(content, F.lit(REGISTRATION), F.lit(0)))


def basic_identifier(content: Column) -> Column:
    """What follows the first label that isn't followed by a mere word; null if there is none."""
    values = F.regexp_extract_all(content, F.lit(BASIC_LABEL), F.lit(1))
    return F.get(F.filter(values, lambda v: (identifiers.agency(v) != "unknown") | v.rlike("[0-9]")), F.lit(0))


def basic_confidence(value: Column) -> Column:
    """How sure a printed basic identifier is, by its check characters."""
    verdict = identifiers.verdict(value)
    return F.when(value.isNotNull(), F.element_at(F.create_map(*[F.lit(x) for kv in BASIC_CONFIDENCE.items() for x in kv]), verdict))


def bare_key(ref: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(ref, F.lit("")), "[^0-9A-Za-z]", ""))


def _tails(key: Column, least: int) -> Column:
    """The ends of key that are shorter than it and have at least that many characters."""
    starts = F.sequence(F.lit(2), F.length(key) - least + 1)
    return F.when(F.length(key) > least, F.transform(starts, lambda i: F.substring(key, i, F.length(key)))).otherwise(F.array().cast("array<string>"))


def near_matches(printed: DataFrame, items: DataFrame) -> DataFrame:
    """(manufacturer, printed_ref, item_ref, kind): the strongest kind by which a printed number matches an item of its manufacturer.

    printed: (manufacturer, printed_ref); items: (manufacturer, item_ref, mfr_ref). Numbers are compared by letters and digits,
    with the item's own number and its manufacturer's: exact, but for leading zeros, or one the end of the other. Both sides give
    every key by which they can meet, so that one equi-join finds all; null manufacturers match nothing.
    """
    probe = lambda table, key, rank=0: F.struct(F.lit(table).alias("t"), key.alias("k"), F.lit(rank).alias("rank"))
    stripped = F.regexp_replace("key", "^0+", "")

    own = items.select("manufacturer", "item_ref", F.explode(F.array(bare_key(F.col("item_ref")), bare_key(F.col("mfr_ref")))).alias("key"))
    own = own.where("key <> ''").distinct()
    tails = F.transform(_tails(F.col("key"), LEAST_PRINTED), lambda x: probe("tail", x))
    own = own.select("manufacturer", "item_ref", F.explode(F.concat(F.array(probe("own", F.col("key")), probe("zeros", stripped)), tails)).alias("p"))
    own = own.select("manufacturer", "item_ref", "p.t", "p.k").where("k <> ''").distinct()

    asked = printed.select("manufacturer", "printed_ref").distinct().withColumn("key", bare_key(F.col("printed_ref"))).where("key <> ''")
    ends = F.transform(_tails(F.col("key"), LEAST_OWN), lambda x: probe("own", x, 2))
    first = F.array(probe("own", F.col("key"), 0), probe("zeros", stripped, 1))
    whole = F.when(F.length("key") >= LEAST_PRINTED, F.array(probe("tail", F.col("key"), 2))).otherwise(F.array().cast("array<struct<t:string,k:string,rank:int>>"))
    asked = asked.select("manufacturer", "printed_ref", F.explode(F.concat(first, whole, ends)).alias("p"))
    asked = asked.select("manufacturer", "printed_ref", "p.t", "p.k", "p.rank").where("k <> ''")

    # a merge: the sizes that plans go by don't know how many keys a row gives, so that all of own could be broadcast
    met = asked.join(own.hint("merge"), ["manufacturer", "t", "k"]).groupBy("manufacturer", "printed_ref", "item_ref").agg(F.min("rank").alias("rank"))
    return met.select("manufacturer", "printed_ref", "item_ref", F.element_at(F.array(*map(F.lit, KINDS)), F.col("rank") + 1).alias("kind"))


def attribute_actors(actors: DataFrame, aliases: DataFrame, floor: float = 88.0) -> DataFrame:
    """(actor, canonical, via, score) for each distinct actor name: the manufacturer whose alias it is, or is nearly.

    actors: (actor); aliases: (canonical, alias). Names are folded without legal forms. An equal fold is `exact`, else the
    best token-sort ratio of at least `floor` is `fuzzy`; the smaller canonical name wins ties; else canonical is null.

    Names with such a ratio share bigrams, at least one more than a name can lose by that many edits; so names are compared only if they
    share one of their rarest bigrams, as many as leave fewer out than must be shared (prefix filter): no pair is missed.
    """
    r = floor / 100
    if not 0.85 <= r <= 1:
        raise ValueError("names of a ratio under 85 need not share a bigram")
    tokens = F.array_join(F.array_sort(F.split("fold", " ")), " ")
    # folded once: they are used in several branches
    own = cut(actors.select("actor").distinct().withColumn("fold", text.fold_actor_column(F.col("actor"))))
    known = cut(aliases.select("canonical", text.fold_actor_column(F.col("alias")).alias("fold")).where("fold <> ''").distinct())
    asked = own.where("fold <> ''").select("fold").distinct()
    exact = asked.join(known, "fold").groupBy("fold").agg(F.min("canonical").alias("canonical"))

    left = asked.join(exact, "fold", "left_anti").select(F.lit(0).alias("side"), tokens.alias("name"))
    names = left.unionByName(known.select(F.lit(1).alias("side"), tokens.alias("name"))).distinct().where("length(name) > 1")
    pieces = F.transform(F.sequence(F.lit(1), F.length("name") - 1), lambda i: F.substring(F.col("name"), i, F.lit(2)))
    listed = names.withColumn("g", pieces)
    # a bigram that comes twice counts as two
    numbered = F.transform("g", lambda x, i: F.concat(x, F.size(F.filter(F.slice("g", F.lit(1), i + 1), lambda y: y == x)).cast("string")))
    grams = listed.select("side", "name", F.explode(numbered).alias("gram"))
    ranked = cut(grams.join(grams.groupBy("gram").agg(F.count("*").alias("n")), "gram"))
    at = F.row_number().over(Window.partitionBy("side", "name").orderBy("n", "gram"))
    size = F.length("name")
    lost = F.floor((1 - r) * (size + F.floor(size * (2 - r) / r + 1e-9)) + 1e-9)
    kept = ranked.withColumn("at", at).where(F.col("at") <= size - F.greatest(F.lit(1), size - 1 - 2 * lost))
    mine, theirs = kept.where("side = 0").select("name", "gram"), kept.where("side = 1").select(F.col("name").alias("other"), "gram")
    pairs = mine.join(theirs, "gram").select("name", "other").distinct()
    scored = pairs.withColumn("score", text.ratio_column("ratio", F.col("name"), F.col("other"))).where(F.col("score") >= floor)
    best = scored.join(known.select("canonical", tokens.alias("other")), "other").groupBy("name").agg(F.min(F.struct((-F.col("score")).alias("s"), "canonical")).alias("b"))

    out = own.join(exact.select("fold", F.col("canonical").alias("same")), "fold", "left").withColumn("name", tokens).join(best, "name", "left")
    return out.select(
        "actor", F.coalesce("same", "b.canonical").alias("canonical"),
        F.when(F.col("same").isNotNull(), "exact").when(F.col("b").isNotNull(), "fuzzy").alias("via"),
        F.when(F.col("same").isNotNull(), 100.0).otherwise(F.round(-F.col("b.s"), 4)).alias("score"),
    )
