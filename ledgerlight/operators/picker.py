"""Item search: numbers that hold a text, else names that are like it, ranked, with the numbers around; any number of asks at once.

Texts are looked up by grams: a number that holds the text has its rarest run of three characters, a name that is like
it has one of the rarest of its trigrams. Candidates come from a hash join on these, and only they are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.functions.text import trigram_similarity, trigrams
from ledgerlight.session import cut, shuffle_width

#: Rows shown, neighbours to each side, the least likeness of a name to a text and of two names.
CAP, NEARBY, LIKE_TEXT, LIKE_NAME = 200, 10, 0.5, 0.2


def _ordered(text: Column) -> Column:
    """The trigrams of a text's words in order, repeated ones too."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3)))))


def word_similarity(query: Column, name: Column) -> Column:
    """The best similarity of the query's trigrams with those of some run of the name's: common ones over all distinct ones.

    The best run begins and ends with a common trigram, so only these are tried.
    """
    state = F.transform(F.array(F.struct(trigrams(query).alias("own"), _ordered(name).alias("other"))), lambda s: F.struct(
        s["own"], s["other"], F.filter(F.transform(s["other"], lambda g, i: F.when(F.array_contains(s["own"], g), i)), lambda i: i.isNotNull()).alias("at")))

    def best(s: Column) -> Column:
        def score(i: Column, j: Column) -> Column:
            run = F.array_distinct(F.slice(s["other"], i + 1, j - i + 1))
            both = F.size(F.array_intersect(s["own"], run))
            return both / (F.size(s["own"]) + F.size(run) - both)

        return F.array_max(F.transform(s["at"], lambda i: F.array_max(F.transform(F.filter(s["at"], lambda j: j >= i), lambda j: score(i, j)))))

    return F.coalesce(F.get(F.transform(state, best), F.lit(0)), F.lit(0.0))


def name_score(query: Column, name: Column) -> Column:
    """word_similarity() of the name, or of it without punctuation if that is more."""
    plain = F.regexp_replace(name, r"[^\p{L}\p{N}\s]", "")
    return F.greatest(word_similarity(query, name), F.when(plain != name, word_similarity(query, plain)))


def _runs(text: Column) -> Column:
    """The distinct runs of one to three characters."""
    low = F.lower(text)
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(low))), lambda i: i + k - 1 <= F.length(low)), lambda i: F.substring(low, i, k)))))


def _ranked(found: DataFrame, cap: int, *order: Column) -> DataFrame:
    """The first `cap` rows of each ask with their rank, and how many there are; parts of an ask are cut before they meet."""
    totals = found.groupBy("ask_id").agg(F.count("*").alias("total"))
    rank = F.row_number().over(Window.partitionBy("ask_id").orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= cap).join(totals, "ask_id")


def search_items(items: DataFrame, asks: DataFrame, *, cap: int = CAP, nearby: int = NEARBY, threshold: float = LIKE_TEXT) -> DataFrame:
    """(ask_id, mode, rank, item_ref, score, total): what each ask finds among its manufacturer's items.

    items: (manufacturer, item_ref, name), asks: (ask_id, manufacturer, q). mode "number": numbers that hold the text,
    in any case, those that begin with it first (score 2, else 1). Where no number does and the text has a letter,
    mode "search": names with at least `threshold`, the closest first, then those whose whole name is closer. "nearby": the
    numbers around those that begin with the text, or around the only one that holds it. A text without letter or digit finds
    nothing; null texts, names and numbers neither. ask_id is a key. Asks for the same text of a manufacturer are answered once.

    Rows that were exploded are merged, not broadcast: the sizes that plans go by are those from before.
    """
    asked_by = asks.select("ask_id", "manufacturer", F.trim("q").alias("q")).where(F.col("q").rlike(r"[\p{L}\p{N}]")).select(F.struct("manufacturer", "q").alias("ask"), "ask_id")
    asks = asked_by.select("ask").distinct().select(F.col("ask").alias("ask_id"), "ask.manufacturer", "ask.q")
    own = items.select("manufacturer", "item_ref", "name").where(F.col("item_ref").isNotNull())
    # numbers: the text's rarest run of three characters, or all of a shorter text
    runs = own.select("manufacturer", "item_ref", F.explode(_runs(F.col("item_ref"))).alias("run")).hint("merge")
    wanted = asks.select("ask_id", "manufacturer", "q", F.explode(F.filter(_runs(F.col("q")), lambda r: F.length(r) == F.least(F.lit(3), F.length("q")))).alias("run"))
    common = runs.join(wanted.select("manufacturer", "run").distinct(), ["manufacturer", "run"], "left_semi").groupBy("manufacturer", "run").agg(F.count("*").alias("n"))
    keys = wanted.join(common, ["manufacturer", "run"], "left").groupBy("ask_id", "manufacturer", "q").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run")).alias("x")).select("ask_id", "manufacturer", "q", F.col("x.run").alias("run"))
    low, q = F.lower("item_ref"), F.lower("q")
    numbers = cut(keys.join(runs, ["manufacturer", "run"]).where(F.contains(low, q)).select("ask_id", "manufacturer", "q", "item_ref", F.when(F.startswith(low, q), 2.0).otherwise(1.0).alias("score")).distinct())
    by_number = _ranked(numbers, cap, F.desc("score"), F.col("item_ref")).select("ask_id", F.lit("number").alias("mode"), "rank", "item_ref", "score", "total")
    # the numbers around: by the outermost anchors
    starts, single = F.col("score") == 2, F.col("held") == 1
    held = numbers.groupBy("ask_id", "manufacturer").agg(
        F.count("*").alias("held"), F.min(F.when(starts, F.col("item_ref"))).alias("low"), F.max(F.when(starts, F.col("item_ref"))).alias("high"), F.min("item_ref").alias("any")
    )
    anchors = held.select("ask_id", "manufacturer", F.coalesce("low", F.when(single, F.col("any"))).alias("low"), F.coalesce("high", F.when(single, F.col("any"))).alias("high")).where("low is not null")
    around = own.select("manufacturer", "item_ref").join(anchors, "manufacturer").where("item_ref < low or item_ref > high").withColumn("side", F.when(F.col("item_ref") < F.col("low"), -1).otherwise(1))
    sides = []
    for side, order in ((-1, F.desc("item_ref")), (1, F.asc("item_ref"))):
        near = around.where(F.col("side") == side)
        sides.append(near.withColumn("n", F.row_number().over(Window.partitionBy("ask_id").orderBy(order))).where(F.col("n") <= nearby).select("ask_id", "item_ref", (F.col("n") * side).alias("rank")))
    beside = sides[0].unionByName(sides[1]).join(numbers.select("ask_id", "item_ref"), ["ask_id", "item_ref"], "left_anti")
    beside = beside.select("ask_id", F.lit("nearby").alias("mode"), "rank", "item_ref", F.lit(1.0).alias("score"), F.lit(None).cast("long").alias("total"))
    # names: a name that reaches the threshold has that share of the text's trigrams, so one of the rarest of them
    open_ = asks.join(numbers.select("ask_id").distinct(), "ask_id", "left_anti").where(F.col("q").rlike(r"\p{L}"))
    both = F.array_union(trigrams(F.col("name")), trigrams(F.regexp_replace("name", r"[^\p{L}\p{N}\s]", "")))
    grams = own.where(F.col("name").isNotNull()).select("manufacturer", "item_ref", "name", F.explode(both).alias("gram")).hint("merge")
    asked = open_.withColumn("own", trigrams(F.col("q"))).select("ask_id", "manufacturer", "q", F.size("own").alias("size"), F.explode("own").alias("gram"))
    common = grams.join(asked.select("manufacturer", "gram").distinct(), ["manufacturer", "gram"], "left_semi").groupBy("manufacturer", "gram").agg(F.count("*").alias("n"))
    told = asked.join(common, ["manufacturer", "gram"], "left").groupBy("ask_id", "manufacturer", "q", "size").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("grams"))
    prefix = F.slice("grams", F.lit(1), F.greatest(F.lit(1), F.col("size") - F.ceil(F.lit(threshold) * F.col("size")).cast("int") + 1))
    keys = told.select("ask_id", "manufacturer", "q", F.explode(prefix).alias("x")).select("ask_id", "manufacturer", "q", F.col("x.gram").alias("gram"))
    maybe = cut(keys.join(grams, ["manufacturer", "gram"]).select("ask_id", "q", "item_ref", "name").distinct())
    # texts and names recur: each pair of them is compared once, if it has enough common trigrams at all
    shared = F.size(F.array_intersect(trigrams(F.col("q")), F.array_union(trigrams(F.col("name")), trigrams(F.regexp_replace("name", r"[^\p{L}\p{N}\s]", "")))))
    pairs = maybe.select("q", "name").distinct().where(shared >= F.lit(threshold) * F.size(trigrams(F.col("q"))))
    # the rows are few bytes and much work, so that they are dealt by number, not by size
    pairs = cut(pairs).repartition(2 * shuffle_width(items.sparkSession)).select("q", "name", name_score(F.col("q"), F.col("name")).alias("score"), F.coalesce(trigram_similarity(F.col("q"), F.col("name")), F.lit(0.0)).alias("whole"))
    scored = maybe.join(pairs.where(F.col("score") >= threshold), ["q", "name"])
    by_name = _ranked(scored, cap, F.desc("score"), F.desc("whole"), F.col("item_ref")).select("ask_id", F.lit("search").alias("mode"), "rank", "item_ref", "score", "total")
    found = by_number.unionByName(by_name).unionByName(beside).withColumnRenamed("ask_id", "ask")
    return found.join(asked_by, "ask").select("ask_id", "mode", "rank", "item_ref", "score", "total")


def similar_items(items: DataFrame, asks: DataFrame, *, cap: int = CAP, threshold: float = LIKE_NAME) -> DataFrame:
    """(ask_id, rank, item_ref, score, total): the manufacturer's items whose names are like that of the asked one (ask_id, manufacturer, item_ref)."""
    own = items.select("manufacturer", "item_ref", "name").where(F.col("item_ref").isNotNull() & F.col("name").isNotNull()).withColumn("own", trigrams(F.col("name")))
    grams = own.select("manufacturer", "item_ref", "name", F.explode("own").alias("gram"))
    asked = asks.join(own, ["manufacturer", "item_ref"]).select("ask_id", "manufacturer", F.col("item_ref").alias("asked"), F.col("name").alias("q"), F.size("own").alias("size"), F.explode("own").alias("gram"))
    common = grams.join(asked.select("manufacturer", "gram").distinct(), ["manufacturer", "gram"], "left_semi").groupBy("manufacturer", "gram").agg(F.count("*").alias("n"))
    told = asked.join(common, ["manufacturer", "gram"]).groupBy("ask_id", "manufacturer", "asked", "q", "size").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("grams"))
    prefix = F.slice("grams", F.lit(1), F.greatest(F.lit(1), F.col("size") - F.ceil(F.lit(threshold) * F.col("size")).cast("int") + 1))
    keys = told.select("ask_id", "manufacturer", "asked", "q", F.explode(prefix).alias("x")).select("ask_id", "manufacturer", "asked", "q", F.col("x.gram").alias("gram"))
    maybe = keys.join(grams, ["manufacturer", "gram"]).where("item_ref <> asked").select("ask_id", "q", "item_ref", "name").distinct()
    scored = maybe.withColumn("score", trigram_similarity(F.col("q"), F.col("name"))).where(F.col("score") >= threshold)
    return _ranked(scored, cap, F.desc("score"), F.col("item_ref")).select("ask_id", "rank", "item_ref", "score", "total")


#: Words that say what kind of document it is, and how many words are looked up and shown.
STOP_WORDS = (
    "izjava", "skladnosti", "navodila", "uporabo", "uporaba", "certifikat", "novo", "declaration", "conformity", "instructions", "instruction", "certificate",
    "with", "from", "for", "the", "and", "use", "pdf", "eu", "ec", "mdr", "mdd",
)
TRIED, SHOWN = 40, 8


def suggested_words(text: Column, manufacturer: Column) -> Column:
    """The words of a document's name and first page that are worth a search: four letters, or three letters and digits mixed; no stop words, none of the manufacturer's."""
    found = lambda c: F.transform(F.filter(F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: w.rlike(r"^\p{L}{4,}$") | ((F.length(w) >= 3) & w.rlike(r"\p{N}") & w.rlike(r"\p{L}"))), F.lower)
    stop = F.concat(F.array(*[F.lit(w) for w in STOP_WORDS]), F.coalesce(found(manufacturer), F.array().cast("array<string>")))
    return F.slice(F.array_distinct(F.array_except(found(text), stop)), 1, TRIED)
