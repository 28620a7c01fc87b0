"""How complete an item's documents are: what its class asks for, the best document held, the state of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that are scored and rows that are evidence only; the number row is answered by a declaration that cites a certificate, or by the certificate.
SCORED, EVIDENCE = ("DoC", "IFU", "nb_number"), ("EC", "ISO")
#: What each class asks for, in the order of SCORED; an unknown class asks for a declaration and leaves the rest open.
BY_CLASS = {
    "I": ("required", "conditional", "not-applicable"), "Is": ("required", "conditional", "required"), "Im": ("required", "conditional", "required"), "Ir": ("required", "required", "required"),
    "IIa": ("required", "conditional", "required"), "IIb": ("required", "required", "required"), "III": ("required", "required", "required"),
}
OPEN_CLASS = ("required", "unknown", "unknown")
#: Days before an expiry that count as expiring, and the buckets that states fall into.
HORIZON = 30
BUCKETS = {
    "held": "held", "expiring": "attention", "review-due": "attention", "review": "attention", "mfr-scope-only": "attention", "class-unknown": "attention", "expired": "lapsed", "superseded": "lapsed",
    "missing": "none", "missing-exception-possible": "none", "not-required": "not_required",
}
SEVERITIES = ("none", "ok", "warn", "bad")


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def requirement(product_class: Column, row: Column) -> Column:
    """required, conditional, not-applicable, unknown or evidence."""
    known = F.trim(F.coalesce(product_class, F.lit("")))
    asked = [F.when(row == r, F.coalesce(F.element_at(_map({c: x[i] for c, x in BY_CLASS.items()}), known), F.lit(OPEN_CLASS[i]))) for i, r in enumerate(SCORED)]
    return F.coalesce(*asked, F.when(row.isin(*EVIDENCE), "evidence"))


def state_of(asked: Column, held: Column, today: Column, horizon: int = HORIZON) -> Column:
    """The state of one row. held: (doc_status, link_status, match_basis, expires, expiry_basis), null if nothing is held."""
    none = F.when(asked == "conditional", "missing-exception-possible").when(asked == "unknown", "class-unknown").when(asked == "not-applicable", "not-required").otherwise("missing")
    live = (held["doc_status"] == "production") & (held["link_status"] == "production")
    return (
        F.when(held.isNull(), none)
        .when(held["doc_status"] == "superseded", "superseded")
        .when(~F.coalesce(live, F.lit(False)), "review")
        .when(held["expires"] < today, F.when(held["expiry_basis"] == "staleness", "review-due").otherwise("expired"))
        .when(F.datediff(held["expires"], today) <= horizon, "expiring")
        .when(held["match_basis"] == "mfr-scope", "mfr-scope-only")
        .otherwise("held")
    )


def severity_of(asked: Column, state: Column) -> Column:
    """none, ok, warn or bad; evidence is never worse than warn, and without it is nothing said."""
    worst = F.when(asked == "evidence", "warn").otherwise("bad")
    missing = F.when(asked == "required", "bad").otherwise("none")
    return F.when(state == "held", "ok").when(state == "not-required", "none").when(state == "missing", missing).when(state.isin("superseded", "expired"), worst).otherwise("warn")


def bucket_of(asked: Column, state: Column) -> Column:
    """held, attention, lapsed, none or not_required; a certificate for all that a manufacturer makes is held, as it comes in no other form."""
    return F.when((asked == "evidence") & (state == "mfr-scope-only"), "held").otherwise(F.element_at(_map(BUCKETS), state))


def item_completeness(items: DataFrame, holdings: DataFrame, today: Column, horizon: int = HORIZON) -> DataFrame:
    """(item_ref, manufacturer, row, requirement, scored, doc_id, state, severity, bucket): five rows for each medical item.

    items: (item_ref, manufacturer, product_class, md_flag); holdings: (item_ref, doc_id, type, doc_status, link_status, match_basis,
    expires, expiry_basis, cert_number), where doc_status is the document's for this item. Of several documents of a type the best is looked at: published on
    the article, published for the manufacturer, open, superseded; of equal ones that with the smallest number.
    """
    published = (F.col("doc_status") == "production") & (F.col("link_status") == "production")
    rank = F.when(F.col("doc_status") == "superseded", 0).when(published & ~F.coalesce(F.col("match_basis") == "mfr-scope", F.lit(False)), 3).when(published, 2).otherwise(1)
    facts = F.struct("doc_id", "doc_status", "link_status", "match_basis", "expires", "expiry_basis", "cert_number")
    best = holdings.where(F.col("doc_id").isNotNull()).groupBy("item_ref", F.col("type").alias("row")).agg(F.max_by(facts, F.struct(rank.alias("rank"), (-F.col("doc_id")).alias("first"))).alias("held"))
    # one row an item, so that the number row can see the declaration and the certificate
    kinds = ("DoC", "IFU", "EC", "ISO")
    held = best.where(F.col("row").isin(*kinds)).groupBy("item_ref").agg(*[F.max_by("held", F.when(F.col("row") == k, 1)).alias(k) for k in kinds])
    number = F.when(F.coalesce(F.col("DoC.cert_number"), F.lit("")) != "", F.col("DoC")).otherwise(F.col("EC"))
    rows = [F.struct(F.lit(r).alias("row"), (number if r == "nb_number" else F.col(r)).alias("held")) for r in (*SCORED, *EVIDENCE)]
    told = items.where("md_flag").join(held, "item_ref", "left").select("item_ref", "manufacturer", "product_class", F.explode(F.array(*rows)).alias("x"))
    told = told.select("item_ref", "manufacturer", F.col("x.row").alias("row"), requirement(F.col("product_class"), F.col("x.row")).alias("requirement"), F.col("x.held").alias("held"))
    told = told.withColumn("state", state_of(F.col("requirement"), F.col("held"), today, horizon))
    return told.select(
        "item_ref", "manufacturer", "row", "requirement", F.col("row").isin(*SCORED).alias("scored"), F.col("held.doc_id").alias("doc_id"), "state",
        severity_of(F.col("requirement"), F.col("state")).alias("severity"), bucket_of(F.col("requirement"), F.col("state")).alias("bucket"),
    )


def maker_completeness(cards: DataFrame) -> DataFrame:
    """(manufacturer, row, held, attention, lapsed, none_n, not_required, severity): the items' rows counted by bucket, with the worst severity."""
    names = {"held": "held", "attention": "attention", "lapsed": "lapsed", "none": "none_n", "not_required": "not_required"}
    worst = F.max(F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))).cast("int")
    counted = cards.groupBy("manufacturer", "row").agg(*[F.count_if(F.col("bucket") == b).alias(n) for b, n in names.items()], worst.alias("worst"))
    return counted.select("manufacturer", "row", *names.values(), F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("worst")).alias("severity"))
