"""How sure the readings of a document are: each read calibrated, two agreeing reads combined, the document's score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields that a document must have, the least calibrated confidence of a read that may confirm another one, and tiers whose reads cite a page.
REQUIRED, AGREEMENT_MIN, CITING = ("type", "regulation", "coverage_scope"), 0.70, ("T1", "T2")
#: What marks a regulation that its citation proves, and a scope that was derived from the type.
CITATION, FROM_TYPE = "citation", "type"


def combined(a: Column, b: Column) -> Column:
    return 1 - (1 - a) * (1 - b)


def calibrated(conf: Column, factor: Column) -> Column:
    """A confidence times its model's factor, between 0 and 1; without a factor as it is."""
    return F.when(conf.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), conf * F.coalesce(factor, F.lit(1.0)))))


def with_factors(evidence: DataFrame, factors: DataFrame) -> DataFrame:
    """evidence with own_factor and agreed_factor; factors: (model_id, field, factor), field `*` for all that have none of their own."""
    known = factors.groupBy("model_id", "field").agg(F.max("factor").alias("factor"))
    out = evidence
    for side, model in (("own", "model_id"), ("agreed", "agreed_model_id")):
        exact = known.where("field <> '*'").select(F.col("model_id").alias(f"__{side}_m"), F.col("field").alias(f"__{side}_f"), F.col("factor").alias(f"__{side}_exact"))
        any_ = known.where("field = '*'").select(F.col("model_id").alias(f"__{side}_n"), F.col("factor").alias(f"__{side}_any"))
        out = out.join(exact, (F.col(model) == F.col(f"__{side}_m")) & (F.col("field") == F.col(f"__{side}_f")), "left").join(any_, F.col(model) == F.col(f"__{side}_n"), "left")
        out = out.withColumn(f"{side}_factor", F.coalesce(f"__{side}_exact", f"__{side}_any")).drop(*[f"__{side}_{x}" for x in ("m", "f", "exact", "n", "any")])
    return out


def confidences(evidence: DataFrame, factors: DataFrame, agreement_min: float = AGREEMENT_MIN) -> DataFrame:
    """evidence with scored and stored: the confidence that a score takes, and the one that is kept.

    evidence: (field, conf, model_id, agreed_conf, agreed_model_id, proven, ...). A read without a model counts as it is. A model's regulation that its
    citation proves is 1. Two agreeing reads that are both sure enough after calibration are combined: scored from the calibrated numbers, stored
    from the raw ones. Else a read counts by its own number, calibrated for the score. What isn't a number is null and never passes.
    """
    told = with_factors(evidence, factors)
    model = F.col("model_id").isNotNull() & (F.col("model_id") != "")
    own = calibrated(F.col("conf"), F.when(model, F.col("own_factor")))
    second = model & F.col("agreed_model_id").isNotNull() & (F.col("agreed_model_id") != "") & F.col("agreed_conf").isNotNull()
    agreed = calibrated(F.col("agreed_conf"), F.col("agreed_factor"))
    told = told.withColumns({"own": own, "agreed": F.when(second, agreed)})
    proven = model & (F.col("field") == "regulation") & (F.col("proven") == CITATION) & F.col("own").isNotNull()
    both = (F.col("own") >= agreement_min) & (F.col("agreed") >= agreement_min)
    scored = F.when(proven, 1.0).when(both, combined(F.col("own"), F.col("agreed"))).otherwise(F.col("own"))
    stored = F.when(proven, 1.0).when(both, combined(F.col("conf"), F.col("agreed_conf"))).otherwise(F.col("conf"))
    return told.withColumns({"scored": scored, "stored": stored}).drop("own", "agreed", "own_factor", "agreed_factor")


def scores(judged: DataFrame) -> DataFrame:
    """(doc_id, score, complete, page_missing) of confidences() with (doc_id, value, verbatim, tier, page, follows).

    The score is the least confidence of the required fields, but for a scope that was derived from the type. A document is complete if each of them has a value, a
    quote, a tier and a number; page_missing: some model's read of them cites no page.
    """
    needed = judged.where(F.col("field").isin(*REQUIRED))
    whole = (F.coalesce(F.col("value"), F.lit("")) != "") & (F.coalesce(F.col("verbatim"), F.lit("")) != "") & (F.coalesce(F.col("tier"), F.lit("")) != "") & F.col("conf").isNotNull()
    derived = F.coalesce((F.col("field") == "coverage_scope") & (F.col("follows") == FROM_TYPE), F.lit(False))
    told = needed.groupBy("doc_id").agg(
        F.min(F.when(~derived, F.coalesce("scored", F.lit(0.0)))).alias("score"), F.countDistinct(F.when(whole, F.col("field"))).alias("fields"), F.max(F.col("tier").isin(*CITING) & F.col("page").isNull()).alias("page_missing")
    )
    return told.select("doc_id", "score", (F.col("fields") == len(REQUIRED)).alias("complete"), F.coalesce("page_missing", F.lit(False)).alias("page_missing"))
