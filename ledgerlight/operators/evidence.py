"""Merging readings of a document's fields into one evidenced value each.

Reads of one (document, field) are folded in step order, as the rule isn't associative: a blank never replaces a
value; of two model reads with equal values the surer one stays (the first one on a tie); a list is never replaced by
a shorter one, and a longer one replaces unless the list in place is settled; otherwise the stronger step stays and
of equal steps the later one. A group holds one document's reads of one field and is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The strength of each step.
RANK = {"T0-guess": 0, "T1-second": 1, "doc-class": 1, "T1": 2, "T2-second": 3, "T2-first": 4, "T2": 5, "T0": 6}
SETTLED = 0.95


def strength(tier: Column, conf: Column) -> Column:
    named = F.element_at(F.create_map(*[F.lit(x) for kv in RANK.items() for x in kv]), tier)
    return F.when(tier == "T0", F.when(F.coalesce(conf, F.lit(0.0)) >= SETTLED, RANK["T0"]).otherwise(RANK["T0-guess"])).otherwise(F.coalesce(named, F.lit(0)))


def better(held: Column, new: Column, listed: Column) -> Column:
    """Which of two reads stays; listed: whether the field holds a list, with commas between."""
    blank = lambda r: F.coalesce(r["value"], F.lit("")) == ""
    conf = lambda r: F.coalesce(r["conf"], F.lit(0.0))
    model = (F.coalesce(held["tier"], F.lit("")) != "T0") & (F.coalesce(new["tier"], F.lit("")) != "T0")
    same = F.upper(F.trim(held["value"])) == F.upper(F.trim(new["value"]))
    longer = F.size(F.split(new["value"], ",")) - F.size(F.split(held["value"], ","))
    settled = (held["tier"] == "T0") & (conf(held) >= SETTLED)
    return (
        F.when(blank(new), held)
        .when(blank(held), new)
        .when(model & same, F.when(conf(new) > conf(held), new).otherwise(held))
        .when(listed & ((longer < 0) | ((longer > 0) & F.coalesce(settled, F.lit(False)))), held)
        .when(listed & (longer > 0), new)
        .when(strength(new["tier"], new["conf"]) >= strength(held["tier"], held["conf"]), new)
        .otherwise(held)
    )


def merge_reads(reads: DataFrame) -> DataFrame:
    """(doc_id, field, value, tier, conf, reads) from rows (doc_id, field, step, value, tier, conf)."""
    read = F.struct("step", "tier", "value", F.col("conf").cast("double").alias("conf"))
    grouped = reads.groupBy("doc_id", "field").agg(F.array_sort(F.collect_list(read)).alias("reads"))
    listed = F.col("field") == "ref_list"
    folded = F.aggregate(F.slice("reads", 2, F.size("reads")), F.get("reads", F.lit(0)), lambda held, new: better(held, new, listed))
    told = grouped.select("doc_id", "field", folded.alias("x"), F.size("reads").cast("long").alias("reads"))
    return told.select("doc_id", "field", "x.value", "x.tier", "x.conf", "reads")
