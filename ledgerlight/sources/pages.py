"""Texts of documents' pages as readers hand them on: marked, clipped to a budget, scans told apart; uploads that wait, and which source a job reads."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.sources import paged
from ledgerlight.sources.readers import check_profile, read_export

#: Characters of text that a reader takes, what says that there was more, and the least characters of a first page with text.
BUDGET, CLIPPED, LEAST_TEXT = 360_000, "\n[[truncated: document continues beyond this point]]", 20
#: Fixed value: days that an upload waits for its use.
RETENTION_DAYS = 7
SOURCES = ("csv", "bc_odata", "upload")


def clean_pages(pages: Column) -> Column:
    """Pages without NUL characters; a missing page is empty."""
    return F.transform(F.coalesce(pages, F.array().cast("array<string>")), lambda p: F.replace(F.coalesce(p, F.lit("")), F.lit("\x00"), F.lit("")))


def full_text(pages: Column, markers: bool = True) -> Column:
    """All pages, one after the other, each behind its marker."""
    clean = clean_pages(pages)
    marked = F.transform(clean, lambda p, i: F.concat(F.lit("[[page "), (i + 1).cast("string"), F.lit("]]\n"), p)) if markers else clean
    return F.array_join(marked, "\n")


def bounded_text(pages: Column, budget: int = BUDGET) -> Column:
    """(text, dropped): the text within the budget of characters, with a note where it was cut, and how many characters were."""
    cut = lambda t: F.struct(
        F.when(F.length(t) > budget, F.concat(F.substring(t, 1, budget), F.lit(CLIPPED))).otherwise(t).alias("text"), F.greatest(F.length(t) - budget, F.lit(0)).cast("long").alias("dropped")
    )
    return F.get(F.transform(F.array(full_text(pages)), cut), F.lit(0))


def is_scan(pages: Column, least: int = LEAST_TEXT) -> Column:
    """Whether the first page has next to no text, so that it is a picture; so has a document without pages."""
    first = F.coalesce(F.get(clean_pages(pages), F.lit(0)), F.lit(""))
    return F.length(F.regexp_replace(first, r"(?U)^\s+|\s+$", "")) < least


def collected_uploads(spool: DataFrame, now: datetime, days: int = RETENTION_DAYS) -> tuple[DataFrame, DataFrame]:
    """(kept, gone) of uploads (created_at, ...): those that nobody used within the days go; one without a time stays."""
    old = F.coalesce(F.col("created_at") < F.lit(now) - F.expr(f"INTERVAL {int(days)} DAYS"), F.lit(False))
    return spool.where(~old), spool.where(old)


def read_source(spark: SparkSession, payload: dict, *, profile: list[str] | None = None, imports: str | None = None, spool: DataFrame | None = None, schema: str | None = None) -> DataFrame:
    """The records that a job's payload (source, ref) names: a CSV export, a paged feed, or an upload's content by its id.

    A relative CSV path is one of the import folder's. A feed needs a schema of text columns. An upload is looked for in spool (id, filename,
    content); one that isn't there any more is an error, not an empty catalogue.
    """
    source, ref = payload.get("source"), payload["ref"]
    if source == "csv":
        local = imports and "://" not in ref and not os.path.isabs(ref)
        return read_export(spark, f"{imports.rstrip('/')}/{ref}" if local else ref, profile)
    if source == "bc_odata":
        if schema is None:
            raise ValueError("source 'bc_odata' needs a schema")
        paged.register(spark)
        return spark.read.format("paged_feed").schema(schema).option("profile", ",".join(profile or [])).load(ref)
    if source == "upload":
        if spool is None:
            raise ValueError("source 'upload' needs the spool")
        row = spool.where(F.col("id") == F.lit(ref)).select(F.col("content").cast("string").alias("content"))
        if not row.limit(1).count():
            raise LookupError(f"upload {ref} is gone: used, or collected after {RETENTION_DAYS} days")
        lines = row.select(F.explode(F.split("content", r"\r\n|\n")).alias("value"))
        found = spark.read.csv(lines.rdd.map(lambda r: r[0]), header=True, inferSchema=False).na.fill("")
        check_profile(found, profile or [])
        return found
    raise ValueError(f"unknown source {source!r}: one of {', '.join(SOURCES)}")
