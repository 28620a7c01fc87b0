"""Paged sources: a feed whose pages name the next one, as a Spark data source, and walks over numbered pages, as joins.

`PagedFeed` is registered with `register(spark)` and read with `spark.read.format("paged_feed")`. Every feed (start address) is
a partition, as only a page knows the next one; many feeds are read side by side. `walk_pages` judges pages that have
landed as rows, of any number of walks at once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from urllib.parse import urljoin
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ledgerlight.sources.readers import ProfileError

NEXT = "@odata.nextLink"


def _open(url: str) -> bytes:
    with urlopen(url) as answer:  # noqa: S310  the caller names the feed
        return answer.read()


def feed_records(start: str, get: Callable[[str], bytes] = _open, most_pages: int = 100_000) -> Iterator[dict]:
    """The records of a feed, page after page; an address may be relative to the page that names it. No record at all is an error, as is a page seen before."""
    url, seen, found = start, set(), False
    while url:
        if url in seen or len(seen) >= most_pages:
            raise ProfileError(f"{start} doesn't end: {url}")
        seen.add(url)
        body = json.loads(get(url))
        for record in body.get("value") or ():
            found = True
            yield record
        following = body.get(NEXT)
        url = urljoin(url, following) if following else None
    if not found:
        raise ProfileError(f"{start} has no records")


class _Start(InputPartition):
    def __init__(self, url: str):
        self.url = url


class _FeedReader(DataSourceReader):
    def __init__(self, columns: list[str], profile: list[str], starts: list[str]):
        self.columns, self.profile, self.starts = columns, profile, starts

    def partitions(self) -> list[InputPartition]:
        return [_Start(url) for url in self.starts]

    def read(self, partition: _Start) -> Iterator[tuple]:
        for i, record in enumerate(feed_records(partition.url)):
            if not i and (missing := sorted(set(self.profile) - set(record))):
                raise ProfileError(f"missing columns: {', '.join(missing)}")
            values = (record.get(c) for c in self.columns)
            yield tuple(v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in values)


class PagedFeed(DataSource):
    """Records as text columns. Options: path, the start addresses, one a line; profile, the columns that the first record must have, with commas between."""

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        raise ValueError("a paged feed needs a schema: spark.read.format('paged_feed').schema('a string, ...')")

    def reader(self, schema) -> DataSourceReader:
        starts = [x for x in self.options.get("path", "").split("\n") if x]
        if not starts:
            raise ValueError("option path names no feed")
        if wrong := [f.name for f in schema.fields if f.dataType.typeName() != "string"]:
            raise ValueError(f"columns of a feed are text: {', '.join(wrong)}")
        return _FeedReader(schema.names, [x for x in self.options.get("profile", "").split(",") if x], starts)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedFeed)


def walk_pages(pages: DataFrame, *, walk_col: str = "walk", page_col: str = "page", status_col: str = "status", body_col: str = "body", record: str = "variant") -> tuple[DataFrame, DataFrame]:
    """(walks, records) of landed pages, one row each, numbered from 0.

    A page is refused where its status isn't 200, its body isn't JSON, or it is empty and says itself that there should be more. It
    is the last one where it says so, where it is empty, or where it is a bare list. A walk is complete if all pages up to a
    last one are there; incomplete, with the records before, if it stops at a refused or missing page later than the
    first; failed if it stops at the first one. walks: (walk, state, pages, stopped_at, reason). records: (walk, page,
    record), of pages before the stop. Of pages with the same number the last status is taken once; nulls in walk or page have no part.
    """
    rows = pages.select(F.col(walk_col).alias("walk"), F.col(page_col).cast("long").alias("page"), F.col(status_col).cast("int").alias("status"), F.try_parse_json(F.col(body_col).cast("string")).alias("v"))
    rows = rows.where(F.col("walk").isNotNull() & (F.col("page") >= 0))
    part = lambda path, kind: F.try_variant_get("v", path, kind)
    listed = F.schema_of_variant("v").startswith("ARRAY")
    told = rows.select(
        "walk", "page", "status", F.col("v").isNotNull().alias("json"), F.coalesce(part("$.content", "array<variant>"), F.when(listed, part("$", "array<variant>")), F.array().cast("array<variant>")).alias("content"),
        part("$.last", "boolean").alias("last"), part("$.totalElements", "long").alias("total"), part("$.number", "long").alias("number"), part("$.totalPages", "long").alias("of"),
    )
    empty = F.size("content") == 0
    more = F.coalesce(~F.col("last"), F.lit(False)) | F.coalesce((F.col("total") > 0) & F.coalesce(F.col("number") < F.col("of") - 1, F.lit(True)), F.lit(False))
    reason = F.when(F.coalesce(F.col("status") != 200, F.lit(True)), F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("unknown")))).when(~F.col("json"), "not JSON").when(empty & more, "empty against its own count")
    told = told.select("walk", "page", "content", reason.alias("reason"), (empty | F.coalesce("last", F.lit(True))).alias("ends"))
    facts = told.groupBy("walk", "page").agg(F.max("reason").alias("reason"), F.max("ends").alias("ends"))
    # where a walk stops: its first refused page, its first last page, or behind the first page without a next one
    following = facts.select("walk", (F.col("page") - 1).alias("page"), F.lit(True).alias("next"))
    joined = facts.join(following, ["walk", "page"], "left")
    stop = (
        F.when(F.col("reason").isNotNull(), F.struct("page", F.lit(0).alias("rank"), F.col("reason").alias("why")))
        .when(F.col("ends"), F.struct("page", F.lit(1).alias("rank"), F.lit("last").alias("why")))
        .when(F.col("next").isNull(), F.struct((F.col("page") + 1).alias("page"), F.lit(2).alias("rank"), F.lit("missing").alias("why")))
    )
    stops = joined.groupBy("walk").agg(F.min(stop).alias("stop"), F.min("page").alias("first"))
    begun = F.when(F.col("first") > 0, F.struct(F.lit(0).cast("long").alias("page"), F.lit(2).alias("rank"), F.lit("missing").alias("why"))).otherwise(F.col("stop"))
    stops = stops.select("walk", begun.alias("stop")).select("walk", F.col("stop.page").alias("stopped_at"), F.col("stop.why").alias("reason"))
    complete = F.col("reason") == "last"
    walks = stops.select("walk", F.when(complete, "complete").when(F.col("stopped_at") > 0, "incomplete").otherwise("failed").alias("state"), (F.col("stopped_at") + F.when(complete, 1).otherwise(0)).alias("pages"), "stopped_at", "reason")
    kept = told.join(walks.select("walk", "pages"), "walk").where("page < pages").dropDuplicates(["walk", "page"])
    cast = F.col("record") if record == "variant" else F.try_variant_get("record", "$", record)
    return walks, kept.select("walk", "page", F.explode("content").alias("record")).select("walk", "page", cast.alias("record"))
