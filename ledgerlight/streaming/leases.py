"""Politeness leases of hosts: a request is granted if the host's last lease has run out, and takes the next one.

The stream form keeps one number for each host, when its lease runs out; the batch form gives the same answers for requests that
are all there: they go by host, in order of time, through tasks that carry that number along. A quiet time as long as the host's gap ends every
lease, so that a host's requests are cut there into runs of their own, which other tasks can take; only finding these cuts is a sort of all of a host's requests, which spills.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Fixed value: milliseconds between two requests to a host that asks for no more.
POLITENESS_MS = 2000
ANSWER = "domain string, id long, at long, granted boolean, leased_until long"


def gap_of(floor: Column, politeness_ms: int = POLITENESS_MS) -> Column:
    """What is held: the general politeness, or the host's own floor if that is longer."""
    return F.greatest(F.lit(politeness_ms).cast("long"), F.coalesce(floor.cast("long"), F.lit(0).cast("long")))


def with_gaps(requests: DataFrame, floors: DataFrame | None, politeness_ms: int = POLITENESS_MS) -> DataFrame:
    """(domain, id, at, gap) of requests (domain, id, at in milliseconds) and floors (domain, min_politeness_ms)."""
    told = requests.select("domain", F.col("id").cast("long").alias("id"), F.col("at").cast("long").alias("at")).where(F.col("domain").isNotNull() & F.col("at").isNotNull())
    if floors is None:
        return told.withColumn("gap", gap_of(F.lit(None), politeness_ms))
    return told.join(floors.groupBy("domain").agg(F.max("min_politeness_ms").alias("floor")), "domain", "left").select("domain", "id", "at", gap_of(F.col("floor"), politeness_ms).alias("gap"))


def _granted(rows: pd.DataFrame, until: int | None) -> tuple[pd.DataFrame, int | None]:
    """The answers to one host's requests in order, and when the last lease runs out."""
    granted, ends = [], []
    for at, gap in zip(rows["at"], rows["gap"], strict=True):
        ok = until is None or until <= at
        if ok:
            until = int(at) + int(gap)
        granted.append(ok)
        ends.append(until)
    return rows[["domain", "id", "at"]].assign(granted=granted, leased_until=ends), until


def grant_leases(requests: DataFrame, floors: DataFrame | None = None, politeness_ms: int = POLITENESS_MS) -> DataFrame:
    """(domain, id, at, granted, leased_until) of each request, in order of time and id."""
    told = with_gaps(requests, floors, politeness_ms)
    # where a host was quiet for as long as its gap nothing is carried over
    before = F.lag("at").over(Window.partitionBy("domain").orderBy("at", "id"))
    cut = told.withColumn("opens", (before.isNull() | (F.col("at") - before >= F.col("gap"))).cast("int"))
    run = F.sum("opens").over(Window.partitionBy("domain").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0))

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, until = None, None
        for frame in frames:
            for own, rows in frame.groupby(["domain", "run"], sort=False):
                if own != key:
                    key, until = own, None
                out, until = _granted(rows, until)
                yield out

    dealt = cut.withColumn("run", run).drop("opens").repartition("domain", "run").sortWithinPartitions("domain", "run", "at", "id")
    return dealt.mapInPandas(judge, ANSWER)


def lease_stream(requests: DataFrame, floors: DataFrame | None = None, politeness_ms: int = POLITENESS_MS) -> DataFrame:
    """The same for a stream of requests; those of one micro-batch are judged in order of time, an older one that comes later when it comes."""

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(["at", "id"])
        out, until = _granted(rows, state.get[0] if state.exists else None)
        state.update((until,))
        yield out

    told = with_gaps(requests, floors, politeness_ms)
    return told.groupBy("domain").applyInPandasWithState(judge, ANSWER, "leased_until long", "append", GroupStateTimeout.NoTimeout)
