"""Leases of hosts: the batch and the stream against one request after the other."""

import random

from ledgerlight.streaming import leases

SCHEMA = "domain string, id long, at long"


def one_by_one(rows, floors):
    until, out = {}, set()
    for d, i, at in sorted((r for r in rows if r[0] and r[2] is not None), key=lambda r: (r[0], r[2], r[1])):
        ok = until.get(d, at) <= at
        if ok:
            until[d] = at + max(2000, floors.get(d, 0))
        out.add((d, i, at, ok, until[d]))
    return out


def made():
    rng = random.Random(4)
    rows, i = [], 0
    for d, n, step in (("a", 300, 400), ("b", 40, 5000), ("slow", 120, 900), ("once", 1, 1)):
        at = 0
        for _ in range(n):
            at += rng.choice([0, step // 2, step, 3 * step])
            rows.append((d, i, at))
            i += 1
    return [*rows, (None, i, 5), ("a", i + 1, None)], {"slow": 7000, "b": 100}


def test_batch_grants_as_one_after_the_other(spark):
    rows, floors = made()
    limits = spark.createDataFrame([*floors.items(), ("slow", 10), ("other", None)], "domain string, min_politeness_ms long")
    got = leases.grant_leases(spark.createDataFrame(rows, SCHEMA).repartition(5), limits)
    assert set(map(tuple, got.collect())) == one_by_one(rows, floors)
    plain = leases.grant_leases(spark.createDataFrame(rows, SCHEMA))
    assert set(map(tuple, plain.collect())) == one_by_one(rows, {})


def test_stream_grants_as_the_batch(spark, tmp_path):
    rows, floors = made()
    rows = sorted(rows, key=lambda r: r[2] or 0)
    parts = [rows[i : i + 150] for i in range(0, len(rows), 150)]
    # a micro-batch takes what has come by then, and times don't go back from one to the next
    edges = [p[-1][2] for p in parts[:-1]]
    parts = [[r for r in rows if sum((r[2] or 0) > e for e in edges) == k] for k in range(len(parts))]
    limits = spark.createDataFrame(list(floors.items()), "domain string, min_politeness_ms long")
    (tmp_path / "in").mkdir()
    stream = leases.lease_stream(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), limits)
    query = stream.writeStream.format("memory").queryName("leases").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").start()
    try:
        for p in parts:
            spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            query.processAllAvailable()
        got = set(map(tuple, spark.table("leases").collect()))
    finally:
        query.stop()
    assert got == one_by_one(rows, floors)
