"""Paged feeds and walks over landed pages."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerlight.sources import paged


def feed(folder, name, *pages, key="value"):
    for i, rows in enumerate(pages):
        body = {key: rows} | ({paged.NEXT: f"{name}-{i + 1}.json"} if i + 1 < len(pages) else {})
        (folder / f"{name}-{i}.json").write_text(json.dumps(body))
    return f"file://{folder}/{name}-0.json"


def test_feed_follows_its_own_links(spark, tmp_path):
    paged.register(spark)
    a = feed(tmp_path, "a", [{"No": "1", "Name": "x", "n": 5}, {"No": "2"}], [], [{"No": "3", "Name": "ž", "extra": 1}])
    b = feed(tmp_path, "b", [{"No": "9", "Name": None}])
    df = spark.read.format("paged_feed").schema("No string, Name string, n string").option("profile", "No").load(f"{a}\n{b}")
    assert sorted(map(tuple, df.collect()), key=repr) == [("1", "x", "5"), ("2", None, None), ("3", "ž", None), ("9", None, None)]
    assert df.rdd.getNumPartitions() == 2


@pytest.mark.parametrize("pages,profile,says", [([[]], "", "no records"), ([[], []], "", "no records"), ([[{"No": "1"}]], "No,Name", "missing columns: Name")])
def test_feed_refuses(spark, tmp_path, pages, profile, says):
    paged.register(spark)
    start = feed(tmp_path, "x", *pages)
    with pytest.raises(Exception, match=says):
        spark.read.format("paged_feed").schema("No string").option("profile", profile).load(start).collect()


def test_feed_refuses_circles_and_missing_pages(tmp_path):
    loop = {"a": {"value": [{"x": "1"}], paged.NEXT: "b"}, "b": {"value": [], paged.NEXT: "a"}}
    with pytest.raises(paged.ProfileError, match="doesn't end"):
        list(paged.feed_records("a", lambda u: json.dumps(loop[u]).encode()))
    with pytest.raises(OSError):
        list(paged.feed_records(f"file://{tmp_path}/none.json"))


def page(content, **more):
    return json.dumps({"content": content} | more)


WALKS = {
    # walk: pages (number, status, body); state, pages kept, stopped_at, reason, records
    "whole": ([(0, 200, page([1, 2], last=False)), (1, 200, page([3], last=True))], ("complete", 2, 1, "last"), [1, 2, 3]),
    "throttled": ([(0, 200, page([1], last=False)), (1, 200, page([], last=False, totalElements=9, totalPages=3, number=1))], ("incomplete", 1, 1, "empty against its own count"), [1]),
    "counted": ([(0, 200, page([1], last=False)), (1, 200, page([], totalElements=9, totalPages=3, number=1))], ("incomplete", 1, 1, "empty against its own count"), [1]),
    "end": ([(0, 200, page([1], last=False)), (1, 200, page([], totalElements=9, totalPages=2, number=1))], ("complete", 2, 1, "last"), [1]),
    "nothing": ([(0, 200, page([], last=True, totalElements=0))], ("complete", 1, 0, "last"), []),
    "bare": ([(0, 200, "[7, 8]"), (1, 200, "[9]")], ("complete", 1, 0, "last"), [7, 8]),
    "object": ([(0, 200, '{"message": 1}')], ("complete", 1, 0, "last"), []),
    "busy": ([(0, 200, page([1], last=False)), (1, 429, page([2], last=True))], ("incomplete", 1, 1, "status 429"), [1]),
    "html": ([(0, 200, "<html>")], ("failed", 0, 0, "not JSON"), []),
    "null": ([(0, None, None)], ("failed", 0, 0, "status unknown"), []),
    "gap": ([(0, 200, page([1], last=False)), (2, 200, page([3], last=True))], ("incomplete", 1, 1, "missing"), [1]),
    "cut": ([(0, 200, page([1], last=False)), (1, 200, page([2], last=False))], ("incomplete", 2, 2, "missing"), [1, 2]),
    "headless": ([(1, 200, page([2], last=True))], ("failed", 0, 0, "missing"), []),
    "beyond": ([(0, 200, page([1], last=True)), (1, 500, ""), (5, 200, page([9], last=False))], ("complete", 1, 0, "last"), [1]),
    "twice": ([(0, 200, page([1], last=True)), (0, 200, page([1], last=True))], ("complete", 1, 0, "last"), [1]),
}


def test_walks(spark):
    rows = [(w, *p) for w, (pages, *_) in WALKS.items() for p in pages] + [(None, 0, 200, "[]")]
    walks, records = paged.walk_pages(spark.createDataFrame(rows, "walk string, page int, status int, body string"), record="int")
    assert {r[0]: tuple(r)[1:] for r in walks.collect()} == {w: x[1] for w, x in WALKS.items()}
    got = {}
    for r in records.orderBy("walk", "page").collect():
        got.setdefault(r["walk"], []).append(r["record"])
    assert {w: sorted(x) for w, x in got.items()} == {w: x[2] for w, x in WALKS.items() if x[2]}
    assert walks.where(F.col("walk").isNull()).count() == 0
