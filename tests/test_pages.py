"""Pages of texts, uploads that wait, and sources of jobs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlight.sources import pages


def test_bounded_text(spark):
    docs = spark.createDataFrame([(1, ["ab", None, "c\x00d"]), (2, []), (3, None), (4, ["x" * 50])], "id int, pages array<string>")
    got = {r["id"]: tuple(r["x"]) for r in docs.select("id", pages.bounded_text(F.col("pages"), 40).alias("x")).collect()}
    whole = "[[page 1]]\nab\n[[page 2]]\n\n[[page 3]]\ncd"
    assert got[1] == (whole, 0) and got[2] == ("", 0) == got[3]
    assert got[4] == (("[[page 1]]\n" + "x" * 50)[:40] + pages.CLIPPED, 21)


def test_scans(spark):
    docs = spark.createDataFrame([(1, [" \n x ", "y" * 100]), (2, ["z" * 20]), (3, []), (4, None), (5, [" " * 30 + "z" * 19])], "id int, pages array<string>")
    assert {r["id"]: r["s"] for r in docs.select("id", pages.is_scan(F.col("pages")).alias("s")).collect()} == {1: True, 2: False, 3: True, 4: True, 5: True}


def test_uploads_are_collected_by_age(spark):
    now = dt.datetime(2026, 1, 10, 12)
    spool = spark.createDataFrame([(1, now - dt.timedelta(days=7)), (2, now - dt.timedelta(days=7, seconds=1)), (3, None)], "id int, created_at timestamp")
    kept, gone = pages.collected_uploads(spool, now)
    assert sorted(r["id"] for r in kept.collect()) == [1, 3] and [r["id"] for r in gone.collect()] == [2]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("No,Name\n1,x\n2,\n")
    (tmp_path / "p.json").write_text(json.dumps({"value": [{"No": "7", "Name": "y"}]}))
    spool = spark.createDataFrame([(5, "u.csv", bytearray(b"No,Name\r\n9,z"))], "id int, filename string, content binary")
    read = lambda payload, **more: sorted(map(tuple, pages.read_source(spark, payload, **more).select("No", "Name").collect()))
    assert read({"source": "csv", "ref": "a.csv"}, imports=str(tmp_path)) == [("1", "x"), ("2", "")]
    assert read({"source": "bc_odata", "ref": f"file://{tmp_path}/p.json"}, schema="No string, Name string") == [("7", "y")]
    assert read({"source": "upload", "ref": 5}, spool=spool, profile=["No"]) == [("9", "z")]
    with pytest.raises(LookupError):
        pages.read_source(spark, {"source": "upload", "ref": 6}, spool=spool)
    with pytest.raises(ValueError, match="unknown source"):
        pages.read_source(spark, {"source": "ftp", "ref": "x"})
    with pytest.raises(ValueError, match="missing columns"):
        pages.read_source(spark, {"source": "upload", "ref": 5}, spool=spool, profile=["No", "Price"])
