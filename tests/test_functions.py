"""Functions, operators and readers that SQL can't express: golden cases."""

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import identifiers, text, web
from ledgerlight.operators.evidence import merge_reads
from ledgerlight.operators.graph import components, roots
from ledgerlight.operators.merge import upsert
from ledgerlight.operators.resolve import resolve
from ledgerlight.sources import readers
from ledgerlight.streaming import incremental


def test_folds():
    assert text.fold("  Société  Générale . SA ,x") == "societe generale.sa,x"
    assert text.fold_actor("Müller & Söhne GmbH Co. KG") == "muller sohne"
    assert text.fold(None) is None and text.fold_actor("AG") == ""
    assert text.fold_actor("Ivoclar Vivadent A.G.") == "ivoclar vivadent" and text.fold_actor("Acme, d.o.o.") == "acme" and text.fold_actor("Co-op Labs") == "co op labs"


def test_ratios_against_plain_dynamic_programming():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 80))) for _ in range(2))
        assert text.common_length(a, b) == lcs(a, b)
    assert text.ratio("", "") == 100.0 and text.ratio("abc", "") == 0.0
    assert text.token_sort_ratio("b a", "a b") == 100.0
    assert text.token_set_ratio("red ring", "ring red small") == 100.0
    assert text.partial_ratio("bcd", "abcde") == 100.0
    assert text.quoted("valid … until 2028", "It is VALID for long\nuntil  2028.") and not text.quoted("no", "yes")


def test_check_pair(spark):
    def plain(payload):
        total = sum(identifiers.CHARACTERS.index(c) * p for c, p in zip(reversed(payload), identifiers.primes(30), strict=False)) % 1021
        return identifiers.CHECK_CHARACTERS[total // 32] + identifiers.CHECK_CHARACTERS[total % 32]

    payloads = ["1987654Ad4X4bL5ttr2310c", "4", "42ab_Z", "+A1"]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    assert [r[0] for r in df.select(identifiers.check_pair(F.col("p"))).collect()] == [plain(p) for p in payloads]
    assert plain("1987654Ad4X4bL5ttr2310c") == "2K"  # the specification's example
    cases = {"1987654Ad4X4bL5ttr2310c2K": "VALID", "1987654Ad4X4bL5ttr2310c2L": "INVALID", "B-12": "UNSCORABLE", None: "UNSCORABLE", "1": "UNSCORABLE", "1é22": "UNSCORABLE", "1" * 26: "INVALID"}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert [r[0] for r in df.select(identifiers.verdict(F.col("v"))).collect()] == list(cases.values())


def test_links_and_robots(spark):
    html = '<a href="/a">x</a><a href="b#t">y</a><A HREF="http://o.org/c">z</A><a>n</a><a href="/a">x</a><a href="mailto:q">m</a>'
    assert web.links(html, "http://h.org/d/") == ["http://h.org/a", "http://h.org/d/b", "http://o.org/c"]
    assert web.links(html, "http://h.org/d/", same_host=True, pattern="/b") == ["http://h.org/d/b"]
    assert web.links(None, None) == [] and web.links("<a href='http://[x'>", "http://h") == []
    rules = web.robots_rules("User-agent: a\nUser-agent: *\nDisallow: /p\nAllow: /p/q\nDisallow: /*.pdf$\n\nUser-agent: b\nDisallow:\n")
    assert [web.robots_allows(rules, p) for p in ("/", "/p/x", "/p/q/r", "/x.pdf", "/x.pdf?y")] == [True, False, True, False, True]
    assert web.robots_rules("User-agent: b\nDisallow: /", "a") == []
    pages = spark.createDataFrame([(1, "http://h/", html), (2, None, None)], "page_id long, url string, html string")
    assert web.harvest(pages).count() == 3


def test_trigram_similarity(spark):
    df = spark.createDataFrame([("word", "two words"), ("abc", "abc"), ("", "x"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(F.round(text.trigram_similarity(F.col("a"), F.col("b")), 4)).collect()]
    assert got == [pytest.approx(4 / 11, abs=1e-4), 1.0, 0.0, None]


def test_evidence_merge(spark):
    pairs = [
        ("type", ("x", "T2", 0.5), ("", "T0", 1.0), ("x", 0.5)), ("type", ("x", "T0", 0.99), ("y", "T2", 0.9), ("x", 0.99)), ("type", ("x", "T1", 0.9), ("y", "T1", 0.1), ("y", 0.1)), ("type", ("X", "T1", 0.9), ("x ", "T2", 0.8), ("X", 0.9)),
        ("ref_list", ("a,b", "T2", 0.9), ("a", "T0", 1.0), ("a,b", 0.9)), ("ref_list", ("a", "T0", 0.99), ("a,b", "T2", 0.9), ("a", 0.99)), ("ref_list", ("a", "T0", 0.5), ("a,b", "T2", 0.9), ("a,b", 0.9)), ("type", ("x", None, None), ("y", "T0", None), ("y", None)),
    ]
    rows = [(i, field, step, *read) for i, (field, first, second, _) in enumerate(pairs, 10) for step, read in ((1, first), (2, second))]
    rows += [(1, "type", 1, None, "T0", None), (1, "type", 2, "DoC", "T1", 0.8), (1, "type", 3, "EC", "T0", 0.5), (2, "type", 1, None, "T0", None)]
    merged = merge_reads(spark.createDataFrame(rows, "doc_id long, field string, step long, value string, tier string, conf double"))
    got = {r["doc_id"]: r for r in merged.collect()}
    assert [(got[i]["value"], got[i]["conf"]) for i in range(10, 10 + len(pairs))] == [p[3] for p in pairs]
    assert [(got[i]["value"], got[i]["reads"]) for i in (1, 2)] == [("DoC", 3), (None, 1)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_roots(spark):
    rng = random.Random(9)
    parent = {i: rng.choice([None, rng.randrange(i)]) if i else None for i in range(120)} | {1000 + i: 1000 + i - 1 if i else None for i in range(300)}
    parent |= {2000: 2001, 2001: 2002, 2002: 2000, 2003: 2000, 2004: 9999, 2005: 2004}  # a circle, and parents that aren't there
    want = {}
    for i in parent:
        at, depth = i, 0
        while parent.get(at) is not None and depth < 999:
            at, depth = parent[at], depth + 1
        if at in parent and parent[at] is None:
            want[i] = (at, depth)
    got = roots(spark.createDataFrame(list(parent.items()), "id long, parent long"))
    assert {r["id"]: (r["root"], r["depth"]) for r in got.collect()} == want
    assert roots(spark.createDataFrame([], "id long, parent long")).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(rng.randrange(900, 960), rng.randrange(900, 960)) for _ in range(40)] + [(1, 1), (None, 2)]
    of = {}
    for a, b in edges:
        if a is not None and a != b:
            of.setdefault(a, a), of.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            if a in of and b in of:
                of[a] = of[b] = min(of[a], of[b])
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == of
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_resolve_ladder(spark):
    members = [(1, "M1", "A", "red ring small", "U1"), (2, "M2", "A", "blue bolt", None), (3, "M3", "B", "red ring small", None)]
    items = [("M1", "A", "anything", None), ("I1", "A", "zzz", "U1"), ("I2", "A", "small red ring", None), ("I3", "A", "green nut", None), ("I4", "B", "blue bolt", None)]
    got = resolve(spark.createDataFrame(items, "item_ref string, manufacturer string, name string, udi string"), spark.createDataFrame(members, "group_id long, item_ref string, manufacturer string, name string, udi string"))
    assert {r["item_ref"]: (r["group_id"], r["rung"]) for r in got.collect()} == {"M1": (1, "link"), "I1": (1, "identifier"), "I2": (1, "name"), "I3": (None, "singleton"), "I4": (None, "singleton")}


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "production"), (2, "b", "staged"), (3, "c", "staged")], "k long, v string, status string")
    new = spark.createDataFrame([(1, "x", "staged"), (2, "y", "staged"), (4, "d", "staged")], "k long, v string, status string")
    got = {r["k"]: (r["v"], r["action"]) for r in upsert(old, new, ["k"], ["v"], F.col("old_status") == "production").collect()}
    assert got == {1: ("a", "kept"), 2: ("y", "update"), 3: ("c", "missing"), 4: ("d", "insert")}


def test_readers(spark, tmp_path):
    (tmp_path / "x.csv").write_text('ref,name\n01,"a, b"\n,\n')
    df = readers.read_export(spark, str(tmp_path / "x.csv"), ["ref", "name"])
    assert [tuple(r) for r in df.collect()] == [("01", "a, b"), ("", "")]
    assert [tuple(r) for r in readers.clean_records(df, ["ref", "name"]).collect()][1] == (None, None)
    with pytest.raises(readers.ProfileError, match="class"):
        readers.read_export(spark, str(tmp_path / "x.csv"), ["class"])
    with pytest.raises(ValueError, match="no reader"):
        readers.read_export(spark, "x.doc")
    (tmp_path / "p.json").write_text('{"value": [{"no": "1", "refs": ["a"]}, {"no": "2"}]}')
    assert readers.read_feed_pages(spark, str(tmp_path / "p.json"), "no string, refs array<string>").count() == 2
    (tmp_path / "e.json").write_text('{"value": []}')
    with pytest.raises(readers.ProfileError):
        readers.read_feed_pages(spark, str(tmp_path / "e.json"), "no string")
    with zipfile.ZipFile(tmp_path / "z.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.txt", "hello")
        z.writestr("bomb.txt", "0" * 1_000_000)
    (tmp_path / "bad.zip").write_bytes(b"no")
    (tmp_path / "m.eml").write_bytes(b"From: a@b.org\r\nSubject: Hi\r\n\r\nBody\r\n")
    files = readers.read_files(spark, str(tmp_path), "*.zip")
    got = {(r["member"], r["refusal"]) for r in readers.expand_archives(files).collect()}
    assert got == {("a.txt", None), ("bomb.txt", "suspicious ratio"), (None, "not an archive")}
    mail = readers.parse_messages(readers.read_files(spark, str(tmp_path), "*.eml")).collect()[0]
    assert (mail["sender"], mail["subject"], mail["body"].strip()) == ("a@b.org", "Hi", "Body")


def test_stream_merge(spark, tmp_path):
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    spark.sql("SELECT 1L AS event_id, timestamp'2024-01-01' AS ts, 7L AS user_id, 'view' AS event_type, 1D AS value").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    incremental.merge_by_batch(stream(), str(tmp_path / "t"), ["user_id"], "event_id", str(tmp_path / "c")).awaitTermination()
    spark.sql("SELECT 2L AS event_id, timestamp'2024-01-02' AS ts, 7L AS user_id, 'click' AS event_type, 2D AS value").write.mode("append").parquet(str(tmp_path / "in"))
    incremental.merge_by_batch(stream(), str(tmp_path / "t"), ["user_id"], "event_id", str(tmp_path / "c")).awaitTermination()
    assert [r["event_id"] for r in spark.read.parquet(str(tmp_path / "t" / "version=1")).collect()] == [2]
