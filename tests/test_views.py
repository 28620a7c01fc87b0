"""Golden cases of the registry semantics, run through the very texts that the queries use."""

import datetime as dt
import hashlib

import pytest

from ledgerlight.plans import projection, registry
from ledgerlight.plans.dialect import duck_sql, spark_sql, write_out

D = dt.date


@pytest.fixture
def seeded(spark, monkeypatch):
    """Replace relations of the projection by rows."""

    def seed(**tables):
        for name, (schema, rows) in tables.items():
            spark.createDataFrame(rows, schema).createOrReplaceTempView(f"seed_{name}")
            monkeypatch.setitem(projection.RELATIONS, name, f"SELECT * FROM seed_{name}")

    return seed


DOC = "doc_id long, type string, regulation string, validity_from date, validity_to date, cert_doc_id long, status string"
LINK = "item_ref string, doc_id long, match_basis string, status string"


def test_effective_expiry_and_basis(spark, seeded):
    seeded(document=(DOC, [
        (1, "DoC", "MDR", D(1996, 1, 1), None, None, "production"),  # stale after five years
        (2, "DoC", "MDR", D(1996, 1, 1), D(1997, 1, 1), None, "production"),  # stated
        (3, "DoC", "MDR", D(1996, 1, 1), None, 4, "production"),  # inherited from its certificate
        (4, "EC", "MDR", D(1996, 1, 1), D(1999, 1, 1), None, "superseded"),
        (5, "DoC", "MDR", None, None, 6, "production"),  # a staged certificate doesn't count
        (6, "EC", "MDR", None, D(1999, 1, 1), None, "staged"),
        (7, "DoC", "MDR", D(1996, 2, 29), None, None, "production"),  # a leap day
        (8, "IFU", "n.a.", D(1990, 1, 1), None, None, "production"),  # nothing to go by
    ]))
    got = {
        r["doc_id"]: (r["expires"], r["basis"], r["inherited"]) for r in spark.sql(spark_sql("SELECT * FROM expiry")).collect()
    }
    assert got[1] == (D(2001, 1, 1), "staleness", False)
    assert got[2] == (D(1997, 1, 1), "stated", False)
    assert got[3] == (D(1999, 1, 1), "inherited", True)
    assert got[5] == (None, None, False)
    assert got[7] == (D(2001, 2, 28), "staleness", False)
    assert got[8] == (None, None, False)


def test_currency_ties_future_dates_and_regulation(spark, seeded):
    docs = [
        (1, "DoC", "MDD", D(1998, 5, 1), None, None, "production"),
        (2, "DoC", "MDR", D(1997, 5, 1), None, None, "production"),  # MDR goes before a newer MDD
        (3, "DoC", "MDR", D(1997, 5, 1), None, None, "superseded"),  # a tie: both are current
        (4, "DoC", "MDR", D(1999, 5, 1), None, None, "production"),  # a future date counts as none
        (5, "ISO", "n.a.", None, None, None, "production"),  # another type: a race of its own
        (6, "DoC", "MDR", D(1998, 7, 1), None, None, "staged"),  # not in the race
        (7, "EC", "MDR", None, None, None, "production"),  # no link at all
    ]
    links = [("P1", i, "ref-list", "production") for i in (1, 2, 3, 4, 5, 6)] + [("P2", 1, "ref-list", "staged")]
    seeded(document=(DOC, docs), link=(LINK, links))
    assert {r["doc_id"] for r in spark.sql(spark_sql("SELECT doc_id FROM current_link")).collect()} == {2, 3, 5}
    assert {r["doc_id"] for r in spark.sql(spark_sql("SELECT doc_id FROM document_current")).collect()} == {2, 3, 5, 7}


def test_one_window_in_currency(spark):
    plan = registry.QUERIES["v06_item_document_production"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


@pytest.mark.parametrize("name", ["v11_certificate_near_miss", "v15_article_status", "r03_ref_gate"])
def test_no_nested_loops(spark, name):
    plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_macros():
    assert write_out("@days(@day(a), f(b, 'x,)'))", 0) == "datediff(f(b, 'x,)'), CAST(a AS DATE))"
    assert "'g'" in duck_sql("SELECT @replace_all(a, 'b', 'c')")
    assert spark_sql("SELECT 1 AS one") == "SELECT 1 AS one"


def test_every_query_has_a_check():
    assert set(registry.QUERIES) - set(registry.ORACLES) <= registry.WITHOUT_SQL


@pytest.mark.parametrize("name", ["q01_coverage", "q25_item_completeness", "g03_disposition", "r05_newer_or_older", "m01_mirror_upsert"])
def test_against_duckdb(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in projection.BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = registry.QUERIES[name](spark, sf)
    want = con.execute(registry.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*names).collect())


ITEM = "item_ref string, item_no long, manufacturer_raw string, mfr_ref string, catalogue string"
EVIDENCE = "doc_id long, line long, printed_ref string"


def test_matching_takes_all_evidence(spark, seeded):
    seeded(item=(ITEM, [("P1234", 1234, "Brand#1", "Brand#1-1234", "C1")]), evidence=(EVIDENCE, [(5, 2, "P77"), (900_000, 3, "P1234")]))
    r03 = registry.QUERIES["r03_ref_gate"](spark, "/root/testdata/sf0.001").collect()
    assert [tuple(r) for r in r03] == [(900_000, "P1234", "ref-item")]


def test_resolve_takes_all_items(spark):
    sf = "/root/testdata/sf0.001"
    items = {f"P{r[0]}" for r in spark.read.parquet(f"{sf}/part.parquet").select("p_partkey").collect()}
    assert {r[0] for r in registry.QUERIES["r01_resolve"](spark, sf).select("item_ref").collect()} == items


@pytest.mark.parametrize("name", ["t01_fold", "t05_fold_accents"])
def test_whole_texts_are_folded(spark, tmp_path, name):
    spark.createDataFrame([(1, "Ab " * 200 + "Éz")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    [row] = registry.QUERIES[name](spark, str(tmp_path)).collect()
    assert row["folded"].lower().endswith("ez") and row["folded"].lower().count("ab") == 200


def test_no_id_ranges(spark, seeded):
    sf = "/root/testdata/sf0.001"
    doc = (9_000_000, "DoC", "MDR", D(1996, 1, 1), None, None, "production")
    seeded(
        item=(ITEM, [("P1", 1, "a", None, "C1"), ("P9000", 9000, "a", None, "C1"), ("P9001", 9001, "a", "x", "C1")]), document=(DOC, [doc]), link=(LINK, []),
        job=("id long, status string, dedupe_key string", [(7, "pending", "k"), (8, "done", "m"), (5001, "done", "k"), (5002, "done", "m"), (5003, "done", "m")]),
    )
    got = lambda name: sorted(tuple(r) for r in registry.QUERIES[name](spark, sf).collect())
    assert got("j17_null_safe_key") == [("P1", 2), ("P9000", 2), ("P9001", 1)]
    assert got("j13_scalar_beside") == [("P1", 1), ("P9000", 1), ("P9001", 1)]
    h = int(hashlib.md5(b"9000000").hexdigest()[:12], 16)
    assert got("a16_fingerprint") == [("DoC", 1, h % 1000003, h)]
    assert got("m05_insert_if_absent") == [(5002, "m")]


def test_held_certificate_reports_rev_only(spark, seeded):
    """An R-code is dropped and isn't a revision; Rev is reported as printed, whatever its case and the document's status."""
    numbers = ["SX 12 R03", "SX 12 Rev. 03", "HZ 7 rev02", "G1 99", "SX 5 Rev. 2 R01"]
    seeded(
        document=("doc_id long, type string, status string, manufacturer string, certificate_number string", [(i, "EC", "superseded", "M", n) for i, n in enumerate(numbers)]),
        link=("item_ref string, doc_id long, match_basis string, status string", [("P1", i, "ref-list", "production") for i in range(len(numbers))]),
    )
    got = {r["doc_id"]: (r["base_number"], r["revision"]) for r in spark.sql(spark_sql("SELECT * FROM held_certificate")).collect()}
    assert got == {0: ("SX 12", None), 1: ("SX 12", "Rev. 03"), 2: ("HZ 7", "rev02"), 3: ("G1 99", None), 4: ("SX 5", None)}


def test_name_suggestion_needs_three_exclusive_articles(spark, seeded):
    from ledgerlight.plans import boards

    items = [("A1", "a", None), ("A2", "a", None), ("A3", "a", None), ("B1", "b", "S"), ("B2", "b", None), ("A4", "a", "S")]
    printed = [(1, "A1"), (1, "A2"), (1, "A3"), (1, "A3"), (1, "unknown"), (2, "A1"), (2, "A2"), (3, "A1"), (3, "A2"), (3, "A3"), (3, "S"), (4, "A1"), (4, "A2"), (4, "A3"), (4, "A4"), (4, "B2")]
    seeded(item=("item_ref string, manufacturer_raw string, mfr_ref string", items), evidence=("doc_id long, printed_ref string", printed))
    text = next(t for d in vars(boards).values() if isinstance(d, dict) and (t := d.get("r11_name_suggestion")))
    assert {tuple(r) for r in spark.sql(spark_sql(text)).collect()} == {(1, "a", 3, 3), (4, "a", 4, 5)}


def test_failure_spikes_by_manufacturer(spark, seeded):
    from ledgerlight.plans import boards

    at, old = dt.datetime(2024, 1, 10), dt.datetime(2023, 12, 1)
    log = [(1, "miss", at)] * 3 + [(2, "hit", at), (2, "skipped", at)] + [(3, "miss", at)] * 4 + [(4, "miss", old)] * 6 + [(5, "miss", at)] * 3 + [(5, "hit", at)] * 3
    seeded(
        member=("group_id long, item_ref string, manufacturer_raw string", [(1, "P1", "x"), (2, "P2", "X"), (2, "P3", "X"), (3, "P4", "y"), (4, "P5", "z"), (5, "P6", "w")]),
        alias=("raw_name string, canonical_name string", [("x", "Maker"), ("X", "Maker")]),
        discovery=("group_id long, outcome string, seen_at timestamp", log),
    )
    text = next(t for d in vars(boards).values() if isinstance(d, dict) and (t := d.get("q16_failure_spikes")))
    assert {tuple(r) for r in spark.sql(spark_sql(text)).collect()} == {("Maker", 5, 3, 0.6)}
