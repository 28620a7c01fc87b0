"""Completeness of items' documents, in golden cases."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerlight.operators import completeness as c

TODAY = date(2026, 8, 24)
FAR, PAST = date(2030, 1, 1), TODAY - timedelta(days=1)
HELD = "struct<doc_status:string,link_status:string,match_basis:string,expires:date,expiry_basis:string>"
P = "production"
#: requirement, held, state, severity, bucket
CELLS = [
    ("required", (P, P, "ref-item", FAR, "stated"), "held", "ok", "held"), ("required", (P, P, "ref-item", None, None), "held", "ok", "held"),
    ("required", (P, P, "ref-item", TODAY + timedelta(days=30), "stated"), "expiring", "warn", "attention"), ("required", (P, P, "ref-item", TODAY + timedelta(days=31), "stated"), "held", "ok", "held"),
    ("required", (P, P, "ref-item", TODAY, "stated"), "expiring", "warn", "attention"), ("required", (P, P, "ref-item", PAST, "stated"), "expired", "bad", "lapsed"), ("required", (P, P, "ref-item", PAST, "inherited"), "expired", "bad", "lapsed"),
    ("required", (P, P, "ref-item", PAST, "staleness"), "review-due", "warn", "attention"), ("evidence", (P, P, "ref-item", PAST, "stated"), "expired", "warn", "lapsed"), ("required", (P, P, "mfr-scope", FAR, "stated"), "mfr-scope-only", "warn", "attention"),
    ("evidence", (P, P, "mfr-scope", FAR, "stated"), "mfr-scope-only", "warn", "held"), ("required", (P, P, "mfr-scope", PAST, "stated"), "expired", "bad", "lapsed"), ("required", (P, "staged", "name-family", FAR, "stated"), "review", "warn", "attention"),
    ("required", ("staged", P, "ref-item", FAR, "stated"), "review", "warn", "attention"), ("required", ("superseded", P, "ref-item", FAR, "stated"), "superseded", "bad", "lapsed"), ("evidence", ("superseded", P, "ref-item", FAR, "stated"), "superseded", "warn", "lapsed"),
    ("required", None, "missing", "bad", "none"), ("conditional", None, "missing-exception-possible", "warn", "none"), ("unknown", None, "class-unknown", "warn", "attention"), ("not-applicable", None, "not-required", "none", "not_required"),
    ("evidence", None, "missing", "none", "none"), ("required", (None, None, None, None, None), "review", "warn", "attention"),
]


def test_cells(spark):
    rows = spark.createDataFrame([(i, a, h) for i, (a, h, *_) in enumerate(CELLS)], f"i int, asked string, held {HELD}")
    state = c.state_of(F.col("asked"), F.col("held"), F.lit(TODAY))
    told = rows.withColumn("state", state).select("i", "state", c.severity_of(F.col("asked"), F.col("state")), c.bucket_of(F.col("asked"), F.col("state")))
    assert sorted(map(tuple, told.collect())) == [(i, *x[2:]) for i, x in enumerate(CELLS)]


def test_requirements(spark):
    rows = spark.createDataFrame([(k,) for k in ("I", " Ir", "IIa", "IIb", None, "IIc", "")], "k string")
    got = {r[0]: tuple(r)[1:] for r in rows.select("k", *[c.requirement(F.col("k"), F.lit(r)) for r in (*c.SCORED, "EC")]).collect()}
    open_ = ("required", "unknown", "unknown", "evidence")
    assert got == {"I": ("required", "conditional", "not-applicable", "evidence"), " Ir": ("required",) * 3 + ("evidence",), "IIa": ("required", "conditional", "required", "evidence"), "IIb": ("required",) * 3 + ("evidence",), None: open_, "IIc": open_, "": open_}


def test_item_and_maker_cards(spark):
    items = spark.createDataFrame([("a", "M", "I", True), ("b", "M", "IIb", True), ("toy", "M", "I", False), ("c", "N", None, True)], "item_ref string, manufacturer string, product_class string, md_flag boolean")
    far, rows = date(2030, 1, 1), []
    for item, doc, kind, status, link, basis, cert in [
        ("a", 1, "DoC", "superseded", P, "ref-list", None), ("a", 2, "DoC", P, "staged", "ref-list", None), ("a", 3, "DoC", P, P, "mfr-scope", None), ("a", 4, "DoC", P, P, "ref-list", "CE 7"), ("a", 5, "DoC", P, P, "ref-list", None),
        ("b", 6, "DoC", P, P, "ref-list", ""), ("b", 7, "EC", P, P, "mfr-scope", None), ("b", 8, "Other", P, P, "ref-list", None), ("toy", 4, "DoC", P, P, "ref-list", None),
    ]:
        rows.append((item, doc, kind, status, link, basis, far, "stated", cert))
    holdings = spark.createDataFrame(rows, "item_ref string, doc_id long, type string, doc_status string, link_status string, match_basis string, expires date, expiry_basis string, cert_number string")
    cards = c.item_completeness(items, holdings, F.lit(TODAY)).persist()
    got = {(r["item_ref"], r["row"]): (r["doc_id"], r["state"], r["bucket"]) for r in cards.collect()}
    assert len(got) == 15 and got["a", "DoC"] == (4, "held", "held") and got["a", "nb_number"] == (4, "held", "held") and got["a", "IFU"] == (None, "missing-exception-possible", "none")
    assert got["b", "nb_number"] == (7, "mfr-scope-only", "attention") and got["b", "EC"] == (7, "mfr-scope-only", "held") and got["c", "IFU"] == (None, "class-unknown", "attention")
    maker = {(r["manufacturer"], r["row"]): tuple(r)[2:] for r in c.maker_completeness(cards).collect()}
    assert maker["M", "DoC"] == (2, 0, 0, 0, 0, "ok") and maker["M", "IFU"] == (0, 0, 0, 2, 0, "bad") and maker["N", "nb_number"] == (0, 1, 0, 0, 0, "warn")
