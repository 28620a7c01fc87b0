"""What documents print, in golden cases and against plain re-computations."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import claims, classify, printed
from ledgerlight.functions.text import ratio
from ledgerlight.operators.names import find_names, manufacturer_of

STAMP = (
    "Template ID:\nTEFO-04812-EN \nVersion:2.0, Valid as of: 13 Sep 2023 08:54:32 (GMT+02:00)\nEU Declaration of Conformity\n"
    "Schaan, 12.02.2024\n(this document is valid without signature)\n"
)
#: text, validity_to, validity_from, refused
DATED = [
    ("Expiry Date: 07.07.2027", "2027-07-07", None, []),
    ("valid until 2027-10-30", "2027-10-30", None, []),
    ("Issue Date: 2024-03-15", None, "2024-03-15", []),
    ("Issue Date: February 18, 2021", None, "2021-02-18", []),
    ("Valid as of: February 14, 2025", None, "2025-02-14", []),
    ("Issue Date: March 3 2024", None, "2024-03-03", []),
    ("Ausstellungsdatum / Issue Date: 18. Februar 2021", None, "2021-02-18", []),
    ("Issue Date: 1. marec 2021", None, "2021-03-01", []),
    ("Expiry Date: December 31, 2027", "2027-12-31", None, []),
    ("Issue Date: 25. 08. 2025", None, "2025-08-25", []),
    ("Issue Date: 30-Apr-2025", None, "2025-04-30", []),
    ("Issue Date: June 24th, 2021", None, "2021-06-24", []),
    ("Issue Date: fev. 18, 2026", None, "2026-02-18", []),
    ("Expiry Date: 30 Sept 2027", "2027-09-30", None, []),
    ("Date: February 18, 2021", None, None, []),
    ("Issue Date: the march of progress 2021", None, None, []),
    ("Issue Date: they may attend in 2021", None, None, []),
    ("Issue Date: Mar 2021", None, None, []),
    ("Version: 13   Valid as of: 18 Aug 2025\nBody\nValid as of: 14 Feb 2025\n", None, "2025-02-14", []),
    ("Diese Konformitatserklarung ist gultig bis: 2028-12-31", "2028-12-31", None, []),
    ("Ärztliche Prüfung für Zähne. Gültig bis: 2028-12-31", "2028-12-31", None, []),
    ("Storitve za zobozdravstvo. Veljavnost do: 2027-05-01", "2027-05-01", None, []),
    ("PDD-00042754, v3.0, Uncontrolled Copy, Effective Date: 2024-07-22", None, "2024-07-22", []),
    ("Effective Date: 2022-01-01\nCurrent Issue Date: 2024-11-25", None, "2024-11-25", []),
    ("Printed on 17.11.2025 10:21:00 by Ritter, Regina (RITTREG)", None, None, []),
    ("Valid from" + " " * 22 + "2021-05-10", None, "2021-05-10", []),
    ("Issue Date: 2020-08-00", None, None, []),
    ("Issue Date: 2021-02-30", None, None, []),
    ("Issue Date: 2024-02-29", None, "2024-02-29", []),
    ("Cuxhaven, February 18, 2021", None, "2021-02-18", []),
    ("Leuven, …10/10/2022…", None, "2022-10-10", []),
    ("Leuven, 12/02/2026 and more", None, None, []),
    # labels first, then the column of values: the first date isn't the expiry's
    ("Expiry date\nEffective date\n2021-05-25", None, "2021-05-25", ["validity_to"]),
    # the first label is a heading, the second one carries the date
    ("Valid until see below\nGültig bis: 31.12.2026", "2026-12-31", None, []),
    ("Effective date, manufacturing date: 2020-01-02", None, None, ["validity_from"]),
    ("Date of issue\nSchaan, 2021-05-25", None, "2021-05-25", []),
    ("", None, None, []),
    (None, None, None, []),
]


def test_labelled_dates(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(DATED)], "i int, text string").select("i", printed.labelled_dates(F.col("text")).alias("x"))
    day = lambda x: str(x["value"]) if x else None
    got = {r["i"]: (day(r["x"]["validity_to"]), day(r["x"]["validity_from"]), r["x"]["refused"]) for r in rows.collect()}
    assert got == {i: tuple(c[1:]) for i, c in enumerate(DATED)}


def test_labelled_dates_quote_what_stands_there(spark):
    rows = spark.createDataFrame([(STAMP,), ("Issue  Date:\n 2024-03-15 and",)], "text string").select(printed.labelled_dates(F.col("text")).alias("x")).collect()
    assert tuple(rows[0]["x"]["validity_from"])[1:] == (0.95, "Schaan, 12.02.2024")
    assert rows[1]["x"]["validity_from"] is None  # a label is found as it is written
    own = spark.createDataFrame([("Ausstellungsdatum 12.02.2026", ["AUSSTELLUNGSDATUM"]), ("Ausstellungsdatum 12.02.2026", None)], "text string, own array<string>")
    got = [r["x"]["validity_from"] for r in own.select(printed.labelled_dates(F.col("text"), from_labels=F.col("own")).alias("x")).collect()]
    assert tuple(got[0])[1:] == (1.0, "Ausstellungsdatum 12.02.2026") and got[1] is None


ANNEX = [
    "Codice NANDO / NANDO codes:", "MD 0402", "GC TEMP PRINT", "Modello / Model:", "901595/10004798, 901596/10004797", "Codici / Codes:", "Tipologia / Medical Devices:", "MI Varnish", "Modello / Model:",
    "900746/10003389, 900748/10003391, 901460/10003xxx", "Codici / Codes:", "Dental Prescale II", "Codes:", "Chief Operating Officer",
]
LISTS = [
    (["\n".join(ANNEX)], (["901595", "10004798", "901596", "10004797", "900746", "10003389", "900748", "10003391", "901460"], 1, "labelled")),
    (["cover", "REF #\n1800\n\n9553.204.060\n033.602S\n12.05.2021\n1800\nSignature\n1234"], (["1800", "9553.204.060", "033.602S"], 2, "text")),
    (["REF no.\nWidget\nno code\n"], None),
    (["Reference list\n1800"], None),
    (["Description\tREF\nWidget\t1055\nGadget\t104 H251EF 060\nRest\tAccording to 1\nOther\t++J022MD0102JT\n\nDescription\t9999"], (["1055", "104 H251EF 060"], 1, "table")),
    (["Basic UDI-DI IUD-ID de base | Artikel-Code\n++J022MD0126K9 | 005117", "a  b\n1  2", "Art. No.  Name\n7  x"], (["005117", "7"], 1, "table")),
    ([None, ""], None),
    ([], None),
    (None, None),
]


def test_reference_lists(spark):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(LISTS)], "i int, pages array<string>").select("i", printed.reference_list(F.col("pages")).alias("x"))
    assert {r["i"]: tuple(r["x"]) if r["x"] else None for r in rows.collect()} == {i: c[1] for i, c in enumerate(LISTS)}


def test_reference_lists_from_tables_and_patterns(spark):
    table = [["Basis-UDI-DI\nBasic UDI-DI\nIUD-ID de base", "Artikel-Code\nArticle Code"], ["++J022MD0126K9", " 005117 "], [None, None], ["x"]]
    rows = spark.createDataFrame([(["REF #\n1"], [(3, table)], None), (["Ref  x\nH1.314.006  a\n12  b"], None, r"^[A-Z0-9]{1,10}\.\d{3}\.\d{1,3}$")], "pages array<string>, tables array<struct<page:int,rows:array<array<string>>>>, pattern string")
    got = [tuple(r["x"]) for r in rows.select(printed.reference_list(F.col("pages"), F.col("tables"), F.col("pattern")).alias("x")).collect()]
    assert got == [(["005117"], 3, "table"), (["H1.314.006"], 1, "table")]


REVISIONS = [
    ("2023-06-01", "REV.00_06-2023", True), ("2024-01-01", "REV.01_01-2024", True), ("2024-01-01", "REV.01_01/2024", True), ("2025-04-01", "04/2025", True), ("2023-06-01", "Rev. June 2023", True),
    ("2023-06-01", "Edition 2023-06", True), ("2024-03-15", "Date of issue: 2024-03-15", True), ("2026-04-01", "701593/M/12 04/26", True), ("2026-04-26", "701593/M/12 04/26", False),
    ("2025", "(c) Institut Straumann AG, 2025", False), ("2023-06-01", "REV.00_07-2023", False), ("2023-06-01", "15-06-2023", False), ("2023-06-01", "2023-06-15", False), ("2023-06-01", "Instructions for use", False),
    ("2023-05-01", "Rev. May 2023", True), ("2023-06-01", "Rev. 1 June 2023", True), ("2023-06-01", "15 June 2023", False), ("2023-06-01", "Datum: 15. Juni 2023", False), ("2025-08-01", "Date of issue 25. 08. 2025", False),
    ("2023-06-01", "06/23/2023", False), ("2024-03-01", "Lot 03/24", False), ("2024-03-01", "LOT: 03/24", False), ("2024-01-01", "Page 1/24", False), ("2019-09-01", "Set 2019", False), ("2023-05-01", "the device may 2023", False),
]


def test_revision_dates(spark):
    rows = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(REVISIONS)], "i int, value string, quote string")
    got = {r["i"]: r["ok"] for r in rows.select("i", claims.issue_date_proven(F.col("value"), F.col("quote")).alias("ok")).collect()}
    assert got == {i: c[2] for i, c in enumerate(REVISIONS)}


LONG = "Declaration of conformity. " * 12
NEW = "Regulation (EU) 2017/745"


def claim(field, value, quote, pages, page=1, codes=None, classes=None, truncated=False, unread=()):
    return field, value, codes, quote, page, (pages, ["text"] * len(pages) if classes is None else classes, truncated, list(unread))


REFS = [f"AB{n:04d}" for n in range(20)]
SETTLED = [
    *[
        (claim("validity_from", iso, q, [LONG + q]), True)
        for q, iso in [("Issue Date: 2022-07-08", "2022-07-08"), ("Valid until 07.07.2027", "2027-07-07"), ("Ausstellungsdatum: 18. Februar 2021", "2021-02-18"), ("Effective date: 30-Apr-2025", "2025-04-30")]
    ],
    (claim("validity_to", "1999-01-01", "Valid until 07.07.2027", [LONG + "Valid until 07.07.2027"]), False),
    (claim("validity_to", "2023-12-17", "Valid until ... 2023-12-17 (layout order: 2020-06-03, 2023-12-17, D1002600038)", [LONG + "Valid from\nValid until\nRegistration no.\n2020-06-03\n2023-12-17\nD1002600038\n"]), False),
    (claim("validity_from", "2025-11-24", "1.0 \nDate \n2025-11-24 \nAuthor \nR. Ritter \nRemark \nFirst MDR Version", [LONG + "Revision History\nVersion \nDate \nAuthor\nRemark\n1.0 \n2025-11-24 \nR. Ritter\nFirst MDR Version\n"]), False),
    (claim("validity_from", "2022-07-08", "Issue Date: 2022-07-08", [LONG, LONG + "Issue Date: 2022-07-08"], 2), True),
    (claim("validity_from", "2022-07-08", "Issue Date: 2022-07-08", [LONG, LONG + "Issue Date: 2022-07-08"], 1), False),
    (claim("validity_from", "2022-07-08", "issue date: 2022-07-08", [LONG + "ISSUE   DATE:\n 2022-07-08"]), True),
    *[(claim("basic_udi_di", "76152081XSCAN001YC", f"Basis-UDI-DI {e} 76152081XSCAN001YC", [LONG + "Basis-UDI-DI\nProduct name\n76152081XSCAN001YC\n"]), True) for e in ("...", "…", "....")],
    (claim("basic_udi_di", "76152081XSCANOOIYC", "Basic UDI-DI 76152081XSCANOOIYC", [LONG + "Basic UDI-DI 76152081XSCANOOIYC"]), False),
    (claim("basic_udi_di", "B-12345", "Basic UDI-DI B-12345", [LONG + "Basic UDI-DI B-12345"]), True),
    (claim("basic_udi_di", "PRODUCT", "Basic UDI-DI PRODUCT", [LONG + "Basic UDI-DI PRODUCT"]), False),
    (claim("manufacturer", "Ceramill GmbH", "Manufacturer: Ceramill GmbH", [LONG + "Manufacturer: Ceramill GmbH"]), True),
    (claim("manufacturer", "Amann Girrbach AG", "Manufacturer: Ceramill GmbH", [LONG + "Manufacturer: Ceramill GmbH"]), False),
    *[(claim("cert_number", n, f"Certificate No. {n}", [LONG + f"Certificate No. {n}"]), ok) for n, ok in [("MDR 778483", True), ("HZ 1234567", True), ("0482", False), ("CE-0197", False), ("CE 0197", False), ("NB1639", False), ("1234", False)]],
    (claim("ref_list", None, None, [LONG + " ".join(REFS[:19])], codes=REFS), True),
    (claim("ref_list", None, None, [LONG + " ".join(REFS[:19])], codes=REFS[:19] + ["ZZ9999", "YY8888"]), False),
    (claim("ref_list", None, None, [LONG], codes=[]), False),
    (claim("ref_list", None, None, [LONG + "ref ab 0001  AB 0002"], codes=["AB0001", "ab0002"]), True),
    *[
        (claim("regulation", v, None, [LONG + t]), ok)
        for t, v, ok in [(NEW, "MDR", True), ("Directive 93/42/EEC", "MDD", True), ("Directive 93/42/EEC", "MDR", False), ("Nothing cited here", "n.a.", True), ("Nothing cited here", "MDR", False), (NEW, "n.a.", False), ("2017/745 replaces Directive 93/42/EEC", "MDR", False), ("Regulation 2017 / 745", "MDR", True)]
    ],
    (claim("regulation", "n.a.", None, [LONG, LONG], classes=["image", "text"]), False),
    (claim("regulation", "MDR", None, [NEW, LONG], unread=(2,)), False),
    (claim("regulation", "MDR", None, [NEW, LONG], truncated=True), False),
    (claim("regulation", "MDR", None, [NEW, LONG], classes=["text"]), False),
    (claim("regulation", "n.a.", None, ["", LONG], classes=["sparse", "sparse"]), False),
    (claim("regulation", "MDR", None, [NEW, LONG], classes=["text", "ocr"]), True),
    (claim("type", "DoC", "EU Declaration of Conformity", [LONG, "EU Declaration of Conformity. " * 10], 2), True),
    (claim("type", "DoC", "a sentence the page does not hold", [LONG, "EU Declaration of Conformity. " * 10], 2), False),
    (claim("type", None, "EU Declaration of Conformity", [LONG, "EU Declaration of Conformity. " * 10], 2), False),
    (claim("unknown_field", "DoC", "Declaration of conformity", [LONG]), False),
    (claim("manufacturer", "", "x", [LONG]), False),
    (claim("manufacturer", "x", None, None or [LONG]), False),
]
CLAIM = "i int, field string, value string, codes array<string>, quote string, page int, doc struct<pages:array<string>,classes:array<string>,truncated:boolean,unread:array<int>>"


def test_settled(spark):
    rows = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(SETTLED)], CLAIM)
    got = rows.select("i", claims.settled(*[F.col(c) for c in ("field", "value", "codes", "quote", "page", "doc")]).alias("ok")).collect()
    assert [(r["i"], r["ok"]) for r in sorted(got)] == [(i, ok) for i, (_, ok) in enumerate(SETTLED)]


PLAIN = "Plain body text.  " * 20
#: field, pages, classes, truncated, unread; one empty answer proven; two proven
EMPTY = [
    ("basic_udi_di", [PLAIN], ["text"], False, [], True, True),
    ("basic_udi_di", [LONG + "Basic UDI-DI: see annex"], ["text"], False, [], False, False),
    ("basic_udi_di", ["Products including accessories and guidelines. "], ["text"], False, [], True, True),
    ("basic_udi_di", [PLAIN, PLAIN], ["text", "image"], False, [], False, True),
    ("basic_udi_di", [PLAIN, PLAIN], ["text", "ocr"], False, [], False, True),
    ("basic_udi_di", [PLAIN], ["text"], False, [3], False, False),
    ("basic_udi_di", [PLAIN], ["text"], True, [], False, False),
    ("basic_udi_di", [PLAIN, "Cover"], ["text", "sparse"], False, [], True, True),
    ("basic_udi_di", [PLAIN, PLAIN], [], False, [], False, False),
    ("basic_udi_di", [PLAIN, PLAIN], ["sparse", "sparse"], False, [], False, False),
    ("type", ["anything"], ["text"], False, [], False, True),
    ("manufacturer", [PLAIN], ["text"], False, [], False, True),
    ("validity_to", ["Expiry: none"], ["text"], False, [], False, True),
    ("cert_number", None, None, None, None, False, False),
]


def test_empty_answers_and_citations(spark):
    rows = spark.createDataFrame([(i, c[0], None, None, None, None, c[1:5]) for i, c in enumerate(EMPTY)], CLAIM)
    field, doc = F.col("field"), F.col("doc")
    got = sorted(map(tuple, rows.select("i", claims.null_settled(field, doc), claims.both_null_settled(field, doc)).collect()))
    assert got == [(i, *c[5:]) for i, c in enumerate(EMPTY)]
    cited = [("MDR", NEW, ["text", "sparse"], True), ("mdr", NEW, ["text", "text"], False), (None, NEW, ["text", "text"], False), ("MDR", NEW, ["text", "image"], False), ("n.a.", "Nothing", ["ocr", "ocr"], True), ("n.a.", "", ["sparse", "sparse"], False)]
    rows = spark.createDataFrame([(i, "regulation", v, None, None, None, ([t, ""], c, False, [])) for i, (v, t, c, _) in enumerate(cited)], CLAIM)
    assert [r["ok"] for r in sorted(rows.select("i", claims.citation_proven(F.col("value"), doc).alias("ok")).collect())] == [c[3] for c in cited]


def test_revision_dates_on_their_page(spark):
    note = "Latest document update 04/2025 (no day given; document revision date)"
    cases = [
        ("2025-04-01", note, 1, [LONG + "Latest document update 04/2025"], ["text"], [], True),
        ("2025-04-01", note, 1, [LONG + "Latest document update"], ["text"], [], False),
        ("2023-06-01", "REV.00_06-2023", 2, [LONG, LONG], ["text", "text"], [], False),
        ("2023-06-01", "REV.00_06-2023", 2, [LONG, ""], ["text", "image"], [2], True),
    ]
    rows = spark.createDataFrame([(i, "", v, None, q, n, (p, c, False, u)) for i, (v, q, n, p, c, u, _) in enumerate(cases)], CLAIM)
    got = rows.select("i", claims.issue_date_proven(F.col("value"), F.col("quote"), F.col("page"), F.col("doc")).alias("ok")).collect()
    assert [r["ok"] for r in sorted(got)] == [c[-1] for c in cases]


def test_nearly_in_equals_all_windows():
    rng = random.Random(4)
    yes = 0
    for _ in range(300):
        page = "".join(rng.choice("ab cd") for _ in range(rng.randint(1, 120)))
        at = rng.randint(0, len(page) - 1)
        piece = list(page[at : at + rng.randint(1, 60)])
        for _ in range(rng.randint(0, 5)):
            i = rng.randrange(len(piece) + 1)
            piece[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "x", "bc"])
        piece = "".join(piece)
        if not piece:
            continue
        short, long = sorted((piece, page), key=len)
        windows = {long[max(i, 0) : i + len(short)] for i in range(1 - len(short), len(long))} - {""}
        want = any(ratio(short, w) >= 95 - 1e-9 for w in windows)
        yes += want and short not in long
        assert claims.nearly_in(piece, page) == want, (piece, page)
    assert yes > 10


NAMES = [("ivo", "Ivoclar Vivadent AG"), ("ivo", "IVOCLAR"), ("gc", "GC"), ("gc", "GC Europe N.V."), ("komet", "Gebr. Brasseler GmbH & Co. KG"), ("dent", "Dentsply IH Limited"), ("odd", "A+(B)*[c] 7"), (None, "Nobody GmbH"), ("none", None)]
NAMED = [
    ("made by  IVOCLAR\nvivadent ag in Schaan", ("ivo", 0.97)), ("Magcare GCF gc", None), ("GC Europe N.V. and Ivoclar", None), ("x gebr. brasseler gmbh & co. kg.", ("komet", 0.97)),
    ("Authorised UK representative: Dentsply IH Limited", ("dent", 0.9)), ("Dentsply IH Limited makes it. " + "w " * 200 + "Authorized EU-representative: Dentsply IH Limited", ("dent", 0.97)),
    ("EC REP " + "w " * 200 + "Dentsply IH Limited", ("dent", 0.97)), ("xIvoclar Ivoclars", None), ("use a+(b)*[C] 7!", ("odd", 0.97)), ("", None), (None, None), ("nobody gmbh", None),
]


def test_names(spark):
    texts = spark.createDataFrame([(i, t, "e", "n") for i, (t, _) in enumerate(NAMED)] + [(None, "Ivoclar", "e", "n")], "doc_id int, text string, entity string, name string")
    names = spark.createDataFrame(NAMES + NAMES[:1], "entity string, name string")
    got = {r["doc_id"]: (r["entity"], r["conf"]) for r in manufacturer_of(texts, names).collect()}
    assert got == {i: want for i, (_, want) in enumerate(NAMED) if want}


def test_names_equal_a_search_for_each(spark):
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "gmbh", "ag", "&", "co."]
    names = sorted({" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(60)})
    texts = [" ".join(rng.choices([*words, "alphax", "ag."], k=rng.randint(0, 30))) for _ in range(80)]
    edge = lambda t, a, b: not (a and t[a - 1].isalnum()) and not (b < len(t) and t[b].isalnum())
    want = set()
    for i, t in enumerate(texts):
        for n in names:
            places = [a for a in range(len(t)) if t.startswith(n, a) and edge(t, a, a + len(n))]
            if len(n) >= 6 and places:
                want.add((i, n, places[0] + 1))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = find_names(docs, spark.createDataFrame([(n, n) for n in names], "entity string, name string"))
    assert {(r["id"], r["name"], r["at"]) for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_prose_behind_a_passage_lists_no_classes(spark, tmp_path):
    spark.createDataFrame([(15, "prose, loose", "s"), (5, "prose, in it", "s")], "doc_id long, text string, source string").selectExpr("doc_id", "concat('aa pros', substr(text, 6)) AS text", "source").write.parquet(f"{tmp_path}/documents.parquet")
    from ledgerlight.plans import extraction

    got = {r["doc_id"]: (r["stated"], r["verbatim"]) for r in extraction.QUERIES["x04_stated_class"](spark, str(tmp_path)).collect()}
    assert got == {15: ("III", "RAZRED iii"), 5: (None, None)}


#: Prose that says by chance what only a passage shall say, or is so short that a quote contains it.
CHANCE = {
    "x05_certificate_number": ["No. De que la los.", "Und so.\nNo. Esa de la\nfin", "Te cert. no ABCD12 z"],
    "x15_settled": ["A.", "At d", "Item.", "de ñref é"],
    "x11_text_fields": ["No. De que la los.", "xx msds xx", "thid | re\n12 | B3\n", "Nombre, 1.2.2003\nde"],
}


@pytest.mark.parametrize("name", CHANCE)
def test_prose_says_nothing_for_the_passage(spark, tmp_path, name):
    import duckdb

    from ledgerlight.plans import extraction

    rows = [(60 * i + j, text, "s") for i, text in enumerate(CHANCE[name]) for j in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(n, f"Supplier#{n:09d}") for n in range(1, 11)], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(extraction.ORACLES[name]).fetchall()
    got = [tuple(r) for r in extraction.QUERIES[name](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_readers_bind_what_they_use_more_than_once(spark):
    """A text is searched once for each thing, whatever the parts of an answer: no reader's expression holds its searches several times."""
    df = spark.createDataFrame([("x", ["x"])], "t string, p array<string>")
    plan = lambda c: df.select(c.alias("c"))._jdf.queryExecution().analyzed().toString()
    assert plan(classify.document_type(F.col("t"), F.lit("a"))).count("instr(") == 1
    assert plan(classify.stated_class(F.col("t"))).count("regexp_extract_all(") == 1


def test_readers_without_a_sign_of_what_they_look_for(spark):
    """What a text lacks is found missing, and what it has in odd letters is found, by readers that look for signs first."""
    rows = [
        (1, None), (2, ""), (3, "nothing at all"), (4, "CLASS IIA"), (5, "Klaſse III"), (6, "Ref #\n A1 \nsignature"), (7, " REF # \n22\npage \n33"), (8, "CODES:\n1"), (9, "1234, 5678\n Codes :"), (10, "a | ref\nb | 77"),
        (11, "Gültig bis: 2024-01-02"), (12, "GULTIG BIS: 2024-01-02"), (13, "İssue date: 2024-01-02"), (14, "Wien, 1. Mai 2023"), (15, "iso 13485, EC Certificate"),
    ]
    df = spark.createDataFrame(rows, "n int, t string")
    dates = printed.labelled_dates(F.col("t"))
    got = df.select(
        "n", classify.stated_class(F.col("t"))["value"], F.array_join(printed.reference_list(F.array("t"))["codes"], ","), printed.reference_list(F.array("t"))["rung"],
        dates["validity_to"]["value"].cast("string"), dates["validity_from"]["value"].cast("string"), classify.document_type(F.col("t"), F.lit("x"))["verbatim"],
    )
    got = {r[0]: tuple(r[1:]) for r in got.collect()}
    none = (None,) * 6
    want = {
        4: ("IIa", *none[1:]), 6: (None, "A1", "text", None, None, None), 7: (None, "22,33", "text", None, None, None), 9: (None, "1234,5678", "labelled", None, None, None), 10: (None, "77", "table", None, None, None),
        11: (None, None, None, "2024-01-02", None, None), 12: (None, None, None, "2024-01-02", None, None), 13: (None, None, None, None, "2024-01-02", None), 14: (None, None, None, None, "2023-05-01", None), 15: (*none[:5], "EC Certificate"),
    }
    assert got == {n: want.get(n, none) for n, _ in rows}
