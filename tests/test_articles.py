"""Articles and declarations against a register, in golden cases."""

import pytest

from ledgerlight.operators import articles

REORDER = articles.REORDER


@pytest.fixture(scope="module")
def status(spark):
    """Articles of a small catalogue."""
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    items = [("1845", None, True), ("1846", None, True), ("1847", None, True), ("R1", None, True), ("DUP1", None, True), ("S1", None, True), ("SUP1", None, True), ("N1", "not there", True), ("TOY", "1845", False), ("OTHER", "1845", True)]
    items += [("K1", "314 RC5 7", True), ("K2", " rc5.314.007", True), ("E1", "314 RC5 7", True), ("TWO", "T1", True)]
    of = {"1845": 1, "1846": 1, "1847": 1, "TOY": 1, "R1": 2, "DUP1": 2, "S1": 2, "SUP1": 2, "N1": 2, "OTHER": 3, "K1": 4, "K2": 4, "E1": 5, "TWO": 2}
    groups = [(1, "CARL"), (2, "CO"), (3, "UNTRUSTED"), (4, "KOMET"), (5, "EXACT")]
    devices = [("BUDI-A", r, None, "M1") for r in ("1845", "1846", "1847")] + [("BUDI-R", "R1", "x", "M2"), ("BUDI-D", "DUP1", "Trade A", "M2"), ("BUDI-D", "DUP1", "Trade B", "M2"), ("BUDI-S", "S1", "s", "M2"), ("BUDI-P", "SUP1", "p", "M2")]
    devices += [("BUDI-K", "RC5.314.007.K3", "bur", "M4"), ("BUDI-E", "RC5.314.007", "bur", "M5"), ("BUDI-T", "T1", "t", "M2"), ("BUDI-U", "T1", "t", "M2"), (None, None, "none", "M2"), ("BUDI-X", "1845", "x", "M9")]
    links = [("R1", 1, "retracted"), ("S1", 2, "staged"), ("SUP1", 3, "production"), ("1845", 4, "production"), ("K1", 5, "production"), ("1846", 99, "production")]
    documents = [(1, "DoC", "production"), (2, "DoC", "staged"), (3, "DoC", "superseded"), (4, "IFU", "production"), (5, "DoC", "staged")]
    return articles.article_status(
        make(items, "item_ref string, mfr_ref string, md_flag boolean"), make([(g, i) for i, g in of.items()], "group_id long, item_ref string"), make(groups, "group_id long, canonical_name string"),
        make([("CARL", "M1"), ("CO", "M2"), ("KOMET", "M4"), ("EXACT", "M5"), ("CARL", "M1")], "canonical_name string, srn string"), make([("KOMET", REORDER), ("CO", None)], "canonical_name string, strategy string"),
        make(devices, "basic_udi_di string, reference string, trade_name string, srn string"), make(links, "item_ref string, doc_id long, status string"), make(documents, "doc_id long, type string, status string"),
    ).persist()


def test_article_status(status):
    got = {(r["item_ref"], r["basic_udi_di"]): tuple(r)[3:] for r in status.collect()}
    assert got == {
        ("1845", "BUDI-A"): (None, True, False, False), ("1846", "BUDI-A"): (None, True, False, False), ("1847", "BUDI-A"): (None, True, False, False), ("R1", "BUDI-R"): ("x", True, False, False),
        ("DUP1", "BUDI-D"): ("Trade B", True, False, False), ("S1", "BUDI-S"): ("s", True, False, True), ("SUP1", "BUDI-P"): ("p", True, True, False), ("N1", None): (None, False, False, False),
        ("K1", "BUDI-K"): ("bur", True, False, False), ("K2", "BUDI-K"): ("bur", True, False, False), ("E1", None): (None, False, False, False), ("TWO", "BUDI-T"): ("t", True, False, False), ("TWO", "BUDI-U"): ("t", True, False, False),
    }


def test_gaps(spark, status):
    gap = {(r["canonical_name"], r["basic_udi_di"]): tuple(r)[2:5] for r in articles.declaration_gap(status, spark.createDataFrame([("CARL",), ("CARL",)], "canonical_name string")).collect()}
    assert gap["CARL", "BUDI-A"] == (3, 0, True) and gap["CO", "BUDI-R"] == (1, 0, False) and gap["CO", "BUDI-D"] == (1, 0, False) and gap["CO", "BUDI-S"] == (1, 1, False) and ("CO", "BUDI-P") not in gap
    summary = {r["canonical_name"]: tuple(r)[1:] for r in articles.gap_summary(status).collect()}
    assert summary == {"CARL": (0, 0, 3, 0), "CO": (1, 1, 3, 1), "KOMET": (0, 0, 2, 0), "EXACT": (0, 0, 0, 1)}
