"""Kinds of documents, in golden cases."""

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import classify


def told(spark, cases, make):
    rows = spark.createDataFrame([(i, t, f) for i, (t, f) in enumerate(cases)], "i int, text string, file string").select("i", make(F.col("text"), F.col("file")).alias("x"))
    return [r["x"] for r in sorted(rows.collect(), key=lambda r: r["i"])]


def pair(x):
    return (x["value"], x["conf"]) if x else None


def test_types(spark):
    cases = {
        ("EU Declaration of Conformity", None): ("DoC", 1.0), ("see the instructions for use; declaration of conformity", ""): ("IFU", 1.0), ("x" * 4000 + "EC certificate", ""): ("EC", 0.6), ("x" * 3999 + "EC certificate", ""): ("EC", 1.0),
        ("certified to ISO 13485 Konformitätserklärung", ""): ("DoC", 1.0), ("ISO 13485", ""): ("ISO", 0.6), ("Zertifikat ISO 13485", ""): ("ISO", 1.0), ("EU Certificate / Quality Management System", ""): ("EC", 1.0), ("Izjava EU o skladnosti", ""): ("DoC", 1.0),
        ("nothing", "a/iso/b/IFU_7.pdf"): ("IFU", 0.6), ("nothing", "a/iso/letter.pdf"): None, ("", "13485 doc"): ("DoC", 0.6), (None, None): None,
    }
    assert [pair(x) for x in told(spark, cases, classify.document_type)] == list(cases.values())


def test_regulations(spark):
    cases = {
        ("Regulation (EU) 2017/745", ""): ("MDR", 1.0), ("93/42/EEC", ""): ("MDD", 1.0), ("2017/745 and 93/42", "mdr"): None, ("", "x/MDR_1.pdf"): ("MDR", 0.6), ("", "mdr/x.pdf"): None, ("", "93-42.pdf"): ("MDD", 0.6), (None, None): None,
    }
    assert [pair(x) for x in told(spark, cases, classify.regulation)] == list(cases.values())


def test_stated_classes(spark):
    cases = {
        "Class III": "III", "risk class: IIa": "IIa", "Klasse/ II b": "IIb", "class I m": "Im", "Class I annex": "I", "Class I sterile": "I", "Class Is/Ir/IIa/llb/lll": None, "class I, IIa": None, "Class IIa. Class IIb.": None, "class iia Class IIa": "IIa",
        "For marketing of class III devices": None, "Class I medical devices were converted": None, "classified as  class III devices": "III", "Class IIa Device Group": "IIa", "class IIa implantable devices": None, "Annex II": None, "class II": None, "": None, None: None,
    }
    got = [x["value"] if x else None for x in told(spark, [(t, None) for t in cases], lambda t, f: classify.stated_class(t))]
    assert got == list(cases.values())
    assert told(spark, [("risk class II  a ok", None)], lambda t, f: classify.stated_class(t))[0]["verbatim"] == "risk class II  a"


def test_certificate_numbers(spark):
    cases = {
        "Certificate No.: 0675GB448260109\nNotified Body identification no. 0123": "0675GB448260109", "Certificate No. G1 234567 8901\nKennung WRONG-ONE": "G1 234567 8901", "Article\nNo.\nDescription": None, "x\nNo. D1002600038\ny": "D1002600038",
        "Zertifikat-Kennung DE-123456": "DE-123456", "Zertifikat-Kennung folgt": None, "Cert. no: AB-1234.": "AB-1234", "": None, None: None,
    }
    pattern = F.lit(r"Kennung\s+(?:([A-Z]{2}-\d{6}))?")
    assert [x["value"] if x else None for x in told(spark, [(t, None) for t in cases], lambda t, f: classify.certificate_number(t, pattern))] == list(cases.values())
    assert told(spark, [("Zertifikat-Kennung DE-123456", None)], lambda t, f: classify.certificate_number(t)) == [None]


@pytest.mark.parametrize("page,header,name,want", [
    ("Varnostni  list", "", "", "msds"), ("Invoice: declaration of conformity", "", "", "business-doc"), ("EC Certificate", "", "", "compliance-doc"), ("cover", "instructions\nfor use", "", "compliance-doc"), ("cover", "cover", "doc.pdf", "unknown"),
    ("", " ", "x/doc.pdf", "compliance-doc"), ("", "", "doc/x.pdf", "unknown"), (None, None, "a_93-42.pdf", "compliance-doc"), (None, None, None, "unknown"),
])
def test_classes_of_documents(spark, page, header, name, want):
    rows = spark.createDataFrame([(page, header, name)], "page string, header string, name string")
    assert rows.select(classify.promoted_class(classify.document_class(F.col("page")), F.col("header"), F.col("name")).alias("c")).first()["c"] == want
