"""Confidences of readings and scores of documents, in golden cases."""

import pytest

from ledgerlight.operators import gate

SCHEMA = "doc_id long, field string, value string, conf double, tier string, verbatim string, page int, model_id string, agreed_conf double, agreed_model_id string, proven string, follows string"


def read(doc, field, conf, model="m1", agreed=None, second="m2", proven=None, follows=None, value="x", tier="T1", verbatim="v", page=1):
    return doc, field, value, conf, tier if model else "T0", verbatim, page, model, agreed, second if agreed is not None or second is None else None, proven, follows


#: read, factors, scored, stored
CASES = [
    (read(1, "type", 0.70, agreed=0.70), 1, 1 - 0.3 * 0.3, 1 - 0.3 * 0.3), (read(2, "coverage_scope", 0.85, agreed=0.90), 1, 1 - 0.15 * 0.10, 1 - 0.15 * 0.10), (read(3, "type", 0.69, agreed=0.95), 1, 0.69, 0.69),
    (read(4, "type", 0.90, agreed=0.69), 1, 0.90, 0.90), (read(5, "type", 0.85), 1, 0.85, 0.85), (read(6, "type", 0.85, agreed=0.95, second=None), 1, 0.85, 0.85), (read(7, "type", 0.85, model=None, agreed=0.95), 1, 0.85, 0.85),
    (read(8, "regulation", 0.60, proven="citation"), 1, 1.0, 1.0), (read(9, "regulation", 0.80, agreed=0.80, proven="citation"), 1, 1.0, 1.0), (read(10, "type", 0.60, proven="citation"), 1, 0.60, 0.60),
    (read(11, "regulation", 0.80, model=None, proven="citation"), 1, 0.80, 0.80), (read(12, "type", 0.90, model="half", agreed=0.90), 1, 0.45, 0.90), (read(13, "type", 0.90, model="most", agreed=0.90), 1, 1 - 0.19 * 0.1, 1 - 0.1 * 0.1),
    (read(14, "type", None), 1, None, None), (read(15, "type", 0.9, model="own"), 1, 0.9 * 0.2, 0.9), (read(16, "regulation", 0.9, model="own"), 1, 1.0, 0.9), (read(17, "type", None, model=None), 1, None, None),
]
FACTORS = [("half", "*", 0.5), ("most", "*", 0.9), ("own", "*", 3.0), ("own", "type", 0.2), (None, "*", 0.1)]


def test_confidences(spark):
    factors = spark.createDataFrame(FACTORS, "model_id string, field string, factor double")
    got = {r["doc_id"]: r for r in gate.confidences(spark.createDataFrame([c[0] for c in CASES], SCHEMA), factors).collect()}
    for row, _, scored, stored in CASES:
        assert got[row[0]]["scored"] == (None if scored is None else pytest.approx(scored)), row
        assert got[row[0]]["stored"] == (None if stored is None else pytest.approx(stored)), row


def test_scores(spark):
    rows = [
        *[read(1, f, c) for f, c in (("type", 0.9), ("regulation", 0.8), ("coverage_scope", 0.7), ("validity_to", 0.1))],
        read(2, "type", 0.9), read(2, "regulation", 0.8), read(2, "coverage_scope", 0.3, follows="type"), read(3, "type", 0.9), read(3, "regulation", 0.9), read(3, "coverage_scope", 0.9, value=None),
        read(4, "type", 0.9), read(4, "regulation", 0.9, page=None), read(4, "coverage_scope", None), read(5, "type", 0.9, model=None, page=None), read(5, "regulation", 1.0, model=None, page=None), read(5, "coverage_scope", 0.95, model=None, page=None),
    ]
    judged = gate.confidences(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], "model_id string, field string, factor double"))
    assert {r["doc_id"]: tuple(r)[1:] for r in gate.scores(judged).collect()} == {1: (0.7, True, False), 2: (0.8, True, False), 3: (0.9, False, False), 4: (0.0, False, True), 5: (0.9, True, False)}
