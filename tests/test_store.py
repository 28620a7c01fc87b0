"""Relations that are written once for a run of queries."""

import pytest

from ledgerlight.plans import registry
from ledgerlight.plans.dialect import drop_relations, keep_relations

SF = "/root/testdata/sf0.001"
NAMES = ("q09_expiring_counts", "q10_expiry_board", "v05_item_document_history", "v07_document_current", "v03_effective_expiry")


@pytest.fixture(scope="module")
def kept(spark):
    plain = {n: sorted(map(tuple, registry.QUERIES[n](spark, SF).collect()), key=repr) for n in NAMES}
    rows = keep_relations(spark, SF)
    yield plain, rows
    drop_relations(spark, SF)


def test_kept_relations_change_nothing(spark, kept):
    plain, rows = kept
    assert set(rows) == {"expiry", "history"} and all(rows.values())
    for name, want in plain.items():
        assert sorted(map(tuple, registry.QUERIES[name](spark, SF).collect()), key=repr) == want, name


def test_kept_relations_are_read_in_place_of_their_making(spark, kept):
    for name in ("q09_expiring_counts", "q10_expiry_board", "v05_item_document_history"):
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "rank(" not in plan, name  # currency isn't ranked again
    assert "l_linestatus" not in plan  # nor are links grouped again for an item's history


def test_dropped_relations_are_made_anew(spark):
    keep_relations(spark, SF, ("expiry",))
    drop_relations(spark, SF)
    plan = registry.QUERIES["v05_item_document_history"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "rank(" in plan
