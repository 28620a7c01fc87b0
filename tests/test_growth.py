"""Queries whose work must grow with their tables: no hot key, no broadcast of grown rows, no pairs that are only counted."""

import pytest
from pyspark.sql import functions as F

from ledgerlight.plans import projection, registry
from ledgerlight.plans.dialect import spark_sql

SF = "/root/testdata/sf0.001"


@pytest.fixture
def plain_shuffles(spark):
    """Joins by shuffle and as planned, as on tables too large to broadcast."""
    values = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def seeded(spark, monkeypatch):
    """Replace relations of the projection by rows."""

    def seed(**tables):
        for name, (schema, rows) in tables.items():
            spark.createDataFrame(rows, schema).createOrReplaceTempView(f"grown_{name}")
            monkeypatch.setitem(projection.RELATIONS, name, f"SELECT * FROM grown_{name}")

    return seed


def test_documents_without_certificate_go_to_all_tasks(spark, plain_shuffles, seeded):
    docs = [(i, "DoC", "MDR", None, None, i + 1 if i % 20 == 0 else None, "production") for i in range(2000)]
    seeded(document=("doc_id long, type string, regulation string, validity_from date, validity_to date, cert_doc_id long, status string", docs))
    held = spark.sql(spark_sql("SELECT * FROM expiry")).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 2000 and max(r["count"] for r in held) < 1000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _broadcast_generates(plan):
    """Whether something below a broadcast is exploded."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = line.index("BroadcastExchange")
            for below in lines[i + 1 :]:
                if len(below) - len(below.lstrip(" :+-")) <= depth:
                    break
                if "Generate " in below:
                    return True
    return False


def test_near_matches_broadcast_no_exploded_rows(spark):
    assert not _broadcast_generates(_plan(registry.QUERIES["r12_near_matches"](spark, SF)))


def test_same_asks_are_answered_once(spark, monkeypatch):
    from ledgerlight.operators import picker

    sizes = []
    cut = picker.cut
    monkeypatch.setattr(picker, "cut", lambda df: (sizes.append(df.count()), cut(df))[1])
    items = spark.createDataFrame([("m", f"V{n:04d}", f"VARIOBASE {n}") for n in range(30)], "manufacturer string, item_ref string, name string")
    asks = spark.createDataFrame([(i, "m", ("V000", "variobase ")[i % 2]) for i in range(40)], "ask_id int, manufacturer string, q string")
    rows = picker.search_items(items, asks, nearby=1).collect()
    assert len(rows) == 20 * (10 + 1) + 20 * 30 and {r["total"] for r in rows if r["mode"] != "nearby"} == {10, 30}
    assert max(sizes) <= 30


def test_names_of_many_items_are_compared_once(spark, monkeypatch):
    from ledgerlight.operators import resolve as module

    seen = []
    ratio = module.ratio_column

    def counted(kind, a, b):
        seen.append(spark.sparkContext.accumulator(0))
        total = seen[-1]

        @F.udf("string")
        def count(x):
            total.add(1)
            return x

        return ratio(kind, count(a), b)

    monkeypatch.setattr(module, "ratio_column", counted)
    kinds = "item_ref string, manufacturer string, name string, udi string"
    items = spark.createDataFrame([(f"i{n}", "m", "large ring" if n % 2 else "small bolt", None) for n in range(60)], kinds)
    members = spark.createDataFrame([(n % 5, f"m{n}", "m", "large ring" if n % 2 else "small bolts", None) for n in range(20)], f"group_id long, {kinds}")
    got = {r["item_ref"]: (r["group_id"], r["rung"], r["score"]) for r in module.resolve(items, members).collect()}
    assert {v for k, v in got.items() if int(k[1:]) % 2} == {(0, "name", 1.0)} and len(got) == 60
    assert seen[0].value <= 8


def test_near_misses_are_met_by_keys(spark):
    plan = _plan(registry.QUERIES["v11_certificate_near_miss"](spark, SF))
    [join] = [x for x in plan.splitlines() if "SortMergeJoin" in x and "srn" in x]
    assert "k#" in join.split("], [")[0]


def test_near_misses_of_all_kinds(spark, seeded):
    held = ["SX 1", "SX 2", "HZ 3", "HZ 4", "SX 5", "SX 6"]
    seeded(
        held_certificate=("doc_id long, manufacturer string, base_number string", [(i, "M", n) for i, n in enumerate(held)]),
        trusted_actor=("canonical_name string, srn string", [("M", "s")]),
        register_certificate=("row_id string, actor_srn string, certificate_number string", [("r", s, n) for s, n in [("s", "SX 1A"), ("s", "HZ 2"), ("s", "SX 3"), ("s", "HZ 4"), ("t", "SX 5A"), ("s", "SX 6"), ("s", None)]]),
    )
    got = {tuple(r) for r in registry.QUERIES["v11_certificate_near_miss"](spark, SF).collect()}
    assert got == {(0, "SX 1", "SX 1A", "trailing-letter"), (1, "SX 2", "HZ 2", "prefix"), (2, "HZ 3", "SX 3", "prefix")}


def test_binding_counts_items_before_the_join(spark):
    plan = registry.QUERIES["g07_manufacturer_binding"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if x.lstrip(" :+-").startswith("Aggregate")]) == 3  # of the aliases, of the items, of the documents


def test_pairs_of_references_are_not_made_distinct(spark, seeded):
    seeded(
        item=("item_ref string, mfr_ref string", [("P1", "a"), ("P1", "a.K1"), ("P1", "a"), ("P2", "a.K1"), ("P3", None)]),
        register_device=("udi_di string, reference string", [("U1", "a.K1"), ("U1", "a.K1"), ("U2", "a"), ("U3", None)]),
    )
    df = registry.QUERIES["j08_theta_as_union"](spark, SF)
    assert sorted(map(tuple, df.collect())) == [("P1", "U1"), ("P1", "U2"), ("P2", "U1")]
    assert "Aggregate" not in _plan(df).split("Join")[0]


@pytest.mark.parametrize(
    "name",
    [
        "v05_item_document_history", "v06_item_document_production", "q01_coverage", "q12_renewal_letters", "q17_items_board", "z08_expiry_scan", "q26_maker_completeness", "q36_item_fields", "a04_bool_or", "a05_distinct_array",
        "a10_two_levels", "j02_left_outer", "j03_count_after_left", "j04_exists_in_filter", "j14_scalar_decorrelated", "q09_expiring_counts",
    ],
)
def test_no_query_over_expiry_meets_by_a_bare_certificate(spark, plain_shuffles, name):
    """Where documents without a certificate have a null key, all of them are one task."""
    keys = [x for x in _plan(registry.QUERIES[name](spark, SF)).splitlines() if "hashpartitioning(" in x and "cert_doc_id#" in x]
    assert all("hashpartitioning(coalesce(cert_doc_id#" in x for x in keys)
    assert keys or "cert_doc_id#" not in _plan(registry.QUERIES[name](spark, SF))
