"""Functions that SQL text can call: as the Column functions, and as a table function."""

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import references, text
from ledgerlight.functions.sql import register

REFS = ["314 h5 7", " rc5.314.07 ", "9.204.005", "RC.070.014.K3", "104 H219A 023-1", "645986WW", "1055", "", None, "a.b", "12ABCD"]


@pytest.fixture(scope="module")
def named(spark):
    assert "fold_code" in register(spark)
    spark.createDataFrame([(i, r, s) for i, r in enumerate(REFS) for s in ("strip-trailing-letters", "reorder-shank-figure-size", None)], "i int, ref string, strategy string").createOrReplaceTempView("refs")
    return spark


def test_scalars_equal_the_columns(named):
    sql = named.sql("SELECT i, strategy, fold_code(ref) AS a, register_key(ref) AS b, normalise_ref(ref, strategy) AS c, bare_key(ref) AS d FROM refs")
    ref = F.col("ref")
    own = named.table("refs").select("i", "strategy", references.fold_code(ref), references.register_key(ref), references.normalise_ref(ref, F.col("strategy")), references.bare_key(ref))
    assert sorted(map(tuple, sql.collect()), key=repr) == sorted(map(tuple, own.collect()), key=repr)
    assert "Python" not in sql._jdf.queryExecution().executedPlan().toString()


def test_similarity(named):
    named.createDataFrame([("word", "two words"), ("E.MAX", "emax ceram"), ("", "x"), (None, "x")], "a string, b string").createOrReplaceTempView("pairs")
    got = [r[0] for r in named.sql("SELECT similarity(a, b) FROM pairs").collect()]
    want = [r[0] for r in named.table("pairs").select(text.trigram_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == want and got[0] == pytest.approx(4 / 11)


def test_records_are_expanded(named):
    named.createDataFrame([(1, '{"value": [{"a": "x", "n": 5}, {"a": null}]}'), (2, '[7, {"k": [1]}]'), (3, "no json"), (4, None), (5, '{"content": []}')], "id int, body string").createOrReplaceTempView("bodies")
    rows = named.sql("SELECT id, pos, key, value FROM bodies, LATERAL expand_records(body)").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted([(1, 0, "a", "x"), (1, 0, "n", "5"), (1, 1, "a", None), (2, 0, None, None), (2, 1, "k", "[1]")], key=repr)
