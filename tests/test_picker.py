"""The item search: golden cases, and the join against a comparison of all names."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import picker

S = "STRAUMANN"


def grams(text):
    out = []
    for w in re.findall(r"[^\W_]+", text.lower()):
        p = f"  {w} "
        out += [p[i : i + 3] for i in range(len(p) - 2)]
    return out


def word_similarity(q, name):
    own, other = set(grams(q)), grams(name)
    runs = [set(other[i:j]) for i in range(len(other)) for j in range(i + 1, len(other) + 1)]
    return max([len(own & r) / len(own | r) for r in runs] or [0.0])


def found(spark, items, asks, **options):
    items = spark.createDataFrame([(m, r, n) for r, n, *m_ in items for m in [m_[0] if m_ else S]], "manufacturer string, item_ref string, name string")
    asks = spark.createDataFrame([(i, S, q) for i, q in enumerate(asks)], "ask_id int, manufacturer string, q string")
    out = {}
    for r in sorted(picker.search_items(items, asks, **options).collect(), key=lambda r: (r["ask_id"], r["mode"], r["rank"])):
        out.setdefault((r["ask_id"], r["mode"]), []).append(r["item_ref"])
    return out


ITEMS = [
    ("010.6042", "NC VARIOBASE FOR CROWN AS"), ("X-1", "NC VARIOBASE FOR CROWN AS", "OTHER"), ("011.1", "BONE LEVEL IMPLANT"), ("010.6054", "B"), ("022.0000", "C 010.6"), ("6042.1", "A"),
    ("596839", "E.MAX CERAM ZIRLINER 5G 1"), ("554034", "EMPRESS KIVETE 100G"), ("50%-A", "X"), ("50-B", "Y"), ("K1", "KIT 999.9 PARTS"), (None, "nothing"), ("n1", None),
]


def test_search(spark):
    asks = ["variobase", "varibase", "010.60", "6042", "999.9", "emax", "", "   ", "%", "_", "-.-", "50%", None, "%50"]
    got = found(spark, ITEMS, asks)
    main = {k: v for k, v in got.items() if k[1] != "nearby"}
    assert main == {
        (0, "search"): ["010.6042"], (1, "search"): ["010.6042"], (2, "number"): ["010.6042", "010.6054"], (3, "number"): ["6042.1", "010.6042"], (5, "search"): ["596839"], (11, "number"): ["50%-A"],
    }
    assert not {a for a, m in got if m == "nearby"} & {0, 1, 4, 5}


def test_nearby_numbers_are_the_ten_to_each_side(spark):
    items = [(f"100.{n:03d}", f"PART {n}") for n in range(1, 31)] + [("100.0155", "OTHER MAKER", "OTHER")]
    got = found(spark, items, ["100.015", "00.015", "00.01"])
    assert got[0, "number"] == ["100.015"] == got[1, "number"]
    want = [f"100.{n:03d}" for n in [*range(5, 15), *range(16, 26)]]
    assert sorted(got[0, "nearby"]) == want == sorted(got[1, "nearby"])
    assert (2, "nearby") not in got  # scattered hits have no neighbours


def test_search_is_capped_and_says_how_many_there_are(spark):
    items = spark.createDataFrame([(S, f"V{n:04d}", f"VARIOBASE {n}") for n in range(25)], "manufacturer string, item_ref string, name string")
    asks = spark.createDataFrame([(1, S, "variobase"), (2, S, "V000")], "ask_id int, manufacturer string, q string")
    rows = picker.search_items(items, asks, cap=20, nearby=1).where("mode <> 'nearby'").collect()
    assert {(r["ask_id"], r["total"]) for r in rows} == {(1, 25), (2, 10)} and len(rows) == 30


def test_search_equals_a_comparison_of_all_names(spark):
    rng = random.Random(5)
    words = ["variobase", "vario", "base", "crown", "e.max", "emax", "implant", "bone-level", "nc", "rc", "5g", "implantat", "krone"]
    items = [(f"i{n}", " ".join(rng.choices(words, k=rng.randint(1, 5))).upper()) for n in range(120)]
    asks = [w[: rng.randint(2, len(w))] + rng.choice(["", "e", "s"]) for w in words] + ["bone level", "nc crown"]
    rows = picker.search_items(
        spark.createDataFrame([(S, *i) for i in items], "manufacturer string, item_ref string, name string"), spark.createDataFrame([(i, S, q) for i, q in enumerate(asks)], "ask_id int, manufacturer string, q string"), cap=10_000
    )
    got = {(r["ask_id"], r["item_ref"], round(r["score"], 9)) for r in rows.where("mode = 'search'").collect()}
    score = lambda q, n: max(word_similarity(q, n), word_similarity(q, re.sub(r"[^\w\s]", "", n)))
    assert got == {(i, r, round(score(q, n), 9)) for i, q in enumerate(asks) for r, n in items if score(q, n) >= 0.5}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_similar_items_and_suggestions(spark):
    items = spark.createDataFrame([(S, "1", "VARIOBASE CROWN AS"), (S, "2", "VARIOBASE BRIDGE"), (S, "3", "IMPLANT"), ("O", "4", "VARIOBASE CROWN")], "manufacturer string, item_ref string, name string")
    asks = spark.createDataFrame([(7, S, "1"), (8, S, "none")], "ask_id int, manufacturer string, item_ref string")
    assert [(r["ask_id"], r["item_ref"]) for r in picker.similar_items(items, asks).collect()] == [(7, "2")]
    text = "PrograMill PM3 navodila za uporabo 2024 Straumann VARIOBASE the variobase x1"
    row = spark.createDataFrame([(text, "Straumann AG")], "t string, m string").select(picker.suggested_words(F.col("t"), F.col("m")).alias("w")).first()
    assert row["w"] == ["programill", "pm3", "variobase"]


@pytest.mark.parametrize("q,name", [("varibase", "NC VARIOBASE FOR CROWN"), ("emax", "E.MAX CERAM"), ("abc abc", "x abc y abc"), ("a", ""), ("zz", "abc")])
def test_word_similarity(spark, q, name):
    got = spark.createDataFrame([(q, name)], "q string, n string").select(picker.word_similarity(F.col("q"), F.col("n")).alias("s")).first()["s"]
    assert got == pytest.approx(word_similarity(q, name))
