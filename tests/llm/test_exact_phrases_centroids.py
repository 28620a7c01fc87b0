"""Exact dedup, collocations and centroid clustering against brute force over small tables with awkward rows."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import centroids, exact_dedup, phrases

# ---- exact dedup


def dup_rows():
    rng = random.Random(3)
    base = ["a b", "a  b", "a\tb", " a b", "a b ", "", " ", "\n", "x" * 20_000, "x" * 20_000 + " ", "é è", None, "a\x0bb", "a\x1cb"]
    rows = [(i, rng.choice(base)) for i in range(300)] + [(i, f"own {i}") for i in range(300, 400)]
    rows += [(7, rows[7][1])] * 3 + [(None, "a b")] * 2 + [(None, "only nulls")] * 4 + [(5, "own 310"), (500, None), (501, "")]
    rng.shuffle(rows)
    return rows


def dup_truth(rows):
    norm = lambda t: re.sub("[ \t-\r]+", " ", t or "")
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for t, ids in groups.items():
        best = min(ids, key=lambda x: (x is None, x or 0))
        left = 1
        for i in ids:
            kept = i == best and left > 0
            left -= kept
            out.append((i, best, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches,shard_rows", [(1, 1000), (2, 1000), (4, 20)])
def test_exact_dedup(spark, batches, shard_rows):
    rows = dup_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, digest string, shard long").repartition(3)
    got = exact_dedup.exact_duplicates(docs, batches=batches, shard_rows=shard_rows).withColumn("digest", F.lower(F.hex("digest")))
    assert sorted(map(tuple, got.collect()), key=repr) == dup_truth(rows)


def test_exact_dedup_compares_bytes(spark):
    """With a digest of one byte most digests are shared by several texts: only the bytes can tell them apart."""
    rows = dup_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weak = lambda t: F.substring(exact_dedup.sha256(t), 1, 1)
    got = exact_dedup.exact_duplicates(docs, batches=3, digest=weak).drop("digest").collect()
    assert sorted(map(tuple, got), key=repr) == sorted((r[:4] for r in dup_truth(rows)), key=repr)


def test_exact_dedup_drops_and_keeps_columns(spark):
    docs = spark.createDataFrame([(2, "a b", "p"), (1, "a  b", "q"), (3, "c", "r")], "doc_id long, text string, keep_id string")
    got = exact_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == [(1, "a  b", "q"), (3, "c", "r")]
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def test_snapshots_take_batches_one_after_the_other(spark, tmp_path):
    store = exact_dedup.SnapshotStore(spark, f"file://{tmp_path}/store", 4)
    batch = lambda *rows: spark.createDataFrame(rows, "doc_id long, text string")
    store.add(batch((9, "a"), (8, "b"), (7, "b")))
    second = store.add(batch((1, "b"), (2, "c"), (3, "c"))).collect()
    assert sorted((r["snapshot"], r["root"]["snapshot"]) for r in second) == [(1, 0), (1, 1)]
    third = store.add(batch((4, "c"), (5, "a"), (6, "z"))).collect()
    assert sorted(r["root"]["snapshot"] for r in third) == [0, 1, 2]
    assert store.buckets(0).where("text = 'b'").first()["n"] == 2
    store.remove()
    assert not (tmp_path / "store").exists()


@pytest.mark.parametrize("n", [0, 1, 2, 10, 1000, 50_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    built = exact_dedup.build_fuse(keys)
    assert exact_dedup.fuse_contains(built, keys).all()
    others = rng.integers(1 << 63, (1 << 64) - 1, 100_000, dtype=np.uint64)
    assert exact_dedup.fuse_contains(built, others).mean() < 0.02
    if n == 50_000:
        assert exact_dedup.fuse_contains(built, others).mean() < 0.006 and 8 * len(built) < 11 * n


# ---- collocations


def phrase_truth(rows, min_count, top, most=5):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang, text = lang or "und", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= min_count}
    gone = {(lang, p[i : i + k]) for (lang, p), c in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if c >= f[lang, p[i : i + k]]}
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) in gone:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, x in out.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1))


def phrase_rows():
    rng = random.Random(8)
    vocabulary = ["The", "of", "and", "to", "Zu", "é", "ß", "x|y", "10%", " ", "ÄB"] + [f"w{i}" for i in range(12)]
    rows = []
    for _ in range(250):
        words = rng.choices(vocabulary, [30, 20, 10, 8] + [2] * 19, k=rng.randint(0, 40))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!"]) for w in words)
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    rows += [("the of the of the of " * 40, "en")] * 5 + [("one phrase that many documents share here.", "de")] * 40 + [(None, "en"), ("", None), ("...", "xx"), ("q " * 3000, "fr")]
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_words": 50, "hot_share": 1 / 20_000}, {"shard_words": 2000, "hot_share": 0.01}, {"bloom_bits": 1 << 13, "codes": 5}, {"codes": 0}])
def test_collocations(spark, options, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 1500)
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, t, x, "n", 0) for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n long").repartition(4)
    got = phrases.collocations(docs, min_count=4, top=60, **options)
    assert sorted(map(tuple, got.collect())) == phrase_truth(rows, 4, 60)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")
    assert phrases.collocations(docs).count() == 0 and phrases.collocations(docs.limit(0)).count() == 0


def test_hot_pairs_are_dealt_by_all_their_words(spark):
    """A pair that most of the text consists of is in many shards, and is counted whole."""
    rng = random.Random(1)
    docs = spark.createDataFrame([(" ".join(f"hot pair v{rng.randint(0, 50)}" for _ in range(200)), "en") for _ in range(40)], "text string, lang string").repartition(4)
    words = phrases.with_keys(phrases.count_words(docs, 0, 1 / 20_000).where("word is not null"), 0)
    keys = {r["word"]: r["key"] for r in words.collect()}
    hot = np.sort(np.array([keys["hot"], keys["pair"]], np.int64).view(np.uint64))
    pair = phrases._pairs(np.array([keys["hot"]], np.int64).view(np.uint64), np.array([keys["pair"]], np.int64).view(np.uint64))
    bloom = np.full(128, ~np.uint64(0))
    plan = spark.sparkContext.broadcast(phrases.Plan(bloom, hot[:1], hot, pair))
    dealt = phrases.deal_suffixes(docs, plan, 32, 5, 0)
    found = phrases.count_prefixes(dealt, plan, 5, 100).withColumn("words", F.length("phrase") / 8)
    assert found.where("words = 2").groupBy("phrase").count().agg(F.max("count")).first()[0] > 16
    assert found.where("words = 2").groupBy("phrase").agg(F.sum("n").alias("n")).where("n = 8000").count() == 1


# ---- centroids


def cluster_truth(rows, clusters, rounds, dim, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: ((r[0] is None), hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [v for _, v in order[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((far(v, c), k) for k, c in enumerate(cents))
    for _ in range(rounds):
        who = collections.defaultdict(list)
        for _, v in kept:
            who[near(v)[1]].append(v)
        cents = [[sum(x) // len(who[k]) for x in zip(*who[k], strict=True)] if k in who else c for k, c in enumerate(cents)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, d, k in last:
        inertia[k] += d
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), cents[k]) for i, d, k in last), key=repr)


def vector_rows(seed, n, dim, spread):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in rng.choice(middles)]) for i in range(n)]
    # ties: points halfway between integer grid points, copies, and rows that share an id
    rows += [(n + i, [float(rng.randint(-1, 1)) for _ in range(dim)]) for i in range(60)] + [(n + i, [0.0] * dim) for i in range(60, 90)]
    bad = [None, [], [1.0] * (dim - 1), [math.nan] + [0.0] * (dim - 1), [math.inf] + [0.0] * (dim - 1), [None] + [0.0] * (dim - 1)]
    rows += [(1000 + i, v) for i, v in enumerate(bad)] + [(None, [0.5] * dim), (3, [2.5] * dim), (3, [-2.5] * dim)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("clusters,dim,spread", [(16, 4, 2.0), (5, 3, 0.1), (400, 2, 1.0)])
def test_centroids(spark, clusters, dim, spread):
    rows = vector_rows(clusters, 150, dim, spread)
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, point string").repartition(3)
    got = centroids.clustering(vectors, clusters=clusters, dim=dim)
    assert sorted(map(tuple, got.collect()), key=repr) == cluster_truth(rows, clusters, 3, dim)
    assert centroids.clustering(vectors.limit(0), dim=dim).count() == 0


def test_annulus_is_smaller_than_all_centroids(spark):
    """Vectors of different norms are compared with the centroids of their annulus only, and with the right result."""
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.uniform(-1, 2) for _ in range(4)]) for i in range(600)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assigned, found = centroids.cluster_vectors(vectors, clusters=50, dim=4)
    assert assigned.agg(F.sum("looked")).first()[0] < 0.5 * 50 * len(rows)
    assert sorted((r["id"], r["cluster"], r["distance"]) for r in assigned.collect()) == sorted(x[:3] for x in cluster_truth(rows, 50, 3, 4))
    assert not spark.sparkContext._jsc.getPersistentRDDs()
