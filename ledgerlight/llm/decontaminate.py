"""Benchmark decontamination by winnowing.

Of every window of `window - k + 1` consecutive k-word grams the one with the least hash is kept, in the documents and
in the benchmark alike; texts that share `window` words then share a kept gram at the same place of the shared span.
The grams meet in a join, each with the words around it, and a joined pair is extended word by word to both sides. A
span of at least `window` common words is a hit; as no hash decides, equal words are compared, the result is exact.
Benchmark items shorter than a window are looked up by their first min(k, length) words at every document position,
as winnowing promises nothing for them, and must match whole.

A Bloom filter of the benchmark's grams, of at most `bloom_bits` bits and so bounded for the broadcast, keeps most of
the documents' grams out of the shuffle. A gram that a third of the documents have makes a hot join key, which
adaptive execution splits; what follows is aggregated by document with partial aggregation.

Edge cases: null, empty and wordless texts have no words and are clean; null or empty items match nothing; repeated
items count once (item_id); a document is known by its id and its text, so that rows that share a doc_id, null too, are
judged each, and rows equal in both are one document; empty tables give empty results or clean documents; further columns, with
whatever names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import _bytes as B

WINDOW, GRAM = 13, 5


def _rows(words: B.Words, texts: np.ndarray, at: np.ndarray, k: np.ndarray, around: int) -> tuple[list, list, list]:
    """Of grams of k words at positions at: the words, those before (nearest first) and those after."""
    mid, before, after = [], [], []
    for t, i, n in zip(texts.tolist(), at.tolist(), k.tolist(), strict=True):
        lo, hi = int(words.bounds[t]), int(words.bounds[t + 1])
        mid.append(" ".join(words.word(x) for x in range(i, i + n)))
        before.append([words.word(x) for x in range(i - 1, max(lo, i - around) - 1, -1)])
        after.append([words.word(x) for x in range(i + n, min(hi, i + n + around))])
    return mid, before, after


def _tagged(grams: np.ndarray, k: int) -> np.ndarray:
    """Grams of other lengths, and those that are looked up everywhere, are other keys."""
    return B.mix(grams ^ np.uint64(k * 0x1000193))


def benchmark_grams(items: DataFrame, id_col: str, text_col: str, window: int, k: int) -> DataFrame:
    """(gram, short, need, item_id, i_mid, i_before, i_after): kept grams of long items; the head of short ones."""
    kind = items.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = B.text_bytes(batch.column(1))
            for a, b in B.pieces(offs):
                w = B.Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], B.ALNUM)
                count = np.diff(w.bounds)
                text = np.repeat(np.arange(b - a), count)
                grams = B.shingles(w.hash, k)
                at = np.flatnonzero(B.winnow(grams, w.left(), k, window - k + 1))
                short = np.flatnonzero((count > 0) & (count < window))
                heads = w.bounds[short]
                lens = np.minimum(count[short], k)
                keys = [_tagged(grams[at], 0)]
                for h, n in zip(heads.tolist(), lens.tolist(), strict=True):
                    keys.append(_tagged(B.shingles(w.hash[h : h + n], n)[:1], n))
                key = np.concatenate(keys).view(np.int64)
                texts = np.concatenate([text[at], short])
                mid, before, after = _rows(w, texts, np.concatenate([at, heads]), np.concatenate([np.full(len(at), k), lens]), window)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key),
                        pa.array(np.repeat([0, 1], [len(at), len(short)]) * np.concatenate([np.zeros(len(at), int), lens]), pa.int32()),
                        pa.array(np.concatenate([np.full(len(at), window), count[short]]), pa.int32()),
                        batch.column(0).slice(a, b - a).take(pa.array(texts)),
                        pa.array(mid, pa.string()),
                        pa.array(before, pa.list_(pa.string())),
                        pa.array(after, pa.list_(pa.string())),
                    ],
                    ["gram", "short", "need", "item_id", "i_mid", "i_before", "i_after"],
                )

    schema = T.StructType.fromDDL("gram long, short int, need int, i_mid string, i_before array<string>, i_after array<string>")
    fields = [*schema.fields[:3], T.StructField("item_id", kind), *schema.fields[3:]]
    return items.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, T.StructType(fields))


def bloom_of(grams: DataFrame, bits: int) -> np.ndarray:
    """Two bits a gram in a table of `bits` bits; at most bits / 64 longs come to the driver."""
    both = grams.select(
        F.explode(
            F.array(F.col("gram").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("gram", 32).bitwiseAND(F.lit(bits - 1)))
        ).alias("bit")
    )
    words = both.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))).alias("set")
    )
    got = words.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[got["word"].to_numpy()] = got["set"].to_numpy().view(np.uint64)
    return out


def _maybe(bloom: np.ndarray, keys: np.ndarray) -> np.ndarray:
    top = np.uint64(len(bloom) * 64 - 1)
    out = np.ones(len(keys), bool)
    for bit in (keys & top, (keys >> np.uint64(32)) & top):
        out &= (bloom[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return out


def document_grams(docs: DataFrame, id_col: str, text_col: str, window: int, k: int, bloom, short: list[int]) -> DataFrame:
    """A row for each document (at = -1, n_words) and one for each kept gram that the benchmark may have."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bloom.value
        for batch in batches:
            data, offs = B.text_bytes(batch.column(1))
            for a, b in B.pieces(offs):
                w = B.Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], B.ALNUM)
                count, left = np.diff(w.bounds), w.left()
                text = np.repeat(np.arange(b - a), count)
                grams = B.shingles(w.hash, k)
                found = []
                at = np.flatnonzero(B.winnow(grams, left, k, window - k + 1))
                key = _tagged(grams[at], 0)
                ok = _maybe(table, key)
                found.append((at[ok], key[ok], np.full(int(ok.sum()), k)))
                for n in short:
                    key = _tagged(B.shingles(w.hash, n), n)
                    at = np.flatnonzero(_maybe(table, key) & (left >= n))
                    found.append((at, key[at], np.full(len(at), n)))
                at, key, size = (np.concatenate(x) for x in zip(*found, strict=True))
                texts = text[at] if len(at) else at.astype(int)
                mid, before, after = _rows(w, texts, at, size, window)
                n = b - a
                rows = pa.array(np.concatenate([np.arange(n), texts]))
                own = B.mix(np.arange(n, dtype=np.uint64) + w.bounds[-1].astype(np.uint64)) if n else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, n).take(rows),
                        batch.column(2).slice(a, n).take(rows),
                        pa.array(np.concatenate([count, count[texts]]), pa.int64()),
                        pa.array(np.concatenate([own, key.astype(np.uint64)]).view(np.int64)),
                        pa.array(np.concatenate([np.full(n, -1), at - w.bounds[texts]]), pa.int32()),
                        pa.array(np.concatenate([np.zeros(n, int), size]), pa.int32()),
                        pa.array([None] * n + mid, pa.string()),
                        pa.array([None] * n + before, pa.list_(pa.string())),
                        pa.array([None] * n + after, pa.list_(pa.string())),
                    ],
                    ["doc_id", "row", "n_words", "gram", "at", "size", "mid", "before", "after"],
                )

    schema = T.StructType.fromDDL("row long, n_words long, gram long, at int, size int, mid string, before array<string>, after array<string>")
    return docs.select(F.col(id_col), F.col(text_col).cast("string"), F.xxhash64(F.col(text_col).cast("string"))).mapInArrow(
        run, T.StructType([T.StructField("doc_id", kind), *schema.fields])
    )


def _common(a: Column, b: Column) -> Column:
    """The length of two arrays' common beginning."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False)
    return F.when(stop == 0, F.size(same)).otherwise(stop - 1).cast("int")


def _covered(spans: Column) -> Column:
    """How many positions a sorted array of (s, e) spans covers."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], x["e"]).alias("upto"),
        ),
        lambda acc: acc["n"],
    )


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    k: int = GRAM,
    bloom_bits: int = 1 << 27,
) -> DataFrame:
    """For each document: doc_id, text_hash (of its text), n_words, n_hit, spans (word ranges hit), items (ids), as described above."""
    spark = docs.sparkSession
    B.small_batches(spark)
    grams = benchmark_grams(items, item_id_col, item_text_col, window, k)
    short = [r[0] for r in grams.where("short > 0").select("short").distinct().collect()]  # at most k numbers
    n_grams = grams.count()
    bits = 1 << 13
    while bits < bloom_bits and bits < 32 * n_grams:
        bits *= 2
    bloom = spark.sparkContext.broadcast(bloom_of(grams, bits))  # at most bloom_bits / 8 bytes
    found = document_grams(docs, id_col, text_col, window, k, bloom, sorted(short))
    joined = found.join(
        grams, (found["gram"] == grams["gram"]) & (found["at"] >= 0) & (found["mid"] == grams["i_mid"]), "left"
    )
    to_left, to_right = _common(F.col("before"), F.col("i_before")), _common(F.col("after"), F.col("i_after"))
    begin = F.when(F.col("short") > 0, F.col("at")).otherwise(F.col("at") - to_left)
    end = F.when(F.col("short") > 0, F.least(F.col("at") + F.col("size") + to_right, F.col("at") + F.col("need"))).otherwise(
        F.col("at") + F.col("size") + to_right
    )
    spans = joined.select("doc_id", "row", "n_words", "item_id", begin.alias("s"), end.alias("e"), "need").select(
        "doc_id", "row", "n_words", "item_id", "s", "e", (F.col("e") - F.col("s") >= F.col("need")).alias("hit")
    )
    return (
        spans.groupBy("doc_id", "row")
        .agg(
            F.max("n_words").alias("n_words"),
            F.collect_set(F.when(F.col("hit"), F.struct("s", "e"))).alias("spans"),
            F.collect_set(F.when(F.col("hit"), F.col("item_id"))).alias("items"),
        )
        .select(F.col("doc_id").alias(id_col), F.col("row").alias("text_hash"), "n_words", _covered(F.col("spans")).alias("n_hit"), F.array_sort("spans").alias("spans"), "items")
    )


def is_contaminated(n_hit: Column, n_words: Column, ratio: int = 20) -> Column:
    """At least one word in `ratio` is hit."""
    return (n_hit > 0) & (n_hit * ratio >= n_words)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """find_contamination()'s rows with counts and a hash in place of the lists."""
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        id_col,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of docs, with all their columns, whose document isn't contaminated."""
    id_col = options.get("id_col", "doc_id")
    found = find_contamination(docs, items, **options)
    bad = found.where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col(id_col).alias("bad_id"), F.col("text_hash").alias("bad_hash"))
    text = docs[options.get("text_col", "text")].cast("string")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["bad_id"]) & (F.xxhash64(text) == bad["bad_hash"]), "left_anti")
