"""N-gram Jaccard join: prefix filters under several global token orders, intersected, then exact verification.

A document's set holds its distinct k-word shingles (as 64-bit hashes). Sets with Jaccard similarity of at least t
share a token within their first n - ceil(t n) + 1 tokens under any one order of all tokens, so a pair is a candidate
only if that holds under each of several orders. The orders here put tokens by the class of their document frequency
first, rare before common, and by different hashes within a class.

1. Equal sets are grouped by a 128-bit signature; one of each group goes on.
2. Counting: blocks of documents deal their distinct tokens out by hash; each shard tells the blocks which of their
   documents' tokens occur in other documents too. A document with fewer than t n such tokens links with nothing and
   leaves; its tokens never travel again. A token goes out once for each block, so a token that a third of all
   documents have is as cheap as others. The shards also give the frequency classes: a table of a fixed number of
   cells, in which unlisted tokens are rare and tokens of one cell share a class. Any such table is a valid order.
3. The remaining documents meet in prefix buckets. Groups form by `_linkage`: a large group of near copies costs one
   check for each member, and only pairs across components are looked at again, under all the orders.

Results are exact but for collisions of 64-bit hashes. Edge cases: null, empty and wordless texts have an empty set,
n_shingles 0 and link with nothing; texts of fewer than k words have one shingle, their whole sequence; repeated rows
and rows that share a doc_id give one result row (the largest set counts); null doc_id rows are left out, as no
component can be named by null; ties need no rule; empty input, empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import _bytes as B
from ledgerlight.llm._linkage import linked_groups
from ledgerlight.llm.decontaminate import _maybe, bloom_of
from ledgerlight.session import cut, shuffle_width

K, PERCENT = 5, 75
REST_BITS = 28
ALONE = 0xFFFF
BLOCK_TOKENS, BLOCK_DOCS = 1 << 20, 60_000
COMMON_FROM = 8


def token_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, ordered by text and hash, and the text's number beside each."""
    w = B.Words(data, offs, B.NOT_SPACE)
    count = np.diff(w.bounds)
    text = np.repeat(np.arange(len(count)), count)
    ok = w.left() >= k
    tokens, owner = B.shingles(w.hash, k)[ok], text[ok]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        heads = [B.shingles(w.hash[w.bounds[i] : w.bounds[i + 1]], int(count[i]))[:1] ^ np.uint64(count[i]) for i in short]
        tokens, owner = np.concatenate([tokens, *heads]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        tokens, owner = tokens[order], owner[order]
    order = B.hash_order(tokens)
    order = order[np.argsort(owner[order].astype(np.uint32), kind="stable")]
    tokens, owner = tokens[order], owner[order]
    keep = np.ones(len(tokens), bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[keep], owner[keep]


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    at = np.searchsorted(owner, np.arange(n + 1))
    return total[at[1:]] - total[at[:-1]]


def _shard_and_rest(tokens: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    return (tokens >> np.uint64(34)) % np.uint64(shards), tokens & np.uint64((1 << REST_BITS) - 1)


def _cell(tokens: np.ndarray, cells: int) -> np.ndarray:
    """A token's place in the table of frequency classes, from the bits that its shard knows too."""
    return (B.mix(tokens & np.uint64((1 << REST_BITS) - 1)) & np.uint64(cells - 1)).astype(np.int64)


def _asks(docs: DataFrame, k: int, percent: int, shards: int) -> DataFrame:
    """(shard, block, kind, payload): for each block its directory and, for each shard, its tokens."""

    def flush(number: int, parts: list, ids: list, first: int) -> Iterator[tuple]:
        sets = np.concatenate([p[0] for p in parts])
        owner = np.concatenate([p[1] for p in parts]).astype(np.uint16)
        n = sum(len(x) for x in ids)
        sizes = np.concatenate([p[2] for p in parts])
        order = B.hash_order(sets)
        sets, owner = sets[order], owner[order]
        begin, df = B.runs(sets)
        several = np.repeat(df > 1, df)
        shared = np.bincount(owner[several], minlength=n)
        sig = [np.concatenate([p[i] for p in parts]).view(np.int64) for i in (3, 4)]
        block = B.block_number(number)
        yield block % shards, block, 0, B.pack(
            ("id", pa.concat_arrays(ids)), ("n", pa.array(sizes, pa.int64())), ("shared", pa.array(shared, pa.int64())),
            ("sig1", pa.array(sig[0])), ("sig2", pa.array(sig[1])),
        )
        token, own = sets[begin], np.where(df > 1, ALONE, owner[begin]).astype(np.uint16)
        shard, rest = _shard_and_rest(token, shards)
        order = np.lexsort((rest, shard)) if shards > 4096 or len(token) >= 1 << 24 else (
            np.sort((shard << np.uint64(52)) | (rest << np.uint64(24)) | np.arange(len(token), dtype=np.uint64)) & np.uint64((1 << 24) - 1)
        ).astype(np.int64)
        rest, own, df, edges = rest[order], own[order], np.minimum(df[order], 255).astype(np.uint8), np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
        for s in range(shards):
            a, b = edges[s], edges[s + 1]
            if b > a:
                step = np.diff(rest[a:b], prepend=np.uint64(0))
                kind = 2 if step.max() < 1 << 16 else 4
                yield s, block, kind, step.astype(np.uint16 if kind == 2 else np.uint32).tobytes() + own[a:b].tobytes() + df[a:b].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, docs_in, tokens_in, parts, ids = 0, 0, 0, [], []

        def out():
            rows = list(zip(*flush(number, parts, ids, 0), strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.binary())],
                ["shard", "block", "kind", "payload"],
            )

        for batch in batches:
            data, offs = B.text_bytes(batch.column(1))
            for a, b in B.pieces(offs):
                sets, owner = token_sets(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], k)
                if parts and (docs_in + b - a > BLOCK_DOCS or tokens_in + len(sets) > BLOCK_TOKENS):
                    yield out()
                    number, docs_in, tokens_in, parts, ids = number + 1, 0, 0, [], []
                sizes = np.bincount(owner, minlength=b - a)
                sig = [_sums(B.mix(sets ^ np.uint64(c)), owner, b - a) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                parts.append((sets, owner + docs_in, sizes, *sig))
                ids.append(batch.column(0).slice(a, b - a))
                docs_in, tokens_in = docs_in + b - a, tokens_in + len(sets)
        if parts:
            yield out()

    return docs.mapInArrow(run, "shard int, block long, kind int, payload binary")


def _answers(asks: DataFrame, cells: int) -> DataFrame:
    """(block, kind, payload): directories (0), counts of shared tokens of a block's documents (1), classes (2)."""

    def run(table: pa.Table) -> pa.Table:
        out, blocks, rests, owns, dfs = [], [], [], [], []
        for block, kind, blob in zip(table["block"].to_pylist(), table["kind"].to_pylist(), table["payload"], strict=True):
            raw = blob.as_py()
            if kind == 0:
                out.append((block, 0, raw))
                continue
            n = len(raw) // (kind + 3)
            rests.append(np.cumsum(np.frombuffer(raw, np.uint16 if kind == 2 else np.uint32, n), dtype=np.uint64))
            owns.append(np.frombuffer(raw, np.uint16, n, n * kind))
            dfs.append(np.frombuffer(raw, np.uint8, n, n * (kind + 2)))
            blocks.append(block)
        if rests:
            edges = np.cumsum([0, *map(len, rests)])
            rest, own, df = np.concatenate(rests), np.concatenate(owns), np.concatenate(dfs)
            packed = np.sort((rest << np.uint64(36)) | np.arange(len(rest), dtype=np.uint64))
            order = (packed & np.uint64((1 << 36) - 1)).astype(np.int64)
            rest = packed >> np.uint64(36)
            begin, length = B.runs(rest)
            several = np.zeros(len(order), bool)
            several[order] = np.repeat(length > 1, length)
            for i, block in enumerate(blocks):
                mine = own[edges[i] : edges[i + 1]][several[edges[i] : edges[i + 1]]]
                counts = np.bincount(mine[mine != ALONE])
                at = np.flatnonzero(counts)
                if len(at):
                    out.append((block, 1, at.astype(np.uint16).tobytes() + counts[at].astype(np.uint32).tobytes()))
            total = np.add.reduceat(df[order].astype(np.int64), begin)
            common = total >= COMMON_FROM
            if common.any():
                level = np.floor(np.log2(total[common])).astype(np.uint8)
                out.append((-1, 2, _cell(rest[begin[common]], cells).astype(np.uint32).tobytes() + level.tobytes()))
        cols = list(zip(*out, strict=True)) if out else [(), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["block", "kind", "payload"])

    return asks.groupBy("shard").applyInArrow(run, "block long, kind int, payload binary")


def _directory(answers: DataFrame, kind: T.DataType) -> DataFrame:
    """(doc_id, n, shared, sig1, sig2): each document with the number of its tokens that others have too."""

    def run(table: pa.Table) -> pa.Table:
        book, counts = None, []
        for kind, blob in zip(table["kind"].to_pylist(), table["payload"].to_pylist(), strict=True):
            if kind == 0:
                book = B.unpack(blob)
            else:
                n = len(blob) // 6
                counts.append((np.frombuffer(blob, np.uint16, n), np.frombuffer(blob, np.uint8, 4 * n, 2 * n).view(np.uint32)))
        shared = book["shared"].to_numpy().copy()
        for at, c in counts:
            shared[at] += c
        return pa.table([book["id"].combine_chunks(), book["n"], pa.array(shared), book["sig1"], book["sig2"]], ["doc_id", "n", "shared", "sig1", "sig2"])

    schema = T.StructType([T.StructField("doc_id", kind), *T.StructType.fromDDL("n long, shared long, sig1 long, sig2 long").fields])
    return answers.where("kind < 2").groupBy("block").applyInArrow(run, schema)


def _classes(answers: DataFrame, cells: int) -> np.ndarray:
    """The table of frequency classes: `cells` bytes."""
    segments, width = 64, cells // 64

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                n = len(blob) // 5
                at, level = np.frombuffer(blob, np.uint32, n), np.frombuffer(blob, np.uint8, n, 4 * n)
                order = np.argsort(at, kind="stable")
                at, level = at[order], level[order]
                edges = np.searchsorted(at, np.arange(0, cells + 1, width))
                rows = [(s, at[edges[s] : edges[s + 1]].tobytes() + level[edges[s] : edges[s + 1]].tobytes()) for s in range(segments) if edges[s + 1] > edges[s]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["segment", "blob"])

    def merge(table: pa.Table) -> pa.Table:
        segment = table["segment"][0].as_py()
        out = np.zeros(width, np.uint8)
        for blob in table["blob"].to_pylist():
            n = len(blob) // 5
            np.maximum.at(out, np.frombuffer(blob, np.uint32, n).astype(np.int64) - segment * width, np.frombuffer(blob, np.uint8, n, 4 * n))
        return pa.table([pa.array([segment], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["segment", "levels"])

    parts = answers.where("kind = 2").select("payload").mapInArrow(split, "segment int, blob binary")
    out = np.zeros((segments, width), np.uint8)
    for row in parts.groupBy("segment").applyInArrow(merge, "segment int, levels binary").collect():  # `cells` bytes in all
        out[row["segment"]] = np.frombuffer(row["levels"], np.uint8)
    return out.reshape(-1)


def _prefixes(docs: DataFrame, keys: np.ndarray, levels: np.ndarray, k: int, percent: int, orders: int) -> DataFrame:
    """(id, n, tokens, p0, p1, ...): the documents in question with their sets and their prefixes under each order."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((keys, levels))  # bounded: bits of the filter, cells of the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, level = shared.value
        for batch in batches:
            key = batch.column(2).to_numpy().view(np.uint64)
            batch = batch.take(pa.array(np.flatnonzero(_maybe(bloom, key))))
            data, offs = B.text_bytes(batch.column(1))
            for a, b in B.pieces(offs):
                sets, owner = token_sets(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], k)
                at = np.searchsorted(owner, np.arange(b - a + 1))
                own, blobs, found = [], [], [[] for _ in range(orders)]
                for i in range(b - a):
                    s = sets[at[i] : at[i + 1]]
                    n = len(s)
                    if n == 0:
                        continue
                    own.append(a + i)
                    blobs.append(np.sort(s).tobytes())
                    head = n - -(-percent * n // 100) + 1
                    rank = level[_cell(s, len(level))].astype(np.uint64) << np.uint64(56)
                    for j in range(orders):
                        order = np.argsort(rank | (B.mix(s ^ np.uint64(0x9E37 * j + 11)) >> np.uint64(8)))
                        found[j].append(s[order[:head]].view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own, pa.int64())), pa.array([len(x) // 8 for x in blobs], pa.int64()), pa.array(blobs, pa.binary())]
                    + [pa.array(x, pa.list_(pa.int64())) for x in found],
                    ["id", "n", "tokens", *[f"p{j}" for j in range(orders)]],
                )

    schema = T.StructType([T.StructField("id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL("n long, tokens binary, " + ", ".join(f"p{j} array<long>" for j in range(orders))).fields])
    return docs.select("doc_id", "text", F.xxhash64("doc_id").alias("key")).mapInArrow(run, schema)


def _verifier(sets: DataFrame, near, percent: int):
    """Keeps the pairs of which percent * union <= 100 * intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([p, q]))
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(ok)) for i in (0, 1)], ["a", "b"])

    def verify(pairs: DataFrame) -> DataFrame:
        kind = pairs.schema["a"].dataType
        side = lambda x: sets.select(*[F.col(c).alias(f"{x}_{c}") for c in ("id", "n", "shared")])
        sized = pairs.join(side("x"), F.col("a") == F.col("x_id")).join(side("y"), F.col("b") == F.col("y_id"))
        alike = F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent
        close = sized.where(near("x_", "y_") & alike).select("a", "b")
        full = close.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a").join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")
        return full.select("a", "b", "ta", "tb").mapInArrow(run, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))

    return verify


def ngram_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = K,
    percent: int = PERCENT,
    orders: int = 2,
    cells: int = 1 << 22,
    max_bloom_bits: int = 1 << 27,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_equal): one row for each document id, as described above."""
    spark = docs.sparkSession
    B.small_batches(spark)
    docs = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shards = 2 * shuffle_width(spark)
    answers = cut(_answers(_asks(docs, k, percent, shards), cells))
    book = cut(
        _directory(answers, docs.schema["doc_id"].dataType)
        .groupBy("doc_id")
        .agg(F.max(F.struct("n", "shared", "sig1", "sig2")).alias("x"))
        .select("doc_id", "x.*")
    )
    equal = book.where("n > 0").groupBy("n", "sig1", "sig2").agg(F.min("doc_id").alias("rep"), F.max("shared").alias("shared"), F.count("*").alias("n_equal"))
    equal = cut(equal)
    asked = equal.where(f"100 * shared >= {percent} * n").select(F.xxhash64("rep").alias("gram"))
    wanted, bits = asked.count(), 1 << 13
    while bits < max_bloom_bits and bits < 16 * wanted:
        bits *= 2
    sets = _prefixes(docs, bloom_of(asked, bits), _classes(answers, cells), k, percent, orders)
    sets = cut(sets.join(equal.select(F.col("rep").alias("id"), F.col("n").alias("n_rep"), "shared"), "id").where("n = n_rep").drop("n_rep").dropDuplicates(["id"]))
    buckets = [sets.select(F.posexplode(f"p{j}").alias("pos", "bucket"), "id") for j in range(orders)]
    facts = sets.select("id", (F.col("n") - F.col("shared")).alias("w"), "n", "shared")
    total = lambda p, q: (F.col(f"{p}n") + F.col(f"{q}n")) * percent  # noqa: E731  / (100 + percent): the least overlap
    near = lambda p, q: F.least(f"{p}shared", f"{q}shared") * (100 + percent) >= total(p, q)

    def near_in_order(p: str, q: str) -> Column:
        """Before the first common token none is common, and of what follows at most the shorter rest."""
        rest = F.least(F.col(f"{p}n") - F.col(f"{p}pos"), F.col(f"{q}n") - F.col(f"{q}pos"))
        return near(p, q) & (rest * (100 + percent) >= total(p, q))

    groups = linked_groups(buckets[0], facts, near_in_order, _verifier(sets, near, percent), buckets[1:])
    named = equal.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.col("n").alias("en"), F.col("sig1").alias("e1"), F.col("sig2").alias("e2"), F.coalesce("component", "rep").alias("component"), "n_equal"
    )
    joined = book.join(named, (F.col("n") == F.col("en")) & (F.col("sig1") == F.col("e1")) & (F.col("sig2") == F.col("e2")), "left")
    return joined.select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("n_equal", F.lit(1)).cast("long").alias("n_equal")
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs but for those whose group has a document with a smaller id; null ids stay."""
    id_col = options.get("id_col", "doc_id")
    gone = ngram_groups(docs, **options).where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone_id"))
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
