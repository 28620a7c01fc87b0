"""Exact dedup against immutable snapshots: static binary-fuse filters, exact buckets, byte checks.

Documents arrive in batches. A batch's documents are grouped by digest and by the whole normalised text (runs of ASCII
white space are one space), so its own duplicates meet by bytes, and these groups are written as one immutable snapshot:
exact buckets (digest, text, smallest id, number of rows) by shard of the digest, and for each shard a binary-fuse
filter of its digests, built once, of about nine bits a digest. The distinct digests of the next batch go to the shards and are screened
by the filters of all earlier snapshots; only those that a filter lets through (every old one, and one new one in 256)
are joined with the exact buckets, where digest and text must be equal. A group that is found there takes the keeper of its
earliest snapshot.

A filter and the digests that ask it are bounded by `shard_rows`: the number of shards follows from the counted
documents. Texts are shuffled once, into their buckets, after duplicates within a task are merged; a text that a third of all rows have is one row a
task. Rows find their group by digest; only where several texts share a digest do they find it by text.

`SnapshotStore` keeps snapshots in a folder that all executors share, for batches that arrive one after the other;
`exact_duplicates` runs a table through a store of its own, in batches by id, so that earlier batches have smaller ids.

Edge cases: a null text is empty, and equal to other empty ones; texts that differ in leading or trailing white space
only in kind or length are equal, but one with and one without aren't; null ids come after all others, so a document with a null id stays only
where all of its group have none; of rows that are repeated, id included, one stays, and all of them count; very long texts are digested whole; an empty table gives an
empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import _bytes as B
from ledgerlight.session import cut, ready_checkpoints, shuffle_width


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


# ---- binary-fuse filters


def _layout(n: int) -> tuple[int, int]:
    """Length of a segment and number of segments for n keys, three of which are neighbours for each key."""
    length = min(1 << 18, 1 << int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(max(n, 2)))
    return length, max(1, -(-round(n * factor) // length) - 2)


def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key, one in each of three neighbouring segments, and its fingerprint."""
    with np.errstate(over="ignore"):
        h = B.mix(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    base = ((h >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    one = (base + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    two = (base + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([base, one, two]).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_fuse(keys: np.ndarray, tries: int = 100) -> bytes:
    """A binary-fuse filter of distinct 64-bit keys: a header of seed, segment length and segments, then one byte a slot.

    Slots that only one key uses are peeled, all that there are at once, until no key is left; in the reverse order each
    peeled slot is set so that the three slots of its key XOR to the fingerprint.
    """
    keys = np.unique(keys)
    length, segments = _layout(len(keys))
    for seed in range(tries):
        slots, prints = _slots(keys, seed, length, segments)
        size = (segments + 2) * length
        users = np.bincount(slots.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # XOR of the numbers of the keys that use the slot
        for s in slots:
            np.bitwise_xor.at(owner, s, np.arange(len(keys)))
        peeled: list[tuple[np.ndarray, np.ndarray]] = []
        single, left = np.flatnonzero(users == 1), len(keys)
        while len(single):
            key, first = np.unique(owner[single], return_index=True)
            peeled.append((key, single[first]))
            left -= len(key)
            touched = slots[:, key].ravel()
            np.subtract.at(users, touched, 1)
            np.bitwise_xor.at(owner, touched, np.tile(key, 3))
            touched = np.unique(touched)
            single = touched[users[touched] == 1]
        if left:
            continue
        table = np.zeros(size, np.uint8)
        for key, slot in reversed(peeled):
            a, b, c = (table[s[key]] for s in slots)
            table[slot] = prints[key] ^ a ^ b ^ c  # the slot itself is still 0
        return np.array([seed, length, segments], "<u4").tobytes() + table.tobytes()
    raise RuntimeError("no binary-fuse filter found")


def fuse_contains(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter may hold: all that it was built of, and one in 256 of the others."""
    seed, length, segments = np.frombuffer(filter_, "<u4", 3).tolist()
    table = np.frombuffer(filter_, np.uint8, offset=12)
    slots, prints = _slots(keys, seed, length, segments)
    return (table[slots[0]] ^ table[slots[1]] ^ table[slots[2]]) == prints


# ---- snapshots


class SnapshotStore:
    """Immutable snapshots of texts seen so far, in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, shards: int, digest: Callable[[Column], Column] = sha256):
        self.spark, self.folder, self.shards, self.digest = spark, folder, shards, digest
        self.snapshots: list[int] = []
        B.workers_import(spark)

    def _key(self, digest: Column) -> Column:
        return F.xxhash64(digest)

    def shard(self, digest: Column) -> Column:
        return F.pmod(F.xxhash64(digest, F.lit(1)), F.lit(self.shards)).cast("int")

    def buckets(self, snapshot: int) -> DataFrame:
        """(shard, digest, text, keep, n, gid): a row for each distinct text of the batch."""
        return self.spark.read.parquet(f"{self.folder}/{snapshot}/buckets")

    def filters(self, snapshot: int) -> DataFrame:
        """(shard, filter) of a snapshot."""
        return self.spark.read.parquet(f"{self.folder}/{snapshot}/filters")

    def screen(self, snapshot: int, groups: DataFrame) -> DataFrame:
        """(digest): the digests of the groups that the snapshot's filters let through."""

        def run(asked: pa.Table, filters: pa.Table) -> pa.Table:
            if not len(asked) or not len(filters):
                return asked.slice(0, 0).select(["digest"])
            ok = fuse_contains(filters["filter"][0].as_py(), asked["key"].to_numpy().view(np.uint64))
            return asked.filter(pa.array(ok)).select(["digest"])

        asked = groups.select("shard", "digest").distinct().withColumn("key", self._key(F.col("digest")))
        return asked.groupBy("shard").cogroup(self.filters(snapshot).groupBy("shard")).applyInArrow(run, "digest binary")

    def remove(self) -> None:
        """Delete the folder with all snapshots."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.snapshots.clear()

    def add(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Take in a batch as the next snapshot; (snapshot, gid, root): its groups and the (snapshot, gid) of their keepers.

        The batch's own duplicates are one group. The root of a group is the group of the earliest snapshot with that text.
        """
        number = len(self.snapshots)
        text = normalised(F.col(text_col))
        own = docs.select(text.alias("text"), F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id")).alias("at"))
        groups = own.withColumn("digest", self.digest(F.col("text"))).withColumn("shard", self.shard(F.col("digest")))
        groups = groups.groupBy("shard", "digest", "text").agg(F.min("at").alias("keep"), F.count("*").alias("n"))
        groups = groups.withColumn("gid", F.monotonically_increasing_id())
        groups.write.parquet(f"{self.folder}/{number}/buckets", compression="zstd")
        groups = self.buckets(number)

        def build(table: pa.Table) -> pa.Table:
            built = build_fuse(table["key"].to_numpy().view(np.uint64))
            return pa.table({"shard": table["shard"].slice(0, 1), "filter": pa.array([built], pa.binary())})

        keys = groups.select("shard", self._key(F.col("digest")).alias("key")).distinct()
        keys.groupBy("shard").applyInArrow(build, "shard int, filter binary").write.parquet(f"{self.folder}/{number}/filters")
        found = None
        for earlier in self.snapshots:
            positive = cut(self.screen(earlier, groups))
            old = self.buckets(earlier).join(positive, "digest", "left_semi").select(F.col("digest").alias("o_digest"), F.col("text").alias("o_text"), F.col("gid").alias("o_gid"))
            new = groups.join(positive, "digest", "left_semi").select("digest", "text", "gid")
            hits = new.join(old, (F.col("digest") == F.col("o_digest")) & (F.col("text") == F.col("o_text")))
            hits = hits.select("gid", F.struct(F.lit(earlier).alias("snapshot"), F.col("o_gid").alias("gid")).alias("root"))
            found = hits if found is None else found.unionByName(hits)
        self.snapshots.append(number)
        mine = F.struct(F.lit(number).alias("snapshot"), F.col("gid"))
        if found is None:
            return groups.select(F.lit(number).alias("snapshot"), "gid", mine.alias("root"))
        roots = found.groupBy("gid").agg(F.min("root").alias("root"))
        return groups.join(roots, "gid", "left").select(F.lit(number).alias("snapshot"), "gid", F.coalesce("root", mine).alias("root"))


def exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: int = 2,
    shard_rows: int = 250_000,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest): one row for each row of docs."""
    spark = docs.sparkSession
    ready_checkpoints(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shares = [i / batches for i in range(1, batches)]
    n, edges = docs.agg(F.count("*"), F.percentile_approx(F.col("id").try_cast("double"), shares, 10_000)).first()
    batch = F.lit(0)
    for edge in edges or []:
        batch = batch + F.when(F.coalesce(F.col("id").try_cast("double") <= edge, F.lit(False)), 0).otherwise(1)
    docs = docs.withColumn("batch", batch.cast("int"))
    store = SnapshotStore(spark, f"{spark.sparkContext.getCheckpointDir()}/snapshots-{uuid.uuid4().hex}", max(shuffle_width(spark), -(-n // shard_rows)), digest)
    roots = None
    for i in range(batches):
        added = store.add(docs.where(F.col("batch") == i), id_col="id")
        roots = added if roots is None else roots.unionByName(added)
    members = None
    for i in store.snapshots:
        own = store.buckets(i).select(F.lit(i).alias("snapshot"), "gid", "digest", "keep", "n")
        members = own if members is None else members.unionByName(own)
    told = members.join(roots, ["snapshot", "gid"])
    classes = told.groupBy("root").agg(F.min("keep").alias("keep"), F.sum("n").alias("group_size"), F.min("digest").alias("digest"))
    classes = cut(classes.withColumn("keep_id", F.col("keep.id")).drop("keep"))
    # a digest with one class only, as all have by far, needs no text to find its rows
    alone = classes.groupBy("digest").agg(F.min(F.struct("root", "keep_id", "group_size")).alias("x"), F.count("*").alias("texts"))
    alone = cut(alone.select("digest", "x.*", "texts"))
    rows = docs.select("id", normalised(F.col("text")).alias("text")).withColumn("digest", digest(F.col("text")))
    told = rows.select("id", "digest").join(alone.where("texts = 1").drop("texts"), "digest")
    if alone.where("texts > 1").limit(1).count():
        several = alone.where("texts > 1").select("digest")
        buckets = None
        for i in store.snapshots:
            own = store.buckets(i).join(several, "digest", "left_semi").select(F.lit(i).alias("snapshot"), "gid", "digest", "text")
            buckets = own if buckets is None else buckets.unionByName(own)
        texts = buckets.join(roots, ["snapshot", "gid"]).select("digest", "text", "root").distinct().join(classes.drop("digest"), "root")
        told = told.unionByName(rows.join(texts, ["digest", "text"]).select(*told.columns))
    # of rows that share the smallest id one stays, the one that was first numbered
    told = cut(told.select("id", "digest", "root", "keep_id", "group_size").withColumn("row", F.monotonically_increasing_id()))
    store.remove()
    first = told.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("root").agg(F.min("row").alias("row"))
    kept = first.select("row", F.lit(True).alias("kept"))
    joined = told.join(kept, "row", "left")
    return joined.select(F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"), F.coalesce("kept", F.lit(False)).alias("kept"), "digest")


def drop_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, with all their columns, but for those whose group has one with a smaller id."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    digest = options.get("digest", sha256)
    gone = exact_duplicates(docs, **options).where(~F.col(id_col).eqNullSafe(F.col("keep_id")))
    gone = gone.select(F.col(id_col).alias("__id"), F.col("digest").alias("__digest")).distinct()
    left = docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]) & (digest(normalised(docs[text_col])) == gone["__digest"]), "left_anti")
    return left
