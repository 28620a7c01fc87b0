"""Language-model scoring with n-gram tries in Elias-Fano levels, sharded by context.

The model is an interpolated bigram model with absolute discounting over an add-one unigram base:
p(w | h) = max(c(h, w) - D, 0) / c(h) + D * successors(h) / c(h) * base(w), base(w) = (c(w) + 1) / (N + V + 1). Every
training token counts; there is no pruning, and no vocabulary or size limit.

1. The tasks that read the documents cut them into blocks. A block keeps its tokens as numbers in its own dictionary
   and asks each shard about the dictionary words and distinct bigrams that belong to the shard by hash of the word or
   of the context, together with how often the block's training documents have them.
2. A shard adds the counts up, builds the trie of its contexts - words' successors with quantised log10 probabilities,
   in memory-mapped levels - and answers every block: word counts, successor numbers, and the codes of its bigrams.
3. A block with its answers scores its documents.

A word goes out once for each block, so frequent words are no hot keys. The successors of a very frequent context are
dealt out over all shards by the pair's hash; which contexts are treated so comes from a bounded sample of documents
(`hot_sample` documents, `hot_words` words), has no influence on any count, and on scores none but where 32-bit
hashes of successors collide differently.

Edge cases: null text is empty, and an empty text is one end token; rows that share a doc_id are scored each;
a null doc_id is not learned from and isn't held out; no training data: all counts 0, score equal to base; very long
texts make larger blocks; empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import _bytes as B
from ledgerlight.llm._trie import Quantiser, Trie
from ledgerlight.session import shuffle_width

DISCOUNT = 0.5
END, BEGIN = np.uint64(0xE4D0F7E4D0F7E4D1), np.uint64(0xBE6150BE6150BE61)
BLOCK_TOKENS, BLOCK_DOCS = 3 << 19, 60_000


def _squeeze(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), "zstd", asbytes=True)


def _low32(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _home(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(33)) % np.uint64(shards)).astype(np.uint32)


class Bigrams:
    """A block's distinct bigrams in the order in which shards get them; the same whenever it is made."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, ends: np.ndarray, hot: np.ndarray, shards: int):
        u = len(words)
        before = np.empty(len(ids), np.int64)
        before[1:] = ids[:-1]
        starts = np.concatenate([[0], ends[:-1]])
        before[starts[starts < len(ids)]] = u
        keys = (before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)
        order = np.argsort(keys)
        first, size = B.runs(keys[order])
        self.of = np.empty(len(ids), np.int64)
        self.of[order] = np.repeat(np.arange(len(first)), size)
        distinct = keys[order][first]
        self.context = (distinct >> np.uint64(32)).astype(np.int64)
        self.word = (distinct & np.uint64(0xFFFFFFFF)).astype(np.int64)
        hashes = np.append(words, BEGIN)
        number = np.full(u + 1, -1, np.int64)  # of hot contexts
        at = np.searchsorted(hot, hashes)
        hit = hot[np.minimum(at, len(hot) - 1)] == hashes
        number[hit] = at[hit]
        self.hot = number[self.context]
        pair = B.mix(hashes[self.context] ^ (words[self.word] * np.uint64(0x9E3779B97F4A7C15)))
        self.shard = np.where(self.hot >= 0, _home(pair, shards), _home(hashes[self.context], shards))
        self.number = number
        self.order = np.argsort(self.shard.astype(np.uint32), kind="stable")
        self.edges = np.searchsorted(self.shard[self.order], np.arange(shards + 1))

    def of_shard(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        """The shard's bigrams: of usual contexts, in their order, and of hot ones, by the context's number."""
        g = self.order[self.edges[s] : self.edges[s + 1]]
        cold, warm = g[self.hot[g] < 0], g[self.hot[g] >= 0]
        return cold, warm[np.argsort(self.hot[warm], kind="stable")]


def _hot_words(docs: DataFrame, sample: int, keep: int) -> np.ndarray:
    """The most frequent words of a bounded sample, and the beginning of a text: sorted hashes."""
    total = docs.count()
    share = 1 << 20
    limit = share if total <= sample else int(share * sample / total)
    picked = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(share)) < limit).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = B.text_bytes(batch.column(0))
            for a, b in B.pieces(offs):
                h = np.sort(B.Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], B.NOT_SPACE).hash)
                first, n = B.runs(h)
                top = np.argsort(-n)[: 4 * keep]
                yield pa.RecordBatch.from_arrays([pa.array(h[first[top]].view(np.int64)), pa.array(n[top])], ["h", "n"])

    top = picked.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(keep)
    found = [r["h"] for r in top.collect()]
    return np.unique(np.append(np.array(found, np.int64).view(np.uint64), BEGIN))


def _asks(docs: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    def flush(number: int, parts: list, ids: list, held: list) -> Iterator[tuple]:
        tokens = np.concatenate([p[0] for p in parts])
        ends = np.cumsum(np.concatenate([p[1] for p in parts]))
        train = np.concatenate(held)
        order = B.hash_order(tokens)
        first, size = B.runs(tokens[order])
        # the more frequent a word, the smaller its number, so that the stream of numbers packs well
        by_size = np.argsort(-size, kind="stable")
        words = tokens[order][first][by_size]
        rank = np.empty(len(words), np.int64)
        rank[by_size] = np.arange(len(words))
        index = np.empty(len(tokens), np.int64)
        index[order] = np.repeat(rank, size)
        learned = np.repeat(train, np.diff(ends, prepend=0))
        counts = np.bincount(index, weights=learned, minlength=len(words)).astype(np.uint32)
        grams = Bigrams(words, index, ends, hot, shards)
        pair_counts = np.bincount(grams.of, weights=learned, minlength=len(grams.word)).astype(np.uint32)
        hot_counts = np.zeros(len(hot), np.int64)
        mine = np.flatnonzero(grams.number[:-1] >= 0)
        hot_counts[grams.number[mine]] = counts[mine]
        hot_counts[np.searchsorted(hot, BEGIN)] = train.sum()
        home = _home(words, shards)
        by_home = np.argsort(home, kind="stable")
        home_edges = np.searchsorted(home[by_home], np.arange(shards + 1))
        block = B.block_number(number)
        stream = index.astype(np.uint32)
        planes = [_squeeze((stream >> np.uint32(8 * i)).astype(np.uint8)) for i in range(4)]
        state = pickle.dumps((words, len(stream), planes, ends, train), 5)
        yield block % shards, block, 0, state, B.pack(("id", pa.concat_arrays(ids)))
        for s in range(shards):
            w = by_home[home_edges[s] : home_edges[s + 1]]
            cold, warm = grams.of_shard(s)
            slot = np.searchsorted(w, grams.context[cold])  # w ascends, as the order is stable
            yield s, block, 1, pickle.dumps(
                (
                    words[w], counts[w], np.bincount(slot, minlength=len(w)).astype(np.uint32), _low32(words[grams.word[cold]]), pair_counts[cold],
                    np.bincount(grams.hot[warm], minlength=len(hot)).astype(np.uint32), _low32(words[grams.word[warm]]), pair_counts[warm], hot_counts,
                ), 5), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, docs_in, tokens_in, parts, ids, held = 0, 0, 0, [], [], []

        def out() -> Iterator[pa.RecordBatch]:
            for s, block, kind, payload, book in flush(number, parts, ids, held):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([block], pa.int64()), pa.array([kind], pa.int32()), pa.array([payload], pa.binary()), pa.array([book], pa.binary())],
                    ["shard", "block", "kind", "payload", "book"],
                )

        for batch in batches:
            data, offs = B.text_bytes(batch.column(1))
            train = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in B.pieces(offs):
                w = B.Words(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], B.NOT_SPACE)
                count = np.diff(w.bounds)
                if parts and (docs_in + b - a > BLOCK_DOCS or tokens_in + len(w) > BLOCK_TOKENS):
                    yield from out()
                    number, docs_in, tokens_in, parts, ids, held = number + 1, 0, 0, [], [], []
                tokens = np.full(len(w) + b - a, END)
                tokens[np.arange(len(w)) + np.repeat(np.arange(b - a), count)] = w.hash
                parts.append((tokens, count + 1))
                ids.append(batch.column(0).slice(a, b - a))
                held.append(train[a:b])
                docs_in, tokens_in = docs_in + b - a, tokens_in + len(tokens)
        if parts:
            yield from out()

    return docs.select("doc_id", "text", "train").mapInArrow(run, "shard int, block long, kind int, payload binary, book binary")


def _answers(asks: DataFrame, hot: np.ndarray, discount: float) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        out, blocks, asked = [], [], []
        for block, kind, payload, book in zip(*(table[c] for c in ("block", "kind", "payload", "book")), strict=True):
            if kind.as_py() == 0:
                out.append((block.as_py(), 0, payload.as_py(), book.as_py()))
            else:
                blocks.append(block.as_py())
                asked.append(pickle.loads(payload.as_buffer()))
        if not asked:
            cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())], ["block", "kind", "payload", "book"])
        words = np.concatenate([x[0] for x in asked])
        distinct, rank = np.unique(words, return_inverse=True)
        count = np.bincount(rank, weights=np.concatenate([x[1] for x in asked]), minlength=len(distinct)).astype(np.int64)
        hot_total = np.sum([x[8] for x in asked], axis=0)
        u = len(distinct)
        cold_context = np.repeat(rank, np.concatenate([x[2] for x in asked]).astype(np.int64))
        warm_context = np.concatenate([u + np.repeat(np.arange(len(hot)), x[5]) for x in asked])
        context = np.concatenate([cold_context, warm_context])
        word = np.concatenate([x[3] for x in asked] + [x[6] for x in asked])
        seen = np.concatenate([x[4] for x in asked] + [x[7] for x in asked])
        keys = (context.astype(np.uint64) << np.uint64(32)) | word
        order = np.argsort(keys)
        first, _ = B.runs(keys[order])
        pair_count = np.add.reduceat(seen[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        learned = pair_count > 0
        pair = keys[order][first][learned]
        pair_context, pair_word = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        of = np.concatenate([count, hot_total])
        logs = np.log10((pair_count[learned] - discount) / np.maximum(1, of[pair_context]))
        successors = np.bincount(pair_context, minlength=u + len(hot))
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(pair_context, pair_word, logs, u + len(hot), folder)
            codes = np.zeros(len(context), np.uint8)
            for a in range(0, len(context), 1 << 18):
                codes[a : a + (1 << 18)] = trie.lookup(context[a : a + (1 << 18)], word[a : a + (1 << 18)])
            floor = trie.quantiser.least
            del trie
        n, v = int(count.sum()), int((count > 0).sum())
        at_word = at_cold = 0
        at_warm = len(cold_context)
        for block, x in zip(blocks, asked, strict=True):
            mine = rank[at_word : at_word + len(x[0])]
            cold, warm = codes[at_cold : at_cold + len(x[3])], codes[at_warm : at_warm + len(x[6])]
            at_word, at_cold, at_warm = at_word + len(x[0]), at_cold + len(x[3]), at_warm + len(x[6])
            out.append((block, 1, pickle.dumps((int(table["shard"][0].as_py()), count[mine], successors[:u][mine].astype(np.uint32), cold, warm, successors[u:], hot_total, n, v, floor), 5), None))
        cols = list(zip(*out, strict=True))
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())], ["block", "kind", "payload", "book"])

    return asks.groupBy("shard").applyInArrow(run, "block long, kind int, payload binary, book binary")


def _scores(answers: DataFrame, hot: np.ndarray, shards: int, discount: float, kind: T.DataType) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        got = {}
        for k, payload, book in zip(table["kind"].to_pylist(), table["payload"], table["book"].to_pylist(), strict=True):
            x = pickle.loads(payload.as_buffer())
            if k == 0:
                words, length, planes, ends, train = x
                ids = B.unpack(book)["id"].combine_chunks()
            else:
                got[x[0]] = x[1:]
        index = np.zeros(length, np.int64)
        for i, plane in enumerate(planes):
            index |= np.frombuffer(pa.decompress(plane, length, "zstd", asbytes=True), np.uint8).astype(np.int64) << (8 * i)
        grams = Bigrams(words, index, ends, hot, shards)
        home = _home(words, shards)
        by_home = np.argsort(home, kind="stable")
        home_edges = np.searchsorted(home[by_home], np.arange(shards + 1))
        count, after = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        seen = np.zeros(len(grams.word))
        hot_after, hot_count, n, v = np.zeros(len(hot), np.int64), np.zeros(len(hot), np.int64), 0, 0
        for s, (c, succ, cold, warm, hot_succ, hot_total, n_s, v_s, floor) in got.items():
            w = by_home[home_edges[s] : home_edges[s + 1]]
            count[w], after[w] = c, succ
            cold_at, warm_at = grams.of_shard(s)
            for place, codes in ((cold_at, cold), (warm_at, warm)):
                seen[place] = np.where(codes > 0, 10 ** Quantiser(floor).logs(codes), 0.0)
            hot_after, hot_count, n, v = hot_after + hot_succ, hot_total, n + n_s, v + v_s
        base = (count + 1) / (n + v + 1)
        of, types = np.append(count, 0).astype(float), np.append(after, 0).astype(float)
        some = grams.number >= 0
        of[some], types[some] = hot_count[grams.number[some]], hot_after[grams.number[some]]
        weight = np.where(of > 0, discount * types / np.maximum(1, of), 1.0)
        gram = np.log10(seen + weight[grams.context] * base[grams.word])
        starts = np.concatenate([[0], ends[:-1]])
        each = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every text has an end token
        m = len(ends)
        return pa.table(
            [
                ids, pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array(each((count > 0)[index].astype(np.int64)), pa.int64()),
                pa.array(np.full(m, n), pa.int64()), pa.array(np.full(m, v), pa.int64()), pa.array(each(np.log10(base)[index])), pa.array(each(gram[grams.of])),
            ],
            ["doc_id", "n_tokens", "n_known", "train_tokens", "train_words", "base_score", "score"],
        )

    fields = T.StructType.fromDDL("n_tokens long, n_known long, train_tokens long, train_words long, base_score double, score double").fields
    return answers.groupBy("block").applyInArrow(run, T.StructType([T.StructField("doc_id", kind), *fields]))


def score_texts(
    docs: DataFrame,
    *,
    train_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    discount: float = DISCOUNT,
    hot_words: int = 128,
    hot_sample: int = 2000,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, train_words, base_score, score): a row for each row of docs.

    train_col: a boolean column, true for the rows that the model learns from.
    """
    spark = docs.sparkSession
    B.small_batches(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(train_col), F.lit(False)).alias("train"))
    hot = _hot_words(docs, hot_sample, hot_words)
    shards = 2 * shuffle_width(spark)
    answers = _answers(_asks(docs, hot, shards), hot, discount)
    out = _scores(answers, hot, shards, discount, docs.schema["doc_id"].dataType)
    return out.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else out
