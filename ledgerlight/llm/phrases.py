"""Phrase collocation mining by Suffix-sigma: sorted truncated suffixes, all prefixes counted with one stack.

Texts are lower-cased (A-Z), split at punctuation and line ends into pieces and these at spaces and tabs into words.
One scan counts single words by language. A phrase that occurs `min_count` times has only words that do, so in a
second scan pieces end at rarer words too (a Bloom filter of at most `bloom_bits` bits names the others; what it lets
through is dropped later by its count). From every word on, the suffix of at most `max_words` words goes to the shard
of its language and first word. Equal suffixes of a block of text are merged before they are sent, as numbers: the most
frequent words, at most `codes` of them, are numbered for all, further ones with each message. A shard sorts its suffixes in reverse lexicographic order, in which all suffixes with a common prefix lie
together and end where the next one's common prefix is shorter: the stack of open prefixes has one counter for each
length, and what is popped is a phrase with its count. Here the stack runs over arrays: a counter is the difference of
two running sums.

Hot groups: a word with more than `1 / (4 shards)` of all occurrences (at least `hot_share`) has its suffixes dealt by two words,
whose phrases of two and more words are still complete; where a pair of words is that frequent they are dealt by all
their words, and the partial counts of their prefixes are summed afterwards. Frequent pairs are found exactly: one with
that share of all pairs has half of it in some block. The lists have at most 1 / hot_share and 2 / hot_share entries.
Shards follow from the counted words (`shard_words` a shard), so no group grows with the input.

Words are known by 64-bit hashes of language and word. The word table is exact text, and if a frequent word shares its hash
with another one, everything is done again with another seed. Counts are joined to the parts of a phrase
afterwards; scores are exact decimal arithmetic.

Edge cases: null texts and texts without words yield nothing but count as documents of their language; a null language is
`und`; a piece can be of any length; rows that are repeated count each; equal scores and counts are ranked by the
phrase's UTF-8 bytes; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm import _bytes as B
from ledgerlight.llm.decontaminate import _maybe, bloom_of
from ledgerlight.session import cut, shuffle_width

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[*b".,;:!?", *range(10, 14)]] = True
WORD = ~SEPARATOR
WORD[[9, 32]] = False
#: Words a block of text holds before its suffixes are merged and sent.
BLOCK_WORDS = 2_000_000
#: Distinct words that a task of the first scan holds before it sends them.
HELD_WORDS = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"


class Tokens:
    """The words of some texts: keys of language and word, and whether the next word follows in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, seed: int):
        self.words = w = B.Words(data, offsets, WORD)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(w.bounds))
        self.text = text
        with np.errstate(over="ignore"):
            self.keys = B.mix((w.hash + np.uint64(seed)) * _ODD + lang[text])
        seps = np.zeros(len(data) + 1, np.int32)
        np.cumsum(SEPARATOR[data], out=seps[1:])
        self.follows = np.zeros(len(w), bool)
        if len(w) > 1:
            self.follows[:-1] = (text[1:] == text[:-1]) & (seps[w.start[1:]] == seps[w.end[:-1]])

    def spelt(self, at: np.ndarray) -> pa.Array:
        """The lower-cased words at these places."""
        w = self.words
        size = w.end[at] - w.start[at]
        offs = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(w.start[at] - offs[:-1], size) + np.arange(offs[-1])
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(B.LOWER[w.data[place]]))


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _tokens(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[Tokens, pa.Array]]:
    """Tokens of pieces of the batches' rows (text, lang), and the language of each of these rows."""
    for batch in batches:
        data, offs = B.text_bytes(batch.column(0))
        named = batch.column(1).dictionary_encode()
        hashes = np.array([_lang_hash(x) for x in named.dictionary.to_pylist()], np.uint64)
        lang = hashes[named.indices.to_numpy()]
        for a, b in B.pieces(offs):
            yield Tokens(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], lang[a:b], seed), batch.column(1).slice(a, b - a)


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return B.mix(first * _ODD + second)


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their first places and summed counts."""
    distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return distinct, first, np.bincount(inverse, counts, len(distinct)).astype(np.int64)


def count_words(docs: DataFrame, seed: int, hot_share: float) -> DataFrame:
    """(key, lang, word, n): words with their counts, without keys; keys of pairs, without words, that are frequent in some block."""
    names = ["key", "lang", "word", "n"]

    def rows(key: pa.Array, lang: pa.Array, word: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([key, lang, word, pa.array(n)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []
        pairs: list[np.ndarray] = []

        def merged() -> None:
            keys, first, n = _counted(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            lang, word = (pa.concat_arrays([x[i] for x in held]).take(pa.array(first)) for i in (2, 3))
            held[:] = [(keys, n, lang, word)]

        def frequent() -> Iterator[pa.RecordBatch]:
            all_pairs = np.concatenate(pairs)
            keys, n = np.unique(all_pairs, return_counts=True)
            keep = n >= hot_share / 2 * len(all_pairs)
            pairs.clear()
            none = pa.nulls(int(keep.sum()), pa.string())
            yield rows(pa.array(keys[keep].view(np.int64)), none, none, n[keep].astype(np.int64))

        for t, langs in _tokens(batches, seed):
            if not len(t.keys):
                continue
            keys, first, n = _counted(t.keys, np.ones(len(t.keys)))
            held.append((keys, n, langs.take(pa.array(t.text[first])), t.spelt(first)))
            at = np.flatnonzero(t.follows)
            if len(at):
                pairs.append(_pairs(t.keys[at], t.keys[at + 1]))
            if sum(len(x[0]) for x in held) > HELD_WORDS:
                merged()
                if len(held[0][0]) > HELD_WORDS // 2:
                    keys, n, lang, word = held.pop()
                    yield rows(pa.nulls(len(keys), pa.int64()), lang, word, n)
            if sum(len(x) for x in pairs) > BLOCK_WORDS:
                yield from frequent()
        if held:
            merged()
            yield rows(pa.nulls(len(held[0][0]), pa.int64()), held[0][2], held[0][3], held[0][1])
        if pairs:
            yield from frequent()

    return docs.mapInArrow(run, "key long, lang string, word string, n long").groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))


def with_keys(words: DataFrame, seed: int) -> DataFrame:
    """(key, lang, word, n) of (lang, word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [t.keys for t, _ in _tokens([batch.select(["word", "lang"])], seed)]
            key = pa.array(np.concatenate(keys or [np.zeros(0, np.uint64)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([key, *batch.columns], ["key", "lang", "word", "n"])

    return words.select("lang", "word", "n").mapInArrow(run, "key long, lang string, word string, n long")


def _within(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


def _merged_suffixes(columns: list[np.ndarray], n: np.ndarray, most: int) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """Suffixes (columns of codes up to `most`, 0 where they have ended) in descending order, equal ones merged.

    Also, for each column, whether all columns up to it equal those of the row before.
    """
    bits = np.uint64(most.bit_length())
    words, have = [], np.uint64(64)
    for c in columns:  # as many columns a sort key as fit in 64 bits
        if have + bits > np.uint64(63):
            words.append(c.astype(np.uint64))
            have = bits
        else:
            words[-1] = (words[-1] << bits) | c.astype(np.uint64)
            have += bits
    order = np.lexsort(words[::-1])[::-1]
    columns = [c[order] for c in columns]
    same = [np.ones(len(order), bool)]
    for c in columns:
        equal = np.zeros(len(order), bool)
        equal[1:] = c[1:] == c[:-1]
        same.append(same[-1] & equal)
    first = np.flatnonzero(~same[-1])
    n = np.add.reduceat(n[order], first) if len(first) else n[:0]
    return [c[first] for c in columns], n, [s[first] for s in same[1:]]


class Plan:
    """What all tasks share: the filter of frequent words, numbers of the most frequent ones, hot words and hot pairs."""

    def __init__(self, bloom: np.ndarray, ranked: np.ndarray, hot_words: np.ndarray, hot_pairs: np.ndarray):
        self.bloom, self.ranked, self.hot_words, self.hot_pairs = bloom, ranked, hot_words, hot_pairs
        self.rank = np.argsort(ranked, kind="stable").astype(np.uint32)
        self.sorted = ranked[self.rank]
        self.top = len(ranked)

    def numbers(self, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A number from 1 for each wanted key, 0 for the others; keys by number, those without a common number last."""
        number = np.zeros(len(keys), np.uint32)
        common = np.zeros(len(keys), bool)
        if self.top:
            place = np.minimum(np.searchsorted(self.sorted, keys), self.top - 1)
            common = (self.sorted[place] == keys) & wanted
            number[common] = self.rank[place[common]] + 1
        own = wanted & ~common
        rest, inverse = np.unique(keys[own], return_inverse=True)
        number[own] = inverse + 1 + self.top
        return number, self.known(rest)

    def known(self, rest: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), self.ranked, rest])


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, byte by byte: first all lowest bytes."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _message(columns: list[np.ndarray], n: np.ndarray, known: np.ndarray, top: int) -> bytes:
    """Suffixes in order, with the keys of words that have no common number."""
    rest = np.unique(np.concatenate([c[c > top] for c in columns]))
    if len(rest):
        columns = [np.where(c > top, np.searchsorted(rest, c) + top + 1, c) for c in columns]
    first = np.diff(columns[0].astype(np.uint32), prepend=np.uint32(0))
    body = pickle.dumps((known[rest], [_planes(c) for c in (first, *columns[1:], n)]), 5)
    return pickle.dumps((len(body), pa.compress(body, "zstd", asbytes=True)), 5)


def _opened(payload: memoryview) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    size, body = pickle.loads(payload)
    rest, packed = pickle.loads(pa.decompress(body, size, "zstd", asbytes=True))
    *columns, n = (_from_planes(x) for x in packed)
    columns[0] = np.cumsum(columns[0], dtype=np.uint32)
    return rest, columns, n.astype(np.int64)


def deal_suffixes(docs: DataFrame, plan, shards: int, max_words: int, seed: int) -> DataFrame:
    """(shard, payload): merged suffixes of two and more words of a block of text, for each shard."""

    def sent(blocks: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, bytes]]:
        shared = plan.value
        keys = np.concatenate([k for k, _ in blocks])
        frequent = _maybe(shared.bloom, keys)
        follows = np.concatenate([f for _, f in blocks]) & frequent
        follows[:-1] &= frequent[1:]
        follows[-1] = False
        at = np.flatnonzero(follows)
        if not len(at):
            return
        number, known = shared.numbers(keys, frequent)
        columns, open_, last = [number[at]], np.ones(len(at), bool), len(keys) - 1
        for j in range(1, max_words):
            place = np.minimum(at + j, last)
            open_ &= (at + j <= last) & follows[np.minimum(at + j - 1, last)]
            columns.append(np.where(open_, number[place], 0).astype(np.uint32))
        columns, n, _ = _merged_suffixes(columns, np.ones(len(at), np.int64), len(known))
        one = known[columns[0]]
        pair = _pairs(one, known[columns[1]])
        deal = np.where(_within(shared.hot_words, one), pair, one)
        hot = np.flatnonzero(_within(shared.hot_pairs, pair))
        if len(hot):
            whole = pair[hot]
            for c in columns[2:]:
                whole = _pairs(whole, known[c[hot]])
            deal[hot] = whole
        shard = ((B.mix(deal.copy()) >> np.uint64(20)) % np.uint64(shards)).astype(np.uint32)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(edges)).tolist():
            rows = order[edges[s] : edges[s + 1]]
            yield s, _message([c[rows] for c in columns], n[rows], known, shared.top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            for s, payload in sent(blocks):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([payload], pa.binary())], ["shard", "payload"])
            blocks.clear()

        for t, _ in _tokens(batches, seed):
            if len(t.keys):
                blocks.append((t.keys, t.follows))
            if sum(len(k) for k, _ in blocks) >= BLOCK_WORDS:
                yield from flush()
        if blocks:
            yield from flush()

    return docs.mapInArrow(run, "shard int, payload binary")


def _phrase_bytes(keys: np.ndarray) -> pa.Array:
    """Rows of keys as binary values of eight bytes a key, most significant first."""
    rows, width = keys.shape
    offs = np.arange(rows + 1, dtype=np.int32) * (8 * width)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offs), pa.py_buffer(keys.astype(">u8").tobytes())])


def _key_bytes(key: Column) -> Column:
    return F.unhex(F.lpad(F.hex(key), 16, "0"))


def count_prefixes(dealt: DataFrame, plan, max_words: int, min_count: int) -> DataFrame:
    """(phrase, n): phrases of two and more words that a shard has counted; those of hot pairs with partial counts."""

    def run(table: pa.Table) -> pa.Table:
        shared = plan.value
        got = [_opened(payload.as_buffer()) for payload in table["payload"]]
        rest, inverse = np.unique(np.concatenate([x[0] for x in got]), return_inverse=True)
        at = 0
        for keys, columns, _ in got:
            own = inverse[at : at + len(keys)]
            at += len(keys)
            if len(keys):
                for c in columns:
                    far = np.flatnonzero(c > shared.top)
                    c[far] = own[c[far] - shared.top - 1] + shared.top + 1
        columns = [np.concatenate([x[1][j] for x in got]) for j in range(max_words)]
        n = np.concatenate([x[2] for x in got])
        del got
        known = shared.known(rest)
        columns, n, same = _merged_suffixes(columns, n, len(known))
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        hot = _within(shared.hot_pairs, _pairs(known[columns[0]], known[columns[1]])) if len(shared.hot_pairs) else np.zeros(len(n), bool)
        phrases, counts = [], []
        for size in range(2, max_words + 1):
            # a counter of this length is pushed where the row has so many words and differs from the row above, popped at the next difference
            edges = np.flatnonzero(~same[size - 1])
            sums = upto[np.append(edges[1:], len(n))] - upto[edges]
            keep = (columns[size - 1][edges] != 0) & ((sums >= min_count) | (hot[edges] & (size < max_words)))
            rows = edges[keep]
            phrases.append(_phrase_bytes(np.stack([known[c[rows]] for c in columns[:size]], 1)))
            counts.append(sums[keep])
        return pa.table([pa.concat_arrays(phrases), pa.array(np.concatenate(counts))], ["phrase", "n"])

    return dealt.groupBy("shard").applyInArrow(run, "phrase binary, n long")


def _sorted_keys(table: DataFrame) -> np.ndarray:
    return np.sort(table.select("key").toArrow()["key"].to_numpy().view(np.uint64))


def phrase_counts(docs: DataFrame, *, text_col: str, lang_col: str, max_words: int, min_count: int, hot_share: float, shard_words: int, bloom_bits: int, codes: int, seeds: int = 8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrase, n) of all phrases of min_count occurrences, single words too; (key, lang, word) of their words; (lang, n)."""
    spark = docs.sparkSession
    B.small_batches(spark)
    docs = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    for seed in range(seeds):
        found = cut(count_words(docs, seed, hot_share))
        words, pairs = cut(with_keys(found.where("word is not null"), seed)), found.where("word is null")
        shared = words.groupBy("key").agg(F.count("*").alias("words"), F.max("n").alias("n")).where((F.col("words") > 1) & (F.col("n") >= min_count))
        if not shared.limit(1).count():
            break
    else:
        raise RuntimeError("frequent words share their hashes under every seed")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= min_count)
    total, n_frequent = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") >= min_count)).first()
    shards = max(shuffle_width(spark), -(-total // shard_words))
    hot = max(hot_share, 1 / (4 * shards)) * total
    bits = 1 << 13
    while bits < bloom_bits and bits < 16 * n_frequent:
        bits *= 2
    bloom = bloom_of(frequent.select(F.col("key").alias("gram")), bits)  # at most bloom_bits / 8 bytes
    # at most 1 / hot_share words and 2 / hot_share pairs
    hot_words, hot_pairs = _sorted_keys(words.where(F.col("n") >= hot)), _sorted_keys(pairs.where(F.col("n") >= hot / 2))
    ranked = frequent.orderBy(F.desc("n"), "key").limit(codes).select("key").toArrow()["key"].to_numpy().view(np.uint64)  # at most eight bytes a code
    plan = spark.sparkContext.broadcast(Plan(bloom, ranked, hot_words, hot_pairs))
    dealt = deal_suffixes(docs, plan, shards, max_words, seed)
    longer = count_prefixes(dealt, plan, max_words, min_count).groupBy("phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    counts = longer.unionByName(frequent.select(_key_bytes(F.col("key")).alias("phrase"), "n"))
    return cut(counts), frequent.select("key", "lang", "word"), totals


def collocations(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    max_words: int = 5,
    min_count: int = 100,
    top: int = 2000,
    hot_share: float = 1 / 20_000,
    shard_words: int = 2_000_000,
    bloom_bits: int = 1 << 27,
    codes: int = 1 << 20,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best collocations.

    a: occurrences of the phrase; l and r: of the two parts of the cut that scores lowest; n: of all words of the language; score:
    floor(1000 a n / (l r)). A phrase that a longer one holds as often as it occurs is left out.
    """
    counts, words, totals = phrase_counts(
        docs, text_col=text_col, lang_col=lang_col, max_words=max_words, min_count=min_count, hot_share=hot_share, shard_words=shard_words, bloom_bits=bloom_bits, codes=codes
    )
    size = F.length("phrase") / 8
    several = counts.where(F.length("phrase") > 8).withColumnRenamed("n", "a")
    # a longer phrase that holds this one as often holds one with a word more that does, so a word more is all to look at
    inner = F.array(F.expr("substring(phrase, 1, length(phrase) - 8)"), F.expr("substring(phrase, 9)"))
    holding = several.where(F.length("phrase") > 16).select(F.explode(inner).alias("phrase"), "a").groupBy("phrase").agg(F.max("a").alias("held"))
    several = several.join(holding, "phrase", "left").where(F.col("held").isNull() | (F.col("held") < F.col("a"))).drop("held")
    langs = words.select(_key_bytes(F.col("key")).alias("first"), "lang")
    several = several.withColumn("first", F.expr("substring(phrase, 1, 8)")).join(langs, "first").drop("first").join(totals, "lang")
    cuts = several.select("*", F.explode(F.sequence(F.lit(1), (size - 1).cast("int"))).alias("k"))
    cuts = cuts.withColumns({"left": F.expr("substring(phrase, 1, 8 * k)"), "right": F.expr("substring(phrase, 8 * k + 1)")})
    cuts = cuts.join(counts.select(F.col("phrase").alias("left"), F.col("n").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("phrase").alias("right"), F.col("n").alias("r")), "right")
    exact = F.expr("cast(1000 as decimal(4)) * cast(a as decimal(17)) * cast(n as decimal(17)) div (cast(l as decimal(19)) * cast(r as decimal(19)))")
    cuts = cuts.withColumn("score", exact)
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    scored = scored.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    # first the best of each of many parts of a language, ties at the edge included, then the best of these; only they are spelt out
    best = (F.desc("score"), F.desc("a"))
    for by in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(64))], ["lang"]):
        scored = scored.withColumn("place", F.rank().over(Window.partitionBy(*by).orderBy(*best))).where(F.col("place") <= top).drop("place")
    scored = cut(scored)
    keys = F.transform(F.sequence(F.lit(0), (size - 1).cast("int")), lambda i: F.conv(F.hex(F.substring("phrase", F.lit(8) * i + 1, F.lit(8))), 16, -10).cast("long"))
    parts = scored.select("phrase", F.posexplode(keys).alias("at", "key")).join(words.select("key", "word"), "key")
    spelt = parts.groupBy("phrase").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("spelt"))
    named = scored.join(spelt, "phrase").withColumn("phrase", F.col("spelt"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase"))
    return named.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
