"""Removal of repeated byte strings by anchored windows and hashes.

A byte goes if a string of `length` bytes that covers it also starts earlier, in a document with a smaller id or
further ahead in the same one. The strings (windows) are all suffixes cut to that length, so those that are equal
are found among all that have the same anchor. The work is spread out by content:

1. A window belongs to its anchor, the least hash of its `gram`-byte grams; equal windows have equal anchors at equal
   offsets. Documents are dealt out to blocks, by a shuffle that all steps use. Blocks ask shards, a few bytes for each distinct anchor, which anchors occur elsewhere too.
2. Runs of consecutive windows of one repeated anchor go to the anchor's shard as one short string. Within a block
   equal strings go once: the first one, while later ones are thereby known to repeat. A passage that a third of all
   documents share costs one string for each block.
3. A shard sets equal strings aside in the same way. Of the others those are left whose half window before or behind the
   anchor's place another string of the anchor has too, as every common window holds one of these halves; strings that have only the
   anchor in common by chance, ever more in larger tables, end here. Windows of those left meet by hash within their anchor and offset and
   are compared byte by byte, so that a collision of hashes can't remove anything; windows whose hashes collide are merge-sorted as suffixes of the joined text,
   compared by their longest common extension, a binary search over prefix polynomial hashes. All but the first of equal windows are told to their block.
4. Blocks mark the bytes and hash what is left.

Edge cases: null and empty texts have 0 bytes; texts shorter than `length` are never touched; rows that share a
doc_id each get a result row, and as none of them is earlier than the other, they don't remove each other's bytes;
null doc_id counts as the largest id; empty tables give empty results; ids are integers; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import _bytes as B
from ledgerlight.session import shuffle_width

LENGTH, GRAM = 100, 24
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 1 << 20
PART_BYTES = 2 << 20
PLACE_BITS = 28
LAST = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.multiply(B._RANDOM[data], B.powers(_BASE, len(data)), out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return sums


def _spans_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (sums[end] - sums[start]) * B.powers(_BASE_INV, len(sums))[start]


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of some spans, one after the other."""
    ends = np.cumsum(size)
    if not len(ends):
        return data[:0]
    return data[np.repeat(start - (ends - size), size) + np.arange(ends[-1])]


class Runs:
    """Runs of windows with one anchor: first and last window start, anchor place and the anchor's hash."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, length: int, gram: int):
        n = len(data)
        self.sums = prefix_hashes(data)
        if n < length:
            self.first = self.last = self.at = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        begin = np.arange(n - gram + 1)
        grams = B.mix(_spans_hash(self.sums, begin, begin + gram))
        packed = (grams & ~np.uint64((1 << PLACE_BITS) - 1)) | begin.astype(np.uint64)
        least = B.sliding(packed, length - gram + 1, np.minimum)[: n - length + 1]
        at = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        whole = np.zeros(n + 1, np.int64)
        some = np.diff(offs) >= length
        np.add.at(whole, offs[:-1][some], 1)
        np.add.at(whole, offs[1:][some] - length + 1, -1)
        whole = np.cumsum(whole)[: n - length + 1] > 0
        new = whole.copy()
        new[1:] &= ~whole[:-1] | (at[1:] != at[:-1])
        stop = whole.copy()
        stop[:-1] &= ~whole[1:] | (at[1:] != at[:-1])
        self.first, self.last = np.flatnonzero(new), np.flatnonzero(stop)
        self.at = at[self.first]
        self.anchor = grams[self.at]


def common_extension(sums: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many bytes the suffixes at a and b have in common, up to most."""
    inverse = B.powers(_BASE_INV, len(sums))
    ia, ib, sa, sb = inverse[a], inverse[b], sums[a], sums[b]
    lo, hi = np.zeros(len(a), np.int64), np.full(len(a), most)
    while np.any(lo < hi):
        mid = (lo + hi + 1) // 2
        same = (sums[a + mid] - sa) * ia == (sums[b + mid] - sb) * ib
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return lo


def suffix_sort(data: np.ndarray, sums: np.ndarray, place: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """The order of the suffixes at place within each bucket; bucket ascends. A bottom-up merge sort of all at once."""
    first, size = B.runs(bucket)
    index, start = np.arange(len(place)), np.repeat(first, size)
    limit = np.repeat(first + size, size)
    order, width = index.copy(), 1

    def less(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        same = common_extension(sums, a, b, length)
        equal = same >= length
        step = np.minimum(same, length - 1)
        return data[a + step] < data[b + step], equal

    while len(size) and width < size.max():
        live = np.flatnonzero(limit - start > width)
        run = (live - start[live]) // width
        right = run % 2 == 1
        mate = start[live] + np.where(right, run - 1, run + 1) * width
        mate_end = np.minimum(mate + width, limit[live])
        lo, hi = np.minimum(mate, mate_end), mate_end.copy()
        mine = place[order[live]]
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            before, equal = less(place[order[mid]], mine[open_])
            before &= ~equal
            before |= equal & right[open_]  # equal ones of the left run stay in front
            lo[open_] = np.where(before, mid + 1, lo[open_])
            hi[open_] = np.where(before, hi[open_], mid)
        own = live - (start[live] + run * width)
        base = start[live] + (run - right) * width
        moved = order[live]
        after = order.copy()
        after[base + own + (lo - np.minimum(mate, mate_end))] = moved
        order, width = after, width * 2
    return order


def _equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans at a and b have the same bytes."""
    out = np.ones(len(a), bool)
    step = 1 << 13
    for i in range(0, len(a), step):
        s = size[i : i + step]
        differ = gather(data, a[i : i + step], s) != gather(data, b[i : i + step], s)
        owner = np.repeat(np.arange(len(s)), s)
        bad = np.unique(owner[differ])
        out[i + bad] = False
    return out


def first_of_equal(data: np.ndarray, hashes: np.ndarray, start: np.ndarray, size: np.ndarray, extra: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each span, given with its hash, the index of the span of least rank with the same bytes and extra value."""
    key = B.mix(hashes ^ B.mix(size.astype(np.uint64) + extra))
    order = np.lexsort((rank, key))
    first, count = B.runs(key[order])
    out = np.empty(len(start), np.int64)
    out[order] = np.repeat(order[first], count)
    other = np.flatnonzero(out != np.arange(len(start)))
    ok = (size[other] == size[out[other]]) & (extra[other] == extra[out[other]])
    ok[ok] = _equal_spans(data, start[other[ok]], start[out[other[ok]]], size[other[ok]])
    out[other[~ok]] = other[~ok]  # a collision: stands for itself
    return out


def _can_repeat(sums: np.ndarray, base: np.ndarray, size: np.ndarray, offset: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Whether a string can have a window in common with another one of its anchor: such a window has half of its bytes before the anchor's place or half of them from there on."""
    half, at = length // 2, base + offset
    out = np.zeros(len(base), bool)
    for begin, there in ((at - half, offset >= half), (at, size - offset >= half)):
        rows = np.flatnonzero(there)
        key = B.mix(_spans_hash(sums, begin[rows], begin[rows] + half) ^ B.mix(group[rows].astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        _, count = B.runs(key[order])
        out[rows[order[np.repeat(count > 1, count)]]] = True
    return out


def equal_windows(data: np.ndarray, sums: np.ndarray, place: np.ndarray, bucket: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows at place that others of their bucket equal, byte by byte, and numbers that these share; bucket ascends."""
    key = B.mix(_spans_hash(sums, place, place + length) ^ B.mix(bucket.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    first, count = B.runs(key[order])
    several = np.repeat(count > 1, count)
    which, cls = order[several], np.repeat(np.arange(len(first)), count)[several]
    near = np.flatnonzero(cls[1:] == cls[:-1]) + 1
    same = bucket[which[near]] == bucket[which[near - 1]]
    same[same] = _equal_spans(data, place[which[near[same]]], place[which[near[same] - 1]], np.full(same.sum(), length))
    if same.all():
        return which, cls
    # a collision: those that have this hash are sorted as suffixes
    odd = np.isin(cls, cls[near[~same]])
    rest = np.sort(which[odd])
    rest = rest[suffix_sort(data, sums, place[rest], bucket[rest], length)]
    equal = np.zeros(len(rest), bool)
    equal[1:] = bucket[rest[1:]] == bucket[rest[:-1]]
    equal[equal] = _equal_spans(data, place[rest[equal]], place[rest[np.flatnonzero(equal) - 1]], np.full(equal.sum(), length))
    return np.concatenate([which[~odd], rest]), np.concatenate([cls[~odd], len(first) + np.cumsum(~equal)])


def repeated_windows(data: np.ndarray, size: np.ndarray, anchor: np.ndarray, offset: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Step 3 for one shard: (string, first, last) ranges of windows that occur earlier.

    data holds the strings one after the other; offset: of the anchor in the string; doc, start: where it came from.
    """
    base = np.cumsum(size) - size
    sums = prefix_hashes(data)
    rank = np.empty(len(size), np.int64)
    by_place = np.lexsort((start, doc))
    rank[by_place] = np.arange(len(size))
    chief = first_of_equal(data, _spans_hash(sums, base, base + size), base, size, offset.astype(np.uint64) ^ anchor, rank)
    later = (doc[chief] < doc) | ((doc[chief] == doc) & (start[chief] < start))
    windows = size - length + 1
    whole = np.flatnonzero(later)
    out = [(whole, np.zeros(len(whole), np.int64), windows[whole] - 1)]
    # distinct strings whose anchor has another distinct string
    own = np.flatnonzero(chief == np.arange(len(size)))
    order = own[np.argsort(anchor[own], kind="stable")]
    first, count = B.runs(anchor[order])
    several = np.repeat(count > 1, count)
    group = np.repeat(np.arange(len(first)), count)[several]
    order = order[several]
    some = _can_repeat(sums, base[order], size[order], offset[order], group, length)
    order, group = order[some], group[some]
    if len(order):
        n = windows[order]
        string = np.repeat(order, n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        bucket = np.repeat(group, n).astype(np.int64) * (2 * length) + (offset[string] - step)
        by_bucket = np.argsort(bucket, kind="stable")
        string, step, bucket = string[by_bucket], step[by_bucket], bucket[by_bucket]
        runs_first, runs_count = B.runs(bucket)
        busy = np.repeat(runs_count > 1, runs_count)
        string, step, bucket = string[busy], step[busy], bucket[busy]
        which, cls = equal_windows(data, sums, base[string] + step, bucket, length)
        string, step = string[which], step[which]
        d, s = doc[string], start[string] + step
        by_class = np.lexsort((s, d, cls))
        first, count = B.runs(cls[by_class])
        lead = np.empty(len(cls), np.int64)
        lead[by_class] = np.repeat(by_class[first], count)
        gone = (d[lead] < d) | ((d[lead] == d) & (s[lead] < s))
        string, step = string[gone], step[gone]
        order = np.lexsort((step, string))
        string, step = string[order], step[order]
        fresh = np.ones(len(string), bool)
        fresh[1:] = (string[1:] != string[:-1]) | (step[1:] != step[:-1] + 1)
        begin = np.flatnonzero(fresh)
        finish = np.append(begin, len(string))[1:] - 1
        out.append((string[begin], step[begin], step[finish]))
    string, begin, finish = (np.concatenate([x[i] for x in out]) for i in range(3))
    # equal strings from the same place (rows that share an id) fare alike
    same = np.flatnonzero((chief != np.arange(len(size))) & ~later)
    if len(same):
        order = np.argsort(string, kind="stable")
        lo, hi = (np.searchsorted(string[order], chief[same], side) for side in ("left", "right"))
        copy = order[np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo) + np.arange((hi - lo).sum())]
        string, begin, finish = np.append(string, np.repeat(same, hi - lo)), np.append(begin, begin[copy]), np.append(finish, finish[copy])
    return string, begin, finish


def _table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
    return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary())], ["shard", "block", "kind", "payload"])


MESSAGE = "shard int, block long, kind int, payload binary"


def _packed(data: np.ndarray) -> tuple[int, bytes]:
    return len(data), pa.compress(data.tobytes(), "zstd", asbytes=True)


def _unpacked(x: tuple[int, bytes]) -> np.ndarray:
    return np.frombuffer(pa.decompress(x[1], x[0], "zstd", asbytes=True), np.uint8) if x[0] else np.zeros(0, np.uint8)


def _by_shard(anchors: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors by shard, how often each occurs, and where shards begin."""
    distinct, count = np.unique(anchors, return_counts=True)
    home = ((distinct >> np.uint64(33)) % np.uint64(shards)).astype(np.uint32)
    order = np.argsort(home, kind="stable")
    return distinct[order], count[order], np.searchsorted(home[order], np.arange(shards + 1))


def _all_runs(data: np.ndarray, offs: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, Runs]]:
    for a, b in B.pieces(offs, PIECE_BYTES):
        yield int(offs[a]), Runs(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], length, gram)


def _laid_out(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's ids, bytes and offsets, in an order that doesn't depend on how its rows came together."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    data, offs = B.text_bytes(table["text"])
    return table["doc_id"].combine_chunks().fill_null(LAST).to_numpy(), data, offs


def _first_asks(blocks: DataFrame, length: int, gram: int, shards: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        _, data, offs = _laid_out(table)
        anchors = np.concatenate([r.anchor for _, r in _all_runs(data, offs, length, gram)] or [np.zeros(0, np.uint64)])
        distinct, count, edges = _by_shard(anchors, shards)
        rows = []
        for s in range(shards):
            a, b = edges[s], edges[s + 1]
            if b > a:
                rows.append((s, block, 1, pickle.dumps(((distinct[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.packbits(count[a:b] > 1)), 5)))
        return _table(rows)

    return blocks.groupBy("block").applyInArrow(run, MESSAGE)


def _first_answers(asks: DataFrame) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        out, blocks = [], table["block"].to_pylist()
        asked = [pickle.loads(payload.as_buffer()) for payload in table["payload"]]
        if asked:
            values = np.concatenate([x[0] for x in asked])
            many = np.concatenate([np.unpackbits(x[1], count=len(x[0])).astype(bool) for x in asked])
            packed = np.sort((values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64))
            order = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)
            _, count = B.runs(packed >> np.uint64(32))
            repeated = many.copy()
            repeated[order] |= np.repeat(count > 1, count)
            at = 0
            for block, x in zip(blocks, asked, strict=True):
                out.append((shard, block, 1, np.packbits(repeated[at : at + len(x[0])]).tobytes()))
                at += len(x[0])
        return _table(out)

    return asks.groupBy("shard").applyInArrow(run, MESSAGE)


def _finish(data: np.ndarray, offs: np.ndarray, spans: np.ndarray) -> list[tuple[int, int, str]]:
    """(n_removed, n_spans, hash of what is left) of each text, given covered (start, end) byte ranges."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    edges = np.searchsorted(spans[:, 0], offs)
    out = []
    for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
        own = spans[edges[i] : edges[i + 1]] - a
        cover = np.bincount(own[:, 0], minlength=b - a + 1) - np.bincount(own[:, 1], minlength=b - a + 1)
        g, d = np.cumsum(cover)[:-1] > 0, data[a:b]
        n = int(g.sum())
        if n:
            spans_n = int(g[0]) + int((g[1:] & ~g[:-1]).sum())
            out.append((n, spans_n, hashlib.sha256(d[~g].tobytes()).hexdigest()))
        else:
            out.append((0, 0, hashlib.sha256(d.tobytes()).hexdigest()))
    return out


def _second_asks(blocks: DataFrame, answers: DataFrame, length: int, gram: int, shards: int) -> DataFrame:
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([])
        block = table["block"][0].as_py()
        flags = {s: np.frombuffer(payload.as_buffer(), np.uint8) for s, payload in zip(told["shard"].to_pylist(), told["payload"], strict=True)}
        ids, data, offs = _laid_out(table)
        found = list(_all_runs(data, offs, length, gram))
        anchors = np.concatenate([r.anchor for _, r in found] or [np.zeros(0, np.uint64)])
        distinct, _, edges = _by_shard(anchors, shards)
        repeated = np.zeros(len(distinct), bool)
        for s, bits in flags.items():
            repeated[edges[s] : edges[s + 1]] = np.unpackbits(bits, count=edges[s + 1] - edges[s])
        hot = np.sort(distinct[repeated])
        parts = []
        for at, r in found:
            keep = np.zeros(len(r.anchor), bool)
            if len(hot):
                slot = np.minimum(np.searchsorted(hot, r.anchor), len(hot) - 1)
                keep = hot[slot] == r.anchor
            first, last = r.first[keep], r.last[keep]
            parts.append((first + at, last - first + length, r.at[keep] - first, r.anchor[keep], B.mix(_spans_hash(r.sums, first, last + length))))
        begin, span, offset, anchor, content = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(5))
        owner = np.searchsorted(offs, begin, "right") - 1
        inside = begin - offs[owner]
        doc = ids[owner] if len(owner) else np.zeros(0, np.int64)
        local = np.zeros((0, 2), np.int64)
        sent = np.zeros(0, np.int64)
        if len(begin):
            rank = np.empty(len(begin), np.int64)
            rank[np.lexsort((inside, doc))] = np.arange(len(begin))
            chief = first_of_equal(data, content, begin, span, anchor.astype(np.uint64) ^ offset.astype(np.uint64), rank)
            later = (doc[chief] < doc) | ((doc[chief] == doc) & (inside[chief] < inside))
            local = np.stack([begin[later], begin[later] + span[later]], axis=1)
            sent = np.flatnonzero(~later)  # the first ones, and equal ones of rows with the same id
        home = ((anchor[sent].astype(np.uint64) >> np.uint64(33)) % np.uint64(shards)).astype(np.uint32)
        order = np.argsort(home, kind="stable")
        sent, at = sent[order], np.searchsorted(home[order], np.arange(shards + 1))
        rows = [(block % shards, block, 0, pickle.dumps((local, begin[sent], at), 5))]
        for s in range(shards):
            g = sent[at[s] : at[s + 1]]
            if len(g):
                rows.append((s, block, 1, pickle.dumps((_packed(gather(data, begin[g], span[g])), span[g].astype(np.int32), anchor[g], offset[g].astype(np.int32), doc[g], inside[g].astype(np.int32)), 5)))
        return _table(rows)

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, MESSAGE)


def _second_answers(asks: DataFrame, length: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        out, blocks, asked = [], [], []
        for block, kind, payload in zip(table["block"].to_pylist(), table["kind"].to_pylist(), table["payload"], strict=True):
            if kind == 0:
                out.append((shard, block, 0, payload.as_py()))
            else:
                blocks.append(block)
                asked.append(pickle.loads(payload.as_buffer()))
        if asked:
            data = np.concatenate([_unpacked(x[0]) for x in asked])
            cols = [np.concatenate([x[i] for x in asked]) for i in range(1, 6)]
            size, anchor, offset = cols[0].astype(np.int64), cols[1].astype(np.uint64), cols[2].astype(np.int64)
            # anchors are independent of each other, so that a part of them at a time bounds the memory
            base, parts = np.cumsum(size) - size, 1 + len(data) // PART_BYTES
            part = (anchor >> np.uint64(5)) % np.uint64(parts)
            found = []
            for j in range(parts):
                rows = np.flatnonzero(part == j)
                if len(rows):
                    own = gather(data, base[rows], size[rows])
                    got = repeated_windows(own, size[rows], anchor[rows], offset[rows], cols[3][rows], cols[4][rows].astype(np.int64), length)
                    found.append((rows[got[0]], got[1], got[2]))
            string, first, last = (np.concatenate([x[i] for x in found]) for i in range(3))
            edges = np.cumsum([0, *(len(x[1]) for x in asked)])
            of = np.searchsorted(edges, string, "right") - 1
            order = np.argsort(of, kind="stable")
            string, first, last, of = string[order], first[order], last[order], of[order]
            cut = np.searchsorted(of, np.arange(len(asked) + 1))
            for i, block in enumerate(blocks):
                a, b = cut[i], cut[i + 1]
                if b > a:
                    out.append((shard, block, 1, pickle.dumps(((string[a:b] - edges[i]).astype(np.int32), first[a:b].astype(np.int32), last[a:b].astype(np.int32)), 5)))
        return _table(out)

    return asks.groupBy("shard").applyInArrow(run, MESSAGE)


def _results(blocks: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        ids, data, offs = _laid_out(table)
        spans, got, begin, at = [np.zeros((0, 2), np.int64)], {}, None, None
        for s, kind, payload in zip(told["shard"].to_pylist(), told["kind"].to_pylist(), told["payload"], strict=True):
            x = pickle.loads(payload.as_buffer())
            if kind == 0:
                local, begin, at = x
                spans.append(local)
            else:
                got[s] = x
        for s, (string, first, last) in got.items():
            base = begin[at[s] + string]
            spans.append(np.stack([base + first, base + last + length], axis=1))
        result = _finish(data, offs, np.concatenate(spans).astype(np.int64))
        return pa.table(
            [
                pa.array(ids, pa.int64(), mask=ids == LAST), pa.array(np.diff(offs), pa.int64()), pa.array([r[0] for r in result], pa.int64()),
                pa.array([r[1] for r in result], pa.int64()), pa.array([r[2] for r in result], pa.string()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    schema = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): a row for each row of docs."""
    spark = docs.sparkSession
    B.small_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shards = 2 * shuffle_width(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(shuffle_width(spark), -(-total // BLOCK_BYTES))
    # a document's block depends on the document alone, so that a task that is run again makes the same blocks
    blocks = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).alias("block"), "doc_id", "text")
    answers = _first_answers(_first_asks(blocks, length, gram, shards))
    answers = _second_answers(_second_asks(blocks, answers, length, gram, shards), length)
    out = _results(blocks, answers, length)
    return out.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else out
