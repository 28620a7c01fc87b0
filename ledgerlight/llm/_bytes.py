"""Vectorised work on the UTF-8 bytes of Arrow text columns: words, word hashes, shingle hashes, window minima."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

CHUNK_BYTES = 2 << 20

_rng = np.random.default_rng(20240229)
_RANDOM = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SHINGLE_BASE = np.uint64(0xD6E8FEB86659FD93)

#: Bytes of words: runs of digits, letters and whatever isn't ASCII / runs of whatever isn't ASCII white space.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False

_powers: dict[int, np.ndarray] = {}


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows, as one row can hold a very long text."""
    workers_import(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes, one after the other, and n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def pieces(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes; one longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """The words of some texts: byte ranges, hashes of the lower-cased words, and the word range of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, hashed: bool = True):
        n = len(data)
        inside = kind[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        first[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[edges - 1] = inside[edges - 1]
        self.data = data
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        if hashed:
            sums = np.zeros(n + 1, np.uint64)
            np.multiply(_RANDOM[LOWER[data]], powers(_BASE, n), out=sums[1:])
            np.cumsum(sums[1:], out=sums[1:])
            self.hash = mix((sums[self.end] - sums[self.start]) * powers(_BASE_INV, n + 1)[self.start])

    def __len__(self) -> int:
        return len(self.start)

    def left(self) -> np.ndarray:
        """How many words the word's text has from it on."""
        return np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(len(self.start))

    def word(self, i: int) -> str:
        return LOWER[self.data[self.start[i] : self.end[i]]].tobytes().decode("utf-8", "replace")


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k words from each word on; the last k - 1 have fewer words and must be left out by the caller."""
    out = hashes.copy()
    n, power = len(hashes), np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(1, min(k, n)):
            power = power * _SHINGLE_BASE
            out[: n - j] += hashes[j:] * power
    return mix(out)


def sliding(values: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over values[i : i + width] for each i; shorter at the end."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        if step >= len(out):
            break
        nxt = out.copy()
        op(out[:-step], out[step:], out=nxt[: len(out) - step])
        out, have = nxt, have + step
    return out


def winnow(grams: np.ndarray, left: np.ndarray, k: int, width: int) -> np.ndarray:
    """Which k-grams are the least of a window of `width` k-grams within one text (all, where several are least).

    left: the words from each position on in its text. Two texts that share width + k - 1 words share a kept k-gram.
    """
    n = len(grams)
    if n == 0:
        return np.zeros(0, bool)
    whole = left >= width + k - 1
    least = sliding(grams, width, np.minimum)
    least[~whole] = 0
    best = sliding(least[::-1], width, np.maximum)[::-1]  # the largest minimum of the windows that hold the position
    return (best == grams) & (left >= k)


def hash_order(hashes: np.ndarray) -> np.ndarray:
    """A stable order that brings equal hashes together (not in full numeric order); sorts, doesn't argsort."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = np.sort((hashes & ~low) | np.arange(n, dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    found = hashes[order]
    same_prefix = (packed[1:] & ~low) == (packed[:-1] & ~low)
    if np.any(same_prefix & (found[1:] != found[:-1])):  # rare: different hashes with the same leading bits
        return np.argsort(hashes, kind="stable")
    return order


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal values begins, and how long it is."""
    if len(values) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return first, np.diff(np.append(first, len(values)))


def pack(*columns: tuple[str, pa.Array]) -> bytes:
    """A record batch of those columns as bytes."""
    batch = pa.RecordBatch.from_arrays([c for _, c in columns], [n for n, _ in columns])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def block_number(count: int) -> int:
    """A number for the task's count-th block that no other task of the stage uses."""
    from pyspark import TaskContext

    return (TaskContext.get().partitionId() << 24) + count
