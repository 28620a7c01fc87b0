"""Token counts without tokens: a count-only Viterbi over the matches of an Aho-Corasick automaton.

The vocabulary is a list of (piece, score); a text's tokens are the pieces of the segmentation with the greatest sum
of scores. Only the best score and its number of pieces are carried from byte to byte. Tie rules are those of the
`tokenizers` library's Unigram model: of segmentations that end at the same place with equal scores the one whose last
piece is longer stays; a character that is no piece itself may be unknown, at the least score less 10, and counts as
its UTF-8 bytes (byte fallback); a literal unknown piece is joined with unknown neighbours. Sums are in double
precision. White space is marked as the vocabulary has it: a space is put in front and all spaces are "▁".

No piece goes on from another character into a space, so a text is cut before each run of spaces; a batch's distinct
cuts are run through the automaton side by side, longest matches first, and longer cuts one by one.

Distinct cuts are told by 64-bit hashes. Edge cases: null and empty texts have 0 tokens; rows are counted one by one,
so repeated rows repeat; null ids are kept; very long texts, and texts without spaces, are counted whole; empty tables
give empty results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import _bytes as B

MARK = "▁"
UNKNOWN_PENALTY = 10.0
SIDE_BY_SIDE = 64
PIECE_BYTES = 8 << 20


def read_pieces(model_file: str) -> list[tuple[str, float]]:
    """The pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.vocab_size())]


class Automaton:
    """Dense Aho-Corasick transitions over bytes, and for each state the chain of pieces that end there."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: str):
        self.unknown_score = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.unknown = unknown.replace(MARK, " ")
        self.scores = {p.replace(MARK, " "): s for p, s in reversed(pieces)}
        children: list[dict[int, int]] = [{}]
        length, score = [0], [0.0]
        for piece, value in self.scores.items():
            at = 0
            raw = piece.encode()
            for byte in raw:
                nxt = children[at].get(byte)
                if nxt is None:
                    nxt = len(children)
                    children[at][byte] = nxt
                    children.append({})
                    length.append(0)
                    score.append(0.0)
                at = nxt
            length[at], score[at] = len(raw), value
        n = len(children)
        self.go = np.zeros((n, 256), np.uint16 if n <= 1 << 16 else np.int32)
        fail = np.zeros(n, np.int64)
        self.up = np.zeros(n, np.int64)  # the next shorter piece that ends at a state
        self.length, self.score = np.array(length, np.int64), np.array(score)
        level = [0]
        while level:
            below = []
            for s in level:
                if s:
                    self.go[s] = self.go[fail[s]]
                    f = fail[s]
                    self.up[s] = f if length[f] else self.up[f]
                for byte, c in children[s].items():
                    fail[c] = self.go[fail[s], byte] if s else 0
                    below.append(c)
            for s in level:
                for byte, c in children[s].items():
                    self.go[s, byte] = c
            level = below
        self.top = np.where(self.length > 0, np.arange(n), self.up)
        self._slow = None

    def count_many(self, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Pieces of each row of a byte matrix, of which the first `size` bytes count; size descends."""
        n, width = rows.shape
        best = np.full((width + 1, n), -np.inf)
        count = np.zeros((width + 1, n), np.int32)
        best[0] = 0
        state = np.zeros(n, np.int64)
        begin = np.zeros(n, np.int64)  # of the character at hand
        for e in range(1, width + 1):
            m = int(np.searchsorted(-size, -e, "right"))  # rows that are this long
            if m == 0:
                break
            byte = rows[:m, e - 1]
            begin[:m] = np.where(byte & 0xC0 == 0x80, begin[:m], e - 1)
            state = self.go[state[:m], byte].astype(np.int64)
            ends = size[:m] == e
            if e < width:
                ends |= rows[:m, e] & 0xC0 != 0x80
            at = np.flatnonzero(ends)
            single = np.zeros(m, bool)
            live, s = at, self.top[state[at]]
            while True:
                some = s > 0
                if not some.all():
                    live, s = live[some], s[some]
                if not len(live):
                    break
                length = self.length[s]
                start = e - length
                value = best[start, live] + self.score[s]
                better = value > best[e, live]
                w = live[better]
                best[e, w] = value[better]
                count[e, w] = count[start[better], w] + 1
                single[live[start == begin[live]]] = True
                s = self.up[s]
            lone = at[~single[at]]
            if len(lone):
                start = begin[lone]
                value = best[start, lone] + self.unknown_score
                better = value > best[e, lone]
                w = lone[better]
                best[e, w] = value[better]
                count[e, w] = count[start[better], w] + (e - start[better])
        return count[size, np.arange(n)]

    def count_one(self, text: str) -> int:
        """Pieces of one text, spaces for marks; slow, for long cuts and those with a literal unknown piece."""
        if self._slow is None:
            import ahocorasick

            self._slow = ahocorasick.Automaton()
            for piece, value in self.scores.items():
                self._slow.add_word(piece, (len(piece), value))
            self._slow.make_automaton()
        n = len(text)
        best, back, unknown = [0.0] + [-np.inf] * n, [0] * (n + 1), [False] * (n + 1)
        single = [False] * (n + 1)
        pending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, match in self._slow.iter(text):
            pending[end + 1].append(match)
        for e in range(1, n + 1):
            for length, value in sorted(pending[e], reverse=True):
                if best[e - length] + value > best[e]:
                    best[e], back[e], unknown[e] = best[e - length] + value, e - length, text[e - length : e] == self.unknown
                single[e] |= length == 1
            if not single[e] and best[e - 1] + self.unknown_score > best[e]:
                best[e], back[e], unknown[e] = best[e - 1] + self.unknown_score, e - 1, True
        total, e, joined = 0, n, ""
        while e > 0:
            part = text[back[e] : e]
            if unknown[e]:
                joined = part + joined
            if joined and (not unknown[e] or back[e] == 0):
                total += 1 if joined in self.scores else len(joined.encode())
                joined = ""
            total += not unknown[e]
            e = back[e]
        return total


_made: dict[int, Automaton] = {}


def count_texts(automaton: Automaton, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Tokens of each text."""
    n = len(offs) - 1
    sizes = np.diff(offs)
    some = sizes > 0
    spaced = np.full(len(data) + int(some.sum()), 32, np.uint8)
    begin = offs[:-1] + np.cumsum(some) - some  # where each text begins, with a space in front
    spaced[np.arange(len(data)) + np.repeat(np.cumsum(some), sizes)] = data
    space = spaced == 32
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[begin[some]] = True
    start = np.flatnonzero(first)
    end = np.append(start[1:], len(spaced))
    sums = np.zeros(len(spaced) + 1, np.uint64)
    np.multiply(B._RANDOM[spaced], B.powers(B._BASE, len(spaced)), out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    key = B.mix((sums[end] - sums[start]) * B.powers(B._BASE_INV, len(sums))[start] ^ (end - start).astype(np.uint64))
    order = B.hash_order(key)
    head, times = B.runs(key[order])
    one = order[head]
    size = end[one] - start[one]
    counts = np.zeros(len(one), np.int64)
    by_size = np.argsort(-size, kind="stable")
    upto = int(np.searchsorted(-size[by_size], -SIDE_BY_SIDE, "left"))
    for i in by_size[:upto].tolist():
        counts[i] = automaton.count_one(spaced[start[one[i]] : end[one[i]]].tobytes().decode("utf-8", "replace"))
    at = upto
    while at < len(by_size):
        most = int(size[by_size[at]])
        stop = int(np.searchsorted(-size[by_size], -(most // 2), "right")) if most > 4 else len(by_size)
        stop = min(max(stop, at + 1), at + (1 << 16))
        rows = by_size[at:stop]
        place = np.minimum(start[one[rows]][:, None] + np.arange(most), len(spaced) - 1)
        counts[rows] = automaton.count_many(spaced[place], size[rows])
        at = stop
    each = np.empty(len(key), np.int64)
    each[order] = np.repeat(counts, times)
    total = np.concatenate([[0], np.cumsum(each)])
    edges = np.searchsorted(start, np.append(begin, len(spaced)))
    out = total[edges[1:]] - total[edges[:-1]]
    out[~some] = 0
    return out


def count_tokens(
    docs: DataFrame, pieces: list[tuple[str, float]], *, unknown: str = "<unk>", id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The kept columns (default: the id) with n_tokens and n_bytes, for each row."""
    spark = docs.sparkSession
    B.small_batches(spark)
    shared = spark.sparkContext.broadcast((pieces, unknown))  # the vocabulary
    number = hash((len(pieces), pieces[0], pieces[-1], unknown))
    keep = [id_col] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if number not in _made:
            _made.clear()
            _made[number] = Automaton(*shared.value)
        automaton = _made[number]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            data, offs = B.text_bytes(texts)
            for a, b in B.pieces(offs, PIECE_BYTES):
                counts = count_texts(automaton, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                for i in range(a, b):  # a literal unknown piece: texts that have one are counted one by one
                    if _has(data[offs[i] : offs[i + 1]], unknown):
                        counts[i - a] = automaton.count_one(" " + texts[i].as_py())
                own = [batch.column(c).slice(a, b - a) for c in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(counts, pa.int64()), pa.array(batch.column(len(keep)).slice(a, b - a))], [*keep, "n_tokens", "n_bytes"])

    marked = F.coalesce(F.replace(F.col(text_col).cast("string"), F.lit(MARK), F.lit(" ")), F.lit(""))
    schema = T.StructType([*[docs.schema[c] for c in keep], *T.StructType.fromDDL("n_tokens long, n_bytes long").fields])
    return docs.select(*keep, F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("__bytes"), marked.alias("__text")).mapInArrow(run, schema)


def _has(data: np.ndarray, word: str) -> bool:
    return data.tobytes().find(word.replace(MARK, " ").encode()) >= 0
