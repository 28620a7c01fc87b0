"""Language identification in two levels: the family first, then one-versus-one linear SVMs among its languages.

Features are hashed byte n-grams (n = 1, 2, 3) of the text with A-Z lower-cased, as shares of the text's n-grams. A
linear support vector machine for each pair of families votes for the family, and one for each pair of languages
within the winning family for the language; votes that are equal go to the larger sum of margins, then to the name
that sorts first. The score is the product of the two levels' logistic confidence in the winner, from 0 to 1.

Training reads the features of a bounded sample: of each language at most `per_language` labelled documents with the
smallest hashes of their ids, and at most `sample` in all. Features are made on the executors, so the driver holds
sample * DIMS floats whatever the length of the texts. Prediction runs over whole texts, in pieces of bounded size,
with a few kilobytes of weights for each pair.

Edge cases: null text, or one with no letter of any script, is `und` with score 0; empty training data makes all
`und`; with one learned language all other texts are that language with score 1; rows are scored one by one, so
repeated rows repeat; null doc_id is never learned from and isn't held out; further columns, whatever their names,
are ignored; very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.llm import _bytes as B

#: Dimensions of each n-gram length.
SIZES = (256, 1024, 2048)
DIMS = sum(SIZES)
UNKNOWN = "und"

#: The family of each language code; codes that aren't listed are families of their own.
FAMILIES = {
    "de": "germanic", "en": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic", "is": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "sl": "slavic", "uk": "slavic", "bg": "slavic", "hr": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic", "ja": "japonic", "ko": "koreanic", "zh": "sinitic",
}

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def _indexes(low: np.ndarray) -> list[np.ndarray]:
    """For n = 1, 2, 3 the dimension of the n-gram at each byte."""
    wide = low.astype(np.uint32)
    out, have = [low.astype(np.int32)], wide
    for n, size in ((2, SIZES[1]), (3, SIZES[2])):
        have = (have[:-1] * np.uint32(0x01000193)) ^ wide[n - 1 :] if len(have) > 1 else have[:0]
        out.append(((have * np.uint32(0x9E3779B1)) >> np.uint32(32 - size.bit_length() + 1)).astype(np.int32))
    return out


def _has_letter(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    counts = np.zeros(len(data) + 1, np.int64)
    np.cumsum(LETTER[data], out=counts[1:])
    out = counts[offs[1:]] > counts[offs[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offs) > 0)):  # letters beyond ASCII
        out[i] = any(c.isalpha() for c in data[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def _features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Shares of n-grams: a row of DIMS floats for each text."""
    low = B.LOWER[data]
    out = np.zeros((len(offs) - 1, DIMS), np.float32)
    indexes = _indexes(low)
    for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
        at = 0
        for n, size in enumerate(SIZES):
            if (upto := b - n) > a:
                out[i, at : at + size] = np.bincount(indexes[n][a:upto], minlength=size) / (upto - a)
            at += size
    return out


def _margins(data: np.ndarray, offs: np.ndarray, weights: np.ndarray, biases: np.ndarray) -> np.ndarray:
    """weights @ features + biases for each text, without making the features."""
    out = np.tile(biases, (len(offs) - 1, 1))
    at = 0
    for n, (size, index) in enumerate(zip(SIZES, _indexes(B.LOWER[data]), strict=True)):
        grams = np.maximum(0, np.diff(offs) - n)
        for c in range(len(weights)):
            sums = np.zeros(len(index) + 1)
            np.cumsum(weights[c, at : at + size][index], out=sums[1:])
            begin = np.minimum(offs[:-1], len(index))
            end = np.maximum(begin, np.minimum(offs[1:] - n, len(index)))
            out[:, c] += np.where(grams > 0, (sums[end] - sums[begin]) / np.maximum(1, grams), 0)
        at += size
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 0.05, epochs: int = 12) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for a linear SVM with hinge loss; y is 1 or -1, columns are standardised meanwhile."""
    mean, dev = x.mean(0), x.std(0) + 1e-4
    z = np.hstack([(x - mean) / dev / np.sqrt(x.shape[1]), np.ones((len(x), 1), np.float32)]).astype(np.float32)
    norm, alpha, w = (z * z).sum(1), np.zeros(len(z)), np.zeros(z.shape[1], np.float32)
    balance = {s: c * len(y) / (2 * max(1, (y == s).sum())) * 20 for s in (1, -1)}
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(z)):
            new = min(max(alpha[i] - (y[i] * float(w @ z[i]) - 1) / norm[i], 0.0), balance[y[i]])
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * z[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    folded = w[:-1] / dev / np.sqrt(x.shape[1])
    return folded.astype(np.float64), float(w[-1] - folded @ mean)


class Model:
    """Families, their languages, and the weights of each pair at both levels."""

    def __init__(self, families: dict[str, list[str]]):
        self.families = {k: sorted(v) for k, v in sorted(families.items())}
        self.levels: dict[str | None, tuple[list[str], list[tuple[int, int]], np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, levels: dict[str | None, tuple[list[str], np.ndarray, np.ndarray]]) -> Model:
        """The model of fitted levels: None is that of the families, the others are named by their family."""
        model = cls({family: names for family, (names, _, _) in levels.items() if family is not None})
        model.levels = {key: (names, list(combinations(range(len(names)), 2)), w, b) for key, (names, w, b) in levels.items()}
        return model

    def fit(self, x: np.ndarray, labels: np.ndarray) -> Model:
        of = {lang: fam for fam, langs in self.families.items() for lang in langs}
        group = np.array([of[v] for v in labels])
        for key, names, values in ((None, list(self.families), group), *((f, langs, labels) for f, langs in self.families.items())):
            pairs = list(combinations(range(len(names)), 2))
            w, b = np.zeros((len(pairs), DIMS)), np.zeros(len(pairs))
            for i, (p, q) in enumerate(pairs):
                rows = np.flatnonzero((values == names[p]) | (values == names[q]))
                w[i], b[i] = fit_svm(x[rows], np.where(values[rows] == names[p], 1, -1))
            self.levels[key] = (names, pairs, w, b)
        return self

    def _decide(self, key: str | None, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names, pairs, w, b = self.levels[key]
        n = len(offs) - 1
        if len(names) == 1:
            return np.zeros(n, int), np.ones(n)
        margins = _margins(data, offs, w, b)
        votes, sums = np.zeros((n, len(names))), np.zeros((n, len(names)))
        worst = np.full((n, len(names)), np.inf)
        for i, (p, q) in enumerate(pairs):
            for at, sign in ((p, 1), (q, -1)):
                votes[:, at] += sign * margins[:, i] > 0
                sums[:, at] += sign * margins[:, i]
                worst[:, at] = np.minimum(worst[:, at], sign * margins[:, i])
        best = np.argmax(votes * 1e6 + np.clip(sums, -1e5, 1e5), axis=1)
        return best, 1 / (1 + np.exp(-3 * np.clip(worst[np.arange(n), best], -50, 50)))

    def predict(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(offs) - 1
        lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
        known = _has_letter(data, offs)
        if not self.families or not known.any():
            return lang, score
        family, sure = self._decide(None, data, offs)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(known & (family == f))
            if not len(rows):
                continue
            if len(self.families[name]) == 1:
                best, inner = np.zeros(len(rows), int), np.ones(len(rows))
            else:
                sizes = np.diff(offs)[rows]
                part = np.concatenate([[0], np.cumsum(sizes)])
                mine = data[np.repeat(offs[rows] - part[:-1], sizes) + np.arange(part[-1])] if len(rows) < n else data
                best, inner = self._decide(name, mine, part if len(rows) < n else offs)
            lang[rows] = np.array(self.families[name], object)[best]
            score[rows] = sure[rows] * inner
        return lang, score


def train(
    labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = 800, sample: int = 3200, families: dict[str, str] | None = None,
) -> Model:
    """Fit on the bounded sample described above; labelled: rows that may be learned from."""
    families = FAMILIES if families is None else families
    B.small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Model({})
    each = max(2, min(per_language, sample // len(counts)))
    top = 1 << 30
    limit = F.lit(0)
    for lang, n in counts.items():  # about a fifth more than are kept
        limit = F.when(F.col(lang_col) == lang, F.lit(int(min(1.0, (1.2 * each + 30) / n) * top))).otherwise(limit)
    order = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(top))
    picked = rows.select(order.alias("key"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text")).where(F.col("key") <= limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = B.text_bytes(batch.column(2))
            for a, b in B.pieces(offs):
                part = data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
                made = [x.tobytes() for x in _features(*part)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(_has_letter(*part)), pa.array(made, pa.binary())], ["key", "lang", "ok", "x"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(batches, pa.schema([("key", pa.int64()), ("lang", pa.string()), ("x", pa.binary())])).to_pandas()
        got = got.sort_values(["lang", "key", "x"]).groupby("lang").head(each)
        if got.empty:
            return
        grouped: dict[str, list[str]] = {}
        for lang in sorted(got["lang"].unique()):
            grouped.setdefault(families.get(lang, lang), []).append(lang)
        x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(len(got), DIMS)
        model = Model(grouped).fit(x, got["lang"].to_numpy())
        for key, (names, _, w, b) in model.levels.items():
            columns = [pa.array([key], pa.string()), pa.array([names], pa.list_(pa.string())), pa.array([w.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["family", "names", "w", "b"])

    # the sample is bounded, so one task can hold it; the driver gets the weights only
    made = picked.mapInArrow(run, "key long, lang string, ok boolean, x binary").where("ok").select("key", "lang", "x")
    levels = made.repartition(1).mapInArrow(fit, "family string, names array<string>, w binary, b binary").collect()
    return Model.of({r["family"]: (list(r["names"]), np.frombuffer(r["w"]).reshape(len(r["b"]) // 8, DIMS), np.frombuffer(r["b"])) for r in levels})


def predict(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs, whatever they are, with lang_pred and score."""
    spark = docs.sparkSession
    B.small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a few kilobytes for each pair of languages of a family
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = B.text_bytes(batch.column(batch.num_columns - 1))
            for a, b in B.pieces(offs):
                lang, score = shared.value.predict(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                own = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(lang, pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text")).mapInArrow(run, schema)


def held_out(doc_id: Column, mod: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == remainder, F.lit(False))
