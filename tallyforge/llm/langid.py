"""Language identification by hierarchical discrimination.

Byte n-grams of the whole text are hashed to relative frequencies. A multinomial linear
classifier first tells the language family; one-versus-one linear support vector machines then
separate the languages within it by votes.

Fitted on a bounded sample of labelled rows (about ``EACH`` for each language), applied to all. Of more
than ``LANGS`` labels, as dirty data have, the most frequent are learned, ties by name; the others'
rows are not, and their texts get the learned language that is most like them.

Edge cases: a null text or one without letters is ``und`` with score 0. Without any labelled row
all rows are ``und``. A language without a known family is a family of its own. A text's prediction
depends on that text alone, not on the rows beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, fitting, hashing

#: Labelled rows used of each language, and of all languages, at most about.
EACH, MOST = 500, 8000
#: Languages that are learned, the most frequent ones, at most; every pair of a family's has a machine.
LANGS = 32
ORDERS = (1, 2, 3)
SLOTS = 1 << 13
UNKNOWN = "und"
#: ``accepted`` rejects texts whose language has a lower score.
SURE = 0.5
#: Languages by family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "finnic": ("et", "fi"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("bn", "hi", "mr", "ne", "pa", "ur"),
}


def family(lang: str) -> str:
    return next((f for f, of in FAMILIES.items() if lang in of), lang)


def _slots(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram slots by order, each as long as the joined bytes; where each text begins).

    Each text ends with a line break. n-grams that would go on into the next text get the slot ``SLOTS``,
    which counts for nothing, so that a text's slots are the same whatever stands beside it.
    """
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    ends = np.cumsum(size)
    a = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8).astype(np.uint32)
    out, code, more = [], np.zeros(len(a), np.uint32), np.concatenate((a, np.zeros(max(ORDERS), np.uint32)))
    for n in range(1, max(ORDERS) + 1):
        code = (code << np.uint32(8)) | more[n - 1 : n - 1 + len(a)]
        if n in ORDERS:
            mixed = (code + np.uint32(n << 26)) * np.uint32(2654435761)
            out.append((mixed >> np.uint32(32 - SLOTS.bit_length() + 1)).astype(np.int32))
            for k in range(1, n):
                out[-1][np.maximum(ends - k, 0)] = SLOTS
    return np.stack(out), np.concatenate(([0], ends))


@dataclass
class Model:
    """Weights by slot, zeros at the last; columns are the families and then the pairs of languages."""

    families: list[str]
    members: list[list[str]]
    pairs: list[list[tuple[int, int]]]
    weights: np.ndarray
    bias: np.ndarray

    def margins(self, texts: list[bytes]) -> np.ndarray:
        slots, begin = _slots(texts)
        total = np.zeros((len(texts), self.weights.shape[1]))
        for row in slots:
            for c in range(self.weights.shape[1]):
                total[:, c] += np.add.reduceat(self.weights[:, c][row], begin[:-1])
        return total / (np.diff(begin) * len(ORDERS))[:, None] + self.bias

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        z = self.margins(texts)
        k = len(self.families)
        e = np.exp(z[:, :k] - z[:, :k].max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        best = p.argmax(1)
        lang, score = [""] * len(texts), p.max(1)
        column = k
        for f in range(k):
            rows = np.flatnonzero(best == f)
            votes = np.zeros((len(rows), len(self.members[f])))
            for a, b in self.pairs[f]:
                sure = 1 / (1 + np.exp(-2 * z[rows, column]))
                votes[:, a] += sure
                votes[:, b] += 1 - sure
                column += 1
            won = votes.argmax(1)
            for r, w in zip(rows.tolist(), won.tolist(), strict=True):
                lang[r] = self.members[f][w]
            if self.pairs[f]:
                score[rows] *= votes.max(1) / (len(self.members[f]) - 1)
        return lang, np.clip(score, 0, 1)


def _frequencies(f: pd.DataFrame) -> Iterator[np.ndarray]:
    for part in hashing.chunks(f["text"].tolist()):
        slots, begin = _slots(part)
        for a, b in zip(begin[:-1], begin[1:], strict=True):
            yield np.bincount(slots[:, a:b].ravel(), minlength=SLOTS + 1)[:SLOTS] / (slots.shape[0] * (b - a))


def fit(labelled: DataFrame, each: int = EACH) -> Model | None:
    """A model from labelled (doc_id, text, lang); null texts and langs are left out."""
    rows = common.pick(labelled, "doc_id", "text", "lang").where("text is not null and lang is not null")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [(v := x.astype(np.float32), np.flatnonzero(v)) for x in _frequencies(f)]
            yield pd.DataFrame({"lang": f["lang"], "slot": [k.astype(np.int32) for _, k in got], "value": [v[k] for v, k in got]})

    rows, _ = fitting.thinned(rows, "lang", "doc_id", each, MOST, LANGS)
    seen = rows.select("text", "lang").mapInPandas(run, "lang string, slot array<int>, value array<float>").toPandas()
    if not len(seen):
        return None
    x = np.zeros((len(seen), SLOTS), np.float32)
    for i, (s, v) in enumerate(zip(seen["slot"], seen["value"], strict=True)):
        x[i, s] = v
    lang = seen["lang"].to_numpy()
    del seen
    mean = x.mean(0)
    scale = 1 / (np.sqrt(mean) + 1e-3)
    # In place: the sample is the largest thing in the driver's memory.
    x -= mean
    x *= scale
    of = np.array([family(v) for v in lang])
    families = sorted(set(of))
    members = [sorted(set(lang[of == f])) for f in families]
    pairs = [list(combinations(range(len(m)), 2)) for m in members]

    y = (of[:, None] == np.array(families)).astype(np.float32)
    y /= y.sum(0)  # families weigh the same

    def softmax(w: np.ndarray, _: int) -> np.ndarray:
        z = x @ w[:-1].astype(np.float32) + w[-1]
        e = np.exp(z - z.max(1, keepdims=True))
        d = e / e.sum(1, keepdims=True) * y.sum(1, keepdims=True) - y
        return np.concatenate((x.T @ d.astype(np.float32) + 1e-4 * w[:-1], d.sum(0, keepdims=True)))

    columns = [fitting.adam(np.zeros((SLOTS + 1, len(families))), softmax, 150, 0.05)]
    for m, of_family in zip(members, pairs, strict=True):
        for a, b in of_family:
            rows_ab = np.flatnonzero((lang == m[a]) | (lang == m[b]))
            xa, sign = x[rows_ab], np.where(lang[rows_ab] == m[a], 1.0, -1.0)
            each_side = np.where(sign > 0, 0.5 / (sign > 0).sum(), 0.5 / (sign < 0).sum())

            def hinge(w: np.ndarray, _: int, xa=xa, sign=sign, each_side=each_side) -> np.ndarray:
                gap = np.maximum(0, 1 - sign * (xa @ w[:-1].astype(np.float32) + w[-1]))
                d = -2 * each_side * sign * gap
                return np.concatenate((xa.T @ d.astype(np.float32) + 1e-4 * w[:-1], [d.sum()]))

            columns.append(fitting.adam(np.zeros(SLOTS + 1), hinge, 150, 0.02)[:, None])
    w = np.concatenate(columns, 1)
    weights = w[:-1] * scale[:, None]
    return Model(families, members, pairs, np.concatenate((weights, np.zeros((1, w.shape[1])))).astype(np.float32), w[-1] - mean @ weights)


def predict(docs: DataFrame, model: Model | None, unmodelled: str = UNKNOWN) -> DataFrame:
    """docs with the columns lang_pred and score added; docs needs the column text.

    unmodelled: what texts with letters get where there is no model.
    """
    have = docs.columns
    at = have.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            lang: list[str] = []
            score: list[float] = []
            for part in hashing.chunks(texts) if model else ():
                a, b = model.predict(part)
                lang += a
                score += b.tolist()
            if not model:
                lang, score = [unmodelled] * len(texts), [0.0] * len(texts)
            for i, t in enumerate(texts):
                if not t or not any(map(str.isalpha, t)):
                    lang[i], score[i] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    plain = docs.toDF(*[f"c{i}" for i in range(len(have))])
    kinds = ", ".join(f"{n} {k}" for n, k in plain.dtypes)
    return plain.mapInArrow(run, f"{kinds}, lang_pred string, score double").toDF(*have, "lang_pred", "score")


def fitted(docs: DataFrame, each: int = EACH) -> Model | None:
    """A model from the rows of docs whose crc32(doc_id) modulo 3 is not 1."""
    rows = common.pick(docs, "doc_id", "text", "lang")
    return fit(rows.where(fitting.remainder(F.col("doc_id"), 3) != 1), each)


def accepted(docs: DataFrame, least: float = SURE) -> DataFrame:
    """The rows of docs with a recognised language, all columns as they were.

    ``und`` rows go, and those whose predicted language has a score under ``least``: texts that the
    classifier can give to no family or language with confidence. Without labelled rows to fit a model
    from, all texts with letters stay.
    """
    if not docs.columns:
        return docs
    have = docs.columns
    model = fitted(docs)
    got = predict(docs, model, unmodelled="any").toDF(*[f"c{i}" for i in range(len(have))], "lang_pred", "score")
    sure = F.col("score") >= least if model else F.lit(True)
    return got.where((F.col("lang_pred") != UNKNOWN) & sure).drop("lang_pred", "score").toDF(*have)
