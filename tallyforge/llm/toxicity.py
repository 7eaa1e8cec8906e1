"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is the logistic of the summed weights
of its distinct words, stems (the first ``STEMS`` bytes of longer words) and pairs of neighbouring
words, which are never negative; the document's is their noisy-or, 1 - product of (1 - p). Only document labels are known;
their likelihood under the noisy-or trains the weights, and the fitted sentence scores then locate
the offending sentences.

Fitted on a bounded sample of labelled rows (about ``EACH`` for each label, and fewer where their slots
are more than ``MOST_SLOTS``), applied to all.

Edge cases: null and empty texts have no sentence and the score of an empty bag, 0. Labels that
are null are left out; contradicting labels of a document count as toxic. Without both labels
every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, fitting, hashing

#: Labelled rows used of each label, at most about.
EACH = 2000
#: Slots of a sample's sentences that come to the driver, at most about; a larger document comes alone.
MOST_SLOTS = 1 << 23
SLOTS = 1 << 20
#: Bytes of a stem.
STEMS = (4, 6)
#: Slots get a weight if they are in so many sampled documents and in so many times the share of toxic
#: documents as of others.
LEAST_DOCS, LIFT = 5, 1.5
STEPS, RATE = 120, 0.15
#: Weights of the sum of weights in the loss when selecting, tried on a part of the sample held back,
#: and the least weight that is then kept.
L1, LEAST = (1e-3, 3e-4, 1e-4, 3e-5), 0.5
#: One of so many sampled rows is held back.
HELD_BACK = 5
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


def _new(x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    out[1:] = x[1:] != x[:-1]
    return out


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slots of each sentence's distinct words, stems and pairs, the first of each sentence, the first sentence
    of each text (one more at the end), and each sentence's first byte in the joined texts.
    Sentences without words don't count."""
    a, start, end, first, hashed = hashing.cut(texts, hashing.NO_LETTER)
    number = np.cumsum(_END[a], dtype=np.int64)
    word, at = hashed(start, end), number[start]
    both = [at * SLOTS + (word % np.uint64(SLOTS)).astype(np.int64)]
    begin = np.flatnonzero(_new(at))
    near = np.flatnonzero(~_new(at))  # words with one before them in the sentence
    pair = hashing.mix(word[near - 1] ^ (word[near] << np.uint64(1) | word[near] >> np.uint64(63)))
    both.append(at[near] * SLOTS + (pair % np.uint64(SLOTS)).astype(np.int64))
    for k in STEMS:
        some = start[end - start > k]
        both.append(number[some] * SLOTS + ((hashed(some, some + k) >> np.uint64(k)) % np.uint64(SLOTS)).astype(np.int64))
    both = np.sort(np.concatenate(both))
    both = both[_new(both)]
    return (both % SLOTS).astype(np.int32), np.flatnonzero(_new(both // SLOTS)), np.searchsorted(begin, first), start[begin]


def noisy_or(weights: np.ndarray, bias: float, slot: np.ndarray, begin: np.ndarray, bag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each sentence, and of each text."""
    z = np.add.reduceat(weights[slot], begin) + bias if len(begin) else np.zeros(0)
    # Minus the log of no toxic sentence, each text summed by itself.
    none = np.bincount(np.repeat(np.arange(len(bag) - 1), np.diff(bag)), np.logaddexp(0, z), len(bag) - 1)
    return 1 / (1 + np.exp(-np.clip(z, -40, 40))), -np.expm1(-none)


@dataclass
class Bags:
    """Sampled documents: word (numbered 0 ..) and sentence of each word of a sentence, document of each sentence."""

    toxic: np.ndarray
    word: np.ndarray
    sentence: np.ndarray
    doc: np.ndarray
    words: int

    def some(self, rows: np.ndarray) -> Bags:
        """Only these documents (a mask)."""
        held = rows[self.doc]
        inside = held[self.sentence]
        return Bags(self.toxic[rows], self.word[inside], (np.cumsum(held) - 1)[self.sentence[inside]], (np.cumsum(rows) - 1)[self.doc[held]], self.words)

    def logits(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logit of each sentence and minus the log of no toxic sentence of each document; w ends with the bias."""
        z = np.bincount(self.sentence, w[self.word], len(self.doc)) + w[-1]
        return z, np.bincount(self.doc, np.logaddexp(0, z), len(self.toxic))

    def loss(self, w: np.ndarray, share: float) -> float:
        none = self.logits(w)[1]
        each = np.where(self.toxic, -np.log(np.maximum(-np.expm1(-none), 1e-9)), none)
        return share * each[self.toxic].mean() + (1 - share) * each[~self.toxic].mean()

    def trained(self, w: np.ndarray, free: np.ndarray, share: float, l1: float) -> np.ndarray:
        """Weights (free ones) and bias after descent, where toxic documents weigh ``share`` of all."""
        weigh = np.where(self.toxic, share / self.toxic.sum(), (1 - share) / (~self.toxic).sum())[self.doc]

        def gradient(w: np.ndarray, _: int) -> np.ndarray:
            w = np.append(np.maximum(w[:-1], 0), w[-1])
            z, none = self.logits(w)
            some = -np.expm1(-none)
            d = np.where(self.toxic[self.doc], -((1 - some) / np.maximum(some, 1e-9))[self.doc], 1.0) * weigh / (1 + np.exp(-z))
            g = np.append(np.bincount(self.word, d[self.sentence], self.words), d.sum())
            g[:-1] = np.where(free & ((w[:-1] > 0) | (g[:-1] < -l1)), g[:-1] + l1, 0)
            return g

        w = fitting.adam(w, gradient, STEPS, RATE)
        return np.append(np.maximum(w[:-1], 0) * free, w[-1])

    def fitted(self, share: float, l1: float) -> np.ndarray:
        """A first pass, with both labels weighing the same, selects words; a second fits their weights, and
        the bias, with the labels weighing as in all rows."""
        w = self.trained(np.append(np.zeros(self.words), -5.0), np.ones(self.words, bool), 0.5, l1)
        return self.trained(w, w[:-1] >= LEAST, share, 0.0)


def trained(toxic: np.ndarray, slots: list[np.ndarray], begins: list[np.ndarray], share: float) -> tuple[np.ndarray, float]:
    """Slot weights and bias from sampled documents: the slots of each, and where its sentences begin in them."""
    docs = np.zeros((2, SLOTS))
    for t, s in zip(toxic, slots, strict=True):
        docs[int(t), np.unique(s)] += 1
    used = np.flatnonzero((docs.sum(0) >= LEAST_DOCS) & (docs[1] / toxic.sum() >= LIFT * docs[0] / (~toxic).sum()))
    place = np.full(SLOTS, -1)
    place[used] = np.arange(len(used))
    # Document by document, so that only slots with a weight are ever side by side.
    word, sentence, number = [], [], 0
    for s, b in zip(slots, begins, strict=True):
        at = place[s]
        word.append(at[at >= 0])
        sentence.append(np.repeat(np.arange(number, number + len(b)), np.diff(np.append(b, len(s))))[at >= 0])
        number += len(b)
    doc = np.repeat(np.arange(len(slots)), [len(b) for b in begins])
    all_ = Bags(toxic, np.concatenate(word), np.concatenate(sentence), doc, len(used))
    back = np.arange(len(toxic)) % HELD_BACK == 0
    l1 = L1[0]
    if all(len(set(toxic[rows])) == 2 for rows in (back, ~back)):
        most, least = all_.some(~back), all_.some(back)
        l1 = min(L1, key=lambda v: least.loss(most.fitted(share, v), share))
    w = all_.fitted(share, l1)
    weights = np.zeros(SLOTS, np.float32)
    weights[used] = w[:-1]
    return weights, float(w[-1])


def fit(labelled: DataFrame, share: float) -> tuple[np.ndarray, float] | None:
    """Slot weights and bias from a bounded sample (text, toxic 0/1) of rows that are toxic by share."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for part in hashing.chunks(f["text"].tolist()):
                slot, begin, bag, _ = bags(part)
                begin = np.append(begin, len(slot))
                for s, e in zip(bag[:-1], bag[1:], strict=True):
                    rows.append((slot[begin[s] : begin[e]], (begin[s:e] - begin[s]).astype(np.int32)))
            yield pd.DataFrame({"at": f["at"], "toxic": f["toxic"], "slot": [r[0] for r in rows], "begin": [r[1] for r in rows]})

    at = F.xxhash64("doc_id", F.lit("held back")).alias("at")
    with common.scratch(labelled.sparkSession):
        held = common.stored(labelled.select(at, "text", "toxic").mapInPandas(run, "at long, toxic int, slot array<int>, begin array<int>"), "bags")
        total = held.agg(F.sum(F.size("slot"))).first()[0] or 0
        few = held.where(F.pmod(F.xxhash64("at"), F.lit(1 << 20)) < F.lit((1 << 20) * min(1.0, MOST_SLOTS / max(total, 1))))
        seen = few.toPandas()
    seen = seen[seen["slot"].map(len) > 0].sort_values("at", kind="stable")
    toxic = seen["toxic"].to_numpy() > 0
    if not 0 < toxic.sum() < len(toxic):
        return None
    return trained(toxic, seen["slot"].to_list(), seen["begin"].to_list(), share)


def score(docs: DataFrame, model: tuple[np.ndarray, float] | None) -> DataFrame:
    """(doc_id, score, sentence_start, sentence_end, sentence_score) of every row of docs.

    The sentence is the most offending one, as byte offsets of the text's UTF-8; null without any.
    """
    weights, bias = model or (np.zeros(SLOTS, np.float32), -np.inf)
    sent = docs.sparkSession.sparkContext.broadcast((np.flatnonzero(weights), weights[weights != 0]))
    known = model is not None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = np.zeros(SLOTS)
        w[sent.value[0]] = sent.value[1]
        for f in frames:
            total, start, end, top = [], [], [], []
            for part in hashing.chunks(f["text"].tolist()):
                slot, begin, bag, at = bags(part)
                p, all_ = noisy_or(w, bias if known else -40.0, slot, begin, bag)
                total.append(all_ if known else np.zeros(len(part)))
                size = np.cumsum([0, *(len(t) + 1 for t in part)])
                stop = np.append(at, size[-1])
                for k in range(len(part)):
                    s, e = bag[k], bag[k + 1]
                    if e > s:
                        i = s + int(p[s:e].argmax())
                        start.append(int(at[i] - size[k]))
                        end.append(int(min(stop[i + 1], size[k + 1] - 1) - size[k]))
                        top.append(float(p[i]) if known else 0.0)
                    else:
                        start.append(None)
                        end.append(None)
                        top.append(None)
            yield pd.DataFrame(
                {"doc_id": f["doc_id"], "score": np.concatenate(total) if total else [], "sentence_start": pd.array(start, "Int64"), "sentence_end": pd.array(end, "Int64"), "sentence_score": pd.array(top, "Float64")}
            )

    schema = "score double, sentence_start long, sentence_end long, sentence_score double"
    return common.mapped(common.pick(docs, "doc_id", "text"), run, schema)


def fitted(docs: DataFrame, labels: DataFrame, each: int = EACH) -> tuple[np.ndarray, float] | None:
    """A model from labels (doc_id, toxic) whose crc32(doc_id) modulo 5 is not 0."""
    known = common.pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(fitting.remainder(F.col("doc_id"), 5) != 0)
    # At most about 2 * each ids, whatever the size of the input.
    known, counts = fitting.thinned(known, "toxic", "doc_id", each)
    if len(counts) < 2:
        return None
    return fit(common.pick(docs, "doc_id", "text").join(F.broadcast(known), "doc_id"), counts[1] / sum(counts.values()))
