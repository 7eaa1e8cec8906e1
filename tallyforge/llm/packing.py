"""Vector bin packing of examples into sequences by the dot-product heuristic.

A sequence has simultaneous limits on tokens, segments and loss-bearing tokens. An open
sequence repeatedly takes the example that fits and whose demand has the largest weighted dot
product with what is still free; weights are the total demand by limit. If cutting is allowed,
free space beyond ``WASTE`` is filled with the beginning of an example that does not fit.

Packing runs inside the tasks that read the input, in blocks of bounded size, and needs no
shuffle; a block's unfilled sequences are dealt out to lengths that are powers of two, which
need no padding. Sequence ids hold the partition's number and a counter.

Edge cases: null text counts as empty; an empty document is its end token alone. Rows with
the same doc_id are packed as separate documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common, words

END_ID = 1
#: A sequence with no more free tokens than this is closed as it is.
WASTE = 16
BLOCK_DOCS, BLOCK_TOKENS = 1024, 1 << 21
_STEP = 1 << 20


@dataclass(frozen=True)
class Limits:
    """Most tokens, segments and loss-bearing tokens of one sequence."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


def fill(tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool) -> list[list[tuple[int, int]]]:
    """Sequences as lists of (example, tokens taken of it), an example's tokens in order.

    With ``cut``, an example may be split; its first token in each piece bears no loss. Without
    it, an example beyond a limit raises ValueError.
    """
    t, bears = tokens.astype(np.int64), loss.astype(np.int64)
    if not cut and len(t) and (t.max() > limits.tokens or bears.max() > limits.loss or limits.segments < 1):
        raise ValueError("an example is larger than a sequence")
    which = np.argsort(-t, kind="stable")
    t, bears = t[which], bears[which]
    cap = np.array([limits.tokens, limits.segments, limits.loss], float)
    weight = np.array([t.sum(), len(t), bears.sum()]) / cap / cap  # total demand, in units of a sequence
    out = []
    while len(t):
        free = [limits.tokens, limits.segments, limits.loss]
        got: list[tuple[int, int]] = []
        alive = np.ones(len(t), bool)
        while free[1]:
            fits = alive & (t <= free[0]) & (bears <= free[2])
            score = np.where(fits, t * (weight[0] * free[0]) + bears * (weight[2] * free[2]), -1.0)
            k = int(score.argmax())
            if score[k] < 0:
                break
            got.append((int(which[k]), int(t[k])))
            alive[k] = False
            free = [free[0] - int(t[k]), free[1] - 1, free[2] - int(bears[k])]
        if cut and free[1] and free[0] > WASTE and free[2] > WASTE and alive.any():
            k = int(np.flatnonzero(alive)[t[alive].argmax()])
            if (n := min(free[0], free[2] + 1, int(t[k]) - 1)) > 0:
                got.append((int(which[k]), n))
                t[k] -= n
                bears[k] = min(bears[k], t[k] - 1)
        out.append(got)
        t, bears, which = t[alive], bears[alive], which[alive]
    return out


def binary(pieces: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """One sequence's pieces dealt out to sequences whose lengths are powers of two."""
    left, out = sum(n for _, n in pieces), []
    pieces = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out.append([])
        while room:
            k, n = pieces.pop()
            out[-1].append((k, take := min(n, room)))
            room -= take
            if n > take:
                pieces.append((k, n - take))
    return out


def _block(ids: np.ndarray, begin: np.ndarray, limits: Limits) -> tuple[np.ndarray, ...]:
    """(document, start, length, crc32, sequence, offset) of the pieces of a block of documents."""
    size = np.diff(begin)
    whole = min(limits.tokens, limits.loss + 1)
    rest = size % whole
    some = np.flatnonzero(rest)
    rows: list[tuple[int, int, int, int, int]] = []
    at = np.zeros(len(size), np.int64)
    seq = 0
    for d in np.flatnonzero(size >= whole).tolist():
        for s in range(0, int(size[d] - rest[d]), whole):
            rows.append((d, s, whole, seq, 0))
            seq += 1
        at[d] = size[d] - rest[d]
    for pieces in fill(rest[some], rest[some] - 1, limits, True):
        used = sum(n for _, n in pieces)
        for part in [pieces] if limits.tokens - used <= WASTE else binary(pieces):
            offset = 0
            for k, n in part:
                d = int(some[k])
                rows.append((d, int(at[d]), n, seq, offset))
                at[d] += n
                offset += n
            seq += 1
    doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True))
    raw = memoryview(ids.astype("<u4").tobytes())
    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((begin[doc] + start).tolist(), (begin[doc] + start + length).tolist(), strict=True)]
    return doc, start, length, np.array(crc, np.int64), sequence, offset


def pack_documents(docs: DataFrame, vocabulary: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """The pieces of docs (doc_id, text): ids of the vocabulary, then the end id, packed.

    Returns (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).
    """
    path = vocabulary or words.default_path()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = words.encoder(path).encode
        first = TaskContext.get().partitionId() << 40
        keys: list = []
        held: list[np.ndarray] = []
        total = 0

        def packed() -> pd.DataFrame:
            nonlocal first, total
            begin = np.concatenate(([0], np.cumsum([len(x) for x in held])))
            doc, start, length, crc, sequence, offset = _block(np.concatenate(held), begin, limits)
            key = pd.Series(keys, dtype=object).iloc[doc].to_numpy()
            out = pd.DataFrame({"doc_id": key, "start": start, "length": length, "ids_crc32": crc, "doc_tokens": np.diff(begin)[doc], "sequence_id": first + sequence, "offset": offset})
            first += int(sequence.max()) + 1
            keys.clear()
            held.clear()
            total = 0
            return out

        for f in frames:
            texts = f["text"].tolist()
            ids_of = f["doc_id"].tolist()
            i = 0
            while i < len(texts):
                j, n = i, 0
                while j < len(texts) and (n == 0 or n < _STEP):
                    n += len(texts[j] or "") + 1
                    j += 1
                ids, to = encode([t or "" for t in texts[i:j]])
                for k in range(j - i):
                    held.append(np.append(ids[to[k] : to[k + 1]], np.uint32(END_ID)))
                    keys.append(ids_of[i + k])
                    total += len(held[-1])
                    if len(held) >= BLOCK_DOCS or total >= BLOCK_TOKENS:
                        yield packed()
                i = j
        if held:
            yield packed()

    return common.mapped(common.pick(docs, "doc_id", "text"), run, "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_examples(examples: DataFrame, tokens: str, loss: str, limits: Limits = Limits()) -> DataFrame:
    """Uncut examples with the columns sequence_id, offset and segment added; all columns stay, those of
    the same names too.

    Null counts are 0. An example beyond a limit raises ValueError.
    """
    have = examples.columns
    size_at, loss_at = have.index(tokens), have.index(loss)

    def counts(batch: pa.RecordBatch, at: int) -> np.ndarray:
        return pc.fill_null(batch.column(at).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(i, BLOCK_DOCS)
                place = np.zeros((part.num_rows, 3), np.int64)
                seqs = fill(counts(part, size_at), counts(part, loss_at), limits, False)
                for s, pieces in enumerate(seqs):
                    offset = 0
                    for segment, (k, n) in enumerate(pieces):
                        place[k] = first + s, offset, segment
                        offset += n
                first += len(seqs)
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, place.T)], [*part.schema.names, "sequence_id", "offset", "segment"])

    plain = examples.toDF(*[f"c{i}" for i in range(len(have))])
    kinds = ", ".join(f"{n} {k}" for n, k in plain.dtypes)
    return plain.mapInArrow(run, f"{kinds}, sequence_id long, offset long, segment long").toDF(*have, "sequence_id", "offset", "segment")
