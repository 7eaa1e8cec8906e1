"""Token counts by offset-mapped attribution.

A document's fields are rendered into one text, which is encoded once as a whole. The tokens'
spans are then joined to the spans of the sections (fields, or the lines of a field), and a token
that crosses a boundary is given out by an explicit rule:

- ``start``: to the section that holds its first byte,
- ``most``: to the section that holds most of its bytes, ties to the earlier one,
- ``share``: to each section by its share of the bytes (counts are then fractions).

The sections' counts add up to the document's tokens under each rule.

Edge cases: null fields count as empty and have no tokens. Each empty field still has its row. Runs of
white space too long for the vocabulary's pattern are cut where that pattern would cut them.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RULES = ("start", "most", "share")
SEPARATOR = "\n"
#: Longer runs of white space overflow the pattern's matcher. What that pattern takes for white space.
_RUN = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{10000,}")
_STEP = 1 << 19


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Lengths:
    """Byte lengths of the tokens of whole texts."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, np.uint32)
        for token, i in ranks.items():
            self.size[i] = len(token)

    def ids(self, text: str) -> list[int]:
        """The tokens of a text.

        The pattern takes a run of white space as one piece, but for its last character where something follows.
        """
        out, at = [], 0
        for run in _RUN.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += self.encoding.encode_ordinary(text[at : run.start()])
            out += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        return out + self.encoding.encode_ordinary(text[at:]) if at else self.encoding.encode_ordinary(text)

    def spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token lengths of all texts, and where each text's tokens begin (one more at the end)."""
        ids = [self.ids(t) for t in texts]
        to = np.concatenate(([0], np.cumsum([len(i) for i in ids])))
        return self.size[np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(to[-1]))], to


@functools.lru_cache(2)
def lengths(path: str) -> Lengths:
    return Lengths(path)


def allocate(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each section, tokens that cross the section's end); ends are byte offsets."""
    starts = np.concatenate(([0], token_ends[:-1]))
    n = len(section_ends)
    first = np.searchsorted(section_ends, starts, "right")
    last = np.searchsorted(section_ends, token_ends, "left")
    crossing = np.bincount(first[last > first], minlength=n)[:n]
    counts = np.bincount(first[last == first], minlength=n).astype(float)
    for t in np.flatnonzero(last > first).tolist():
        over = np.arange(first[t], last[t] + 1)
        edges = np.concatenate(([starts[t]], np.minimum(section_ends[over], token_ends[t])))
        held = np.diff(edges)
        if rule == "start":
            counts[over[0]] += 1
        elif rule == "most":
            counts[over[held.argmax()]] += 1
        else:
            counts[over] += held / held.sum()
    return counts, crossing


def attribute(rows: DataFrame, key: str, fields: list[str], by_line: tuple[str, ...] = (), rule: str = "start", vocabulary: str | None = None) -> DataFrame:
    """(key, section, field, start, end, n_tokens, n_crossing) of every row's sections.

    Fields are rendered in order with a line break between them, which belongs to the field before
    it. Fields in ``by_line`` make one section of each line, its line break included. start and end
    are code points of the rendered text; n_crossing counts the tokens that go on beyond the end.
    """
    if rule not in RULES:
        raise ValueError(rule)
    path = vocabulary or default_path()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spans = lengths(path).spans
        for f in frames:
            values = list(zip(*(f[c].tolist() for c in fields), strict=True))
            keys = f[key].tolist()
            i = 0
            while i < len(values):
                texts, parts, ids, n = [], [], [], 0
                while i < len(values) and (not texts or n < _STEP):
                    split = [
                        (name, part)
                        for k, name in enumerate(fields)
                        for part in _sections((values[i][k] or "") + SEPARATOR * (k + 1 < len(fields)), name in by_line)
                    ]
                    parts.append(split)
                    texts.append("".join(p for _, p in split))
                    ids.append(keys[i])
                    n += len(texts[-1])
                    i += 1
                size, to = spans(texts)
                yield _sections_frame(key, ids, parts, size, to, rule)

    kind = "double" if rule == "share" else "long"
    wanted = common.pick(rows, key, *fields)
    wanted = wanted.select(key, *[F.col(c).cast("string") for c in fields])
    return common.mapped(wanted, run, f"section int, field string, start long, end long, n_tokens {kind}, n_crossing long")


def _sections(text: str, by_line: bool) -> list[str]:
    if not by_line or not text:
        return [text]
    lines = text.split("\n")
    return [line + "\n" for line in lines[:-1]] + [lines[-1]] * bool(lines[-1])


def _sections_frame(key: str, ids: list, parts: list[list[tuple[str, str]]], size: np.ndarray, to: np.ndarray, rule: str) -> pd.DataFrame:
    columns: list[list] = [[], [], [], [], [], [], []]
    for k, split in enumerate(parts):
        chars = np.cumsum([0, *(len(p) for _, p in split)])
        ends = np.cumsum([len(p) if p.isascii() else len(p.encode("utf-8", "surrogatepass")) for _, p in split])
        counts, crossing = allocate(np.cumsum(size[to[k] : to[k + 1]], dtype=np.int64), ends, rule)
        n = len(split)
        for c, v in zip(columns, ([ids[k]] * n, range(n), [name for name, _ in split], chars[:-1].tolist(), chars[1:].tolist(), counts.tolist(), crossing.tolist()), strict=True):
            c += v
    names = (key, "section", "field", "start", "end", "n_tokens", "n_crossing")
    out = pd.DataFrame(dict(zip(names, columns, strict=True)))
    return out if rule == "share" else out.astype({"n_tokens": "int64"})
