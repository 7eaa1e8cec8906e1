"""Token ids of a word-level BPE vocabulary, with a cache of white-space separated words.

The vocabulary lower-cases, drops white space and never joins across it, so the ids of a text
are those of its words in order. A word is merged as bytes followed by an end mark, with each
token's id as its rank; a test holds this against the vocabulary's own encoder. Words with
letters outside Latin, or that may hold special tokens, go to that encoder itself.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata

import numpy as np

#: Words kept by each Python worker, and characters of them, before it starts afresh.
CACHE, CACHE_CHARACTERS = 200_000, 4_000_000
#: Fixed: how the vocabulary splits a word.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN_END = "ɏ"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces:
    """A growing table of whole numbers for each distinct piece of text, of bounded size between calls."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.characters = 0
        self.values = np.zeros(1 << 20, np.uint32)
        self.begin = np.zeros(1 << 16, np.int64)  # of each code; one more at the end

    def of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All numbers of the pieces one after another, and how many each has."""
        raise NotImplementedError

    def _add(self, pieces: list[str]) -> None:
        flat, length = self.of(pieces)
        n, used = len(self.code), int(self.begin[len(self.code)])
        while used + len(flat) > len(self.values):
            self.values = np.concatenate((self.values, np.zeros_like(self.values)))
        while n + len(pieces) + 1 > len(self.begin):
            self.begin = np.concatenate((self.begin, np.zeros_like(self.begin)))
        self.values[used : used + len(flat)] = flat
        self.begin[n + 1 : n + len(pieces) + 1] = used + np.cumsum(length)
        self.characters += sum(map(len, pieces))
        self.code.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def gathered(self, pieces: list[str], upto: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of consecutive texts made of pieces; upto: each text's first piece, and the end.

        Returns all numbers, and where each text's begin (one more at the end).
        """
        new = set(pieces).difference(self.code)
        if self.code and (len(new) + len(self.code) > CACHE or self.characters > CACHE_CHARACTERS):
            self._clear()
            new = set(pieces)
        if new:
            self._add(list(new))
        code = np.fromiter(map(self.code.__getitem__, pieces), np.int64, len(pieces))
        start, length = self.begin[code], self.begin[code + 1] - self.begin[code]
        to = np.concatenate(([0], np.cumsum(length)))
        index = np.repeat(start - to[:-1], length) + np.arange(to[-1])
        return self.values[index], to[upto]


class Encoder(Pieces):
    """Ids of whole texts, as encode(text, add_special_tokens=False) of the vocabulary gives them."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        end, byte_of = "</w>", _byte_of()
        ranks = {}
        for token, i in vocabulary.items():
            body = token.removesuffix(end)
            if all(c in byte_of for c in body) and not token.startswith("<|"):
                ranks[bytes(byte_of[c] for c in body) + b"\n" * (body != token)] = i
        self.merge = tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[i for b, i in ranks.items() if b != b"\n" and b.endswith(b"\n")]] = True
        self.split = regex.compile(SPLIT).findall
        super().__init__()

    @functools.cached_property
    def full(self):
        """The vocabulary's own encoder, which few texts need."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts, count, odd = [], [], []
        for w in words:
            if not w.isascii():
                w = unicodedata.normalize("NFC", w)
            if "<|" in w or max(w, default="") > _LATIN_END:
                odd.append((len(count), w))
                count.append(0)
                continue
            low = w.lower()
            if low.isalpha():
                parts.append(low)
                count.append(1)
            else:
                got = self.split(low)
                parts += got
                count.append(len(got))
        flat = np.array(self.merge.encode_ordinary("\n".join([*parts, ""])), np.uint32)
        stop = np.concatenate(([0], np.flatnonzero(self.ends[flat]) + 1))  # of each part
        length = np.diff(stop[np.concatenate(([0], np.cumsum(count)))])
        if odd:
            got = {k: self.full.encode(w, add_special_tokens=False).ids for k, w in odd}
            cut = np.split(flat, np.cumsum(length)[:-1])
            cut = [np.array(got[k], np.uint32) if k in got else x for k, x in enumerate(cut)]
            flat, length = np.concatenate(cut), np.array([len(x) for x in cut])
        return flat, length

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's begin (one more at the end)."""
        words: list[str] = []
        upto = [0]
        for t in texts:
            for c in "\n\t\r\x0b\x0c":
                if c in t:
                    t = t.replace(c, " ")
            words += t.split(" ")
            upto.append(len(words))
        return self.gathered(words, upto)


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
