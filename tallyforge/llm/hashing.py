"""64-bit hashes of all words of many texts at once, in numpy."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np

_U = np.uint64
#: Texts are hashed in chunks of about this many bytes.
CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(32))
        x = x * _U(0xD6E8FEB86659FD93)
        x = x ^ (x >> _U(32))
        x = x * _U(0xD6E8FEB86659FD93)
        return x ^ (x >> _U(32))


def random(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64)


#: Bytes of ASCII white space.
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that cannot be part of a letter word: ASCII without letters.
NO_LETTER = np.zeros(256, bool)
NO_LETTER[:128] = True
NO_LETTER[[*range(65, 91), *range(97, 123)]] = False
_BYTE = random(11, 256)
_BASE = int(random(14, 1)[0]) & ~7 | 5


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def chunks(texts: list[str | None], most: int = CHUNK) -> Iterator[list[bytes]]:
    """The texts as UTF-8 (null: empty) in lists of about ``most`` bytes; a longer text is whole."""
    part: list[bytes] = []
    size = 0
    for t in texts:
        part.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(part[-1])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def cut(texts: list[bytes], between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Callable[[np.ndarray, np.ndarray], np.ndarray]]:
    """Words of the texts, A-Z lowered and split at the bytes ``between``, which must hold the newline.

    Returns the joined lower-case bytes, each word's first byte and end, each text's first word (one more
    at the end), and a function that hashes bytes from starts to ends.
    """
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    a = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    power, inverse = _powers(max(CHUNK * 2, 1 << int(len(a)).bit_length()))
    edge = np.diff(np.concatenate(([True], between[a])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    with np.errstate(over="ignore"):
        total = np.concatenate(([_U(0)], np.cumsum(_BYTE[a] * power[: len(a)], dtype=np.uint64)))

    def hashed(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((total[end] - total[start]) * inverse[start])

    return a, start, end, np.searchsorted(start, np.concatenate(([0], np.cumsum(size)))), hashed


def words(texts: list[bytes], between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined lower-case bytes, each word's hash and first byte, and each text's first word, as by ``cut``."""
    a, start, end, first, hashed = cut(texts, between)
    return a, hashed(start, end), start, first
