"""Laplace noise as column expressions.

``keyed_laplace`` is the one to protect with: whole numbers from a keyed pseudo-random function. Its
noise is decided by the key and the cell, so a task that runs again gives the same; nobody without the key can
tell it from random bits, and no rounding of floating-point numbers shows through.
"""

from __future__ import annotations

import functools
import hashlib
import math
import secrets
from decimal import Decimal, localcontext

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The least tail probability; Spark's generator draws multiples of it, 0 included.
LEAST = 2.0**-53


def laplace_from(u: Column, scale: float) -> Column:
    """The Laplace quantile of u in [0, 1]. The ends count as the nearest numbers that have one."""
    d = u - 0.5
    return -scale * F.signum(d) * F.log(F.greatest(1 - 2 * F.abs(d), F.lit(LEAST)))


def laplace(scale: float, seed: int | None = None) -> Column:
    """Independent Laplace(0, scale) noise. Spark's generator is not a cryptographic source.

    A plan that is run again may draw again: materialise the result before using it twice.
    """
    return laplace_from(F.rand(seed) if seed is not None else F.rand(), scale)


def hash_laplace(scale: float, *keys: Column) -> Column:
    """Noise that the keys decide, in whole 1024ths, so that sums and medians are exact. For tests
    only: it protects nobody."""
    text = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
    return F.round(laplace_from((h + 0.5) / float(1 << 32), scale) * 1024) / 1024


#: Bits of each uniform number, uniform numbers of a digest, and bits of a noise value's size.
UNIFORM, EACH, BITS = 52, 4, 12
#: Fixed: HMAC's block in bytes and its two pads.
_BLOCK, _INNER, _OUTER = 64, 0x36, 0x5C


def new_key() -> bytes:
    """A key from the system's own source, to be drawn once on the driver."""
    return secrets.token_bytes(32)


@functools.lru_cache(1024)
def bit_threshold(epsilon: float, j: int) -> int:
    """The count of UNIFORM-bit numbers that set binary digit j of a geometric number.

    P(G = g) is proportional to exp(-epsilon * g). Its digits are independent: digit j is 1 with
    probability r / (1 + r), r = exp(-epsilon * 2**j).
    """
    with localcontext() as context:
        context.prec = 60
        r = (-Decimal(epsilon) * 2**j).exp()
        return int((1 << UNIFORM) * r / (1 + r))


def bit_thresholds(epsilon: float) -> list[int]:
    return [bit_threshold(epsilon, j) for j in range(BITS)]


def pads(key: bytes) -> tuple[bytes, bytes]:
    """The inner and the outer block of HMAC-SHA256 under a key."""
    key = (hashlib.sha256(key).digest() if len(key) > _BLOCK else key).ljust(_BLOCK, b"\0")
    return bytes(b ^ _INNER for b in key), bytes(b ^ _OUTER for b in key)


def hmac_hex(key: bytes, message: Column) -> Column:
    """HMAC-SHA256 of a text, in hex digits."""
    inner, outer = pads(key)
    return F.sha2(F.concat(F.lit(outer), F.unhex(F.sha2(F.concat(F.lit(inner), message.cast("binary")), 256))), 256)


def message(*parts: Column) -> Column:
    """One text of several values, null included; different values give different texts."""
    texts = [p.cast("string") for p in parts]
    return F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts])


def keyed_laplace(key: bytes, epsilon: float, *cell: Column) -> Column:
    """Whole noise of the discrete Laplace law, P(x) proportional to exp(-epsilon * |x|), for each cell.

    The difference of two geometric numbers, whose binary digits are compared with fixed thresholds. A digit's
    probability is exact to 2**-52, and sizes end at 2**BITS: beyond it lies exp(-epsilon * 2**BITS).
    """
    thresholds = bit_thresholds(epsilon)
    text, digits = message(*cell), UNIFORM // 4
    hexes = [hmac_hex(key, F.concat(text, F.lit(f"|{i}"))) for i in range(-(-2 * BITS // EACH))]
    bits = []
    for i in range(2 * BITS):
        u = F.conv(F.substring(hexes[i // EACH], 1 + i % EACH * digits, digits), 16, 10).cast("long")
        bits.append(F.when(u < thresholds[i % BITS], F.lit(1 << i % BITS)).otherwise(0))
    return (sum(bits[1:BITS], bits[0]) - sum(bits[BITS + 1 :], bits[BITS])).cast("long")


class Stream:
    """Uniform numbers of UNIFORM bits from a key and a name, in Python, for what no column expression can draw."""

    def __init__(self, key: bytes, name: str) -> None:
        inner, outer = pads(key)
        self.inner, self.outer, self.name, self.at, self.left = hashlib.sha256(inner), hashlib.sha256(outer), name, 0, []

    def next(self) -> int:
        if not self.left:
            inner, outer = self.inner.copy(), self.outer.copy()
            inner.update(f"{self.name}|{self.at}".encode())
            outer.update(inner.digest())
            self.at += 1
            bits = int.from_bytes(outer.digest(), "big")
            self.left = [bits >> UNIFORM * i & ((1 << UNIFORM) - 1) for i in range(EACH)]
        return self.left.pop()

    def geometric(self, epsilon: float, most: int = (1 << BITS) - 1) -> int:
        """A whole number g >= 0 with probability proportional to exp(-epsilon * g); if it is over ``most``, any such.

        Digits are drawn from the highest that can matter down.
        """
        g = 0
        for j in range(max(BITS, math.ceil(math.log2(64 / epsilon))) - 1, -1, -1):
            g += (self.next() < bit_threshold(epsilon, j)) << j
            if g > most:
                break
        return g
