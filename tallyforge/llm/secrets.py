"""Secret scan: keyword automaton, anchored expressions near its hits, checksum validation.

An Aho-Corasick automaton over all keywords reads a text once (ASCII letters lowered). Only where
a keyword hits is the kind's expression tried, anchored at the hit; a hit inside the kind's last
match is passed over, which gives the leftmost non-overlapping matches. Runs of hex digits have
no keyword and are found by their length alone. Kinds with an embedded checksum are kept only
if it holds.

Spans are (kind, start, end) in code points, end exclusive. Base kinds: assign, access, hex.
Added kinds: github and npm (prefixed tokens whose last 6 base-62 digits are the CRC-32 of the 30
characters before them), card (payment card numbers near a word for them, with a valid Luhn
digit), iban (near its name, with a valid remainder modulo 97).

Edge cases: null text counts as empty and has no spans.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from . import common

KINDS = ("assign", "access", "hex", "github", "npm", "card", "iban")
#: The base expressions.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16
#: Token formats with an embedded checksum.
GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
CARD = re.compile(r"(?:card|visa|mastercard)[^0-9\n]{0,20}((?:[0-9][ -]?){12,18}[0-9])(?![0-9])", re.ASCII | re.IGNORECASE)
IBAN = re.compile(r"iban[: \t]{0,4}([A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30})(?![A-Z0-9])", re.ASCII | re.IGNORECASE)
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_LOWER = {i: i + 32 for i in range(65, 91)}


def crc_holds(token: str) -> bool:
    """Whether the last 6 characters are the base-62 CRC-32 of the 30 before them."""
    value = 0
    for c in token[-6:]:
        value = value * 62 + DIGITS.index(c)
    return value == zlib.crc32(token[-36:-6].encode())


def luhn_holds(number: str) -> bool:
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return len(set(digits)) > 1 and (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def iban_holds(number: str) -> bool:
    n = number.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in n[4:] + n[:4])) % 97 == 1


def _assign(m: re.Match) -> tuple[int, int] | None:
    return m.span() if len(m[2]) >= LEAST_VALUE else None


def _access(m: re.Match) -> tuple[int, int] | None:
    return m.span() if len(m[0]) >= LEAST_ACCESS else None


def _token(m: re.Match) -> tuple[int, int] | None:
    return m.span() if crc_holds(m[0]) else None


def _card(m: re.Match) -> tuple[int, int] | None:
    return m.span(1) if luhn_holds(m[1]) else None


def _iban(m: re.Match) -> tuple[int, int] | None:
    return m.span(1) if iban_holds(m[1]) else None


#: Keyword in lower case -> kind, expression and validation.
_RULES = (
    {k: ("assign", ASSIGN, _assign) for k in ("password", "passwd", "secret", "token", "apikey", "api_key")}
    | {"akia": ("access", ACCESS, _access), "npm_": ("npm", NPM, _token)}
    | {f"gh{c}_": ("github", GITHUB, _token) for c in "pousr"}
    | {k: ("card", CARD, _card) for k in ("card", "visa")}
    | {"iban": ("iban", IBAN, _iban)}
)


@functools.lru_cache(1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for k, rule in _RULES.items():
        found.add_word(k, (len(k) - 1, *rule))
    found.make_automaton()
    return found


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans of a text, by start and then by the order of kinds."""
    out = []
    after: dict[str, int] = {}
    # str.lower() may change a text's length; only A-Z must be lowered.
    low = text.lower() if text.isascii() else text.translate(_LOWER)
    hits = sorted((end - back, kind, pattern, valid) for end, (back, kind, pattern, valid) in _automaton().iter(low)) if low else []
    for at, kind, pattern, valid in hits:
        if at >= after.get(kind, 0) and (m := pattern.match(text, at)):
            after[kind] = m.end()
            if got := valid(m):
                out.append((*got, kind))
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind,start,end>>) of every row of docs (doc_id, text)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [[{"kind": k, "start": s, "end": e} for s, e, k in spans(t or "")] for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "spans": got})

    return common.mapped(common.pick(docs, "doc_id", "text"), run, "spans array<struct<kind:string,start:long,end:long>>")
