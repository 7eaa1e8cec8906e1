"""String functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a year in a label.
YEAR = r"\b(19|20)\d{2}\b"


def _null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def zip5(c: Column) -> Column:
    """The leading 4 or 5 digits, padded to 5 with zeros; null without them."""
    return F.lpad(_null_if_empty(F.regexp_extract(c.cast("string"), r"^(\d{4,5})", 1)), 5, "0")


def without_state(c: Column) -> Column:
    """Without a trailing blank and two-letter state code."""
    return F.regexp_replace(c, r"\s[A-Z]{2}$", "")


def year(c: Column) -> Column:
    """The first year from 1900 to 2099; -1 without one."""
    return F.coalesce(_null_if_empty(F.regexp_extract(c, YEAR, 0)).cast("int"), F.lit(-1))


def first_digits(c: Column) -> Column:
    """The first run of digits, or ''."""
    return F.coalesce(F.regexp_extract(c, r"\d+", 0), F.lit(""))


def second_or_empty(content: Column) -> Column:
    """The second element of a content list, or ''."""
    return F.coalesce(F.get(content, 1), F.lit(""))


def document_key(path: Column) -> Column:
    """The file's name up to ``_cropped`` and then up to ``_page``."""
    name = F.substring_index(path, "/", -1)
    return F.substring_index(F.substring_index(name, "_cropped", 1), "_page", 1)


def extension(path: Column, missing: str | None = None) -> Column:
    """The last part after a dot, in lower case; without a dot ``missing``, or the whole name."""
    name = F.substring_index(path, "/", -1)
    bare = F.lit(missing) if missing is not None else F.lower(name)
    return F.when(F.instr(name, ".") > 0, F.lower(F.substring_index(name, ".", -1))).otherwise(bare)


def is_digits(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9]+$"), F.lit(False))


def page_number(path: Column) -> Column:
    """The number in ``_page_<n>_result.json``; null without one, which sorts last."""
    return _null_if_empty(F.regexp_extract(path, r"_page_(\d+)_result\.json", 1)).cast("int")


def prefix(c: Column, length: int = 2) -> Column:
    return F.substring(c, 1, length)


def fill(first: Column, second: Column) -> Column:
    """The first value unless null or empty, else the second."""
    return F.coalesce(_null_if_empty(first), second)


def split_label(c: Column, separator: str, parts: int) -> list[Column]:
    """A label cut at its last ``parts - 1`` separators, from the left."""
    pieces = [F.substring_index(F.substring_index(c, separator, -(parts - 1 - i)), separator, 1) for i in range(parts - 1)]
    tail = F.substring_index(c, separator, -(parts - 1))
    head = F.substr(c, F.lit(1), F.length(c) - F.length(tail) - len(separator))
    return [head, *pieces]


def content_hash(content: Column) -> Column:
    """SHA-256 of a text's UTF-8 or of bytes, in hex digits."""
    return F.sha2(content, 256)


def whole(c: Column) -> Column:
    """The nearest whole number, a half to the even one."""
    return F.bround(c, 0)
