"""Parsing of log lines ``[LEVEL],timestamp,PREFIX,message`` and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The forms of log lines.
_LINE = r"^\[([A-Z]+)\],([0-9/]+ [0-9:]+),([^,]*),(.*)$"
_INVALID = r"row-\[([^\]]+)\],col-\[([^\]]+)\]"
_CELL = r"val:(\d+),conf:([0-9.]+),loc:\[([0-9]+), ([0-9]+)\]"


def parsed(lines: DataFrame, line: str = "line") -> DataFrame:
    """lines with level, ts, prefix and message; null where the line has another form."""
    part = lambda i: F.when(F.col(line).rlike(_LINE), F.regexp_extract(line, _LINE, i))
    return lines.withColumns({"level": part(1), "ts": F.try_to_timestamp(part(2), F.lit("yyyy/MM/dd HH:mm:ss")), "prefix": part(3), "message": part(4)})


def classified(lines: DataFrame, line: str = "line") -> DataFrame:
    """lines with kind: valid, invalid, unconfident or null, the first that fits."""
    c = F.col(line)
    kind = F.when(c.contains("Valid table"), "valid").when(c.contains("Invalid table"), "invalid").when(c.contains("Unconfident_cell"), "unconfident")
    return lines.withColumn("kind", kind)


def invalid_flags(lines: DataFrame, line: str = "line") -> DataFrame:
    """lines with row_flags and col_flags; null where not found."""
    flags = lambda i: F.when(F.col(line).rlike(_INVALID), F.transform(F.split(F.regexp_extract(line, _INVALID, i), ","), lambda s: F.trim(s) == "True"))
    return lines.withColumn("row_flags", flags(1)).withColumn("col_flags", flags(2))


def unconfident_cells(lines: DataFrame, line: str = "line") -> DataFrame:
    """lines with val, conf, loc_c and loc_r; null where not found."""
    part = lambda i, kind: F.when(F.col(line).rlike(_CELL), F.regexp_extract(line, _CELL, i)).cast(kind)
    return lines.withColumns({"val": part(1, "int"), "conf": part(2, "double"), "loc_c": part(3, "int"), "loc_r": part(4, "int")})


def summary(lines: DataFrame, file: str, line: str = "line", prefix: str | None = None) -> DataFrame:
    """(logs, valid, invalid, accuracy): a log is valid if any of its lines says so.

    prefix: only lines of that part count, and logs without any are left out. accuracy is null
    without logs.
    """
    rows = lines.where(F.col(line).contains(f",{prefix},")) if prefix else lines
    files = rows.groupBy(file).agg(F.bool_or(F.col(line).contains("Valid table")).alias("valid"))
    ok = F.count_if("valid")
    return files.agg(F.count("*").alias("logs"), ok.alias("valid"), F.count_if(~F.col("valid")).alias("invalid"), F.round(ok * 100 / F.nullif(F.count("*"), F.lit(0)), 2).alias("accuracy"))
