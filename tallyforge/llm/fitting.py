"""What the classifiers share: bounded samples of labelled rows, and a gradient optimiser."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: F.Column, n: int) -> F.Column:
    """crc32 of the id as text modulo n; a null id counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def thinned(rows: DataFrame, label: str, doc_id: str, each: int, most: int | None = None, kinds: int | None = None) -> tuple[DataFrame, dict]:
    """About ``each`` rows of each label, by a fixed hash of the id (all rows of rarer labels), fewer if
    that made more than ``most`` rows of all labels; of the ``kinds`` most frequent labels only.

    Also these labels' counts, which come to the driver as one row for each.
    """
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label)
    counts = {r[0]: r[1] for r in (counts.limit(kinds) if kinds else counts).collect()}
    each = min(each, most // max(1, len(counts))) if most else each
    # A row for each label that is learned.
    kind = rows.schema[label].dataType.simpleString()
    shares = rows.sparkSession.createDataFrame([(v, min(1.0, each / n)) for v, n in counts.items()], f"_label {kind}, _share double")
    at = F.pmod(F.xxhash64(doc_id, F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    return rows.join(F.broadcast(shares), F.col(label) == F.col("_label")).where(at < F.col("_share")).select(*rows.columns), counts


def adam(weights: np.ndarray, gradient: Callable[[np.ndarray, int], np.ndarray], steps: int, rate: float) -> np.ndarray:
    """Weights after some steps of Adam down the gradient."""
    w, m, v = weights.astype(np.float64), 0.0, 0.0
    for i in range(1, steps + 1):
        g = gradient(w, i)
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return w
