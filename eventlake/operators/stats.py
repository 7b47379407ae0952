"""Exact order statistics without gathering a column into one task.

:func:`kth_smallest` is a radix select over a long column: each pass groups the
candidate rows by the next 16 bits of ``value - min`` (at most 65,536 counts
reach the driver), keeps the digit holding rank ``k`` and narrows the
candidates.  A 64-bit range needs at most four passes, each a distributed,
map-side-combined aggregate.  :func:`median` builds on it; ``approx=True``
switches to ``percentile_approx`` for a single pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.session import checkpoint_root

DIGIT_BITS = 16


def kth_smallest(df: DataFrame, col: str, k: int, lo: int | None = None,
                 hi: int | None = None) -> int | None:
    """The ``k``-th smallest (0-based) non-null value of long column ``col``."""
    vals = df.select(F.col(col).cast("long").alias("_v")).filter(F.col("_v").isNotNull())
    if lo is None or hi is None:
        r = vals.agg(F.min("_v"), F.max("_v")).first()
        lo, hi = r[0], r[1]
    if lo is None:
        return None
    span = hi - lo
    shift = span.bit_length()
    prefix = 0
    rel = vals.select((F.col("_v") - F.lit(lo)).alias("_r"))
    while shift > 0:
        step = min(DIGIT_BITS, shift)
        shift -= step
        cand = rel
        if prefix or shift + step < span.bit_length():
            cand = rel.filter(F.shiftrightunsigned("_r", shift + step) == F.lit(prefix))
        digit = F.shiftrightunsigned("_r", shift).bitwiseAND(F.lit((1 << step) - 1))
        counts = sorted((r[0], r[1]) for r in
                        cand.groupBy(digit.alias("_d")).agg(F.count(F.lit(1))).collect())
        for d, c in counts:
            if k < c:
                prefix = (prefix << step) | d
                break
            k -= c
        else:  # k out of range
            return None
    return lo + prefix


def median(df: DataFrame, col: str, approx: bool = False, materialise: bool = True) -> float | None:
    """Median of a long column (mean of the two middle values when n is even).
    ``materialise=False`` when ``df`` is already a checkpointed/cheap frame."""
    if approx:
        return df.agg(F.percentile_approx(col, 0.5, 10000)).first()[0]
    # Several passes follow: materialise the single column once (shared
    # checkpoint folder) instead of recomputing the upstream plan per pass.
    if materialise:
        checkpoint_root(df.sparkSession)
        df = df.select(F.col(col).cast("long").alias(col)).checkpoint(eager=True)
    r = df.agg(F.count(col), F.min(col), F.max(col)).first()
    n, lo, hi = r[0], r[1], r[2]
    if not n:
        return None
    if n % 2:
        return float(kth_smallest(df, col, n // 2, lo, hi))
    a = kth_smallest(df, col, n // 2 - 1, lo, hi)
    b = kth_smallest(df, col, n // 2, lo, hi)
    return a + (b - a) / 2.0
