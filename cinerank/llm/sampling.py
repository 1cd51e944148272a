"""Bounded, repeatable samples of rows for fitting a model in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 1 << 40


def bounded_sample(rows: DataFrame, key: Column, bound: int, seed: int) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hashes of ``key``.  Rows that cannot
    be among them are dropped by a hash threshold first, so about ``bound`` rows move;
    the choice depends on keys alone, not on partitions."""
    h = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(SPREAD))
    n = rows.count()
    if n > bound:
        share = (bound + 6 * bound ** 0.5 + 16) / n
        rows = rows.filter(h < int(min(1.0, share) * SPREAD))
    return rows.orderBy(h, key, *[c for c in rows.columns]).limit(bound)
