"""Bounded samples that are the same in any run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 40


def hash_sample(rows: DataFrame, n: int, *columns: str) -> DataFrame:
    """At most ``n`` rows: those of smallest hash of the columns.

    All rows are counted first, so that each task passes on its share of about ``1.2 * n`` rows only.
    """
    total = rows.count()
    place = F.pmod(F.xxhash64(*columns), F.lit(_STEPS))
    if total > n:
        # So much room that a sample falls short of n only by a freak of the hash.
        share = min(1.0, (1.2 * n + 100) / total)
        rows = rows.filter(place < int(share * _STEPS))
    return rows.orderBy(place, *columns).limit(n)
