"""Join helpers: size-checked broadcast.

A side is broadcast only when the optimizer's size estimate for it is under
a bound; otherwise no hint is given and the planner (sort-merge join, with
AQE's runtime broadcast conversion and skew splitting) decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound for hinting a broadcast: 64 MiB of estimated plan output.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (no job runs), or None."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:
        return None


def small_side(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast-hint ``df`` when its estimated size is proven under the limit."""
    size = estimated_bytes(df)
    if size is not None and size <= limit_bytes:
        return F.broadcast(df)
    return df
