"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: In-memory bytes up to which a measured side is broadcast.
BROADCAST_BYTES = 256 << 20


def _cached_bytes(df: DataFrame) -> int:
    """In-memory bytes of a persisted frame that has been computed."""
    return int(str(df.select("*")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and, if it is persisted, so
    that its size is known, at most ``max_bytes`` bytes.

    A parallel count: a limit would send up to max_rows rows of every task to
    one task.
    """
    return df.count() <= max_rows and (not df.is_cached or _cached_bytes(df) <= max_bytes)


def checked_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows (and, if it is persisted, bytes in bound).

    Above the bound the frame is returned unhinted and Catalyst/AQE pick a
    shuffle join.  Use it for sides whose size is bounded by the domain
    (counties, code tables, a daily increment), never for facts.
    """
    return F.broadcast(df) if fits(df, max_rows) else df


def held_bytes(df: DataFrame) -> int:
    """In-memory bytes of a persisted frame, which is computed if it has not been."""
    df.count()
    return _cached_bytes(df)


def broadcast_if_small(df: DataFrame, measured: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` hinted for a broadcast if the persisted frame it is taken from
    (``measured``, at least as wide) holds at most ``most`` bytes, else as it is."""
    return F.broadcast(df) if held_bytes(measured) <= most else df
