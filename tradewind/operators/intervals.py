"""Event-time interval join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
) -> DataFrame:
    """Inner join on a key where ``right_time`` lies in ``left_time + [lower, upper]``, ends included.

    Column names of the two sides must differ. The equality makes it a hash-partitioned join, with
    the time range checked inside each key; a hot key is split by the adaptive skew join. On streams
    both time columns need a watermark, and the range then bounds the state kept per side.
    """
    earliest = F.col(left_time) + F.expr(f"INTERVAL '{lower}'")
    latest = F.col(left_time) + F.expr(f"INTERVAL '{upper}'")
    return left.join(
        right,
        (F.col(left_key) == F.col(right_key))
        & (F.col(right_time) >= earliest)
        & (F.col(right_time) <= latest),
        "inner",
    )
