"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(changes: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """The row with the highest ``seq`` per key; each task keeps one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(seq).desc())
    return changes.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def blank_nulls(changes: DataFrame, row: str = "after") -> DataFrame:
    """Null values of a dimension row are stored as empty text."""
    return changes.withColumn(row, F.transform_values(row, lambda _, v: F.coalesce(v, F.lit(""))))


def upsert(snapshot: DataFrame | None, changes: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Merge changes into a keyed snapshot.

    Both are reduced to one row per key in one pass, each task before the shuffle; the store hands in
    only the buckets that the changes touch. An older change never replaces a newer stored row.
    """
    return latest(changes if snapshot is None else snapshot.unionByName(changes), keys, seq)
