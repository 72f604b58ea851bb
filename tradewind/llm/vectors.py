"""Vectors as whole numbers: what the integer operators on embeddings share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Components beyond this are set to it, so that squares and products over a vector fit 64 bits.
LARGEST = 1 << 26


def whole_vectors(table: DataFrame) -> DataFrame:
    """``vec_id, label, v`` with ``v = floor(256 * x)``, without the rows whose vector cannot be used.

    Vectors that are null or hold null or non-finite components are left out. Other columns are not
    read, whatever their names.
    """
    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"),
    )
    usable = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    edge = float(LARGEST)
    numbers = F.transform(
        "x", lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(edge)), F.lit(-edge))).cast("int")
    )
    return rows.filter(usable).select("vec_id", "label", numbers.alias("v"))
