"""Row changes of a database."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.json_text import MAP, text_map
from tradewind.schemas import CDC_CHANGE


def normalise(records: DataFrame) -> DataFrame:
    """Capture records to changes: database and table from ``server.database.table``, absent rows as
    empty maps, operation in lower case with ``create`` called ``insert``."""
    path = F.split("topic", "\\.")
    op = F.lower("op")
    empty = F.create_map().cast(MAP)
    return records.select(
        path[1].alias("database"),
        path[2].alias("table"),
        F.coalesce(text_map("before"), empty).alias("before"),
        F.coalesce(text_map("after"), empty).alias("after"),
        F.when(op == "create", "insert").otherwise(op).alias("operation"),
        "seq",
    )


def envelope(changes: DataFrame) -> DataFrame:
    """Changes as the JSON text that goes to the topic."""
    return changes.select(
        F.to_json(F.struct("database", "table", "before", "after", "operation", "seq")).alias("value")
    )


def from_envelope(lines: DataFrame) -> DataFrame:
    return lines.select(F.from_json("value", CDC_CHANGE).alias("change")).select("change.*")
