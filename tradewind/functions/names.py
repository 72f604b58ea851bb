"""Column naming."""

from __future__ import annotations

from pyspark.sql import DataFrame


def camel(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    """Rename every column from ``snake_case`` to ``camelCase``."""
    return df.toDF(*[camel(name) for name in df.columns])
