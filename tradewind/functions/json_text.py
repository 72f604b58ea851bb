"""JSON text with unknown fields, parsed once into a variant.

Numbers keep their digits this way; parsing straight into a text map would turn them into doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP = "map<string,string>"


def is_object(value: Column) -> Column:
    """Whether a variant is a JSON object; false for text that was no JSON at all."""
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def with_parsed(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the parsed text as a variant column.

    By way of a generator: filters and projections on the variant then read it, where they would
    otherwise each be rewritten to parse the text again.
    """
    return df.select("*", F.explode(F.array(F.try_parse_json(text))).alias(name))


def part(value: Column | str, path: str, type_name: str) -> Column:
    """A part of a variant; null if it is absent or of another kind."""
    value = F.col(value) if isinstance(value, str) else value
    return F.try_variant_get(value, f"$.{path}", type_name)


def text_map(text: Column | str) -> Column:
    """The fields of a JSON object as text, nested values as JSON text; null if it is no object."""
    return F.try_variant_get(F.try_parse_json(text), "$", MAP)
