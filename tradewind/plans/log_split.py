"""Raw click log to start, page and display logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.json_text import MAP, is_object, part, with_parsed
from tradewind.functions.times import is_blank
from tradewind.operators.visits import repair_new_flag


def dirty(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON object, unchanged."""
    return lines.filter(~is_object(F.try_parse_json("value"))).select("value")


def heads(lines: DataFrame) -> DataFrame:
    """Lines that are JSON objects, with what the new-visitor repair needs."""
    return (
        with_parsed(lines, "value", "line")
        .filter(is_object(F.col("line")))
        .select(
            "seq",
            "value",
            "line",
            part("line", "common.mid", "string").alias("mid"),
            part("line", "common.is_new", "string").alias("is_new"),
            part("line", "ts", "bigint").alias("ts"),
        )
    )


def open_parts(events: DataFrame) -> DataFrame:
    """The parts of each parsed line; fields nobody listed stay in the map of their part."""
    return events.select(
        "seq",
        "mid",
        "is_new",
        part("line", "common", MAP).alias("common"),
        part("line", "start", "string").alias("start"),
        part("line", "page", MAP).alias("page"),
        part("line", "displays", f"array<{MAP}>").alias("displays"),
        "ts",
    )


def clean(lines: DataFrame) -> DataFrame:
    return open_parts(heads(lines))


def repaired(lines: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Clean lines with the new-visitor flag repaired; ``seen``: the visitors of earlier runs."""
    return put_flag(repair_new_flag(clean(lines), seen=seen))


def forwarded(lines: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Clean lines as JSON text with the flag repaired: every field of a line, with its own type."""
    fixed = repair_new_flag(heads(lines), seen=seen)
    rest = "map_filter(try_variant_get(line, '$', 'map<string,variant>'), (k, v) -> k <> 'common')"
    own = "map_filter(try_variant_get(line, '$.common', 'map<string,variant>'), (k, v) -> k <> 'is_new')"
    flag = "map('is_new', parse_json(concat('\"', is_new, '\"')))"
    whole = f"to_json(map_concat({rest}, map('common', parse_json(to_json(map_concat({own}, {flag}))))))"
    text = F.when(F.col("is_new").isin("0", "1"), F.expr(whole)).otherwise(F.to_json("line"))
    return fixed.select("seq", "mid", "is_new", "ts", text.alias("value"))


def put_flag(events: DataFrame) -> DataFrame:
    """Write the ``is_new`` column back into ``common``."""
    others = F.map_filter("common", lambda key, _: key != "is_new")
    flag = F.when(F.col("is_new").isNotNull(), F.create_map(F.lit("is_new"), F.col("is_new")))
    return events.withColumn("common", F.map_concat(others, F.coalesce(flag, F.create_map().cast(MAP))))


def starts(events: DataFrame) -> DataFrame:
    """App-start lines; a line with a start part is nothing else."""
    return events.filter(~is_blank("start")).select("seq", "mid", "common", "start", "ts")


def pages(events: DataFrame) -> DataFrame:
    return events.filter(is_blank("start")).drop("start")


def displays(events: DataFrame) -> DataFrame:
    """One row per shown item: its own fields plus the id of the page it was on."""
    shown = pages(events).select("page", F.explode("displays").alias("display"))
    own = F.map_filter("display", lambda key, _: key != "page_id")
    return shown.select(
        F.map_concat(own, F.create_map(F.lit("page_id"), F.col("page")["page_id"])).alias("display")
    )


def page_log(page_events: DataFrame) -> DataFrame:
    """Page lines as flat typed rows, the input of every later job."""
    item = lambda d: F.struct(d["item"].alias("item"), d["item_type"].alias("item_type"))
    common, page = F.col("common"), F.col("page")
    return page_events.select(
        "seq",
        "mid",
        *[common[c].alias(c) for c in ("vc", "ch", "ar")],
        "is_new",
        *[page[c].alias(c) for c in ("page_id", "last_page_id", "item", "item_type")],
        F.expr("try_cast(page['during_time'] AS BIGINT)").alias("during_time"),
        F.transform("displays", item).alias("displays"),
        "ts",
    )


def page_json(page_events: DataFrame) -> DataFrame:
    """Page lines back to JSON text, for a topic."""
    return page_events.select(
        F.to_json(F.struct("common", "page", "displays", "ts")).alias("value"), "seq"
    )
