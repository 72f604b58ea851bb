"""Searched words in ten-second windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.times import at_second
from tradewind.functions.words import count_split_words, split_words
from tradewind.operators.windows import PART, SIZE, dealt, in_day, tumble, tumble_dealt, with_watermark
from tradewind.schemas import KEYWORD_STATS_COLUMNS

DELAY = "1 second"
SEARCH = "SEARCH"


def searches(pages: DataFrame) -> DataFrame:
    """Page views that came from a search and carry its text."""
    return pages.filter((F.col("last_page_id") == "search") & F.col("item").isNotNull())


def search_words(
    pages: DataFrame, dictionary: DataFrame | None = None, source: Column | str = SEARCH, day: str | None = None
) -> DataFrame:
    """``source, ts, word``: one row per searched word; ``source`` says where it was seen."""
    return split_words(_searched(pages, source, day), "item", dictionary)


def search_word_counts(
    pages: DataFrame, dictionary: DataFrame, source: Column | str = SEARCH, day: str | None = None
) -> DataFrame:
    """``source, ts, word, ct``: ``search_words``, counted where source, time and word are equal."""
    return count_split_words(_searched(pages, source, day), "item", dictionary)


def _searched(pages: DataFrame, source: Column | str, day: str | None) -> DataFrame:
    source = F.lit(source) if isinstance(source, str) else source
    rows = searches(in_day(pages.withColumn("__time", at_second("ts")), "__time", day))
    return rows.select("item", source.alias("source"), "ts")


def count_words(words: DataFrame, size: str = SIZE, delay: str = DELAY) -> DataFrame:
    """Hits per word, source and window of ``search_words`` or ``search_word_counts`` rows."""
    timed = with_watermark(words.withColumn("event_time", at_second("ts")), "event_time", delay)
    hits = F.sum("ct") if "ct" in words.columns else F.count(F.lit(1))
    keys, counts = ["word", "source"], {"ct": hits, "ts": F.min("ts")}
    if PART in words.columns:
        counted = tumble_dealt(timed, "event_time", keys, counts, {"ct": F.sum("ct"), "ts": F.min("ts")}, size)
    else:
        counted = tumble(timed, "event_time", keys, counts, size)
    return counted.withColumnRenamed("word", "keyword").select(*KEYWORD_STATS_COLUMNS)


def keyword_stats(
    pages: DataFrame,
    dictionary: DataFrame | None = None,
    source: Column | str = SEARCH,
    size: str = SIZE,
    delay: str = DELAY,
    day: str | None = None,
    deal: bool = True,
) -> DataFrame:
    """Words per window. The pages of a table are dealt out while they are texts, which are far fewer than words
    (``deal``; a micro-batch, whose size its trigger bounds, need not pay for that)."""
    rows = _searched(pages, source, day)
    if deal and dictionary is None and not pages.isStreaming:
        rows = dealt(rows)
    return count_words(split_words(rows, "item", dictionary), size, delay)
