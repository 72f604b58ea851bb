"""Tumbling event-time windows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.times import time_text

SIZE = "10 seconds"
WINDOW = "window"
PART = "__part"
HELD, DEAL = "__held", "__deal"
# Tasks per shuffle partition where each of them holds a table of groups, and parts per such task, which evens them out.
TASKS, SPREAD = 4, 32


def _width_us(size: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL '{size}'"))


def _window(df: DataFrame, time: str, size: str) -> Column:
    """Grouping key of the window of a row, epoch aligned.

    A stream needs Spark's window column, which carries the watermark; a table takes the start as a
    plain number, which the hash aggregates handle faster than a struct.
    """
    if df.isStreaming:
        return F.window(time, size).alias(WINDOW)
    us = F.unix_micros(F.col(time))
    return (us - F.pmod(us, _width_us(size))).alias(WINDOW)


def tumble(
    df: DataFrame, time: str, keys: list[str], aggregates: Mapping[str, Column], size: str = SIZE
) -> DataFrame:
    """Aggregate per key and window; the window bounds come out as ``stt``, ``edt``."""
    timed = df.filter(F.col(time).isNotNull())
    out = timed.groupBy(_window(timed, time, size), *keys).agg(
        *[a.alias(n) for n, a in aggregates.items()]
    )
    return bounds_as_text(out, size)


def without_time(df: DataFrame, time: str) -> DataFrame:
    """The rows that belong to no window, for a reject output."""
    return df.filter(F.col(time).isNull())


def tumble_distinct(
    df: DataFrame,
    time: str,
    keys: list[str],
    distinct: list[str],
    partial: Mapping[str, Column],
    final: Mapping[str, Column],
    size: str = SIZE,
) -> DataFrame:
    """Window aggregate with exact distinct counts, by way of one row per distinct value.

    First per (window, keys, distinct), then per (window, keys): ``final`` counts rows of the first
    step where it wants distinct values and sums its ``partial`` columns. No set is held per group,
    a hot key spreads over its distinct values, and both steps run on streams too. Rows ``held`` by some of
    the keys lie together already: with the place they were held at among the keys, neither step moves them.
    """
    timed = df.filter(F.col(time).isNotNull())
    place = [c for c in (HELD, DEAL) if c in df.columns]
    step = timed.groupBy(_window(timed, time, size), *place, *keys, *distinct).agg(
        *[a.alias(n) for n, a in partial.items()]
    )
    out = step.groupBy(WINDOW, *place, *keys).agg(*[a.alias(n) for n, a in final.items()])
    return bounds_as_text(out.drop(*place), size)


def _tasks(df: DataFrame) -> int:
    return TASKS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame) -> DataFrame:
    """The rows of a table in small parts (column ``PART``) by their content, before each becomes many rows."""
    tasks = _tasks(df)
    part = F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD * tasks))
    return df.withColumn(PART, part).repartition(tasks, PART)


def tumble_dealt(
    df: DataFrame, time: str, keys: list[str], partial: Mapping[str, Column], final: Mapping[str, Column], size: str = SIZE
) -> DataFrame:
    """Window aggregate of rows that were ``dealt``: inside each part, where the rows are, then over all parts.

    Where nearly every row is a group of its own, a task's table of groups is as large as its share of the
    rows, both before and after the shuffle. Here that share follows neither from the files nor from
    how far adaptive execution puts partitions together.
    """
    timed = df.filter(F.col(time).isNotNull())
    step = timed.groupBy(PART, _window(timed, time, size), *keys).agg(*[a.alias(n) for n, a in partial.items()])
    step = step.drop(PART).repartition(_tasks(df), WINDOW, *keys)
    return bounds_as_text(step.groupBy(WINDOW, *keys).agg(*[a.alias(n) for n, a in final.items()]), size)


def bounds_as_text(df: DataFrame, size: str = SIZE) -> DataFrame:
    window = F.col(WINDOW)
    if df.isStreaming:
        start, end = window["start"], window["end"]
    else:
        start, end = F.timestamp_micros(window), F.timestamp_micros(window + _width_us(size))
    rest = [c for c in df.columns if c != WINDOW]
    return df.select(time_text(start).alias("stt"), time_text(end).alias("edt"), *rest)


def in_day(df: DataFrame, time: str, day: str | None, extra: str = "0 seconds") -> DataFrame:
    """Rows of one day (``yyyyMMdd``) and ``extra`` time after it; all rows without a day.

    Windows never cross midnight, so cutting the input is the same as cutting the result, and it
    happens before anything is shuffled.
    """
    if day is None:
        return df
    start = F.to_timestamp(F.lit(day), "yyyyMMdd")
    end = start + F.expr("INTERVAL '1 day'") + F.expr(f"INTERVAL '{extra}'")
    return df.filter((F.col(time) >= start) & (F.col(time) < end))


def with_watermark(df: DataFrame, time: str, delay: str | None) -> DataFrame:
    """Attach a watermark on streams; batch inputs pass through."""
    return df.withWatermark(time, delay) if delay and df.isStreaming else df


def held(
    df: DataFrame, time: str, size: str = SIZE, delay: str = "1 second", spread: int = 32, by: list[str] | None = None
) -> DataFrame:
    """The rows of a stream, let go when the watermark has passed the end of their window.

    A window's rows all come out in one micro-batch, so what is counted per window can be counted on that
    batch as on a table. The state has at most ``spread`` entries a window, each with its share of the rows,
    dealt by content: far fewer than an entry per group, each of which is read, written and deleted one by
    one. Rows behind the watermark and rows without a time are dropped, as by a windowed aggregate.

    ``by``: columns to deal by instead. Rows of a window that agree in them are then in one entry, which they
    have to fit, and come out together, with their place (``HELD``, ``DEAL``): a plan that groups by these
    columns and by the place needs no shuffle.
    """
    timed = with_watermark(df.filter(F.col(time).isNotNull()), time, delay)
    deal = F.pmod(F.xxhash64(*(by or df.columns)), F.lit(spread)).alias(DEAL)
    packed = timed.groupBy(F.window(time, size).alias(WINDOW), deal).agg(
        F.collect_list(F.struct(*df.columns)).alias("__rows")
    )
    place = [F.col(WINDOW).alias(HELD), DEAL] if by else []
    return packed.select(*place, F.explode("__rows").alias("__row")).select(*([HELD, DEAL] if by else []), "__row.*")
