"""Traffic per version, channel, area and visitor kind in ten-second windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.times import at_ms
from tradewind.operators.visits import is_entry
from tradewind.operators.windows import SIZE, in_day, tumble, with_watermark
from tradewind.schemas import VISITOR_STATS_COLUMNS

KEYS = ["vc", "ch", "ar", "is_new"]
COUNTS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]
DELAY = "11 seconds"


def _rows(events: DataFrame, **measures: Column) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return events.select(
        *KEYS, "ts", *[measures.get(c, zero).cast("bigint").alias(c) for c in COUNTS]
    )


def visitor_stats(
    pages: DataFrame,
    unique_visits: DataFrame,
    jumps: DataFrame,
    size: str = SIZE,
    delay: str = DELAY,
    day: str | None = None,
) -> DataFrame:
    """Visitors, page views, sessions, bounces and dwell time.

    On streams the watermark sits on the union, so it is one clock over the three inputs. Bounces
    come late by design (they wait for their time to run out): a delay shorter than that wait drops
    them.
    """
    one = F.lit(1)
    views = _rows(
        pages,
        pv_ct=one,
        sv_ct=F.when(is_entry(), 1).otherwise(0),
        dur_sum=F.coalesce("during_time", F.lit(0)),
    )
    union = views.unionByName(_rows(unique_visits, uv_ct=one)).unionByName(_rows(jumps, uj_ct=one))
    union = in_day(union.withColumn("event_time", at_ms("ts")), "event_time", day)
    timed = with_watermark(union, "event_time", delay)
    sums = {c: F.sum(c) for c in COUNTS}
    return tumble(timed, "event_time", KEYS, {**sums, "ts": F.min("ts")}, size).select(
        *VISITOR_STATS_COLUMNS
    )
