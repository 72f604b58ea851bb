"""Order amount and order count per province in ten-second windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.times import text_time
from tradewind.operators.windows import SIZE, in_day, tumble_distinct, with_watermark
from tradewind.plans.order_wide import ORDER_TIME
from tradewind.schemas import PROVINCE_STATS_COLUMNS, TOTAL

KEYS = [
    "province_id", "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
]
DELAY = "1 second"


def timed(wide: DataFrame) -> DataFrame:
    """The columns that the statistics need, with the order's time."""
    time = F.col(ORDER_TIME) if ORDER_TIME in wide.columns else text_time("create_time")
    return wide.select(*KEYS, "order_id", "split_total_amount", time.alias(ORDER_TIME))


def province_stats(
    wide: DataFrame, size: str = SIZE, delay: str = DELAY, day: str | None = None
) -> DataFrame:
    rows = timed(wide).withColumnRenamed(ORDER_TIME, "event_time")
    return tumble_distinct(
        with_watermark(in_day(rows, "event_time", day), "event_time", delay),
        "event_time",
        KEYS,
        ["order_id"],
        {"order_amount": F.sum("split_total_amount"), "ts": F.min(F.unix_millis("event_time"))},
        {
            "order_amount": F.sum("order_amount").cast(TOTAL),
            "order_count": F.count("order_id"),
            "ts": F.min("ts"),
        },
        size,
    ).select(*PROVINCE_STATS_COLUMNS)
