"""Daily reports over the four statistics tables. ``day`` is ``yyyyMMdd``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.codes import KEYWORD_WEIGHT
from tradewind.functions.numbers import ratio_half_up
from tradewind.schemas import TOTAL

RATE = "decimal(20,2)"


def on_day(stats: DataFrame, day: str | int) -> DataFrame:
    """Windows that start on a day. A stored table's ``dt`` partitions are pruned by it."""
    text = str(day)
    iso = f"{text[:4]}-{text[4:6]}-{text[6:]}"
    if "dt" in stats.columns:
        return stats.filter(F.col("dt").cast("string") == iso)
    return stats.filter(F.substring("stt", 1, 10) == iso)


def gmv(product: DataFrame, day: str | int) -> DataFrame:
    return on_day(product, day).agg(F.sum("order_amount").cast(TOTAL).alias("order_amount"))


def _top_amount(
    product: DataFrame, day: str | int, keys: list[str], limit: int, **extra: Column
) -> DataFrame:
    """Groups by order amount, highest first, ties by key; a top-n, so no full sort runs."""
    totals = on_day(product, day).groupBy(*keys).agg(
        F.sum("order_amount").cast(TOTAL).alias("order_amount"),
        *[c.alias(n) for n, c in extra.items()],
    )
    ranked = totals.filter("order_amount > 0").orderBy(F.desc("order_amount"), keys[0])
    return ranked.limit(limit)


def spu_top(product: DataFrame, day: str | int, limit: int = 10) -> DataFrame:
    """``order_ct`` adds up per-sku, per-window distinct orders: one order can count several times."""
    top = _top_amount(product, day, ["spu_id", "spu_name"], limit, order_ct=F.sum("order_ct"))
    return top.select("spu_name", "order_amount", "order_ct")


def category_top(product: DataFrame, day: str | int, limit: int = 4) -> DataFrame:
    top = _top_amount(product, day, ["category3_id", "category3_name"], limit)
    return top.select(F.col("category3_name").alias("name"), F.col("order_amount").alias("value"))


def trademark_top(product: DataFrame, day: str | int, limit: int = 20) -> DataFrame:
    return _top_amount(product, day, ["tm_id", "tm_name"], limit).select("tm_name", "order_amount")


def trademark_arrays(product: DataFrame, day: str | int, limit: int = 20) -> DataFrame:
    """The trademark ranking as two parallel arrays (at most ``limit`` entries)."""
    top = _top_amount(product, day, ["tm_id", "tm_name"], limit)
    ranked = F.array_sort(
        F.collect_list(
            F.struct((-F.col("order_amount")).alias("rank"), "tm_id", "tm_name", "order_amount")
        )
    )
    return top.agg(ranked.alias("ranked")).select(
        F.col("ranked.tm_name").alias("categories"), F.col("ranked.order_amount").alias("data")
    )


def province_map(province: DataFrame, day: str | int) -> DataFrame:
    totals = on_day(province, day).groupBy("province_id", "province_name").agg(
        F.sum("order_amount").cast(TOTAL).alias("value")
    )
    return totals.select(F.col("province_name").alias("name"), "value")


def hourly(visitor: DataFrame, day: str | int) -> DataFrame:
    """Visitors, page views and new visitors for each of the 24 hours, zeros where there is nothing."""
    per_hour = on_day(visitor, day).groupBy(F.substring("stt", 12, 2).alias("hr")).agg(
        F.sum("uv_ct").alias("uv"),
        F.sum("pv_ct").alias("pv"),
        F.sum(F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0)).alias("new_uv"),
    )
    hours = visitor.sparkSession.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hr"))
    return hours.join(per_hour, "hr", "left").na.fill(0, ["uv", "pv", "new_uv"])


def new_and_old(visitor: DataFrame, day: str | int) -> DataFrame:
    """Five measures, new against returning visitors; a side with no visitors or sessions shows 0."""
    counts = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]
    sides = {"new": F.col("is_new") == "1", "old": ~F.col("is_new").eqNullSafe("1")}
    zero = F.lit(0).cast("bigint")
    sums = on_day(visitor, day).agg(
        *[
            F.coalesce(F.sum(F.when(is_side, F.col(c))), zero).alias(f"{c}_{side}")
            for side, is_side in sides.items()
            for c in counts
        ]
    )

    def value(side: str, measure: str) -> Column:
        uv, pv, sv, uj, dur = (F.col(f"{c}_{side}") for c in counts)
        per_session = F.when(uv == 0, zero).otherwise(sv)
        # Whole milliseconds first, then tenths of a second: the two roundings are part of the report.
        milliseconds = ratio_half_up(dur, per_session, 0).cast("bigint")
        return {
            "visitors": uv.cast(RATE),
            "pages": pv.cast(RATE),
            "bounce_percent": ratio_half_up(uj * 100, per_session, 2),
            "seconds_per_session": ratio_half_up(milliseconds, F.lit(1000).cast("bigint"), 1),
            "pages_per_session": ratio_half_up(pv, per_session, 2),
        }[measure]

    measures = ["visitors", "pages", "bounce_percent", "seconds_per_session", "pages_per_session"]
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("type"), value("new", m).alias("new"), value("old", m).alias("old"))
            for m in measures
        ]
    )
    return sums.select(F.inline(rows))


def row_counts(visitor: DataFrame, day: str | int) -> DataFrame:
    """How many statistics rows carry page views and visitors: counts of rows, not sums."""
    return on_day(visitor, day).agg(F.count("pv_ct").alias("pv_ct"), F.count("uv_ct").alias("uv_ct"))


def keywords(keyword: DataFrame, day: str | int, limit: int = 20) -> DataFrame:
    """Words ranked by raw hits and shown with their weighted hits."""
    weight = F.lit(0)
    for source, points in KEYWORD_WEIGHT.items():
        weight = F.when(F.col("source") == source, points).otherwise(weight)
    totals = on_day(keyword, day).groupBy(F.col("keyword").alias("name")).agg(
        F.sum(F.col("ct") * weight).cast("bigint").alias("value"), F.sum("ct").alias("hits")
    )
    return totals.orderBy(F.desc("hits"), "name").limit(limit).select("name", "value")
