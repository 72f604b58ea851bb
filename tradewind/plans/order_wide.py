"""Orders joined with their details, payments and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.times import age_years, text_ms, text_time
from tradewind.operators.enrichment import enrich, product_dim
from tradewind.operators.intervals import interval_join
from tradewind.operators.windows import with_watermark
from tradewind.schemas import AMOUNT, ORDER_WIDE_COLUMNS, ORDER_WIDE_FILLED

ORDER_TIME = "order_time"
PAYMENT_TIME = "payment_time"
DELAY = "0 seconds"


def with_order_times(orders: DataFrame) -> DataFrame:
    """Day, hour and epoch milliseconds of ``create_time``."""
    parts = F.split("create_time", " ")
    return orders.withColumns(
        {
            "create_date": parts[0],
            "create_hour": F.split(parts[1], ":")[0],
            "create_ts": text_ms("create_time"),
        }
    )


def order_facts(
    orders: DataFrame,
    details: DataFrame,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
    delay: str = DELAY,
) -> DataFrame:
    """Order details next to their order, where both were written within the time bounds.

    ``order_time`` is the order's event time; on a stream it carries the watermark onward.
    """
    return _dated(_met(orders, details, lower, upper, delay), orders, details)


def _met(orders: DataFrame, details: DataFrame, lower: str, upper: str, delay: str) -> DataFrame:
    """Orders joined with their details, with the columns that both came with."""
    left = orders.select(
        F.col("id").alias("order_id"),
        *[c for c in orders.columns if c != "id"],
        text_time("create_time").alias(ORDER_TIME),
    )
    right = details.select(
        F.col("id").alias("detail_id"),
        F.col("order_id").alias("__detail_order"),
        *[c for c in details.columns if c not in ("id", "order_id", "create_time")],
        text_time("create_time").alias("__detail_time"),
    )
    joined = interval_join(
        with_watermark(left, ORDER_TIME, delay),
        with_watermark(right, "__detail_time", delay),
        "order_id", "__detail_order", ORDER_TIME, "__detail_time", lower, upper,
    )
    return joined.drop("__detail_order", "__detail_time")


def _dated(met: DataFrame, orders: DataFrame, details: DataFrame) -> DataFrame:
    """``order_facts`` of rows that have met: what follows from the order's time is worked out behind the
    joins, which need not move or keep it. Columns that neither side has come last."""
    before = ["order_id", *[c for c in orders.columns if c != "id"]]
    behind = ["detail_id", *[c for c in details.columns if c not in ("id", "order_id", "create_time")]]
    looked_up = [c for c in met.columns if c not in {*before, *behind, ORDER_TIME}]
    return with_order_times(met).select(
        *before, "create_date", "create_hour", ORDER_TIME, *behind,
        F.lit(None).cast(AMOUNT).alias("split_feight_fee"), *looked_up,
    )


def with_user(wide: DataFrame, users: DataFrame, as_of: Column | str) -> DataFrame:
    """Gender and age of the buyer; the date the age counts to is an argument, not the clock."""
    return enrich(
        wide, users, "user_id", {"user_age": age_years("birthday", as_of), "user_gender": "gender"}
    )


def with_province(wide: DataFrame, provinces: DataFrame) -> DataFrame:
    return enrich(
        wide,
        provinces,
        "province_id",
        {
            "province_name": "name",
            "province_area_code": "area_code",
            "province_iso_code": "iso_code",
            "province_3166_2_code": "iso_3166_2",
        },
    )


def with_product(wide: DataFrame, products: DataFrame) -> DataFrame:
    """Sku name (the stored one wins) with spu, trademark and category."""
    columns = ["sku_name", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"]
    return enrich(wide, products, "sku_id", {c: c for c in columns})


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    sku: DataFrame,
    spu: DataFrame,
    trademark: DataFrame,
    category3: DataFrame,
    as_of: Column | str,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
    delay: str = DELAY,
) -> DataFrame:
    """Order facts with all six dimensions, looked up where the rows are fewest and narrowest.

    Orders take their user, and on tables the province and the details their product, before the two meet:
    the wide rows then move no more and lie by order id, as ``payment_wide`` wants them. A stream would keep
    those names in its state, so there the wide rows look them up: the products first, while the rows, which move
    for them, have neither the few provinces' names nor the parts of their time.
    """
    products = product_dim(sku, spu, trademark, category3)
    orders = with_user(orders, users, as_of)
    if orders.isStreaming or details.isStreaming:
        met = with_product(_met(orders, details, lower, upper, delay), products)
        wide = _dated(with_province(met, provinces), orders, details)
    else:
        orders, details = with_province(orders, provinces), with_product(details, products)
        wide = order_facts(orders, details, lower, upper, delay)
    return wide.select(*ORDER_WIDE_COLUMNS, ORDER_TIME)


def with_dimensions(
    facts: DataFrame, users: DataFrame, provinces: DataFrame, sku: DataFrame, spu: DataFrame, trademark: DataFrame,
    category3: DataFrame, as_of: Column | str,
) -> DataFrame:
    """Order facts with all six dimensions."""
    wide = with_province(with_user(facts, users, as_of), provinces)
    wide = with_product(wide, product_dim(sku, spu, trademark, category3))
    return wide.select(*ORDER_WIDE_COLUMNS, ORDER_TIME)


def first_non_null(
    one: DataFrame, other: DataFrame, keys: list[str], filled: list[str] = ORDER_WIDE_FILLED
) -> DataFrame:
    """Merge two wide rows of the same key: the first's values, gaps in ``filled`` from the second."""
    a, b = one.alias("a"), other.alias("b")
    joined = a.join(b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "inner")

    def pick(name: str) -> Column:
        if name in filled and name not in keys:
            return F.coalesce(F.col(f"a.{name}"), F.col(f"b.{name}")).alias(name)
        return F.col(f"a.{name}").alias(name)

    return joined.select(*[pick(c) for c in one.columns])


def without_time(rows: DataFrame) -> DataFrame:
    """Orders, details or payments whose ``create_time`` cannot be read: no join finds them."""
    return rows.filter(text_time("create_time").isNull())


def payment_wide(
    payments: DataFrame,
    wide: DataFrame,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
    delay: str = DELAY,
) -> DataFrame:
    """Payments next to the order rows they pay, the order written within the bounds of the payment.

    Fields both sides have (order, user, total) come from the payment. ``payment_time`` is the
    payment's event time. Where the order side is the bare join of orders and details it is already
    partitioned by order id, and only the payments move.
    """
    left = payments.select(
        F.col("id").alias("payment_id"),
        "subject",
        "payment_type",
        F.col("create_time").alias("payment_create_time"),
        "callback_time",
        "order_id",
        "user_id",
        "total_amount",
        text_time("create_time").alias(PAYMENT_TIME),
    )
    dropped = {"order_id", "user_id", "total_amount", "create_time", "operate_time", "expire_time",
               "create_date", "create_hour", ORDER_TIME}
    right = wide.select(
        F.col("order_id").alias("__wide_order"),
        F.col("create_time").alias("order_create_time"),
        (F.col(ORDER_TIME) if ORDER_TIME in wide.columns else text_time("create_time")).alias("__wide_time"),
        *[c for c in wide.columns if c not in dropped],
    )
    joined = interval_join(
        with_watermark(left, PAYMENT_TIME, delay),
        with_watermark(right, "__wide_time", delay),
        "order_id", "__wide_order", PAYMENT_TIME, "__wide_time", lower, upper,
    )
    return joined.drop("__wide_order", "__wide_time")
