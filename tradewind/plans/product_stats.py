"""Product activity per sku in ten-second windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.codes import APPRAISE
from tradewind.operators.enrichment import enrich
from tradewind.operators.windows import SIZE, in_day, tumble_distinct, with_watermark
from tradewind.plans.order_wide import ORDER_TIME, PAYMENT_TIME
from tradewind.schemas import AMOUNT, PRODUCT_STATS_COLUMNS, TOTAL

COUNTS = [
    "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct",
]
AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
# Distinct orders are counted per kind of row.
ORDER_COUNTS = {"order_ct": "order", "paid_order_ct": "payment", "refund_order_ct": "refund"}
DELAY = "1 second"
TIME = "event_time"
COLUMNS = ["stt", "edt", "sku_id", *COUNTS, *AMOUNTS, *ORDER_COUNTS, "ts"]


def _rows(
    events: DataFrame, kind: str, time: str, sku: str = "sku_id", order: str = "NULL", **measures: str
) -> DataFrame:
    """One row layout for every kind of activity; kind and measures are SQL expressions, absent ones 0."""
    return events.selectExpr(
        f"{sku} AS sku_id",
        f"{time} AS {TIME}",
        f"{kind} AS kind",
        f"CAST({order} AS BIGINT) AS order_id",
        *[f"CAST({measures.get(c, '0')} AS BIGINT) AS {c}" for c in COUNTS],
        *[f"CAST(coalesce({measures.get(a, '0')}, 0) AS {AMOUNT}) AS {a}" for a in AMOUNTS],
    )


def _time(events: DataFrame, text: str, column: str | None = None) -> str:
    """The event time a join already worked out, or the parsed text of a stored row."""
    return column if column in events.columns else f"try_cast({text} AS TIMESTAMP)"


def clicks(pages: DataFrame) -> DataFrame:
    """Detail-page views of a sku."""
    seen = pages.filter("page_id = 'good_detail' AND item_type = 'sku_id'")
    return _rows(seen, "'click'", "timestamp_millis(ts)", "try_cast(item AS BIGINT)", click_ct="1")


def displays(pages: DataFrame) -> DataFrame:
    """Skus shown in lists, one row each."""
    shown = pages.selectExpr("ts", "explode(displays) AS display").filter("display.item_type = 'sku_id'")
    sku = "try_cast(display.item AS BIGINT)"
    return _rows(shown, "'display'", "timestamp_millis(ts)", sku, display_ct="1")


def page_activity(pages: DataFrame) -> DataFrame:
    """Clicks and displays in one pass: a row per sku that a page view is about or shows."""
    seen = pages.selectExpr(
        "ts",
        "explode(concat("
        "if(page_id = 'good_detail' AND item_type = 'sku_id', array(struct('click' AS kind, item AS sku)), array()), "
        "coalesce(transform(filter(displays, d -> d.item_type = 'sku_id'), d -> struct('display' AS kind, d.item AS sku)), "
        "array()))) AS act",
    )
    return _rows(
        seen, "act.kind", "timestamp_millis(ts)", "try_cast(act.sku AS BIGINT)",
        click_ct="if(act.kind = 'click', 1, 0)", display_ct="if(act.kind = 'display', 1, 0)",
    )


def order_activity(wide: DataFrame, payment: DataFrame, within: str = "5 seconds") -> DataFrame:
    """Order and payment rows from one pass over the order details of a table.

    The payments of an order come to its details as an array, by the order id that the details are
    partitioned by already; each detail gives an order row and a row for every payment ``within`` the
    time of the order.
    """
    paid = payment.selectExpr("order_id AS paid_order", "try_cast(create_time AS TIMESTAMP) AS paid_time")
    paid = paid.groupBy("paid_order").agg(F.collect_list("paid_time").alias("paid_times"))
    joined = wide.join(paid, wide["order_id"] == paid["paid_order"], "left")
    near = f"abs(unix_micros(p) - unix_micros({ORDER_TIME})) <= unix_micros(timestamp_micros(0) + INTERVAL {within})"
    acts = joined.selectExpr(
        "sku_id", "order_id", "sku_num", "split_total_amount",
        f"explode(concat(array(struct('order' AS kind, {ORDER_TIME} AS time)), "
        f"transform(filter(coalesce(paid_times, array()), p -> {near}), p -> struct('payment' AS kind, p AS time)))) AS act",
    )
    of = lambda kind, value: f"if(act.kind = '{kind}', {value}, 0)"
    return _rows(
        acts, "act.kind", "act.time", order="order_id", order_sku_num=of("order", "sku_num"),
        order_amount=of("order", "split_total_amount"), payment_amount=of("payment", "split_total_amount"),
    )


def favors(favor: DataFrame) -> DataFrame:
    return _rows(favor, "'favor'", _time(favor, "create_time"), favor_ct="1")


def carts(cart: DataFrame) -> DataFrame:
    return _rows(cart, "'cart'", _time(cart, "create_time"), cart_ct="1")


def orders(wide: DataFrame) -> DataFrame:
    return _rows(
        wide, "'order'", _time(wide, "create_time", ORDER_TIME), order="order_id",
        order_sku_num="sku_num", order_amount="split_total_amount",
    )


def payments(paid: DataFrame) -> DataFrame:
    return _rows(
        paid, "'payment'", _time(paid, "payment_create_time", PAYMENT_TIME), order="order_id",
        payment_amount="split_total_amount",
    )


def refunds(refund: DataFrame) -> DataFrame:
    return _rows(
        refund, "'refund'", _time(refund, "create_time"), order="order_id", refund_amount="refund_amount"
    )


def comments(comment: DataFrame) -> DataFrame:
    good = f"if(appraise = '{APPRAISE['good']}', 1, 0)"
    return _rows(
        comment, "'comment'", _time(comment, "create_time"), comment_ct="1", good_comment_ct=good
    )


def activity(
    pages: DataFrame | None = None,
    favor: DataFrame | None = None,
    cart: DataFrame | None = None,
    wide: DataFrame | None = None,
    paid: DataFrame | None = None,
    refund: DataFrame | None = None,
    comment: DataFrame | None = None,
) -> DataFrame:
    """All product activity as rows of one layout; inputs left out do not contribute."""
    parts = []
    if pages is not None:
        parts.append(page_activity(pages))
    for rows, events in (
        (favors, favor), (carts, cart), (orders, wide), (payments, paid), (refunds, refund),
        (comments, comment),
    ):
        if events is not None:
            parts.append(rows(events))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def product_stats(
    rows: DataFrame, size: str = SIZE, delay: str = DELAY, day: str | None = None
) -> DataFrame:
    """Counts, amounts and exact distinct orders per sku and window; ``day`` limits it to one day."""
    timed = with_watermark(in_day(rows, TIME, day), TIME, delay)
    counts = {c: F.sum(c) for c in COUNTS}
    amounts = {a: F.sum(a) for a in AMOUNTS}
    return tumble_distinct(
        timed,
        TIME,
        ["sku_id"],
        ["kind", "order_id"],
        {**counts, **amounts, "ts": F.min(F.unix_millis(TIME))},
        {
            **counts,
            **{a: F.sum(a).cast(TOTAL) for a in AMOUNTS},
            **{n: F.count_if(F.col("kind") == kind) for n, kind in ORDER_COUNTS.items()},
            "ts": F.min("ts"),
        },
        size,
    )


def with_product(stats: DataFrame, products: DataFrame) -> DataFrame:
    """Add the product dimension to the aggregated rows (far fewer than the activity)."""
    columns = ["sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name", "category3_id",
               "category3_name"]
    wide = enrich(stats, products, "sku_id", {c: c for c in columns})
    return wide.select(*PRODUCT_STATS_COLUMNS)
