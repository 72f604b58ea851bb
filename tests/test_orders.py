from decimal import Decimal

from pyspark.sql import functions as F

from tradewind.functions.names import camel
from tradewind.functions.times import age_years
from tradewind.operators.enrichment import enrich, product_dim
from tradewind.operators.intervals import interval_join
from tradewind.plans import order_wide
from tradewind.schemas import (
    AMOUNT, DIM_CATEGORY3, DIM_PROVINCE, DIM_SKU, DIM_SPU, DIM_TRADEMARK, DIM_USER, ORDER_DETAIL,
    ORDER_INFO, ORDER_WIDE_COLUMNS, PAYMENT_INFO,
)

D = Decimal


def order(spark, *rows):
    return spark.createDataFrame(
        [(i, 1, "1001", 5, D("10.00"), D(0), D(0), D("10.00"), D(0), None, t, None) for i, t in rows], ORDER_INFO
    )


def detail(spark, *rows):
    return spark.createDataFrame(
        [(i, o, sku, D("4.00"), 2, "old name", t, D("8.00"), D(0), D(0)) for i, o, sku, t in rows], ORDER_DETAIL
    )


def dims(spark):
    return (
        spark.createDataFrame([("5", "F", "1990-01-01")], DIM_USER),
        spark.createDataFrame([("1", "North", "100", "N-1", "R-1")], DIM_PROVINCE),
        spark.createDataFrame([("9", "phone", "99.50", "90", "91", "92"), ("8", "cable", None, "70", None, "92")], DIM_SKU),
        spark.createDataFrame([("90", "phones")], DIM_SPU),
        spark.createDataFrame([("91", "brand")], DIM_TRADEMARK),
        spark.createDataFrame([("92", "devices")], DIM_CATEGORY3),
    )


def test_interval_bounds_are_inclusive(spark, rows):
    left = spark.createDataFrame([(1, 100)], "a BIGINT, s BIGINT").withColumn("t", F.timestamp_seconds("s"))
    right = spark.createDataFrame(
        [(1, 100 + o, o) for o in (-6, -5, 0, 5, 6)] + [(2, 100, 99)], "b BIGINT, r BIGINT, o INT"
    ).withColumn("u", F.timestamp_seconds("r"))
    assert rows(interval_join(left, right, "a", "b", "t", "u"), "o") == [(-5,), (0,), (5,)]


def test_order_wide_and_payment_wide(spark):
    orders = order(spark, (1, "2024-01-01 10:00:00"))
    details = detail(spark, (11, 1, 9, "2024-01-01 10:00:03"), (12, 1, 8, "2024-01-01 09:59:55"),
                     (13, 1, 7, "2024-01-01 10:00:05"), (14, 1, 9, "2024-01-01 10:00:06"))
    user, province, sku, spu, tm, cat = dims(spark)
    wide = order_wide.order_wide(orders, details, user, province, sku, spu, tm, cat, "2024-01-01")
    assert wide.columns == [*ORDER_WIDE_COLUMNS, order_wide.ORDER_TIME]
    got = {r.detail_id: r for r in wide.collect()}
    assert sorted(got) == [11, 12, 13]
    full = got[11]
    assert (full.sku_name, full.spu_name, full.tm_name, full.category3_name) == ("phone", "phones", "brand", "devices")
    assert (full.user_age, full.user_gender, full.province_name) == (34, "F", "North")
    assert (full.create_date, full.create_hour) == ("2024-01-01", "10")
    # A sku without spu and brand rows keeps what it has; an unknown sku keeps the row and its own name.
    assert (got[12].sku_name, got[12].spu_id, got[12].spu_name, got[12].tm_id) == ("cable", 70, None, None)
    assert (got[13].sku_name, got[13].category3_name) == ("old name", None)

    payments = spark.createDataFrame(
        [(100, 1, 6, D("9.99"), "s", "1101", "2024-01-01 10:00:05", None),
         (101, 1, 6, D("9.99"), "s", "1101", "2024-01-01 10:00:06", None)], PAYMENT_INFO
    )
    paid = order_wide.payment_wide(payments, wide).collect()
    assert sorted((r.payment_id, r.detail_id) for r in paid) == [(100, 11), (100, 12), (100, 13)]
    assert {(r.user_id, r.total_amount, r.order_create_time) for r in paid} == {(6, D("9.99"), "2024-01-01 10:00:00")}


def test_enrich_keeps_rows_without_match(spark, rows):
    facts = spark.createDataFrame([(1, 9), (2, 77), (3, None)], "n INT, sku_id BIGINT")
    _, _, sku, spu, tm, cat = dims(spark)
    wide = enrich(facts, product_dim(sku, spu, tm, cat), "sku_id", {"name": "sku_name", "price": F.col("sku_price")})
    assert rows(wide, "n", "name", "price") == [(1, "phone", D("99.50")), (2, None, None), (3, None, None)]


def test_first_non_null(spark):
    layout = f"order_id BIGINT, order_status STRING, sku_name STRING, split_total_amount {AMOUNT}, tm_name STRING"
    one = spark.createDataFrame([(1, None, "a", None, None)], layout)
    other = spark.createDataFrame([(1, "1002", "b", D("3.00"), "tm")], layout)
    assert tuple(order_wide.first_non_null(one, other, ["order_id"]).first()) == (1, "1002", "a", None, None)


def test_age_counts_years_of_365_days(spark):
    df = spark.createDataFrame([("2000-01-01",), ("2023-01-03",), (None,)], "b STRING")
    assert [r[0] for r in df.select(age_years("b", "2024-01-01")).collect()] == [24, 0, None]


def test_camel():
    assert [camel(n) for n in ("sku_name", "iso_3166_2", "ID", "tm_id")] == ["skuName", "iso31662", "id", "tmId"]


def test_nothing_is_forced_to_broadcast_and_no_job_runs_while_planning(spark):
    _, _, sku, spu, tm, cat = dims(spark)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    plan = product_dim(sku, spu, tm, cat)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plan
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_wide_rows_are_not_shuffled_again(spark):
    """The join of orders and details is the last step that moves rows: no exchange of its rows above it."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {key: spark.conf.get(key) for key in keys}
    try:
        spark.conf.set(keys[0], "-1")
        spark.conf.set(keys[1], "false")
        at = "2024-01-01 10:00:00"
        wide = order_wide.order_wide(order(spark, (1, at)), detail(spark, (1, 1, 9, at)), *dims(spark), "2024-01-01")
        payments = spark.createDataFrame([], PAYMENT_INFO)
        plan = order_wide.payment_wide(payments, wide)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    join = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line and "__detail_order" in line)
    level = indent(plan[join])
    for line in reversed(plan[:join]):
        if indent(line) < level:
            level = indent(line)
            assert "Exchange" not in line, line
