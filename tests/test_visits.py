import random

import pytest
from pyspark.sql import functions as F

from tradewind.operators.visits import CELLS, bounces, cells, daily_unique, following_events, repair_new_flag, seen_visitors

PAGES = "seq BIGINT, mid STRING, ts BIGINT, last_page_id STRING"
DAY = 86_400_000


def pages(spark, data):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(data)], PAGES)


def naive_bounces(data, within):
    out, by_mid = [], {}
    for seq, (mid, ts, last) in enumerate(data):
        by_mid.setdefault(mid, []).append((ts, seq, not last))
    for events in by_mid.values():
        events.sort()
        for here, after in zip(events, events[1:] + [None]):
            if here[2] and not (after and after[0] - here[0] < within and not after[2]):
                soon = after is not None and after[0] - here[0] < within
                out.append((here[1], "match" if soon else "timeout"))
    return sorted(out, key=repr)


def test_daily_unique(spark, rows):
    df = pages(
        spark,
        [("a", 5, "home"), ("a", 10, None), ("a", 20, ""), ("a", DAY - 1, None), ("a", DAY, None),
         ("b", DAY + 7, ""), ("b", DAY + 3, "home")],
    )
    assert rows(daily_unique(df), "mid", "dt", "seq") == [
        ("a", "1970-01-01", 1), ("a", "1970-01-02", 4), ("b", "1970-01-02", 5)
    ]


def test_bounce_rule(spark, rows):
    df = pages(
        spark,
        [("a", 1000, None), ("a", 9000, "home"), ("b", 1000, ""), ("c", 2000, None), ("c", 5000, None),
         ("d", 1000, None), ("d", 30000, "home"), ("z", 60000, None),
         ("e", 1000, None), ("e", 11000, "home"), ("f", 1000, None), ("f", 10999, "home")],
    )
    assert rows(bounces(df), "mid", "ts", "kind") == [
        ("b", 1000, "timeout"), ("c", 2000, "match"), ("c", 5000, "timeout"), ("d", 1000, "timeout"),
        ("e", 1000, "timeout"), ("z", 60000, "timeout"),
    ]


@pytest.mark.parametrize("slice_ms", [None, 10_000, 13_000])
def test_bounces_equal_the_rule_applied_naively(spark, rows, slice_ms):
    """One visitor owns a third of the rows; events cluster around slice borders."""
    rnd = random.Random(7)
    data = []
    for _ in range(1500):
        mid = "hot" if rnd.random() < 0.34 else f"m{rnd.randrange(40)}"
        ts = rnd.choice([rnd.randrange(2_000_000), rnd.randrange(30) * 60_000 + rnd.randrange(-50, 50) + 60_000])
        data.append((mid, ts, rnd.choice([None, "", "home", "home"])))
    found = bounces(pages(spark, data), slice_ms=slice_ms)
    assert rows(found, "seq", "kind") == naive_bounces(data, 10_000)


def test_no_group_holds_a_blank_visitor(spark, rows):
    """A blank and a missing visitor own most rows of one slice; no group and no task gets many of them."""
    rnd = random.Random(8)
    data = [(rnd.choice(["", None, "", f"m{rnd.randrange(9)}"]), rnd.randrange(60_000), rnd.choice([None, "home"])) for _ in range(8000)]
    df = pages(spark, data)
    assert rows(bounces(df, slice_ms=60_000), "seq", "kind") == naive_bounces(data, 10_000)
    assert rows(bounces(df), "seq", "kind") == naive_bounces(data, 10_000)
    events = cells(df, 10_000 // CELLS)
    largest = events.groupBy("__visitor", "__cell").count().selectExpr("max(count)").first()[0]
    assert largest < len(data) / 50
    tasks = events.repartition(4, "__visitor", "__cell").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < len(data) / 2
    # What is known about a cell is one event, whatever it holds.
    assert following_events(events.drop("__page")).count() == events.select("__visitor", "__cell").distinct().count()


def test_bounces_of_extra_columns_and_rows_without_time(spark, rows):
    df = pages(spark, [("a", None, None), ("a", -5, None), (None, -3, "x"), (None, -3, None)]).withColumn("next", F.lit(1))
    assert rows(bounces(df), "seq", "mid", "kind", "next") == [(1, "a", "timeout", 1), (3, None, "timeout", 1)]


def test_slice_must_cover_the_window(spark):
    with pytest.raises(ValueError):
        bounces(pages(spark, [("a", 1, None)]), within_ms=10_000, slice_ms=5_000)


def test_repair_equals_the_rule_applied_naively(spark, rows):
    rnd = random.Random(3)
    data = [("hot" if rnd.random() < 0.34 else f"m{rnd.randrange(30)}", rnd.choice("01"), rnd.randrange(500), i)
            for i in range(1200)]
    want, seen = [], set()
    for mid, flag, ts, seq in sorted(data, key=lambda r: (r[2], r[3])):
        want.append((seq, "0" if flag == "1" and mid in seen else flag))
        if flag == "1":
            seen.add(mid)
    df = spark.createDataFrame(data, "mid STRING, is_new STRING, ts BIGINT, seq BIGINT")
    assert rows(repair_new_flag(df), "seq", "is_new") == sorted(want, key=repr)


def test_repair_goes_on_from_the_visitors_seen_before(spark, rows):
    layout = "mid STRING, is_new STRING, ts BIGINT, seq BIGINT"
    day1 = spark.createDataFrame([("a", "1", 5, 1), ("b", "0", 6, 2), (None, "1", 7, 3), ("a", "1", 8, 4)], layout)
    day2 = spark.createDataFrame([("a", "1", 15, 5), ("b", "1", 16, 6), (None, "1", 17, 7), ("c", None, 18, 8)], layout)
    seen = seen_visitors(day1)
    assert rows(seen) == [("a",), (None,)]
    assert rows(repair_new_flag(day2, seen=seen), "seq", "is_new") == [(5, "0"), (6, "1"), (7, "0"), (8, None)]
    assert rows(seen_visitors(day2, seen=seen)) == [("a",), ("b",), (None,)]
    plan = repair_new_flag(day2)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_repair_orders_nulls_negatives_and_large_numbers(spark, rows):
    layout = "mid STRING, is_new STRING, ts BIGINT, seq BIGINT"
    big = (1 << 63) - 1
    df = spark.createDataFrame(
        [("a", "1", -3, big), ("a", "1", -2, 0), ("b", "1", None, 5), ("b", "1", -big, 1), ("c", "1", big, big), ("c", "1", big, -big)],
        layout,
    )
    assert rows(repair_new_flag(df).filter("is_new = '1'"), "mid", "seq") == [("a", big), ("b", 5), ("c", -big)]
