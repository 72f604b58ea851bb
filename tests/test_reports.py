from decimal import Decimal

from pyspark.sql import functions as F

from tradewind.functions.numbers import ratio_half_up
from tradewind.plans import reports
from tradewind.sources import tables
from tradewind.streaming import sinks

D = Decimal
DAY = "20240102"
VISITOR = "stt STRING, is_new STRING, uv_ct BIGINT, pv_ct BIGINT, sv_ct BIGINT, uj_ct BIGINT, dur_sum BIGINT"
PRODUCT = "stt STRING, spu_id BIGINT, spu_name STRING, tm_id BIGINT, tm_name STRING, order_amount DECIMAL(38,2), order_ct BIGINT"


def test_ratio_rounds_half_up_once(spark):
    df = spark.createDataFrame(
        [(1, 8), (1, 3), (2, 3), (5, 0), (0, 7), (444_999_999_999, 1_000_000_000_000)], "a BIGINT, b BIGINT"
    )
    got = df.select(ratio_half_up(F.col("a"), F.col("b"), 2).alias("r")).collect()
    assert [r.r for r in got] == [D("0.13"), D("0.33"), D("0.67"), D("0.00"), D("0.00"), D("0.44")]


def test_new_and_old(spark):
    stats = spark.createDataFrame(
        [("2024-01-02 00:00:00", "1", 3, 10, 8, 1, 12_345), ("2024-01-02 10:00:00", "0", 1, 4, 0, 0, 99),
         ("2024-01-01 00:00:00", "1", 50, 50, 50, 50, 50)], VISITOR
    )
    got = {r.type: (r.new, r.old) for r in reports.new_and_old(stats, DAY).collect()}
    assert got == {
        "visitors": (D(3), D(1)), "pages": (D(10), D(4)), "bounce_percent": (D("12.50"), D(0)),
        "seconds_per_session": (D("1.5"), D(0)), "pages_per_session": (D("1.25"), D(0)),
    }
    none = reports.new_and_old(stats, "20240103").collect()
    assert all((r.new, r.old) == (D(0), D(0)) for r in none) and len(none) == 5


def test_no_visitors_means_zero_rates(spark):
    stats = spark.createDataFrame([("2024-01-02 00:00:00", "1", 0, 9, 2, 1, 10)], VISITOR)
    got = {r.type: r.new for r in reports.new_and_old(stats, DAY).collect()}
    assert got["bounce_percent"] == 0 and got["pages_per_session"] == 0 and got["pages"] == 9


def test_hourly_fills_all_hours(spark):
    stats = spark.createDataFrame(
        [("2024-01-02 00:10:00", "1", 2, 5, 0, 0, 0), ("2024-01-02 13:00:10", "0", 1, 4, 0, 0, 0),
         ("2024-01-02 13:59:50", "1", 3, 1, 0, 0, 0)], VISITOR
    )
    got = {r.hr: (r.uv, r.pv, r.new_uv) for r in reports.hourly(stats, DAY).collect()}
    assert sorted(got) == [f"{h:02d}" for h in range(24)]
    assert got["00"] == (2, 5, 2) and got["13"] == (4, 5, 3) and got["07"] == (0, 0, 0)


def test_top_products(spark):
    stats = spark.createDataFrame(
        [("2024-01-02 00:00:00", i, f"s{i}", i % 2, f"t{i % 2}", D(a), 1) for i, a in
         [(1, "5.00"), (2, "7.00"), (3, "7.00"), (4, "0.00"), (5, "1.00")]]
        + [("2024-01-03 00:00:00", 5, "s5", 1, "t1", D("99.00"), 1)], PRODUCT
    )
    assert [tuple(r) for r in reports.spu_top(stats, DAY, 3).collect()] == [
        ("s2", D("7.00"), 1), ("s3", D("7.00"), 1), ("s1", D("5.00"), 1)
    ]
    assert len(reports.spu_top(stats, DAY).collect()) == 4  # nothing sold, nothing shown
    assert tuple(reports.trademark_arrays(stats, DAY).first()) == (["t1", "t0"], [D("13.00"), D("7.00")])
    assert reports.gmv(stats, DAY).first()[0] == D("20.00")
    # A stored table with day partitions gives the same.
    stored = stats.withColumn("dt", F.substring("stt", 1, 10))
    assert reports.gmv(stored, DAY).first()[0] == D("20.00")


def test_keyword_weights_and_raw_ranking(spark):
    stats = spark.createDataFrame(
        [("w", 1, s, "2024-01-02 00:00:00") for s in ("SEARCH", "ORDER", "CART", "CLICK", "other")]
        + [("many", 6, "other", "2024-01-02 00:00:00"), ("top", 5, "SEARCH", "2024-01-02 00:00:00")],
        "keyword STRING, ct BIGINT, source STRING, stt STRING",
    )
    assert [tuple(r) for r in reports.keywords(stats, DAY).collect()] == [("many", 0), ("top", 50), ("w", 16)]


def test_row_counts(spark):
    stats = spark.createDataFrame([("2024-01-02 00:00:00", "1", 2, None, 0, 0, 0)], VISITOR)
    assert tuple(reports.row_counts(stats, DAY).first()) == (0, 1)


def test_stored_statistics_are_sorted_by_a_number(spark, rows, tmp_path):
    """the day a writer sorts by is a date; folders and rows are those of its text."""
    stats = spark.createDataFrame(
        [("2024-01-02 23:59:50", 1), ("2024-01-01 00:00:00", 2), (None, 3), ("2024-01-02 00:00:00", 4)], "stt STRING, n INT"
    )
    assert dict(tables.with_day(stats).dtypes)["dt"] == "date"
    sinks.stats_writer(f"{tmp_path}/stats", stats.columns)(stats, 0)
    folders = {p.name for p in (tmp_path / "stats").rglob("dt=*")}
    assert folders == {"dt=2024-01-01", "dt=2024-01-02", "dt=__HIVE_DEFAULT_PARTITION__"}
    stored = tables.read_stats(spark, f"{tmp_path}/stats")
    assert rows(stored, "stt", "n") == rows(stats) and rows(reports.on_day(stored, "20240102"), "n") == [(1,), (4,)]
