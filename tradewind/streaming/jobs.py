"""The streaming jobs: the batch plans over streams, with the stateful operators swapped in.

Jobs are materialised between layers (topic or table), as each has its own event-time clock: a job takes
its inputs as streams, for instance another job's rows by ``tables.json_stream``, and a folder for its
checkpoint (``job``) and its rows (``rows``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewind.functions.json_text import with_parsed
from tradewind.functions.times import at_ms, at_second, day_text
from tradewind.operators.visits import is_entry
from tradewind.operators.windows import SIZE, held
from tradewind.plans import (
    keyword_stats,
    log_split,
    order_wide,
    product_stats,
    province_stats,
    visitor_stats,
)
from tradewind.plans.order_wide import ORDER_TIME
from tradewind.schemas import KEYWORD_STATS_COLUMNS, PROVINCE_STATS_COLUMNS
from tradewind.streaming import sinks
from tradewind.streaming.stateful import bounces_stream, mark_late, repair_new_flag_stream


def log_events(lines: DataFrame, ttl_ms: int | None = None, seen: DataFrame | None = None) -> DataFrame:
    """Clean, repaired log lines; ``log_split.starts``, ``pages`` and ``displays`` split them.

    ``seen``: the visitors of earlier runs, for a job that starts anew."""
    fixed = repair_new_flag_stream(log_split.heads(lines), ttl_ms, seen)
    return log_split.put_flag(log_split.open_parts(with_parsed(fixed, "value", "line")))


def log_outputs() -> dict:
    """The named outputs of the log split, for ``sinks.fan_out``."""
    return {"start": log_split.starts, "page": log_split.pages, "display": log_split.displays}


def daily_unique(pages: DataFrame, keep: str = "24 hours") -> DataFrame:
    """First entry page per visitor and day as it arrives; state lives ``keep`` past the event time.

    The delay holds nothing back, but it must not be shared with a later window.
    """
    entries = pages.filter(is_entry()).withColumns({"dt": day_text("ts"), "event_time": at_ms("ts")})
    return (
        entries.withWatermark("event_time", keep)
        .dropDuplicatesWithinWatermark(["mid", "dt"])
        .drop("event_time")
    )


def _job(
    rows: DataFrame, path: str, writer: Callable[[str], sinks.BatchWriter], once: bool, closes: bool = True
) -> StreamingQuery:
    return sinks.start(rows, f"{path}/job", writer(f"{path}/rows"), once, closes=closes)


def base_log(lines: DataFrame, path: str, once: bool = False) -> list[StreamingQuery]:
    """Raw lines to start, page and display logs, and the dirty lines as they came."""
    split = sinks.start(log_events(lines), f"{path}/job", sinks.fan_out(log_outputs(), f"{path}/rows"), once)
    dirty = sinks.start(log_split.dirty(lines), f"{path}/dirty_job", sinks.table_writer(f"{path}/rows/dirty"), once)
    return [split, dirty]


def unique_visits(pages: DataFrame, path: str, once: bool = False) -> StreamingQuery:
    return _job(daily_unique(pages), path, sinks.json_writer, once)


def jumps(pages: DataFrame, path: str, within_ms: int = 10_000, once: bool = False) -> StreamingQuery:
    return _job(bounces_stream(pages, within_ms=within_ms), path, sinks.json_writer, once)


def wide_orders(orders: DataFrame, details: DataFrame, *dims: DataFrame, as_of: str, path: str, once: bool = False) -> StreamingQuery:
    """Orders with details and the six dimensions (user, province, sku, spu, trademark, category)."""
    wide = order_wide.order_wide(orders, details, *dims, as_of).drop(order_wide.ORDER_TIME)
    return _job(wide, path, sinks.json_writer, once, closes=False)


def wide_orders_by_batch(
    orders: DataFrame, details: DataFrame, load_dims: Callable[[], dict[str, DataFrame]], as_of: str, path: str, once: bool = False
) -> StreamingQuery:
    """As ``wide_orders``, with dimensions that change while the job runs.

    Only the interval join is a stream; each batch of joined rows looks its dimensions up in what
    ``load_dims`` reads at that moment (by name: users, provinces, sku, spu, trademark, category3), for
    instance from a keyed table that another job writes.
    """

    def writer(out: str) -> sinks.BatchWriter:
        store = sinks.json_writer(out)

        def write(batch: DataFrame, number: int) -> None:
            wide = order_wide.with_dimensions(batch, as_of=as_of, **load_dims())
            store(wide.drop(order_wide.ORDER_TIME), number)

        return write

    return _job(order_wide.order_facts(orders, details), path, writer, once, closes=False)


def wide_payments(payments: DataFrame, wide: DataFrame, path: str, delay: str = "10 seconds", once: bool = False) -> StreamingQuery:
    """Payments with stored order rows; ``delay`` covers how late an order row can be written."""
    paid = order_wide.payment_wide(payments, wide, delay=delay).drop(order_wide.PAYMENT_TIME)
    return _job(paid, path, sinks.json_writer, once, closes=False)


def route_changes(
    changes: DataFrame, load_rules: Callable[[], DataFrame], path: str, dims: sinks.KeyedTable, create=None,
    versioned: bool = False, once: bool = False,
) -> StreamingQuery:
    """Row changes split by the rules of each batch or change: facts by topic, rejects, dimension rows."""
    return _job(changes, path, lambda out: sinks.route_writer(load_rules, out, dims, create, versioned), once)


def without_late(rows: DataFrame, path: str, ms: str = "ts", delay: str = "1 second", once: bool = False) -> StreamingQuery:
    """Rows in time for windows with this ``delay`` (``on_time``), and a reject table of the others (``late``)."""
    outputs = {
        "on_time": lambda batch: batch.filter("NOT late").drop("late"),
        "late": lambda batch: batch.filter("late").drop("late"),
    }
    return _job(mark_late(rows, ms, delay), path, lambda out: sinks.fan_out(outputs, out), once)


def _stats(rows: DataFrame, path: str, once: bool) -> StreamingQuery:
    return _job(rows, path, lambda out: sinks.stats_writer(out, rows.columns), once)


def window_stats(
    rows: DataFrame, time: str, plan: Callable[[DataFrame], DataFrame], path: str, columns: list[str], delay: str,
    size: str = SIZE, once: bool = False, by: list[str] | None = None,
) -> StreamingQuery:
    """Statistics per window by a plan over tables: rows are held until their window is over
    (``windows.held``) and the plan runs on what each batch lets go. ``plan`` must group by that window, and by
    the columns ``by``, if it is given and the plan is one that makes use of where the rows lie."""
    partitions = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    writer = lambda out: sinks.by_batch(plan, sinks.stats_writer(out, columns), partitions)
    return _job(held(rows, time, size, delay, by=by), path, writer, once)


def visitors(pages: DataFrame, uv: DataFrame, uj: DataFrame, path: str, once: bool = False) -> StreamingQuery:
    return _stats(visitor_stats.visitor_stats(pages, uv, uj), path, once)


def products(activity: DataFrame, path: str, once: bool = False) -> StreamingQuery:
    return window_stats(
        activity, product_stats.TIME, product_stats.product_stats, path, product_stats.COLUMNS, product_stats.DELAY, once=once,
        by=["sku_id"],
    )


def provinces(wide: DataFrame, path: str, once: bool = False) -> StreamingQuery:
    rows = province_stats.timed(wide)
    return window_stats(
        rows, ORDER_TIME, province_stats.province_stats, path, PROVINCE_STATS_COLUMNS, province_stats.DELAY, once=once
    )


def keywords(pages: DataFrame, path: str, source=keyword_stats.SEARCH, once: bool = False) -> StreamingQuery:
    """Pages are held as they are; their words are split and counted when the window is over."""
    source = F.lit(source) if isinstance(source, str) else source
    searched = keyword_stats.searches(pages).select("last_page_id", "item", source.alias("source"), "ts")
    timed = searched.withColumn("event_time", at_second("ts"))
    plan = lambda batch: keyword_stats.keyword_stats(batch, source=F.col("source"), deal=False)
    return window_stats(timed, "event_time", plan, path, KEYWORD_STATS_COLUMNS, keyword_stats.DELAY, once=once)


def keyword_words(
    pages: DataFrame, load_dictionary: Callable[[], DataFrame], path: str, source=keyword_stats.SEARCH, once: bool = False,
    counted: bool = False,
) -> StreamingQuery:
    """Searched words, CJK text by a dictionary that is read anew for every batch, as JSON rows.

    Looking up a run takes several steps over all its places, which is work for a batch; the windows
    over its rows are a job of their own (``word_counts``). ``counted``: equal words of a batch with the same
    source and time are one row with their number (``ct``) instead of a row each.
    """
    words = keyword_stats.search_word_counts if counted else keyword_stats.search_words
    plan = lambda batch: words(batch, load_dictionary(), source)
    partitions = pages.sparkSession.conf.get("spark.sql.shuffle.partitions")
    writer = lambda out: sinks.by_batch(plan, sinks.json_writer(out), partitions, coalesce=False)
    return _job(pages, path, writer, once)


def word_counts(words: DataFrame, path: str, once: bool = False) -> StreamingQuery:
    """Words per window of the rows of ``keyword_words``, counted or not."""
    columns = [c for c in ("source", "ts", "word", "ct") if c in words.columns]
    timed = words.select(*columns).withColumn("event_time", at_second("ts"))
    return window_stats(
        timed, "event_time", keyword_stats.count_words, path, KEYWORD_STATS_COLUMNS, keyword_stats.DELAY, once=once
    )


def sql_stats(
    timed: DataFrame, job: Callable[[SparkSession, DataFrame], DataFrame], path: str, columns: list[str],
    delay: str = "1 second", once: bool = False,
) -> StreamingQuery:
    """A job of SQL text over lines with their event time (``sql_jobs.with_time``): the text is held by that
    time, the statement runs on what each batch lets go."""
    plan = lambda batch: job(batch.sparkSession, batch.select("value"))
    return window_stats(timed, "row_time", plan, path, columns, delay, once=once)
