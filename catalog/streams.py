"""Registered queries that replay the sample tables through the streaming jobs."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import queries as q
from tradewind.operators import visits
from tradewind.plans import log_split, order_wide, product_stats, sql_jobs, visitor_stats
from tradewind.schemas import KEYWORD_STATS_COLUMNS, PROVINCE_STATS_COLUMNS
from tradewind.session import shared_dir
from tradewind.sources import cdc, tables
from tradewind.sources.sample_tables import EPOCH, PERIOD, SampleTables
from tradewind.streaming import jobs, sinks, stateful


def _new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


def _run(spark: SparkSession, df: DataFrame, path: str, write: sinks.BatchWriter, closes: bool = True) -> None:
    """Run a stream over everything there is."""
    sinks.start(df, f"{path}/checkpoint", write, once=True, closes=closes).awaitTermination()


def _replay(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = _new_dir(spark, name)
    _run(spark, df, path, sinks.table_writer(f"{path}/rows", df.columns))
    return spark.read.schema(df.schema).parquet(f"{path}/rows/batch=*")


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A layer written as a table and read as a stream, as between two jobs."""
    path = _new_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def _in_slices(t: SampleTables, inputs: dict[str, tuple[DataFrame, str]], path: str, run, slices: int = 3) -> None:
    """Feed tables in slices of their times, calling ``run`` with them as streams after each slice.

    Every call is a job started anew on its checkpoint, as after a stop, so the state of the slices
    before carries over.
    """
    bounds = [df.selectExpr(f"min({second})", f"max({second})").first() for df, second in inputs.values()]
    first, last = min(low for low, _ in bounds), max(high for _, high in bounds)
    for k in range(slices):
        for name, (df, second) in inputs.items():
            low, high = (first + (last + 1 - first) * i // slices for i in (k, k + 1))
            low, high = (-(1 << 62) if k == 0 else low), (1 << 62 if k == slices - 1 else high)
            df.filter(f"{second} >= {low} AND {second} < {high}").write.mode("append").option("compression", "zstd").parquet(f"{path}/{name}")
        run({name: t.spark.readStream.schema(df.schema).parquet(f"{path}/{name}") for name, (df, _) in inputs.items()})


def _streams(t: SampleTables) -> SampleTables:
    return SampleTables(t.spark, t.path, stream=True)


@q.query
def stream_new_flag(t: SampleTables) -> DataFrame:
    events = jobs.log_events(_streams(t).log_lines())
    return _replay(t.spark, events.select("seq", "mid", "is_new", "ts"), "new_flag")


@q.query
def stream_uv_daily(t: SampleTables) -> DataFrame:
    """Which of a visitor's rows of a day comes first is up to arrival; the visitor and day are not."""
    visits_of_day = jobs.daily_unique(_streams(t).page_log())
    return _replay(t.spark, visits_of_day.select("dt", "mid"), "uv_daily")


@q.query
def stream_jump_detail(t: SampleTables) -> DataFrame:
    """Bounces over three runs of the job, each a day range of the pages, with state carried over."""
    path, columns = _new_dir(t.spark, "jump_detail"), ["mid", "seq", "ts", "page_id", "kind"]

    def run(s: dict[str, DataFrame]) -> None:
        jobs.jumps(s["pages"], path, within_ms=q.JUMP_MS, once=True).awaitTermination()

    _in_slices(t, {"pages": (t.page_log(), "ts div 1000")}, f"{path}/in", run)
    text = t.spark.read.text(f"{path}/rows/batch=*")
    schema = "mid STRING, seq BIGINT, ts BIGINT, page_id STRING, kind STRING"
    return text.select(F.from_json("value", schema).alias("row")).select(*[f"row.{c}" for c in columns])


@q.query
def stream_order_wide(t: SampleTables) -> DataFrame:
    """Stream-stream interval join with lookups in all six dimensions."""
    s, path = _streams(t), _new_dir(t.spark, "order_wide")
    dims = [t.dim_user(), t.dim_province(), t.dim_sku(), t.dim_spu(), t.dim_trademark(), t.dim_category3()]
    jobs.wide_orders(s.order_info(), s.order_detail(), *dims, as_of=q.AS_OF, path=path, once=True).awaitTermination()
    stored = q.wide_orders(t).drop(order_wide.ORDER_TIME).schema
    text = t.spark.read.text(f"{path}/rows/batch=*")
    return text.select(F.from_json("value", stored).alias("row")).select("row.*")


@q.query
def stream_payment_wide(t: SampleTables) -> DataFrame:
    """Two jobs with JSON text between them: orders with details, then payments with those; three runs."""
    path, second = _new_dir(t.spark, "payment_wide"), "unix_timestamp(create_time)"
    inputs = {"orders": t.order_info(), "details": t.order_detail(), "payments": t.payment_info()}
    columns = ["payment_id", "order_id", "detail_id", "sku_id", "split_total_amount", "payment_create_time"]
    facts = q.order_facts(t).schema

    def run(s: dict[str, DataFrame]) -> None:
        rows = order_wide.order_facts(s["orders"], s["details"])
        _run(t.spark, rows, f"{path}/facts", sinks.json_writer(f"{path}/facts/rows"), closes=False)
        stored = tables.json_stream(t.spark, f"{path}/facts/rows", facts)
        jobs.wide_payments(s["payments"], stored, f"{path}/paid", once=True).awaitTermination()

    _in_slices(t, {name: (df, second) for name, df in inputs.items()}, path, run)
    paid = order_wide.payment_wide(t.payment_info(), q.order_facts(t)).drop(order_wide.PAYMENT_TIME).schema
    text = t.spark.read.text(f"{path}/paid/rows/batch=*")
    return text.select(F.from_json("value", paid).alias("row")).select(*[F.col(f"row.{c}").alias(c) for c in columns])


@q.query
def stream_keyword_stats(t: SampleTables) -> DataFrame:
    """Searched words per window over three runs of the job, which goes on from its checkpoint."""
    path = _new_dir(t.spark, "keywords")

    def run(s: dict[str, DataFrame]) -> None:
        jobs.keywords(s["pages"], path, F.col("source"), once=True).awaitTermination()

    _in_slices(t, {"pages": (t.search_pages(), "ts div 1000")}, f"{path}/in", run)
    return tables.read_stats(t.spark, f"{path}/rows").select(*KEYWORD_STATS_COLUMNS)


@q.query
def stream_keyword_cjk(t: SampleTables) -> DataFrame:
    """Words of searches written in ideographs, by a dictionary of part names: two jobs, three runs."""
    path, schema = _new_dir(t.spark, "keyword_cjk"), "source STRING, ts BIGINT, word STRING, ct BIGINT"

    def run(s: dict[str, DataFrame]) -> None:
        named = lambda: q.cjk_dictionary(t)
        jobs.keyword_words(s["pages"], named, f"{path}/words", F.col("source"), once=True, counted=True).awaitTermination()
        words = tables.json_stream(t.spark, f"{path}/words/rows", schema)
        jobs.word_counts(words, f"{path}/counts", once=True).awaitTermination()

    pages = t.search_pages().withColumn("item", q.ideographs("item"))
    _in_slices(t, {"pages": (pages, "ts div 1000")}, f"{path}/in", run)
    return tables.read_stats(t.spark, f"{path}/counts/rows").select(*KEYWORD_STATS_COLUMNS)


def _sql_job(t: SampleTables, name: str, rows: DataFrame, second: str, job, view: tuple[str, str], columns: list[str]) -> DataFrame:
    """A job of SQL text over JSON text, in three runs."""
    path = _new_dir(t.spark, name)
    lines = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"), F.expr(second).alias("second"))

    def run(s: dict[str, DataFrame]) -> None:
        jobs.sql_stats(sql_jobs.with_time(s["lines"], *view), job, path, columns, once=True).awaitTermination()

    _in_slices(t, {"lines": (lines, "second")}, f"{path}/in", run)
    return tables.read_stats(t.spark, f"{path}/rows").select(*columns)


@q.query
def sql_keyword_stats(t: SampleTables) -> DataFrame:
    view, columns = (sql_jobs.SEARCH_PAGES, sql_jobs.PAGE_TIME), KEYWORD_STATS_COLUMNS
    return _sql_job(t, "sql_keywords", t.search_pages(), "ts div 1000", sql_jobs.keyword_job, view, columns)


@q.query
def sql_province_stats(t: SampleTables) -> DataFrame:
    wide = order_wide.with_province(q.order_facts(t), t.dim_province())
    rows = wide.selectExpr(*[c.split()[0] for c in sql_jobs.WIDE_ORDERS.split(", ")])
    view, columns = (sql_jobs.WIDE_ORDERS, sql_jobs.WIDE_TIME), PROVINCE_STATS_COLUMNS
    return _sql_job(t, "sql_provinces", rows, "unix_timestamp(create_time)", sql_jobs.province_job, view, columns)


@q.query
def stream_new_flag_two_days(t: SampleTables) -> DataFrame:
    """A table job over the first half, then a stream that starts with the visitors it has seen."""
    spark, heads = t.spark, ["seq", "mid", "is_new", "ts"]
    events = log_split.heads(t.log_lines())
    early = events.filter(f"ts < {q.MIDDLE_MS}")
    late = _stored(spark, events.filter(f"ts >= {q.MIDDLE_MS}"), "late_heads")
    repaired = stateful.repair_new_flag_stream(late, seen=visits.seen_visitors(early))
    rest = _replay(spark, repaired.select(*heads), "new_flag_late")
    return visits.repair_new_flag(early.select(*heads)).unionByName(rest)


@q.query
def stream_late_rows_rows(t: SampleTables) -> DataFrame:
    """Every fiftieth page view arrives in the last of three runs; those behind the watermark are told apart."""
    path = _new_dir(t.spark, "late_rows")
    pages = t.page_log().select("seq", "mid", "page_id", "ts")

    def run(s: dict[str, DataFrame]) -> None:
        jobs.without_late(s["pages"], path, once=True).awaitTermination()

    arrives = f"if(seq % 50 = 0, {EPOCH + PERIOD - 1}, ts div 1000)"
    _in_slices(t, {"pages": (pages, arrives)}, f"{path}/in", run)
    rows = lambda kind: t.spark.read.schema(pages.schema).parquet(f"{path}/rows/{kind}/batch=*")
    on_time, late = (rows(kind).withColumn("late", F.lit(kind == "late")) for kind in ("on_time", "late"))
    return on_time.unionByName(late)


@q.query
def stream_visitor_stats(t: SampleTables) -> DataFrame:
    uv = _stored(t.spark, visits.daily_unique(t.page_log()), "uv_rows")
    uj = _stored(t.spark, q.jumps(t), "jump_rows")
    return _replay(t.spark, visitor_stats.visitor_stats(_streams(t).page_log(), uv, uj), "visitor_stats")


@q.query
def stream_product_stats(t: SampleTables) -> DataFrame:
    path, activity = _new_dir(t.spark, "product_stats"), _stored(t.spark, q.product_activity(t), "activity_rows")
    jobs.products(activity, path, once=True).awaitTermination()
    stored = q.products_by_window(t).schema
    return t.spark.read.schema(stored).parquet(f"{path}/rows").select(*product_stats.COLUMNS)


@q.query
def stream_province_stats(t: SampleTables) -> DataFrame:
    wide = order_wide.with_province(q.order_facts(t), t.dim_province())
    path, rows = _new_dir(t.spark, "province_stats"), _stored(t.spark, wide, "wide_rows")
    jobs.provinces(rows, path, once=True).awaitTermination()
    stored = q.provinces(t).schema
    return t.spark.read.schema(stored).parquet(f"{path}/rows").select(*PROVINCE_STATS_COLUMNS)


@q.query
def stream_dim_upsert(t: SampleTables) -> DataFrame:
    """Changes routed by the rules, dimension rows merged into a keyed store."""
    path = _new_dir(t.spark, "routed")
    store = sinks.KeyedTable(t.spark, f"{path}/dims", ["sink_table", "id"], part="sink_table")
    changes = cdc.normalise(_streams(t).cdc_records())
    jobs.route_changes(changes, t.routing_rules, path, store, once=True).awaitTermination()
    after = F.col("after")
    columns = ["name", "gender", "birthday", "sku_name", "price"]
    return store.read().select("sink_table", "id", "seq", *[after[c].alias(c) for c in columns])
