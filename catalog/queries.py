"""The registered queries: every warehouse operator over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.names import camel_columns
from tradewind.functions.times import text_ms, time_text
from tradewind.functions.words import spaced_words, split_words
from tradewind.operators import routing, upsert, visits, windows
from tradewind.operators.enrichment import enrich, product_dim
from tradewind.operators.intervals import interval_join
from tradewind.operators.windows import in_day, tumble_distinct
from tradewind.plans import (
    keyword_stats,
    log_split,
    order_wide,
    product_stats,
    province_stats,
    reports,
    visitor_stats,
)
from tradewind.schemas import ROUTING_RULE
from tradewind.session import prepare, shared_dir
from tradewind.sources import cdc, tables
from tradewind.sources.sample_tables import SampleTables
from tradewind.streaming import sinks

DAY = "20240115"
AS_OF = "2024-01-31"
JUMP_MS = 3_600_000
MIDDLE_MS = 1_705_363_200_000  # 2024-01-16
# Stand-ins for text without word breaks: one ideograph per small letter.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
IDEOGRAPHS = "".join(chr(0x4E00 + i) for i in range(26))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def sized(spark: SparkSession) -> SparkSession:
    """A local session left at Spark's 200 shuffle partitions gets one per core, once and for good."""
    key = "spark.sql.shuffle.partitions"
    if spark.sparkContext.master.startswith("local[") and spark.conf.get(key) == "200":
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    return spark


def query(fn: Callable[[SampleTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(SampleTables(sized(prepare(spark)), sf_dir))

    # Functions that would hide an imported module carry a suffix.
    QUERIES[fn.__name__.removesuffix("_rows")] = run
    return run


# -- layers -------------------------------------------------------------------------------------


def products(t: SampleTables) -> DataFrame:
    return product_dim(t.dim_sku(), t.dim_spu(), t.dim_trademark(), t.dim_category3())


def order_facts(t: SampleTables) -> DataFrame:
    return order_wide.order_facts(t.order_info(), t.order_detail())


def wide_orders(t: SampleTables) -> DataFrame:
    return order_wide.order_wide(
        t.order_info(), t.order_detail(), t.dim_user(), t.dim_province(),
        t.dim_sku(), t.dim_spu(), t.dim_trademark(), t.dim_category3(), AS_OF,
    )


def jumps(t: SampleTables) -> DataFrame:
    return visits.bounces(t.page_log(), within_ms=JUMP_MS)


def visitors(t: SampleTables) -> DataFrame:
    return visitor_stats.visitor_stats(t.page_log(), visits.daily_unique(t.page_log()), jumps(t))


def visitors_of_day(t: SampleTables, day: str) -> DataFrame:
    """Visitor statistics of one day: bounces look one bounce time past its end, the rest not at all."""
    pages = t.page_log().withColumn("time", F.timestamp_millis("ts"))
    today = in_day(pages, "time", day)
    ahead = in_day(pages, "time", day, f"{JUMP_MS // 1000} seconds")
    bounced = visits.bounces(ahead, within_ms=JUMP_MS)
    return visitor_stats.visitor_stats(today, visits.daily_unique(today), bounced, day=day)


def product_activity(t: SampleTables) -> DataFrame:
    facts = order_facts(t)
    rest = product_stats.activity(
        t.page_log(), t.favor_info(), t.cart_info(), refund=t.refund_info(), comment=t.comment_info()
    )
    return rest.unionByName(product_stats.order_activity(facts, t.payment_info()))


def products_by_window(t: SampleTables, day: str | None = None) -> DataFrame:
    return product_stats.product_stats(product_activity(t), day=day)


def products_named(t: SampleTables, day: str | None = None) -> DataFrame:
    return product_stats.with_product(products_by_window(t, day), products(t))


def provinces(t: SampleTables, day: str | None = None) -> DataFrame:
    wide = order_wide.with_province(order_facts(t), t.dim_province())
    return province_stats.province_stats(wide, day=day)


def keywords(t: SampleTables, day: str | None = None) -> DataFrame:
    return keyword_stats.keyword_stats(t.search_pages(), source=F.col("source"), day=day)


def ideographs(text: str) -> Column:
    return F.translate(text, LETTERS, IDEOGRAPHS)


def cjk_dictionary(t: SampleTables) -> DataFrame:
    cut = t.table("part").select(F.expr("substring(p_name, 1, CAST(1 + p_partkey % 7 AS INT))").alias("word"))
    return cut.filter("word NOT LIKE '% %'").select(ideographs("word").alias("word"))


def routed(t: SampleTables) -> DataFrame:
    return routing.route(cdc.normalise(t.cdc_records()), t.routing_rules())


def dimension_rows(t: SampleTables) -> DataFrame:
    changes = upsert.blank_nulls(routing.dimension_changes(routed(t)))
    return upsert.latest(changes, ["sink_table", "id"])


# -- sources, log split ---------------------------------------------------------------------------


@query
def src_log_text(t: SampleTables) -> DataFrame:
    """Land the raw lines as day-partitioned text and read them back."""
    path = f"{shared_dir(t.spark)}/log_text-{uuid4().hex}"
    tables.land_lines(t.log_lines(), path)
    lines = tables.text_lines(t.spark, path)
    return lines.groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count("value").alias("line_ct"), F.sum(F.length("value")).alias("char_ct")
    )


@query
def csv_load(t: SampleTables) -> DataFrame:
    """Write customers as CSV with header lines and load them without."""
    path = f"{shared_dir(t.spark)}/csv-{uuid4().hex}"
    rows = t.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    tables.write_csv(rows, path)
    return tables.read_csv(
        t.spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING"
    )


@query
def log_dirty(t: SampleTables) -> DataFrame:
    return log_split.dirty(t.log_lines())


@query
def log_is_new_fix(t: SampleTables) -> DataFrame:
    return visits.repair_new_flag(log_split.clean(t.log_lines())).select("seq", "mid", "is_new", "ts")


@query
def log_is_new_two_days(t: SampleTables) -> DataFrame:
    """Two runs, the second with the visitors of the first, give what one run over both gives."""
    events = log_split.heads(t.log_lines()).select("seq", "mid", "is_new", "ts")
    early, late = events.filter(f"ts < {MIDDLE_MS}"), events.filter(f"ts >= {MIDDLE_MS}")
    seen = visits.seen_visitors(early)
    return visits.repair_new_flag(early).unionByName(visits.repair_new_flag(late, seen=seen))


@query
def log_page_json(t: SampleTables) -> DataFrame:
    """Lines with a field nobody listed, forwarded as JSON text and read again."""
    extra = F.regexp_replace("value", r"\}$", F.concat(F.lit(',"extra":{"n":'), F.col("seq"), F.lit(',"on":true}}')))
    text = log_split.forwarded(t.log_lines().withColumn("value", extra))
    paths = {
        "mid": "common.mid", "is_new": "common.is_new", "vc": "common.vc", "page_id": "page.page_id",
        "entry": "start.entry", "extra_n": "extra.n", "extra_on": "extra.on", "ts": "ts",
    }
    return text.select("seq", *[F.get_json_object("value", f"$.{path}").alias(name) for name, path in paths.items()])


@query
def log_start(t: SampleTables) -> DataFrame:
    return log_split.starts(log_split.repaired(t.log_lines())).select(
        "seq", "mid", F.col("common")["is_new"].alias("is_new"), "start", "ts"
    )


@query
def log_page(t: SampleTables) -> DataFrame:
    flat = log_split.page_log(log_split.pages(log_split.repaired(t.log_lines())))
    return flat.select(*[c for c in flat.columns if c != "displays"], F.size("displays").alias("shown_ct"))


@query
def log_display(t: SampleTables) -> DataFrame:
    shown = log_split.displays(log_split.clean(t.log_lines()))
    return shown.select(*[F.col("display")[c].alias(c) for c in ("item", "item_type", "page_id")])


# -- row changes ----------------------------------------------------------------------------------


@query
def cdc_normalize(t: SampleTables) -> DataFrame:
    changes = cdc.from_envelope(cdc.envelope(cdc.normalise(t.cdc_records())))
    return changes.select(
        "database", "table", "operation", "seq", F.col("before")["id"].alias("before_id"),
        F.col("after")["id"].alias("after_id"), F.size("after").alias("after_fields"),
        *[F.col("after")[c].alias(f"after_{c}") for c in ("name", "gender", "birthday", "sku_name", "price")],
    )


@query
def cdc_route(t: SampleTables) -> DataFrame:
    after = F.col("after")
    return routed(t).select(
        "table", "operation", "seq", "sink_type", "sink_table",
        after["id"].alias("id"), after["name"].alias("name"), after["price"].alias("price"),
        after["total_amount"].alias("total_amount"), F.size(after).alias("fields"),
    )


@query
def cdc_route_versions(t: SampleTables) -> DataFrame:
    """Rules that change midway: user updates go to a narrower table later, orders to none in the end."""
    later = t.spark.createDataFrame(
        [("user_info", "update", "hbase", "dim_user_short", "id,name", None, None, 500),
         ("order_info", "insert", None, None, None, None, None, 3000)],
        ROUTING_RULE,
    )
    found = routing.route_at(cdc.normalise(t.cdc_records()), t.routing_rules().unionByName(later))
    return found.select(
        "table", "operation", "seq", "sink_table", F.when(F.col("sink_table").isNotNull(), F.size("after")).alias("fields")
    )


@query
def cdc_facts(t: SampleTables) -> DataFrame:
    return routing.facts(routed(t))


@query
def cdc_rejects(t: SampleTables) -> DataFrame:
    return routing.rejected(routed(t)).groupBy("table", "operation").agg(F.count("seq").alias("change_ct"))


@query
def dim_upsert(t: SampleTables) -> DataFrame:
    after = F.col("after")
    columns = ["name", "gender", "birthday", "sku_name", "price"]
    return dimension_rows(t).select("sink_table", "id", "seq", *[after[c].alias(c) for c in columns])


@query
def dim_schema(t: SampleTables) -> DataFrame:
    """Columns the rules ask for, with how many stored rows fill each."""
    filled = dimension_rows(t).select("sink_table", F.explode("after").alias("column_name", "cell"))
    counts = filled.filter("cell <> ''").groupBy("sink_table", "column_name").agg(
        F.count("cell").alias("filled_ct")
    )
    asked = routing.rule_columns(t.routing_rules())
    # The narrower rule that was replaced does not count: only rules in force are asked.
    return asked.join(counts, ["sink_table", "column_name"], "left").na.fill(0, ["filled_ct"])


# -- orders ---------------------------------------------------------------------------------------


@query
def order_enrich_time(t: SampleTables) -> DataFrame:
    return order_wide.with_order_times(t.order_info()).select(
        "id", "create_time", "create_date", "create_hour", "create_ts"
    )


@query
def time_rejects(t: SampleTables) -> DataFrame:
    """Orders and page views whose time was spoilt, with the rows the joins and windows leave out."""
    orders = t.order_info().withColumn(
        "create_time", F.when(F.col("id") % 11 == 0, "soon").when(F.col("id") % 13 != 0, F.col("create_time"))
    )
    pages = t.page_log().withColumn("ts", F.when(F.col("seq") % 17 != 0, F.col("ts")))
    timed = pages.withColumn("event_time", F.timestamp_millis("ts"))
    parts = {
        "order": order_wide.without_time(orders).select("id"),
        "page": visits.without_time(pages).select(F.col("seq").alias("id")),
        "window": windows.without_time(timed, "event_time").select(F.col("seq").alias("id")),
    }
    named = [rows.withColumn("kind", F.lit(kind)) for kind, rows in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query
def interval_join_rows(t: SampleTables) -> DataFrame:
    """Order lines shipped at most 30 days before or after their order date."""
    orders = t.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = t.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    joined = interval_join(
        orders, lines, "o_orderkey", "l_orderkey", "o_orderdate", "l_shipdate", "-30 days", "30 days"
    )
    return joined.select(
        "o_orderkey", "o_custkey", "l_partkey", "l_linenumber",
        time_text("o_orderdate").alias("order_time"), time_text("l_shipdate").alias("ship_time"),
    )


@query
def interval_join_seconds(t: SampleTables) -> DataFrame:
    return order_facts(t).select(
        "order_id", "detail_id", "sku_id", "sku_num", "sku_name", "split_total_amount", "create_time"
    )


@query
def order_wide_rows(t: SampleTables) -> DataFrame:
    return wide_orders(t).drop(order_wide.ORDER_TIME)


@query
def payment_wide_rows(t: SampleTables) -> DataFrame:
    return order_wide.payment_wide(t.payment_info(), wide_orders(t)).drop("payment_time")


@query
def wide_coalesce(t: SampleTables) -> DataFrame:
    """Orders with gaps, filled from a second version of the same row."""
    keys = F.col("id").alias("order_id")
    one = t.order_info().select(
        keys,
        F.when(F.col("id") % 3 != 0, F.col("order_status")).alias("order_status"),
        F.when(F.col("id") % 5 != 0, F.col("total_amount")).alias("total_amount"),
        F.when(F.col("id") % 2 != 0, F.col("feight_fee")).alias("split_total_amount"),
    )
    other = t.order_info().select(
        keys, F.lit("1005").alias("order_status"), F.col("original_total_amount").alias("total_amount"),
        F.col("feight_fee").alias("split_total_amount"),
    )
    return order_wide.first_non_null(one, other, ["order_id"])


@query
def dim_enrich(t: SampleTables) -> DataFrame:
    """Order lines with a shifted sku id, so some find no sku and keep nulls."""
    shifted = t.order_detail().select("order_id", (F.col("sku_id") + 50).alias("sku_id"), "sku_num")
    wide = enrich(shifted, products(t), "sku_id", {"sku_name": "sku_name", "tm_name": "tm_name"})
    return wide.groupBy("sku_id", "sku_name", "tm_name").agg(
        F.count("order_id").alias("line_ct"), F.sum("sku_num").alias("sku_num")
    )


@query
def order_wide_orphans(t: SampleTables) -> DataFrame:
    """Order lines with a shifted sku id: those without a sku keep the name they came with."""
    shifted = t.order_detail().withColumn("sku_id", F.col("sku_id") + 50)
    wide = order_wide.with_product(shifted, products(t))
    return wide.select("id", "order_id", "sku_id", "sku_name", "tm_name")


@query
def dim_camel(t: SampleTables) -> DataFrame:
    return camel_columns(products(t))


@query
def json_roundtrip(t: SampleTables) -> DataFrame:
    orders = t.order_info()
    text = orders.select(F.to_json(F.struct(*orders.columns)).alias("value"))
    return text.select(F.from_json("value", orders.schema.simpleString()).alias("o")).select("o.*")


# -- visitors, windows ------------------------------------------------------------------------------


@query
def uv_daily(t: SampleTables) -> DataFrame:
    return visits.daily_unique(t.page_log()).select("dt", "mid", "seq", "ts", "vc", "ch", "is_new")


@query
def jump_detail(t: SampleTables) -> DataFrame:
    return jumps(t).select("mid", "seq", "ts", "page_id", "kind")


@query
def visitor_stats_rows(t: SampleTables) -> DataFrame:
    return visitors(t)


@query
def product_click_display(t: SampleTables) -> DataFrame:
    """Pages that show nothing have no list at all."""
    pages = t.page_log().withColumn("displays", F.when(F.size("displays") > 0, F.col("displays")))
    rows = product_stats.activity(pages)
    return rows.select("sku_id", F.unix_millis("event_time").alias("ts"), "kind", "click_ct", "display_ct")


@query
def product_stats_rows(t: SampleTables) -> DataFrame:
    return products_by_window(t)


@query
def product_stats_wide(t: SampleTables) -> DataFrame:
    return products_named(t)


@query
def province_stats_rows(t: SampleTables) -> DataFrame:
    return provinces(t)


@query
def keyword_tokens(t: SampleTables) -> DataFrame:
    """Words per document; CJK runs are looked up in a dictionary made of the part names."""
    dictionary = t.table("part").select(F.explode(spaced_words(F.col("p_name"))).alias("word")).distinct()
    docs = t.table("documents").select("doc_id", "text")
    words = split_words(docs, "text", dictionary)
    return words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("ct"))


@query
def keyword_cjk(t: SampleTables) -> DataFrame:
    """Words of the documents written in ideographs, by words of one to seven characters of the part names."""
    docs = t.table("documents").select("doc_id", ideographs("text").alias("text"))
    words = split_words(docs, "text", cjk_dictionary(t))
    return words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("ct"))


@query
def keyword_stats_rows(t: SampleTables) -> DataFrame:
    return keywords(t)


@query
def distinct_per_window(t: SampleTables) -> DataFrame:
    """Exact distinct visitors per page and hour."""
    pages = t.page_log().withColumn("event_time", F.timestamp_millis("ts"))
    return tumble_distinct(
        pages, "event_time", ["page_id"], ["mid"],
        {"view_ct": F.count("seq")},
        {"mid_ct": F.count("mid"), "view_ct": F.sum("view_ct")},
        "1 hour",
    )


@query
def scalar_pack(t: SampleTables) -> DataFrame:
    """Text, date, decimal, conditional and array functions of the jobs, row by row."""
    o = t.order_info()
    parts = F.split("create_time", " ")
    return o.select(
        "id",
        F.upper(F.concat_ws("','", "order_status", "create_time")).alias("joined"),
        F.lower(F.lit("CREATE")).alias("op"),
        F.lpad(F.hour(F.to_timestamp("create_time")).cast("string"), 2, "0").alias("hr"),
        F.date_format(F.to_timestamp("create_time"), "yyyyMMdd").alias("day"),
        F.element_at(F.split(parts[1], ":"), 2).alias("minute"),
        (text_ms("create_time") / 1000).cast("bigint").alias("second"),
        F.round(F.col("total_amount") / 7, 2).cast("decimal(20,2)").alias("seventh"),
        F.coalesce(F.when(F.col("id") % 2 == 0, F.col("operate_time")), F.col("expire_time")).alias("either"),
        F.aggregate(
            F.transform(F.sequence(F.lit(1), F.col("id") % 5 + 1), lambda x: x * x),
            F.lit(0).cast("bigint"), lambda a, x: a + x,
        ).alias("squares"),
    )


# -- reports ----------------------------------------------------------------------------------------


@query
def rpt_gmv(t: SampleTables) -> DataFrame:
    """The turnover comes from order rows alone, so nothing else is read."""
    ordered = product_stats.activity(wide=order_facts(t))
    return reports.gmv(product_stats.product_stats(ordered, day=DAY), DAY)


@query
def rpt_spu_topn(t: SampleTables) -> DataFrame:
    return reports.spu_top(products_named(t, DAY), DAY)


@query
def rpt_category_topn(t: SampleTables) -> DataFrame:
    return reports.category_top(products_named(t, DAY), DAY)


@query
def rpt_trademark_topn(t: SampleTables) -> DataFrame:
    return reports.trademark_top(products_named(t, DAY), DAY)


@query
def rpt_trademark_arrays(t: SampleTables) -> DataFrame:
    arrays = reports.trademark_arrays(products_named(t, DAY), DAY)
    return arrays.select(
        F.concat_ws(",", "categories").alias("categories"),
        F.concat_ws(",", F.col("data").cast("array<string>")).alias("data"),
    )


@query
def rpt_province(t: SampleTables) -> DataFrame:
    return reports.province_map(provinces(t, DAY), DAY)


@query
def rpt_hourly(t: SampleTables) -> DataFrame:
    return reports.hourly(visitors_of_day(t, DAY), DAY)


@query
def rpt_new_old(t: SampleTables) -> DataFrame:
    return reports.new_and_old(visitors_of_day(t, DAY), DAY)


@query
def rpt_row_counts(t: SampleTables) -> DataFrame:
    return reports.row_counts(visitors_of_day(t, DAY), DAY)


@query
def rpt_keywords(t: SampleTables) -> DataFrame:
    """The documents fall into the first minutes and hours of the period."""
    return reports.keywords(keywords(t, "20240101"), "20240101")


# -- reports on stored statistics: all days are written by dt, a report reads the folder of its day ------


def stored_stats(t: SampleTables, stats: DataFrame) -> DataFrame:
    path = f"{shared_dir(t.spark)}/stats-{uuid4().hex}"
    sinks.stats_writer(path, stats.columns)(stats, 0)
    return tables.read_stats(t.spark, path)


@query
def rpt_gmv_stored(t: SampleTables) -> DataFrame:
    return reports.gmv(stored_stats(t, products_by_window(t)), DAY)


@query
def rpt_spu_topn_stored(t: SampleTables) -> DataFrame:
    return reports.spu_top(stored_stats(t, products_named(t)), DAY)


@query
def rpt_province_stored(t: SampleTables) -> DataFrame:
    return reports.province_map(stored_stats(t, provinces(t)), DAY)


@query
def rpt_hourly_stored(t: SampleTables) -> DataFrame:
    return reports.hourly(stored_stats(t, visitors(t)), DAY)


@query
def rpt_keywords_stored(t: SampleTables) -> DataFrame:
    return reports.keywords(stored_stats(t, keywords(t)), "20240101")
