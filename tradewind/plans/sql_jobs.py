"""Streaming jobs written as SQL text, and what the session needs to run them.

``register`` makes ``split_word`` known, a table function for ``LATERAL`` that Spark expands in place:
there is no user-defined code behind it, on tables or on streams. ``json_view`` puts a typed view with
an event time over a topic's text. The statements give the rows of ``keyword_stats`` and
``province_stats``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.words import ASCII_BREAK, EITHER_RUN

SEARCH_PAGES = "last_page_id STRING, item STRING, source STRING, ts BIGINT"
WIDE_ORDERS = (
    "order_id BIGINT, province_id BIGINT, province_name STRING, province_area_code STRING, province_iso_code STRING, "
    "province_3166_2_code STRING, split_total_amount DECIMAL(16,2), create_time STRING"
)
# The event times of the two views, as SQL over their columns.
PAGE_TIME, WIDE_TIME = "timestamp_seconds(ts div 1000)", "try_cast(create_time AS TIMESTAMP)"

_BOUNDS = (
    "date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt, date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt"
)

KEYWORDS = f"""
SELECT word AS keyword, count(*) AS ct, source, {_BOUNDS}, min(ts) AS ts
FROM search_page, LATERAL split_word(item)
WHERE last_page_id = 'search' AND item IS NOT NULL
GROUP BY window(row_time, '10 seconds'), word, source"""

# One row per order first: no set of orders is held per province.
PROVINCES = f"""
SELECT {_BOUNDS}, province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
    CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount, count(order_id) AS order_count, min(ts) AS ts
FROM (SELECT window, province_id, province_name, province_area_code, province_iso_code, province_3166_2_code, order_id,
          sum(split_total_amount) AS order_amount, min(unix_millis(row_time)) AS ts
      FROM order_wide
      GROUP BY window(row_time, '10 seconds'), province_id, province_name, province_area_code, province_iso_code,
          province_3166_2_code, order_id)
GROUP BY window, province_id, province_name, province_area_code, province_iso_code, province_3166_2_code"""


def _text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession) -> None:
    """``split_word(text)``: a row ``word`` per word of a text, as ``functions.words`` splits it without a dictionary.

    The body has no filter of its own: Spark could not expand it in place, but would join the words to
    the distinct texts, which a stream cannot have.
    """
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION split_word(text STRING) RETURNS TABLE (word STRING)
RETURN SELECT lower(found) AS word FROM (SELECT explode(filter(flatten(transform(
    split(text, {_text(ASCII_BREAK)}),
    p -> if(octet_length(p) = length(p), array(p), regexp_extract_all(p, {_text(EITHER_RUN)}, 0)))), w -> w <> '')) AS found)
"""
    )


def json_view(
    lines: DataFrame, name: str, schema: str, row_time: str, delay: str | None = None
) -> None:
    """A temporary view ``name`` over JSON text in ``value``: the columns of ``schema`` and ``row_time``, an
    SQL expression over them, with a watermark of ``delay`` on streams. Text that is no JSON has null columns."""
    typed = lines.select(F.from_json("value", schema).alias("row")).select("row.*").withColumn("row_time", F.expr(row_time))
    if delay and typed.isStreaming:
        typed = typed.withWatermark("row_time", delay)
    typed.createOrReplaceTempView(name)


def with_time(lines: DataFrame, schema: str, row_time: str) -> DataFrame:
    """``value, row_time``: the text and the event time of its view, for a job that holds lines by it."""
    typed = lines.select("value", F.from_json("value", schema).alias("row")).select("value", "row.*")
    return typed.select("value", F.expr(row_time).alias("row_time"))


def keyword_job(spark: SparkSession, lines: DataFrame, delay: str = "1 second") -> DataFrame:
    register(spark)
    json_view(lines, "search_page", SEARCH_PAGES, PAGE_TIME, delay)
    return spark.sql(KEYWORDS)


def province_job(spark: SparkSession, lines: DataFrame, delay: str = "1 second") -> DataFrame:
    json_view(lines, "order_wide", WIDE_ORDERS, WIDE_TIME, delay)
    return spark.sql(PROVINCES)
