"""Equivalent SQL of the registered queries."""

from __future__ import annotations

from catalog.ctes import DAY, edt, sql, stt

_FINAL = {
    "src_log_text": """
        SELECT strftime(make_timestamp(t * 1000), '%Y-%m-%d') AS dt, count(*) AS line_ct,
            CAST(sum(length(log_lines.value)) AS BIGINT) AS char_ct
        FROM log_lines JOIN ev ON event_id = seq WHERE seq % 97 <> 0 GROUP BY 1
        UNION ALL SELECT NULL, count(*), CAST(sum(length(value)) AS BIGINT) FROM log_lines WHERE seq % 97 = 0""",
    "csv_load": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "log_dirty": "SELECT value FROM log_lines WHERE seq % 97 = 0",
    "log_is_new_fix": "SELECT seq, mid, is_new, ts FROM repaired",
    "log_is_new_two_days": "SELECT seq, mid, is_new, ts FROM repaired",
    "log_page_json": """
        SELECT seq, mid, is_new, vc, CASE WHEN NOT is_start THEN page_id END AS page_id,
            CASE WHEN is_start THEN 'icon' END AS entry, CAST(seq AS VARCHAR) AS extra_n, 'true' AS extra_on,
            CAST(ts AS VARCHAR) AS ts FROM repaired""",
    "log_start": """
        SELECT seq, mid, is_new, '{"entry":"icon","loading_time":' || k || '}' AS start, ts
        FROM repaired WHERE is_start""",
    "log_page": """
        SELECT seq, mid, vc, ch, ar, is_new, page_id, last_page_id, item, item_type, during_time, ts,
            CAST(k % 4 AS INTEGER) AS shown_ct FROM repaired WHERE NOT is_start""",
    "log_display": "SELECT item, item_type, page_id FROM shown WHERE seq % 97 <> 0 AND k % 10 <> 7",
    "cdc_normalize": """
        SELECT 'shop' AS database, tab AS "table", op AS operation, seq,
            CASE WHEN op IN ('update', 'delete') AND tab = 'user_info' THEN id END AS before_id,
            CASE WHEN op <> 'delete' THEN id END AS after_id,
            CASE WHEN op <> 'delete' AND tab IN ('user_info', 'base_nation') THEN name END AS after_name,
            CASE WHEN op <> 'delete' AND tab = 'user_info' THEN gender END AS after_gender,
            CASE WHEN op <> 'delete' AND tab = 'user_info' THEN birthday END AS after_birthday,
            CASE WHEN op <> 'delete' AND tab = 'sku_info' THEN name END AS after_sku_name,
            CASE WHEN op <> 'delete' AND tab = 'sku_info' THEN price END AS after_price,
            CAST(CASE WHEN op = 'delete' THEN 0 WHEN tab = 'user_info' THEN 5 WHEN tab = 'base_nation' THEN 2
                ELSE 4 END AS INTEGER) AS after_fields
        FROM changes""",
    "cdc_route_versions": """
        SELECT tab AS "table", op AS operation, seq, sink_table, CASE WHEN sink_table IS NULL THEN NULL
            WHEN sink_table = 'dim_user_info' THEN 4 WHEN sink_table = 'dim_user_short' THEN 2 ELSE 3 END AS fields
        FROM (SELECT *, CASE
            WHEN tab = 'user_info' AND op = 'update' AND seq >= 500 THEN 'dim_user_short'
            WHEN tab = 'user_info' AND seq >= CASE op WHEN 'insert' THEN 2 WHEN 'update' THEN 3 ELSE 4 END THEN 'dim_user_info'
            WHEN tab = 'sku_info' AND seq >= 5 THEN 'dim_sku_info'
            WHEN tab = 'order_info' AND op = 'insert' AND seq >= 6 AND seq < 3000 THEN 'dwd_order_info' END AS sink_table
            FROM changes WHERE op <> 'delete')""",
    "cdc_route": """
        SELECT tab AS "table", op AS operation, seq, sink_table,
            CASE WHEN sink_table LIKE 'dim%' THEN 'hbase' WHEN sink_table IS NOT NULL THEN 'kafka' END AS sink_type,
            id, CASE WHEN tab IN ('user_info', 'base_nation') THEN name END AS name,
            CASE WHEN tab = 'sku_info' THEN price END AS price,
            CASE WHEN tab = 'order_info' THEN price END AS total_amount,
            CAST(CASE WHEN tab = 'base_nation' THEN 2 WHEN tab = 'order_info' AND sink_table IS NOT NULL THEN 3
                WHEN tab = 'sku_info' THEN 3 ELSE 4 END AS INTEGER) AS fields
        FROM routed""",
    "cdc_facts": """
        SELECT 'dwd_order_info' AS topic, '{"id":"' || o_orderkey || '","total_amount":"'
            || CAST(o_totalprice AS DECIMAL(16,2)) || '","user_id":"' || o_custkey || '"}' AS value, o_orderkey AS seq
        FROM orders WHERE o_orderstatus = 'O'""",
    "cdc_rejects": """
        SELECT tab AS "table", op AS operation, count(*) AS change_ct FROM routed
        WHERE sink_table IS NULL GROUP BY ALL""",
    "dim_upsert": """
        SELECT sink_table, id, seq, CASE WHEN tab = 'user_info' THEN name END AS name,
            CASE WHEN tab = 'user_info' THEN coalesce(gender, '') END AS gender, birthday,
            CASE WHEN tab = 'sku_info' THEN name END AS sku_name, price
        FROM dims""",
    "dim_schema": """
        SELECT 'dim_user_info' AS sink_table, CAST(position AS INTEGER) AS position, column_name,
            'varchar' AS column_type, column_name = 'id' AS is_key,
            (SELECT count(*) FROM dims WHERE tab = 'user_info'
                AND (column_name <> 'gender' OR gender IS NOT NULL)) AS filled_ct
        FROM (VALUES (0, 'id'), (1, 'name'), (2, 'gender'), (3, 'birthday')) v(position, column_name)
        UNION ALL SELECT 'dim_sku_info', CAST(position AS INTEGER), column_name, 'varchar', column_name = 'id',
            (SELECT count(*) FROM dims WHERE tab = 'sku_info')
        FROM (VALUES (0, 'id'), (1, 'sku_name'), (2, 'price')) v(position, column_name)""",
    "order_enrich_time": """
        SELECT id, create_time, substr(create_time, 1, 10) AS create_date,
            substr(create_time, 12, 2) AS create_hour, s * 1000 AS create_ts FROM order_info""",
    "interval_join": """
        SELECT o_orderkey, o_custkey, l_partkey, l_linenumber,
            strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time,
            strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ship_time
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
            AND l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 30 DAY""",
    "interval_join_seconds": """
        SELECT order_id, detail_id, sku_id, sku_num, sku_name, split_total_amount, create_time FROM order_facts""",
    "order_wide": "SELECT * EXCLUDE (s) FROM order_wide",
    "payment_wide": "SELECT * FROM payment_wide",
    "time_rejects": """
        SELECT o_orderkey AS id, 'order' AS kind FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0
        UNION ALL SELECT seq, kind FROM page_log, (VALUES ('page'), ('window')) k(kind) WHERE seq % 17 = 0""",
    "wide_coalesce": """
        SELECT id AS order_id, CASE WHEN id % 3 <> 0 THEN order_status ELSE '1005' END AS order_status,
            CASE WHEN id % 5 <> 0 THEN total_amount ELSE original_total_amount END AS total_amount,
            CASE WHEN id % 2 <> 0 THEN feight_fee END AS split_total_amount
        FROM order_info""",
    "dim_enrich": """
        SELECT l_partkey + 50 AS sku_id, k.sku_name, k.tm_name, count(*) AS line_ct,
            CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sku_num
        FROM lineitem LEFT JOIN dim_sku k ON k.id = CAST(l_partkey + 50 AS VARCHAR) GROUP BY ALL""",
    "order_wide_orphans": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey + 50 AS sku_id,
            CASE WHEN k.id IS NULL THEN 'sku ' || l_partkey ELSE k.sku_name END AS sku_name, k.tm_name
        FROM lineitem LEFT JOIN dim_sku k ON k.id = CAST(l_partkey + 50 AS VARCHAR)""",
    "dim_camel": """
        SELECT id, sku_name AS "skuName", CAST(price AS DECIMAL(16,2)) AS "skuPrice",
            CAST(spu_id AS BIGINT) AS "spuId", CAST(tm_id AS BIGINT) AS "tmId",
            CAST(category3_id AS BIGINT) AS "category3Id", spu_name AS "spuName", tm_name AS "tmName",
            category3_name AS "category3Name" FROM dim_sku""",
    "json_roundtrip": "SELECT * EXCLUDE (s) FROM order_info",
    "uv_daily": "SELECT dt, mid, seq, ts, vc, ch, is_new FROM uv",
    "jump_detail": "SELECT mid, seq, ts, page_id, kind FROM jumps",
    "visitor_stats": "SELECT * FROM visitor_stats",
    "product_click_display": """
        SELECT sku_id, ts, kind, CAST(kind = 'click' AS BIGINT) AS click_ct,
            CAST(kind = 'display' AS BIGINT) AS display_ct
        FROM activity WHERE kind IN ('click', 'display')""",
    "product_stats": "SELECT * FROM product_stats",
    "product_stats_wide": "SELECT * FROM product_stats_wide",
    "province_stats": "SELECT * FROM province_stats",
    "keyword_tokens": "SELECT doc_id, word, count(*) AS ct FROM words WHERE word <> '' GROUP BY ALL",
    "keyword_cjk": "SELECT doc_id, word, count(*) AS ct FROM cjkwords WHERE word <> '' GROUP BY ALL",
    "keyword_stats": "SELECT * FROM keyword_stats",
    "distinct_per_window": f"""
        SELECT {stt('ts', 3600)}, {edt('ts', 3600)}, page_id, count(DISTINCT mid) AS mid_ct, count(*) AS view_ct
        FROM page_log GROUP BY ts // 3600000, page_id""",
    "scalar_pack": """
        SELECT id, order_status || ''',''' || create_time AS joined, 'create' AS op,
            substr(create_time, 12, 2) AS hr, replace(substr(create_time, 1, 10), '-', '') AS day,
            substr(create_time, 15, 2) AS minute, s AS second,
            CAST(CAST((CAST(total_amount * 100 AS BIGINT) * 2 + 7) // 14 AS DECIMAL(18,0)) / 100 AS DECIMAL(20,2)) AS seventh,
            CASE WHEN id % 2 = 0 THEN operate_time ELSE expire_time END AS either,
            CAST((id % 5 + 1) * (id % 5 + 2) * (2 * (id % 5) + 3) // 6 AS BIGINT) AS squares
        FROM order_info""",
    "rpt_gmv": f"""
        SELECT CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount
        FROM product_stats WHERE substr(stt, 1, 10) = '{DAY}'""",
    "rpt_spu_topn": f"""
        SELECT spu_name, CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount,
            CAST(sum(order_ct) AS BIGINT) AS order_ct
        FROM product_stats_wide WHERE substr(stt, 1, 10) = '{DAY}' GROUP BY spu_id, spu_name
        HAVING sum(order_amount) > 0 ORDER BY sum(order_amount) DESC, spu_id LIMIT 10""",
    "rpt_category_topn": f"""
        SELECT category3_name AS name, CAST(sum(order_amount) AS DECIMAL(38,2)) AS value
        FROM product_stats_wide WHERE substr(stt, 1, 10) = '{DAY}' GROUP BY category3_id, category3_name
        HAVING sum(order_amount) > 0 ORDER BY sum(order_amount) DESC, category3_id LIMIT 4""",
    "rpt_trademark_topn": f"""
        SELECT tm_name, CAST(sum(order_amount) AS DECIMAL(38,2)) AS order_amount
        FROM product_stats_wide WHERE substr(stt, 1, 10) = '{DAY}' GROUP BY tm_id, tm_name
        HAVING sum(order_amount) > 0 ORDER BY sum(order_amount) DESC, tm_id LIMIT 20""",
    "rpt_trademark_arrays": f"""
        SELECT string_agg(tm_name, ',' ORDER BY a DESC, tm_id) AS categories,
            string_agg(CAST(a AS VARCHAR), ',' ORDER BY a DESC, tm_id) AS data
        FROM (SELECT tm_id, tm_name, CAST(sum(order_amount) AS DECIMAL(38,2)) AS a
            FROM product_stats_wide WHERE substr(stt, 1, 10) = '{DAY}' GROUP BY tm_id, tm_name
            HAVING sum(order_amount) > 0 ORDER BY a DESC, tm_id LIMIT 20)""",
    "rpt_province": f"""
        SELECT province_name AS name, CAST(sum(order_amount) AS DECIMAL(38,2)) AS value
        FROM province_stats WHERE substr(stt, 1, 10) = '{DAY}' GROUP BY province_id, province_name""",
    "rpt_hourly": f"""
        SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hr, CAST(coalesce(sum(uv_ct), 0) AS BIGINT) AS uv,
            CAST(coalesce(sum(pv_ct), 0) AS BIGINT) AS pv,
            CAST(coalesce(sum(uv_ct) FILTER (is_new = '1'), 0) AS BIGINT) AS new_uv
        FROM range(24) r(h) LEFT JOIN (SELECT * FROM visitor_stats WHERE substr(stt, 1, 10) = '{DAY}') v
            ON CAST(substr(stt, 12, 2) AS INTEGER) = h GROUP BY h""",
    "rpt_new_old": """
        SELECT type, CAST(max(v) FILTER (is_new = '1') AS DECIMAL(20,2)) AS new,
            CAST(max(v) FILTER (is_new = '0') AS DECIMAL(20,2)) AS old
        FROM (
            SELECT is_new, 'visitors' AS type, CAST(uv AS DECIMAL(20,2)) AS v FROM day_sums
            UNION ALL SELECT is_new, 'pages', pv FROM day_sums
            UNION ALL SELECT is_new, 'bounce_percent', CAST((uj * 20000 + sv) // (2 * sv) AS DECIMAL(18,0)) / 100 FROM day_sums
            UNION ALL SELECT is_new, 'seconds_per_session',
                CAST((((dur * 2 + sv) // (2 * sv)) * 20 + 1000) // 2000 AS DECIMAL(18,0)) / 10 FROM day_sums
            UNION ALL SELECT is_new, 'pages_per_session', CAST((pv * 200 + sv) // (2 * sv) AS DECIMAL(18,0)) / 100 FROM day_sums
        ) GROUP BY type""",
    "rpt_row_counts": f"""
        SELECT count(pv_ct) AS pv_ct, count(uv_ct) AS uv_ct
        FROM visitor_stats WHERE substr(stt, 1, 10) = '{DAY}'""",
    "rpt_keywords": """
        SELECT keyword AS name, CAST(sum(ct * CASE source WHEN 'SEARCH' THEN 10 WHEN 'ORDER' THEN 3
            WHEN 'CART' THEN 2 WHEN 'CLICK' THEN 1 ELSE 0 END) AS BIGINT) AS value
        FROM keyword_stats WHERE substr(stt, 1, 10) = '2024-01-01'
        GROUP BY keyword ORDER BY sum(ct) DESC, keyword LIMIT 20""",
}

# Append mode holds back windows and timers the watermark has not passed: the latest event time
# minus the delay of the job.
_STREAMS = {
    "stream_new_flag": _FINAL["log_is_new_fix"],
    "stream_uv_daily": "SELECT dt, mid FROM uv",
    "stream_jump_detail": """
        SELECT mid, seq, ts, page_id, kind FROM jumps
        WHERE (ts // 21600000 + 1) * 21600000 + 3600000 <= (SELECT max(ts) - 1000 FROM page_log)""",
    "stream_order_wide": _FINAL["order_wide"],
    "stream_payment_wide": """
        SELECT payment_id, order_id, detail_id, sku_id, split_total_amount, payment_create_time FROM payment_wide""",
    "stream_keyword_stats": """
        SELECT * FROM keyword_stats
        WHERE (ts // 10000 + 1) * 10000 <= (SELECT max(s) * 1000 - 1000 FROM words WHERE word <> '')""",
    "stream_keyword_cjk": f"""
        SELECT word AS keyword, count(*) AS ct, source, {stt('s * 1000')}, {edt('s * 1000')}, min(s) * 1000 AS ts
        FROM (SELECT word, CASE lang WHEN 'en' THEN 'SEARCH' WHEN 'fr' THEN 'ORDER' WHEN 'de' THEN 'CART'
                WHEN 'es' THEN 'CLICK' END AS source, 1704067200 + doc_id % 2592000 AS s
              FROM cjkwords JOIN documents USING (doc_id) WHERE word <> '')
        WHERE (s // 10 + 1) * 10000 <= (SELECT max(1704067200 + doc_id % 2592000) * 1000 - 1000 FROM documents
            WHERE text <> '')
        GROUP BY ALL""",
    "stream_late_rows": """
        SELECT seq, mid, page_id, ts,
            coalesce(ts < (SELECT max(d.ts) - 1000 FROM arrived d WHERE d.run < a.run), false) AS late FROM arrived a""",
    "stream_visitor_stats": """
        SELECT * FROM visitor_stats
        WHERE (ts // 10000 + 1) * 10000 <= (SELECT max(ts) - 11000 FROM visitor_rows)""",
    "stream_product_stats": """
        SELECT * FROM product_stats
        WHERE (ts // 10000 + 1) * 10000 <= (SELECT max(ts) - 1000 FROM activity)""",
    "stream_province_stats": """
        SELECT * FROM province_stats
        WHERE (ts // 10000 + 1) * 10000 <= (SELECT max(s) * 1000 - 1000 FROM order_wide)""",
    "stream_dim_upsert": _FINAL["dim_upsert"],
    "stream_new_flag_two_days": _FINAL["log_is_new_two_days"],
}
# The jobs written as SQL text give the same rows.
_STREAMS |= {f"sql_{name}": _STREAMS[f"stream_{name}"] for name in ("keyword_stats", "province_stats")}

# The same reports, read from stored tables.
_STORED = {
    f"{name}_stored": _FINAL[name]
    for name in ("rpt_gmv", "rpt_spu_topn", "rpt_province", "rpt_hourly", "rpt_keywords")
}


def statements() -> dict[str, str]:
    return {name: sql(final) for name, final in {**_FINAL, **_STORED, **_STREAMS}.items()}
