import random
from decimal import Decimal

from pyspark.sql import functions as F

from tradewind.functions.words import split_words, words_of_runs
from tradewind.plans import keyword_stats, product_stats, province_stats, sql_jobs, visitor_stats
from tradewind.schemas import AMOUNT, COMMENT_INFO, KEYWORD_STATS_COLUMNS, PAGE_LOG, VISITOR_STATS_COLUMNS

D = Decimal


def page(seq, mid, ts, page_id="home", last=None, item=None, kind=None, during=None, displays=None, is_new="0"):
    return (seq, mid, "v1", "web", "3", is_new, page_id, last, item, kind, during, displays, ts)


def test_product_clicks_displays_and_comments(spark, rows):
    pages = spark.createDataFrame(
        [page(1, "a", 10_000, "good_detail", item="7", kind="sku_id", displays=[("7", "sku_id"), ("8", "other")]),
         page(2, "a", 19_999, "good_detail", item="word", kind="sku_id"),
         page(3, "a", 20_000, "good_list", item="7", kind="sku_id", displays=[])], PAGE_LOG
    )
    comments = spark.createDataFrame(
        [(1, 1, None, None, 7, None, None, a, None, "1970-01-01 00:00:19", None) for a in ("1201", "1202", None)],
        COMMENT_INFO,
    )
    stats = product_stats.product_stats(product_stats.activity(pages, comment=comments))
    assert rows(stats, "stt", "edt", "sku_id", "click_ct", "display_ct", "comment_ct", "good_comment_ct", "ts") == [
        ("1970-01-01 00:00:10", "1970-01-01 00:00:20", 7, 1, 1, 3, 1, 10_000),
        ("1970-01-01 00:00:10", "1970-01-01 00:00:20", None, 1, 0, 0, 0, 19_999),
    ]


def test_product_distinct_orders_per_window(spark, rows):
    wide = spark.createDataFrame(
        [(5, 7, 1, D("1.10"), "2024-01-01 00:00:01"), (5, 7, 2, D("2.20"), "2024-01-01 00:00:02"),
         (6, 7, 1, None, "2024-01-01 00:00:03"), (5, 7, 1, D("4.00"), "2024-01-01 00:00:10")],
        f"order_id BIGINT, sku_id BIGINT, sku_num BIGINT, split_total_amount {AMOUNT}, create_time STRING",
    )
    stats = product_stats.product_stats(product_stats.activity(wide=wide))
    assert rows(stats, "stt", "order_ct", "order_sku_num", "order_amount", "paid_order_ct") == [
        ("2024-01-01 00:00:00", 2, 4, D("3.30"), 0), ("2024-01-01 00:00:10", 1, 1, D("4.00"), 0)
    ]
    day = product_stats.product_stats(product_stats.activity(wide=wide), day="20240102")
    assert day.count() == 0


def test_visitor_stats(spark, rows):
    pages = spark.createDataFrame(
        [page(1, "a", 1_000, during=500), page(2, "a", 2_000, last="home", during=None), page(3, "b", 3_000, last="")],
        PAGE_LOG,
    )
    stats = visitor_stats.visitor_stats(pages, pages.filter("seq = 1"), pages.filter("seq = 3"))
    assert stats.columns == VISITOR_STATS_COLUMNS
    assert rows(stats) == [
        ("1970-01-01 00:00:00", "1970-01-01 00:00:10", "v1", "web", "3", "0", 1, 3, 2, 1, 500, 1_000)
    ]


def test_province_stats(spark, rows):
    wide = spark.createDataFrame(
        [(1, "North", 9, D("1.25"), "2024-01-01 00:00:01"), (1, "North", 9, D("2.25"), "2024-01-01 00:00:09"),
         (1, "North", 8, D("1.00"), "2024-01-01 00:00:09"), (1, "North", 8, D("1.00"), "2024-01-01 00:00:10")],
        f"province_id BIGINT, province_name STRING, order_id BIGINT, split_total_amount {AMOUNT}, create_time STRING",
    ).selectExpr("*", "'a' AS province_area_code", "'b' AS province_iso_code", "'c' AS province_3166_2_code")
    assert rows(province_stats.province_stats(wide), "stt", "order_amount", "order_count", "ts") == [
        ("2024-01-01 00:00:00", D("4.50"), 2, 1_704_067_201_000),
        ("2024-01-01 00:00:10", D("1.00"), 1, 1_704_067_210_000),
    ]


def test_words(spark, rows):
    texts = spark.createDataFrame(
        [(1, "大数据abc"), (2, "iPhone13 Pro-max"), (3, None), (4, "数据，数据！")], "n INT, text STRING"
    )
    dictionary = spark.createDataFrame([("大数据",), ("数据",), ("abc",)], "word STRING")
    assert rows(split_words(texts, "text", dictionary)) == sorted(
        [(1, "大数据"), (1, "数据"), (1, "abc"), (2, "iphone13"), (2, "pro"), (2, "max"), (4, "数据"), (4, "数据")],
        key=repr,
    )
    # Without a dictionary a run without word breaks comes out whole.
    assert rows(split_words(texts, "text").filter("n = 1")) == [(1, "abc"), (1, "大数据")]


def test_words_of_any_script_and_length_are_whole(spark, rows):
    texts = spark.createDataFrame(
        [(1, "größe été O\u0301k"), (2, "人工智能大数据平台"), (3, "カタカナーとひらがな한국어"), (4, "我们的北京大学物理系学生会")], "n INT, text STRING"
    )
    dictionary = spark.createDataFrame([("人工智能大",), ("大数据",), ("北京大学物理系",), ("と",)], "word STRING")
    assert rows(split_words(texts, "text", dictionary)) == sorted(
        [(1, "größe"), (1, "été"), (1, "o\u0301k"), (2, "人工智能大"), (2, "大数据"), (2, "平台"),
         (3, "カタカナー"), (3, "と"), (3, "ひらがな한국어"), (4, "我们的"), (4, "北京大学物理系"), (4, "学生会")],
        key=repr,
    )


def test_words_are_found_anywhere_in_a_long_text(spark):
    text = "x" * 50_000 + " 数" * 2000 + "大数据"
    df = spark.createDataFrame([(text,)], "text STRING")
    dictionary = spark.createDataFrame([("大数据",)], "word STRING")
    assert split_words(df, "text", dictionary).filter("word = '大数据'").count() == 1


def test_keyword_stats(spark, rows):
    pages = spark.createDataFrame(
        [page(1, "a", 1_999, last="search", item="Red red 数据"), page(2, "a", 2_000, last="home", item="red"),
         page(3, "a", 3_000, last="search"), page(4, "b", 11_000, last="search", item="red")], PAGE_LOG
    )
    dictionary = spark.createDataFrame([("数据",)], "word STRING")
    stats = keyword_stats.keyword_stats(pages, dictionary)
    assert stats.columns == KEYWORD_STATS_COLUMNS
    assert rows(stats, "keyword", "ct", "source", "stt") == [
        ("red", 1, "SEARCH", "1970-01-01 00:00:10"), ("red", 2, "SEARCH", "1970-01-01 00:00:00"),
        ("数据", 1, "SEARCH", "1970-01-01 00:00:00"),
    ]
    by_source = keyword_stats.keyword_stats(pages, source=F.upper("last_page_id"))
    assert {r.source for r in by_source.collect()} == {"SEARCH"}


def test_words_are_counted_in_small_parts(spark, rows):
    """neither side of the shuffle of words has a task with more than its part of the groups, whatever the input's files."""
    texts = [(f"w{i} w{i + 1} W{i} same", "ab"[i % 2], 1000 * (i % 40)) for i in range(400)] + [(None, "a", 1), ("x", "a", None), ("x", None, 1)] * 2
    pages = spark.createDataFrame(texts, "item STRING, source STRING, ts BIGINT").coalesce(1).selectExpr("'search' AS last_page_id", "*")
    stats = keyword_stats.keyword_stats(pages, source=F.col("source"))
    plain = keyword_stats.count_words(keyword_stats.search_words(pages, source=F.col("source")))
    assert rows(stats) == rows(plain) and stats.filter("keyword = 'same'").agg(F.sum("ct")).first()[0] == 400
    plan = stats._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count(", 16), REPARTITION_BY_NUM") == 2


def test_clicks_of_pages_that_list_nothing(spark, rows):
    """Both forms agree whether the list of displays is missing, empty or filled."""
    pages = spark.createDataFrame(
        [page(1, "a", 1, "good_detail", item="7", kind="sku_id"), page(2, "a", 2, "good_detail", item="7", kind="sku_id", displays=[]),
         page(3, "a", 3, None, item="8", kind="sku_id"), page(4, "a", 4, displays=[("9", "sku_id"), ("9", None)])], PAGE_LOG
    )
    apart = product_stats.clicks(pages).unionByName(product_stats.displays(pages))
    assert rows(product_stats.page_activity(pages), "sku_id", "kind") == rows(apart, "sku_id", "kind")
    assert apart.count() == 3


def cjk(n, rnd):
    return "".join(chr(0x4E00 + rnd.randrange(40)) for _ in range(n))


def test_words_of_runs_against_a_plain_search(spark, rows):
    rnd = random.Random(1)
    known = sorted({cjk(rnd.choice([1, 2, 3, 5, 300]), rnd) for _ in range(60)})
    runs = [cjk(n, rnd) for n in (1, 5, 255, 256, 257, 512, 700, 1500)] + [known[-1] + cjk(3, rnd) + max(known, key=len), "𠀀𠀁" + cjk(600, rnd)]
    want = []
    for run in runs:
        covered = [False] * len(run)
        for at in range(len(run)):
            for word in known:
                if run.startswith(word, at):
                    want.append((run, word))
                    covered[at : at + len(word)] = [True] * len(word)
        rest = "".join(" " if c else x for c, x in zip(covered, run)).split()
        want += [(run, word) for word in rest]
    docs = spark.createDataFrame([(i, f"one {run}, Two") for i, run in enumerate(runs)], "id BIGINT, text STRING")
    words = split_words(docs, "text", spark.createDataFrame([(w,) for w in known], "word STRING"))
    got = rows(words.filter("word NOT IN ('one', 'two')"), "id", "word")
    assert got == sorted(((runs.index(run), word) for run, word in want), key=repr)


def test_a_short_run_meets_its_texts_as_one_row(spark, rows):
    """F8: places of short runs stay with the run, which comes out once with all its words, known or not."""
    runs = spark.createDataFrame([("大数据平台",), ("大数据平台",), ("中文",), ("据",), ("数" * 256,)], "run STRING")
    known = spark.createDataFrame([("大数据",), ("数据",), ("据",), ("据平台甲",), (None,), ("",)], "word STRING")
    found = {r.key: sorted(r.words) for r in words_of_runs(runs, known).collect()}
    assert found == {"大数据平台": ["大数据", "平台", "据", "数据"], "中文": ["中文"], "据": ["据"], "数" * 256: ["数" * 256]}
    assert words_of_runs(runs, known).count() == 4
    none = words_of_runs(runs, known.filter("word = 'x'"))
    assert sorted(r.words[0] for r in none.collect()) == sorted(found)


def test_a_very_long_run(spark):
    """Time is linear in the run: this one took minutes when every place looked at the whole run."""
    rnd = random.Random(2)
    run = cjk(200_000, rnd)
    known = spark.createDataFrame([(cjk(2, rnd),) for _ in range(200)], "word STRING").distinct()
    docs = spark.createDataFrame([(1, run)], "id BIGINT, text STRING")
    total = split_words(docs, "text", known).agg(F.sum(F.length("word"))).first()[0]
    words = [r.word for r in known.collect()]
    covered = bytearray(len(run))
    found = 0
    for word in words:
        at = run.find(word)
        while at >= 0:
            found += len(word)
            covered[at : at + len(word)] = b"\1" * len(word)
            at = run.find(word, at + 1)
    assert total == found + covered.count(0)


def test_words_from_sql_are_those_of_the_plan(spark, rows):
    texts = ["Ein Äpfel-baum, 2x; x2 'ça' \\ [a_b]", "中文 mix中文ed ードÀ", "", None, "plain words only", "...", "e\u0301té 𠀀"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING")
    sql_jobs.register(spark)
    docs.createOrReplaceTempView("some_docs")
    found = spark.sql("SELECT id, word FROM some_docs, LATERAL split_word(text)")
    assert rows(found, "id", "word") == rows(split_words(docs, "text"), "id", "word")
    assert found.count() == 19
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "Join" not in plan and "Aggregate" not in plan


def test_sql_jobs_on_tables(spark, rows):
    lines = spark.createDataFrame(
        [('{"last_page_id":"search","item":"A b","source":"S","ts":1500}',), ('{"last_page_id":"home","item":"c","ts":1}',), ("no json",)],
        "value STRING",
    )
    assert rows(sql_jobs.keyword_job(spark, lines), "keyword", "ct", "stt", "ts") == [
        ("a", 1, "1970-01-01 00:00:00", 1500), ("b", 1, "1970-01-01 00:00:00", 1500)
    ]


def test_counted_words_are_the_words_counted(spark, rows):
    """words of equal source and time as one row with their number; what they are counted from is the same."""
    texts = ["大数据平台 Ein ein, 数据", "数据 大数据平台" + "数" * 300, None, "", "nur Wörter 𠀀", "数据 Ein"]
    pages = [("search", text, source, 1000 * (k // 2)) for k, text in enumerate(texts) for source in ("SEARCH", None)]
    pages = [*pages, *pages[:3], ("search", "数据 x", "SEARCH", None), ("home", "数据", "SEARCH", 1000)]
    seen = spark.createDataFrame(pages, "last_page_id STRING, item STRING, source STRING, ts BIGINT")
    known = spark.createDataFrame([("大数据",), ("数据",), ("据",), ("平台甲",), (None,)], "word STRING")
    plain = keyword_stats.search_words(seen, known, F.col("source"))
    counted = keyword_stats.search_word_counts(seen, known, F.col("source"))
    want = plain.groupBy("source", "ts", "word").agg(F.count(F.lit(1)).alias("ct"))
    assert rows(counted, "source", "ts", "word", "ct") == rows(want)
    assert rows(keyword_stats.count_words(counted)) == rows(keyword_stats.count_words(plain))
