from tradewind.functions.json_text import text_map
from tradewind.operators.visits import repair_new_flag
from tradewind.plans import log_split
from tradewind.schemas import LOG_LINE


def lines(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], LOG_LINE)


def test_dirty_lines_are_those_that_are_no_object(spark, rows):
    good, lenient = '{"common":{"mid":"a"},"ts":1}', '{"common":{"mid":"a"},"ts":1}}'
    df = lines(spark, good, "oops{", "[1]", "", "null", '"text"', lenient)
    assert {v for (v,) in rows(log_split.dirty(df))} == {"", '"text"', "[1]", "null", "oops{"}
    assert log_split.clean(df).count() == 2


def test_routing(spark, rows):
    page = '"page":{"page_id":"home","item":"7"}'
    df = lines(
        spark,
        '{"common":{"mid":"a","is_new":"0"},"start":{"entry":"icon"},"ts":1}',
        '{"common":{"mid":"a","is_new":"0"},' + page + ',"ts":2}',
        '{"common":{"mid":"a","is_new":"0"},' + page
        + ',"displays":[{"item":"1","pos":3},{"item":"2","page_id":"x"}],"ts":3}',
        '{"common":{"mid":"b"},"start":{"entry":"icon"},' + page + ',"displays":[{"item":"9"}],"ts":4}',
    )
    events = log_split.clean(df)
    assert rows(log_split.starts(events), "seq", "start") == [
        (0, '{"entry":"icon"}'), (3, '{"entry":"icon"}')
    ]
    assert rows(log_split.pages(events), "seq") == [(1,), (2,)]
    shown = [r.display for r in log_split.displays(events).collect()]
    # Own fields and the page id only; the page's id wins over a field of that name.
    assert sorted(shown, key=lambda d: d["item"]) == [
        {"item": "1", "pos": "3", "page_id": "home"}, {"item": "2", "page_id": "home"}
    ]
    flat = log_split.page_log(log_split.pages(events))
    assert rows(flat, "seq", "mid", "page_id", "item", "ts") == [(1, "a", "home", "7", 2), (2, "a", "home", "7", 3)]


def test_new_flag_repair(spark, rows):
    df = spark.createDataFrame(
        [("a", "1", 1, 1), ("a", "1", 2, 2), ("a", "0", 3, 3), ("a", "1", 4, 4), ("b", "0", 1, 5),
         ("b", "1", 2, 6), ("d", "1", None, 10), ("d", "1", 5, 11), (None, "1", 1, 7), (None, "1", 1, 8), ("c", None, 1, 9)],
        "mid STRING, is_new STRING, ts BIGINT, seq BIGINT",
    )
    assert sorted(rows(repair_new_flag(df), "seq", "is_new")) == [
        (1, "1"), (2, "0"), (3, "0"), (4, "0"), (5, "0"), (6, "1"), (7, "1"), (8, "0"), (9, None), (10, "1"), (11, "0")
    ]


def test_repaired_flag_lands_in_common(spark):
    line = '{"common":{"mid":"a","is_new":"1","os":"x"},"page":{"page_id":"home"},"ts":%d}'
    events = log_split.repaired(lines(spark, line % 1, line % 2))
    assert {r.seq: r.common for r in events.collect()} == {
        0: {"mid": "a", "is_new": "1", "os": "x"}, 1: {"mid": "a", "is_new": "0", "os": "x"}
    }
    text = {r.value for r in log_split.page_json(log_split.pages(events)).collect()}
    assert len(text) == 2 and all('"page":{"page_id":"home"}' in t for t in text)


def test_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([('{"id":1,"amount":12345678901234567.89,"n":{"x":[1]},"none":null}',)], "v STRING")
    assert df.select(text_map("v").alias("m")).first().m == {
        "id": "1", "amount": "12345678901234567.89", "n": '{"x":[1]}', "none": None
    }
