"""Streams against batch: same rows through files, one file per trigger."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradewind.operators.enrichment import enrich
from tradewind.operators.intervals import interval_join
from tradewind.operators.visits import bounces, daily_unique
from tradewind.operators.windows import tumble, tumble_distinct, with_watermark
from tradewind.plans import log_split, order_wide, product_stats, reports
from tradewind.schemas import CDC_CHANGE, LOG_LINE, ORDER_DETAIL, ORDER_INFO, PAGE_LOG, ROUTING_RULE
from tradewind.sources import tables
from tradewind.streaming import jobs, sinks, stateful

PAGE = {"vc": "v1", "ch": "web", "ar": "1", "is_new": "0", "page_id": "home"}


class Feed:
    """A folder of JSON files read as a stream, one file per trigger in the order added."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.count = spark, path, schema, 0
        path.mkdir()

    def add(self, *rows):
        self.count += 1
        text = "\n".join(json.dumps(r) for r in rows)
        file = self.path / f"{self.count:04d}.json"
        file.write_text(text)
        # File streams take files by modification time.
        import os

        os.utime(file, (1_600_000_000 + self.count * 10,) * 2)

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.json(str(self.path))

    def batch(self):
        return self.spark.read.schema(self.schema).json(str(self.path))


def run(df, out, write=None):
    write = write or sinks.table_writer(f"{out}/rows")
    sinks.start(df, f"{out}/checkpoint", write, once=True).awaitTermination()


def result(spark, df, out):
    return spark.read.schema(df.schema).parquet(f"{out}/rows/batch=*")


def event(seq, mid, ts, last=None, **more):
    return {"seq": seq, "mid": mid, "ts": ts, "last_page_id": last, **PAGE, **more}


def test_bounces_out_of_order_and_across_a_restart(spark, rows, tmp_path):
    feed = Feed(spark, tmp_path / "in", PAGE_LOG)
    feed.add(event(1, "a", 9_000, "home"), event(2, "c", 5_000), event(3, "b", 1_000))
    feed.add(event(4, "a", 1_000), event(5, "c", 2_000), event(6, "d", 1_000))
    stream = stateful.bounces_stream(feed.stream(), delay="20 seconds")
    run(stream, tmp_path)
    assert rows(result(spark, stream, tmp_path)) == []
    feed.add(event(7, "d", 30_000, "home"), event(8, "z", 60_000))
    feed.add(event(9, "y", 200_000, "home"))
    run(stateful.bounces_stream(feed.stream(), delay="20 seconds"), tmp_path)
    run(stateful.bounces_stream(feed.stream(), delay="20 seconds"), tmp_path)
    got = result(spark, stream, tmp_path)
    assert rows(got, "mid", "ts", "kind") == rows(bounces(feed.batch()), "mid", "ts", "kind")
    assert rows(got, "mid", "ts") == [("b", 1_000), ("c", 2_000), ("c", 5_000), ("d", 1_000), ("z", 60_000)]
    assert {(r.vc, r.page_id) for r in got.collect()} == {("v1", "home")}


def test_new_flag_across_batches_and_restart(spark, rows, tmp_path):
    line = lambda mid, flag, ts: json.dumps({"common": {"mid": mid, "is_new": flag}, "page": {"page_id": "p"}, "ts": ts})
    feed = Feed(spark, tmp_path / "in", LOG_LINE)
    feed.add(*[{"seq": i, "value": line(*v)} for i, v in enumerate(
        [("a", "1", 3), ("a", "1", 1), ("a", "0", 2), ("b", "0", 1)])], {"seq": 9, "value": "oops{"})
    events = jobs.log_events(feed.stream())
    run(events.select("seq", "is_new", F.col("common")["is_new"].alias("written")), tmp_path)
    feed.add({"seq": 4, "value": line("a", "1", 0)}, {"seq": 5, "value": line("b", "1", 7)})
    out = jobs.log_events(feed.stream()).select("seq", "is_new", F.col("common")["is_new"].alias("written"))
    run(out, tmp_path)
    assert rows(result(spark, out, tmp_path)) == [
        (0, "0", "0"), (1, "1", "1"), (2, "0", "0"), (3, "0", "0"), (4, "0", "0"), (5, "1", "1")
    ]


def test_daily_unique(spark, rows, tmp_path):
    day = 86_400_000
    feed = Feed(spark, tmp_path / "in", PAGE_LOG)
    feed.add(event(1, "a", 1_000, "home"), event(2, "a", 5_000), event(3, "b", day - 1))
    feed.add(event(4, "a", 9_000), event(5, "b", day), event(6, "a", 2_000))
    stream = jobs.daily_unique(feed.stream()).select("mid", "dt")
    run(stream, tmp_path)
    assert rows(result(spark, stream, tmp_path)) == rows(daily_unique(feed.batch()), "mid", "dt")


def test_late_rows_are_dropped_from_windows(spark, rows, tmp_path):
    feed = Feed(spark, tmp_path / "in", "ts BIGINT, k STRING, o BIGINT")
    feed.add({"ts": 1_000, "k": "x", "o": 1}, {"ts": 2_000, "k": "x", "o": 1}, {"ts": 3_000, "k": "x", "o": 2})
    feed.add({"ts": 25_000, "k": "x", "o": 3})
    feed.add({"ts": 26_000, "k": "x", "o": 3})  # rows count as late one trigger after the watermark moved
    feed.add({"ts": 4_000, "k": "x", "o": 4}, {"ts": 40_000, "k": "x", "o": 5})
    timed = lambda df: with_watermark(df.withColumn("t", F.timestamp_millis("ts")), "t", "1 second")
    count = {"n": F.count("o")}

    def distinct(df):
        return tumble_distinct(timed(df), "t", ["k"], ["o"], count, {"d": F.count("o"), "n": F.sum("n")})

    plain = tumble(timed(feed.stream()), "t", ["k"], count)
    run(plain, tmp_path / "plain")
    exact = distinct(feed.stream())
    run(exact, tmp_path / "exact")
    assert rows(result(spark, plain, tmp_path / "plain"), "stt", "n") == [
        ("1970-01-01 00:00:00", 3), ("1970-01-01 00:00:20", 2)
    ]
    assert rows(result(spark, exact, tmp_path / "exact"), "stt", "d", "n") == [
        ("1970-01-01 00:00:00", 2, 3), ("1970-01-01 00:00:20", 1, 2)
    ]
    assert rows(distinct(feed.batch()), "stt", "d", "n")[0] == ("1970-01-01 00:00:00", 3, 4)


def test_interval_join_and_lookup(spark, rows, tmp_path):
    at = "2024-01-01 00:00:%02d"
    orders = Feed(spark, tmp_path / "orders", "id BIGINT, create_time STRING, province_id BIGINT")
    details = Feed(spark, tmp_path / "details", "id BIGINT, order_id BIGINT, create_time STRING")
    orders.add({"id": 1, "create_time": at % 10, "province_id": 1}, {"id": 2, "create_time": at % 12, "province_id": 7})
    details.add(*[{"id": s, "order_id": 1, "create_time": at % s} for s in (4, 5, 10, 15, 16)],
                {"id": 50, "order_id": 2, "create_time": at % 12})
    provinces = spark.createDataFrame([("1", "North")], "id STRING, name STRING")

    def wide(o, d):
        facts = order_wide.order_facts(o, d, delay="10 seconds")
        return enrich(facts, provinces, "province_id", {"name": "name"}).select("order_id", "detail_id", "name")

    stream = wide(orders.stream(), details.stream())
    run(stream, tmp_path)
    expected = [(1, 5, "North"), (1, 10, "North"), (1, 15, "North"), (2, 50, None)]
    assert rows(result(spark, stream, tmp_path)) == sorted(expected, key=repr)
    assert rows(wide(orders.batch(), details.batch())) == sorted(expected, key=repr)


def test_fan_out_writes_each_output_once(spark, rows, tmp_path):
    feed = Feed(spark, tmp_path / "in", LOG_LINE)
    page = {"common": {"mid": "a"}, "page": {"page_id": "p"}, "displays": [{"item": "1"}, {"item": "2"}], "ts": 1}
    feed.add({"seq": 1, "value": json.dumps(page)},
             {"seq": 2, "value": json.dumps({"common": {"mid": "a"}, "start": {"x": 1}, "ts": 2})})
    write = sinks.fan_out(jobs.log_outputs(), str(tmp_path / "out"))
    events = log_split.clean(feed.stream())
    run(events, tmp_path, lambda batch, number: (write(batch, number), write(batch, number)))  # a replay replaces itself
    counts = {n: spark.read.parquet(f"{tmp_path}/out/{n}").count() for n in ("start", "page", "display")}
    assert counts == {"start": 1, "page": 1, "display": 2}


def test_log_job_writes_four_outputs(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", LOG_LINE)
    page = {"common": {"mid": "a"}, "page": {"page_id": "p"}, "displays": [{"item": "1"}], "ts": 1}
    feed.add({"seq": 1, "value": json.dumps(page)}, {"seq": 2, "value": "no json {"},
             {"seq": 3, "value": json.dumps({"common": {"mid": "a"}, "start": {"x": 1}, "ts": 2})})
    for query in jobs.base_log(feed.stream(), str(tmp_path / "out"), once=True):
        query.awaitTermination()
    counts = {n: spark.read.parquet(f"{tmp_path}/out/rows/{n}").count() for n in ("start", "page", "display", "dirty")}
    assert counts == {"start": 1, "page": 1, "display": 1, "dirty": 1}


def test_rules_are_read_again_for_every_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", CDC_CHANGE)
    row = lambda seq, **after: {"database": "d", "table": "user", "after": after, "operation": "insert", "seq": seq}
    versions = iter(["id,name", "id,name,city", "id,name,city"])

    def rules():
        return spark.createDataFrame(
            [("user", "insert", "hbase", "dim_user", next(versions), None, None, 1)], ROUTING_RULE
        )

    feed.add(row(1, id="1", name="a", city="x"))
    feed.add(row(2, id="2", name="b", city="y"), row(3, id="1", name=None, city="z"))
    store = sinks.KeyedTable(spark, str(tmp_path / "dims"), ["sink_table", "id"], part="sink_table")
    run(feed.stream(), tmp_path, sinks.route_writer(rules, str(tmp_path / "out"), store))
    got = sinks.dimension(store, "dim_user", ["id", "name", "city"])
    assert sorted(tuple(r) for r in got.collect()) == [("1", "", "z"), ("2", "b", "y")]
    assert sinks.dimension(sinks.KeyedTable(spark, str(tmp_path / "no"), ["id"]), "x", ["id"]).count() == 0


def test_stats_table_is_pruned_by_day(spark, tmp_path):
    stats = spark.createDataFrame(
        [("2024-01-01 23:59:50", 2, 3), ("2024-01-02 00:00:00", 5, 7)], "stt STRING, pv_ct BIGINT, uv_ct BIGINT"
    )
    sinks.stats_writer(str(tmp_path / "s"), ["stt", "pv_ct"])(stats, 0)
    stored = tables.read_stats(spark, str(tmp_path / "s"))
    assert set(stored.columns) == {"stt", "pv_ct", "dt", "batch"}
    day = reports.on_day(stored, "20240102")
    assert [r.pv_ct for r in day.collect()] == [5]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "dims"), ["id"], buckets=16)
    table.merge(spark.range(200).selectExpr("CAST(id AS STRING) AS id", "id AS seq"))
    before = {f.name for f in (tmp_path / "dims/rows").glob("*/*.parquet")}
    table.merge(spark.createDataFrame([("7", 900)], "id STRING, seq BIGINT"))
    after = {f.parent.name for f in (tmp_path / "dims/rows").glob("*/*.parquet") if f.name not in before}
    assert len(after) == 1
    assert table.read().count() == 200 and table.read().filter("id = '7'").first().seq == 900


@pytest.mark.parametrize("kind", ["table", "json", "stats", "fan_out"])
def test_a_new_checkpoint_leaves_the_rows_of_the_old_one(spark, tmp_path, kind):
    out = str(tmp_path / "rows")
    writer = {
        "table": lambda: sinks.table_writer(out), "json": lambda: sinks.json_writer(out),
        "stats": lambda: sinks.stats_writer(out, ["stt", "n"]), "fan_out": lambda: sinks.fan_out({"all": lambda b: b}, out),
    }[kind]
    for run_number in range(2):
        feed = Feed(spark, tmp_path / f"in{run_number}", "stt STRING, n BIGINT")
        feed.add({"stt": "2024-01-01 00:00:00", "n": run_number})
        sinks.start(feed.stream(), str(tmp_path / f"checkpoint{run_number}"), writer(), once=True).awaitTermination()
    read = spark.read.text(f"{out}/batch=*") if kind == "json" else spark.read.parquet(f"{out}/all" if kind == "fan_out" else out)
    assert read.count() == 2


def test_a_running_job_sees_a_dimension_change(spark, rows, tmp_path):
    name = {1: "Old", 2: "New"}
    table = lambda columns, *data: spark.createDataFrame(list(data), ", ".join(f"{c} STRING" for c in columns.split()))

    def dims():
        return {
            "users": table("id gender birthday", ("7", "F", "1990-01-01")),
            "provinces": table("id name area_code iso_code iso_3166_2", ("1", name[number], "a", "i", "j")),
            "sku": table("id sku_name price spu_id tm_id category3_id"), "spu": table("id spu_name"),
            "trademark": table("id tm_name"), "category3": table("id name"),
        }

    orders, details = (Feed(spark, tmp_path / name, schema) for name, schema in (("o", ORDER_INFO), ("d", ORDER_DETAIL)))
    for number in (1, 2):
        at = f"2024-01-01 00:0{number}:00"
        orders.add({"id": number, "province_id": 1, "user_id": 7, "create_time": at})
        details.add({"id": number * 10, "order_id": number, "sku_id": 5, "create_time": at})
        query = jobs.wide_orders_by_batch(orders.stream(), details.stream(), dims, "2024-01-31", str(tmp_path / "wide"), once=True)
        query.awaitTermination()
    text = spark.read.text(f"{tmp_path}/wide/rows/batch=*")
    got = text.select(*[F.get_json_object("value", f"$.{c}").alias(c) for c in ("order_id", "province_name", "user_gender")])
    assert rows(got) == [("1", "Old", "F"), ("2", "New", "F")]


def test_late_rows_come_out_on_their_own(spark, rows, tmp_path):
    feed = Feed(spark, tmp_path / "in", "ts BIGINT, name STRING")
    feed.add({"ts": 1_000, "name": "a"}, {"ts": 9_000, "name": "b"})
    feed.add({"ts": 5_000, "name": "late"}, {"ts": 8_000, "name": "edge"}, {"ts": 20_000, "name": "c"}, {"name": "no time"})
    feed.add({"ts": 18_999, "name": "late too"}, {"ts": 19_000, "name": "edge too"})
    jobs.without_late(feed.stream(), str(tmp_path / "job"), once=True).awaitTermination()
    got = {k: rows(spark.read.parquet(f"{tmp_path}/job/rows/{k}"), "name") for k in ("on_time", "late")}
    assert got == {
        "on_time": [("a",), ("b",), ("c",), ("edge too",), ("edge",)], "late": [("late too",), ("late",), ("no time",)]
    }


def test_topic_records_are_ordered_by_time_over_partitions(spark):
    records = spark.createDataFrame(
        [(b"old", 3, 5, 1_000), (b"new", 0, 1, 2_000), (b"newer", 0, 2, 2_000)],
        "value BINARY, partition INT, offset BIGINT, ms BIGINT",
    ).selectExpr("value", "partition", "offset", "timestamp_millis(ms) AS timestamp")
    assert [r.value for r in tables.topic_lines(records).orderBy("seq").collect()] == ["old", "new", "newer"]


@pytest.mark.parametrize("kind", ["text", "csv"])
def test_files_round_trip(spark, tmp_path, kind):
    path = str(tmp_path / "f")
    if kind == "text":
        lines = spark.createDataFrame([('{"ts":1000}', 1), ("broken", 2)], LOG_LINE)
        tables.land_lines(lines, path)
        got = {(r.value, str(r.dt)) for r in tables.text_lines(spark, path).collect()}
        assert got == {('{"ts":1000}', "1970-01-01"), ("broken", "None")}
    else:
        tables.write_csv(spark.createDataFrame([(1, "a,b")], "id BIGINT, v STRING"), path)
        assert tuple(tables.read_csv(spark, path, "id BIGINT, v STRING").first()) == (1, "a,b")


def test_a_task_sends_one_candidate_of_a_hot_visitor(monkeypatch):
    def chunk(*rows):
        names = ["mid", "seq", "ts", "is_new", "value"]
        return pa.RecordBatch.from_pylist([dict(zip(names, (*r, "1", "v"), strict=True)) for r in rows])

    chunks = [chunk(("a", 1, 9), ("a", 2, 5), (None, 3, 4)), chunk(("a", 4, 5), (None, 5, 3), ("b", 6, 1))]

    def found():
        out = [r for batch in stateful._earliest_per_task(iter(chunks)) for r in batch.to_pylist()]
        assert sorted(r["seq"] for r in out) == [1, 2, 3, 4, 5, 6]
        return sorted(r["seq"] for r in out if r["is_new"] == stateful.CANDIDATE)

    assert found() == [2, 5, 6]
    monkeypatch.setattr(stateful, "HELD", 1)  # handed on earlier: more candidates, the state decides
    assert found() == [2, 3, 4, 5, 6]


def test_visitors_of_one_bucket_are_told_apart(spark, rows, tmp_path):
    feed = Feed(spark, tmp_path / "in", "mid STRING, seq BIGINT, ts BIGINT, is_new STRING, value STRING")
    head = lambda mid, seq, ts: {"mid": mid, "seq": seq, "ts": ts, "is_new": "1", "value": "v"}
    feed.add(head("a", 1, 9), head("a", 2, 5), head(None, 3, 4), head("", 4, 4))
    feed.add(head("a", 5, 1), head(None, 6, 1), head("b", 7, 3), head("b", 8, 2), head("c", 9, 1))
    seen = spark.createDataFrame([("c",)], "mid STRING")
    out = stateful.repair_new_flag_stream(feed.stream(), seen=seen, buckets=1)
    run(out, tmp_path)
    assert rows(result(spark, out, tmp_path).filter("is_new = '1'"), "seq") == [(2,), (3,), (4,), (8,)]


def test_a_stream_opens_few_state_stores(spark, tmp_path, monkeypatch):
    """One store per join partition, as many as the cores ask for; no batch after the last rows."""
    monkeypatch.setattr(sinks, "STORES_PER_CORE", 0.5)
    sides = []
    for name in ("left", "right"):
        feed = Feed(spark, tmp_path / name, f"{name} BIGINT, {name}_time TIMESTAMP")
        feed.add({name: 1, f"{name}_time": "2024-01-01 00:00:00"})
        sides.append(feed.stream().withWatermark(f"{name}_time", "0 seconds"))
    joined = interval_join(*sides, "left", "right", "left_time", "right_time")
    sinks.start(joined, f"{tmp_path}/job", sinks.json_writer(f"{tmp_path}/rows"), once=True, closes=False).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    folders = [p for p in (tmp_path / "job" / "state" / "0").iterdir() if p.is_dir() and p.name.isdigit()]
    assert len(folders) == 2 and not any((p / "left-keyToNumValues").exists() for p in folders)
    assert len([p for p in (tmp_path / "job" / "commits").iterdir() if p.name.isdigit()]) == 1
    assert list((tmp_path / "rows").glob("batch=*/*.gz")) and spark.read.text(f"{tmp_path}/rows/batch=*").count() == 1


def test_windows_are_held_in_few_entries(spark, rows, tmp_path):
    """A word counted per window does not cost an entry of state each: the state has at most 32 a window."""
    pages = [("search", " ".join(f"w{i}" for i in range(k, k + 300)), "SEARCH", k * 1000) for k in range(20)]
    schema = "last_page_id STRING, item STRING, source STRING, ts BIGINT"
    spark.createDataFrame([*pages, ("search", "late", "SEARCH", None)], schema).write.parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = jobs.keywords(feed, str(tmp_path / "job"), F.col("source"), once=True)
    query.awaitTermination()
    state = [op for batch in query.recentProgress for op in batch["stateOperators"]]
    assert state and max(op["numRowsUpdated"] for op in state) <= 2 * 32
    got = tables.read_stats(spark, str(tmp_path / "job" / "rows"))
    assert rows(got.filter("stt = '1970-01-01 00:00:00'"), "keyword", "ct")[:2] == [("w0", 1), ("w1", 2)]
    assert got.filter("stt = '1970-01-01 00:00:00'").agg(F.sum("ct")).first()[0] == 3000


def test_products_are_counted_where_they_were_held(spark, rows, tmp_path, monkeypatch):
    """rows of a sku and window come out of the state together, so counting them shuffles nothing; a run over
    everything keeps no list of state changes beside the state's files."""
    events = [(k % 7 if k % 11 else None, k % 3, k % 90 + 0.5) for k in range(400)]
    seen = spark.createDataFrame(events, "sku_id BIGINT, order_id BIGINT, s DOUBLE").selectExpr(
        "sku_id", "order_id", "CAST(sku_id AS DECIMAL(16,2)) AS refund_amount", "date_format(timestamp_seconds(s), 'yyyy-MM-dd HH:mm:ss') AS create_time"
    )
    acts = product_stats.refunds(seen)
    acts.write.parquet(str(tmp_path / "in"))
    plans, plan = [], product_stats.product_stats

    def seen_plan(batch):
        counted = plan(batch)
        plans.append(counted._jdf.queryExecution().executedPlan().toString())
        return counted

    monkeypatch.setattr(product_stats, "product_stats", seen_plan)
    feed = spark.readStream.schema(acts.schema).parquet(str(tmp_path / "in"))
    jobs.products(feed, str(tmp_path / "job"), once=True).awaitTermination()
    assert plans and not any("Exchange" in p for p in plans)
    got = spark.read.parquet(str(tmp_path / "job" / "rows")).select(*product_stats.COLUMNS)
    assert rows(got) == rows(plan(acts).filter("stt < '1970-01-01 00:01:20'"))
    state = tmp_path / "job" / "job" / "state"
    assert list(state.rglob("*.zip")) and not list(state.rglob("*.changelog"))


def test_wide_rows_move_for_products_before_they_get_longer(spark, rows, tmp_path, monkeypatch):
    """on streams the rows that are shuffled to the products have no province and no parts of their time yet."""
    at = "2024-01-01 00:00:%02d"
    orders, details = Feed(spark, tmp_path / "orders", ORDER_INFO), Feed(spark, tmp_path / "details", ORDER_DETAIL)
    orders.add({"id": 1, "create_time": at % 10, "province_id": 1, "user_id": 5}, {"id": 2, "create_time": None})
    details.add(*[{"id": s, "order_id": 1, "sku_id": s % 2, "sku_name": "own", "create_time": at % s} for s in (4, 5, 10)])
    table = lambda values, names: spark.createDataFrame(values, ", ".join(f"{n} STRING" for n in names.split()))
    dims = [
        table([("5", "F", "1990-01-01")], "id gender birthday"), table([("1", "North", "a", "b", "c")], "id name area_code iso_code iso_3166_2"),
        table([("1", "tea", "2.00", "7", "8", "9")], "id sku_name price spu_id tm_id category3_id"), table([("7", "teas")], "id spu_name"),
        table([("8", "mark")], "id tm_name"), table([("9", "drink")], "id name"),
    ]
    want = order_wide.order_wide(orders.batch(), details.batch(), *dims, "2024-01-31").drop(order_wide.ORDER_TIME)
    moved, with_product = [], order_wide.with_product

    def seen(wide, products):
        moved.append(wide.columns)
        return with_product(wide, products)

    monkeypatch.setattr(order_wide, "with_product", seen)
    jobs.wide_orders(orders.stream(), details.stream(), *dims, as_of="2024-01-31", path=str(tmp_path / "job"), once=True).awaitTermination()
    assert moved and not {"create_date", "create_hour", "province_name"} & set(moved[0])
    got = spark.read.text(f"{tmp_path}/job/rows/batch=*").select(F.from_json("value", want.schema).alias("row")).select("row.*")
    assert rows(got) == rows(want) and got.count() == 2


def test_a_checkpoint_goes_on_with_and_without_a_list_of_changes(spark, rows, tmp_path):
    """runs over everything upload their state once, without a list of changes beside it; a job that keeps one
    goes on from theirs, and they from its."""
    at, sides = "2024-01-01 00:00:0%d", {}
    for name in ("left", "right"):
        sides[name] = Feed(spark, tmp_path / name, f"{name} BIGINT, {name}_time TIMESTAMP")
    sides["left"].add({"left": 1, "left_time": at % 1})
    sides["right"].add({"right": 9, "right_time": at % 1})
    state, lists = tmp_path / "job" / "state", []
    for k, once in enumerate((True, False, True)):
        timed = [feed.stream().withWatermark(f"{name}_time", "10 seconds") for name, feed in sides.items()]
        joined = interval_join(*timed, "left", "right", "left_time", "right_time")
        query = sinks.start(
            joined, f"{tmp_path}/job", sinks.json_writer(f"{tmp_path}/rows"), once=once, interval="1 second", closes=False
        )
        if once:
            query.awaitTermination()
        else:
            query.processAllAvailable()
            query.stop()
        lists.append(len(list(state.rglob("*.changelog"))))
        sides["right"].add({"right": 1, "right_time": at % (k + 2)})
    assert lists[0] == 0 and list(state.rglob("*.zip")) and lists[1] > 0 and lists[2] == lists[1]
    got = spark.read.text(f"{tmp_path}/rows/batch=*").select(F.from_json("value", "left INT, right_time STRING").alias("r"))
    assert [v[0] for v in rows(got.select(F.substring("r.right_time", 18, 2)))] == ["02", "03"]
