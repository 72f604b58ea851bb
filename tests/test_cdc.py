import json

import pytest

from tradewind.operators import routing, upsert
from tradewind.schemas import CDC_CHANGE, CDC_RECORD, ROUTING_RULE
from tradewind.sources import cdc
from tradewind.streaming import sinks


def change(table, operation, seq, **after):
    return ("shop", table, {}, {k: v for k, v in after.items()}, operation, seq)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), CDC_CHANGE)


def rules(spark):
    return spark.createDataFrame(
        [("user", "insert", "hbase", "dim_user", "id", None, None, 1),
         ("user", "insert", "hbase", "dim_user", "id,name", None, None, 9),
         ("user", "update", "hbase", "dim_user", "id,name", "id", None, 2),
         ("brand", "insert", "clickhouse", "dim_brand", "code,name", "code", None, 3),
         ("order", "insert", "kafka", "dwd_order", "id,total", None, None, 4)],
        ROUTING_RULE,
    )


def test_normalise(spark):
    records = spark.createDataFrame(
        [("srv.shop.user", None, '{"id":1,"amount":12345678901234567.89}', "CREATE", 1),
         ("srv.shop.user", '{"id":1}', '{"id":1,"name":null}', "UPDATE", 2),
         ("srv.shop.user", '{"id":1}', None, "DELETE", 3), ("srv.shop.user", None, '{"id":2}', "READ", 4)],
        CDC_RECORD,
    )
    normal = cdc.normalise(records)
    got = {r.seq: r for r in cdc.from_envelope(cdc.envelope(normal)).collect()}
    assert [(got[i].operation, got[i].before, got[i].after) for i in (1, 2, 3, 4)] == [
        ("insert", {}, {"id": "1", "amount": "12345678901234567.89"}),
        ("update", {"id": "1"}, {"id": "1", "name": None}), ("delete", {"id": "1"}, {}),
        ("read", {}, {"id": "2"}),
    ]
    assert {(r.database, r.table) for r in got.values()} == {("shop", "user")}


def test_routing(spark, rows):
    routed = routing.route(
        changes(
            spark,
            change("user", "insert", 1, id="1", name="a", secret="x"), change("user", "delete", 2, id="1"),
            change("nowhere", "insert", 3, id="1"), change("order", "insert", 4, id="1", total="2.50", other="y"),
            change("order", "update", 5, id="1"), change("brand", "insert", 6, code="c", name="n"),
            ("shop", "user", {}, {"id": "7"}, None, 7),
        ),
        rules(spark),
    )
    fact = routing.facts(routed).first()
    assert (fact.topic, json.loads(fact.value), fact.seq) == ("dwd_order", {"id": "1", "total": "2.50"}, 4)
    assert routing.facts(routed).count() == 1
    dims = {(r.sink_table, r.id, r.seq): r.after for r in routing.dimension_changes(routed).collect()}
    assert dims == {("dim_user", "1", 1): {"id": "1", "name": "a"}, ("dim_brand", "c", 6): {"code": "c", "name": "n"}}
    assert rows(routing.rejected(routed), "seq") == [(3,), (5,), (7,)]


def test_a_replay_routes_as_the_first_run(spark, rows):
    snapshot = [("user", "insert", "hbase", "dim_a", "id", None, None, None)]
    later = [("user", "insert", "hbase", "dim_b", "id,name", None, None, 10), ("user", "insert", None, None, None, None, None, 20)]
    early = changes(spark, change("user", "insert", 3, id="1", name="x"), change("user", "insert", 9, id="2", name="y"))
    late = changes(spark, change("user", "insert", 10, id="3", name="z"), change("user", "insert", 20, id="4", name="w"))
    first = routing.route_at(early, spark.createDataFrame(snapshot, ROUTING_RULE))
    everything = spark.createDataFrame(snapshot + later, ROUTING_RULE)
    again = routing.route_at(early.unionByName(late), everything)
    assert rows(first, "seq", "sink_table") == [(3, "dim_a"), (9, "dim_a")]
    assert rows(again, "seq", "sink_table") == [(10, "dim_b"), (20, None), (3, "dim_a"), (9, "dim_a")]
    assert {r.seq: len(r.after) for r in again.collect()} == {3: 1, 9: 1, 10: 2, 20: 2}
    assert rows(routing.rejected(again), "seq") == [(20,)]


def test_table_layout_from_rules(spark, rows):
    schema = routing.table_schema("code,name", "code")
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("code", "string", False), ("name", "string", True)
    ]
    assert [f.nullable for f in routing.table_schema("id,name")] == [False, True]
    assert rows(routing.rule_columns(rules(spark)), "sink_table", "position", "column_name", "is_key") == [
        ("dim_brand", 0, "code", True), ("dim_brand", 1, "name", False),
        ("dim_user", 0, "id", True), ("dim_user", 1, "name", False),
    ]


def test_upsert_and_blank_nulls(spark, rows):
    layout = "sink_table STRING, id STRING, after MAP<STRING, STRING>, seq BIGINT"
    stored = spark.createDataFrame([("t", "1", {"v": "old"}, 5), ("t", "2", {"v": "keep"}, 5), ("t", "3", {"v": "new"}, 50)], layout)
    incoming = spark.createDataFrame(
        [("t", "1", {"v": "mid"}, 7), ("t", "1", {"v": None}, 8), ("t", "3", {"v": "late"}, 6), ("u", "1", {"v": "other"}, 9)],
        layout,
    )
    merged = upsert.upsert(stored, upsert.blank_nulls(incoming), ["sink_table", "id"])
    assert sorted((r.sink_table, r.id, r.after["v"]) for r in merged.collect()) == [
        ("t", "1", ""), ("t", "2", "keep"), ("t", "3", "new"), ("u", "1", "other")
    ]


def test_keyed_table_replays(spark, rows, tmp_path):
    layout = "id STRING, v STRING, bucket STRING, seq BIGINT"
    table = sinks.KeyedTable(spark, str(tmp_path / "dim"), ["id"])
    assert table.read() is None
    table.merge(spark.createDataFrame([("1", "a", "x", 1), ("2", "b", "y", 2)], layout))
    second = spark.createDataFrame([("1", "c", "z", 3)], layout)
    table.merge(second)
    table.merge(second)
    assert rows(table.read(), "id", "v", "bucket") == [("1", "c", "z"), ("2", "b", "y")]
    table.merge(spark.createDataFrame([("3", "d", None, 4), ("2", "old", None, 1)], layout))
    assert rows(table.read(), "id", "v", "bucket") == [("1", "c", "z"), ("2", "b", "y"), ("3", "d", None)]


def test_a_merge_that_was_interrupted_is_finished_by_the_next(spark, rows, tmp_path, monkeypatch):
    layout = "kind STRING, id STRING, name STRING, seq BIGINT"
    table = sinks.KeyedTable(spark, str(tmp_path / "dim"), ["kind", "id"], part="kind")
    table.merge(spark.createDataFrame([("007", "1", "a", 1), (None, "2", "b", 2)], layout))
    stopped = sinks.KeyedTable(spark, table.path, ["kind", "id"], part="kind")
    finish, calls = stopped._finish, iter([True, False])
    monkeypatch.setattr(stopped, "_finish", lambda: finish() if next(calls) else None)
    stopped.merge(spark.createDataFrame([("007", "1", "c", 3)], layout))
    assert rows(table.read(), "kind", "id", "name") == [("007", "1", "a"), (None, "2", "b")]
    table.merge(spark.createDataFrame([("8", "3", "d", 4)], layout))
    assert rows(table.read(), "kind", "id", "name") == [("007", "1", "c"), ("8", "3", "d"), (None, "2", "b")]


def test_an_unreadable_table_is_no_missing_table(spark, tmp_path):
    (tmp_path / "dim" / "rows").mkdir(parents=True)
    (tmp_path / "dim" / "rows" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        sinks.KeyedTable(spark, str(tmp_path / "dim"), ["id"]).read()


def test_a_rule_has_its_table_made_before_its_first_row(spark, tmp_path):
    versions = [[("user", "insert", "hbase", "made_user", "code,name", "code", "SALT_BUCKETS=4, note=it's, IMMUTABLE_ROWS", 1)],
                [("brand", "insert", "hbase", "made_brand", "id,name", None, None, 1)]]
    made = []
    create = sinks.catalog_table(spark, str(tmp_path / "tables"))

    def noted(rule):
        create(rule)
        made.append(rule.sink_table)

    dims = sinks.KeyedTable(spark, str(tmp_path / "dims"), ["sink_table", "id"], part="sink_table")
    load = lambda: spark.createDataFrame(versions[0] + (versions[1] if made else []), ROUTING_RULE)
    write = sinks.route_writer(load, str(tmp_path / "out"), dims, noted)
    write(changes(spark), 0)  # no row yet
    assert made == ["made_user"] and spark.table("made_user").count() == 0
    write(changes(spark, change("brand", "insert", 1, id="1", name="n")), 1)
    write(changes(spark, change("brand", "insert", 2, id="2", name="m")), 2)
    assert made == ["made_user", "made_brand"]
    said = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES made_user").collect()}
    assert (said["SALT_BUCKETS"], said["note"], said["IMMUTABLE_ROWS"]) == ("4", "it's", "true")
    assert [f.name for f in spark.table("made_user").schema] == ["code", "name"]
    spark.sql("DROP TABLE made_user")
    spark.sql("DROP TABLE made_brand")


def test_create_table_leaves_an_existing_one_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_table(spark, path, "id,name")
    spark.createDataFrame([("1", "a")], "id STRING, name STRING").write.mode("append").parquet(path)
    sinks.create_table(spark, path, "id,name")
    assert spark.read.parquet(path).count() == 1


def test_changes_are_not_moved_to_meet_their_rules(spark):
    """Without adaptive execution, as in a stream's batch: all changes of a table would meet in one task."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        routed = routing.route(changes(spark, change("user_info", "insert", 1, id="1")), rules(spark))
        plan = routed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
