"""Rule-driven routing of row changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STREAM_SINK = "kafka"
DEFAULT_KEY = "id"


def latest_rules(rules: DataFrame) -> DataFrame:
    """The rule in force per source table and operation: the one with the highest ``seq``."""
    body = F.struct("sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend")
    return (
        rules.groupBy("source_table", "operate_type")
        .agg(F.max_by(body, "seq").alias("rule"))
        .select("source_table", "operate_type", "rule.*")
    )


def keep_listed(row: Column, columns: Column) -> Column:
    """Keep the entries of a map whose key is in a comma list (no trimming)."""
    wanted = F.split(columns, ",")
    return F.map_filter(row, lambda key, _: F.array_contains(wanted, key))


def rule_versions(rules: DataFrame) -> DataFrame:
    """Every rule with the range of change numbers it holds for: from its own ``seq`` to the next one's.

    A rule without ``seq`` belongs to the first snapshot and holds from the beginning; a version without
    a ``sink_table`` ends the rule. Of versions with one ``seq`` the largest by its columns counts.
    """
    body = F.struct("sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend")
    one = rules.groupBy("source_table", "operate_type", F.col("seq").alias("valid_from")).agg(F.max(body).alias("rule"))
    following = Window.partitionBy("source_table", "operate_type").orderBy(F.asc_nulls_first("valid_from"))
    ranged = one.withColumn("valid_to", F.lead("valid_from").over(following))
    return ranged.select("source_table", "operate_type", "valid_from", "valid_to", "rule.*")


def _routed(changes: DataFrame, rules: DataFrame, holds: Column) -> DataFrame:
    live = changes.filter(~F.col("operation").eqNullSafe("delete"))
    same = (live["table"] == F.col("source_table")) & (live["operation"] == F.col("operate_type"))
    cut = keep_listed(F.col("after"), F.col("sink_columns"))
    return live.join(F.broadcast(rules), same & holds, "left").select(
        *[c for c in changes.columns if c != "after"],
        F.when(F.col("sink_columns").isNull() | F.col("sink_table").isNull(), F.col("after")).otherwise(cut).alias("after"),
        "sink_type",
        "sink_table",
        F.coalesce("sink_pk", F.lit(DEFAULT_KEY)).alias("sink_pk"),
    )


def route(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Match each change that is not a delete with its rule, the one in force now.

    Adds ``sink_type``, ``sink_table``, ``sink_pk`` and cuts ``after`` to the listed columns. A
    change without a rule keeps nulls there (see ``rejected``). Changes have few distinct tables and
    operations, on which they would pile up in a shuffle, so the rules go to the changes: they are few,
    but Spark does not know the size of rows handed in from Python.
    """
    return _routed(changes, latest_rules(rules), F.lit(True))


def route_at(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """As ``route``, with the rule that was in force at the number (``seq``) of each change.

    Rules and changes are numbered by one clock. A replay with more rules than the first run had routes
    the old changes as the first run did.
    """
    holds = (F.col("valid_from").isNull() | (changes["seq"] >= F.col("valid_from"))) & (
        F.col("valid_to").isNull() | (changes["seq"] < F.col("valid_to"))
    )
    return _routed(changes, rule_versions(rules), holds)


def facts(routed: DataFrame) -> DataFrame:
    """Changes for a stream topic; the payload is ``after`` as JSON text."""
    return routed.filter(F.col("sink_type") == STREAM_SINK).select(
        F.col("sink_table").alias("topic"), F.to_json("after").alias("value"), "seq"
    )


def dimension_changes(routed: DataFrame) -> DataFrame:
    """Changes for a keyed table: every matched rule that is not a stream sink."""
    return routed.filter(
        F.col("sink_table").isNotNull() & ~F.col("sink_type").eqNullSafe(STREAM_SINK)
    ).select("sink_table", F.col("after")[F.col("sink_pk")].alias("id"), "after", "seq")


def rejected(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("sink_table").isNull()).select("database", "table", "operation", "after", "seq")


def table_schema(sink_columns: str, sink_pk: str | None = None) -> T.StructType:
    """All-text schema of the table a rule asks for; the key column is the one that is not null."""
    key = sink_pk or DEFAULT_KEY
    return T.StructType([T.StructField(c, T.StringType(), c != key) for c in sink_columns.split(",")])


def table_rules(rules: DataFrame) -> DataFrame:
    """The rules in force that ask for a keyed table: name, columns, key, properties."""
    keyed = latest_rules(rules).filter(~F.col("sink_type").eqNullSafe(STREAM_SINK))
    keyed = keyed.filter("sink_table IS NOT NULL AND sink_columns IS NOT NULL")
    return keyed.select("sink_table", "sink_columns", "sink_pk", "sink_extend").distinct()


def rule_columns(rules: DataFrame) -> DataFrame:
    """Columns of every keyed table the rules ask for: name, position, type, key flag."""
    keyed = latest_rules(rules).filter(~F.col("sink_type").eqNullSafe(STREAM_SINK))
    named = keyed.select(
        "sink_table",
        F.coalesce("sink_pk", F.lit(DEFAULT_KEY)).alias("__key"),
        F.posexplode(F.split("sink_columns", ",")).alias("position", "column_name"),
    ).distinct()
    return named.select(
        "sink_table",
        "position",
        "column_name",
        F.lit("varchar").alias("column_type"),
        (F.col("column_name") == F.col("__key")).alias("is_key"),
    )
