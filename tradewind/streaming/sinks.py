"""Micro-batch sinks. Every file sink is idempotent: a replayed batch overwrites its own folder.

Batch numbers start again with every checkpoint, so the folder carries the id of the streaming query,
too: rows that another checkpoint wrote stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradewind.operators import routing, upsert
from tradewind.sources.tables import with_day

BatchWriter = Callable[[DataFrame, int], None]


STORES_PER_CORE = 4


def start(
    df: DataFrame, checkpoint: str, write: BatchWriter, once: bool = False, interval: str = "10 seconds",
    closes: bool = True,
) -> StreamingQuery:
    """Run a stream into a batch writer; ``once`` takes what is there and stops.

    A new checkpoint gets at most ``STORES_PER_CORE`` state partitions per core, as every batch opens and
    commits all of them. ``closes``: whether rows wait for the watermark; without (inner joins), no batch
    runs only to drop state, which the next one with rows does. With ``once`` a batch changes so much state that
    its files are uploaded anyway, so no list of the changes is kept beside them; a checkpoint may be taken up
    either way.
    """
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stores = min(partitions, max(1, int(STORES_PER_CORE * spark.sparkContext.defaultParallelism)))
    settings = {
        "spark.sql.shuffle.partitions": stores, "spark.sql.streaming.noDataMicroBatches.enabled": closes,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": not once,
    }
    # The stream takes a copy of the settings when it starts.
    with _settings(spark, settings):
        return writer.start()


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, object]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, str(value).lower())
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def batch_folder(batch: DataFrame, batch_id: int) -> str:
    """``batch=<query>-<number>`` inside a stream, ``batch=<number>`` for a batch written by hand."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"batch={run}-{batch_id}" if run else f"batch={batch_id}"


def topic_sink(df: DataFrame, servers: str, checkpoint: str, topic: str | None = None) -> StreamingQuery:
    """Rows to a topic; without ``topic`` each row names its own in a ``topic`` column."""
    writer = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        writer = writer.option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def as_json(df: DataFrame) -> DataFrame:
    """Rows as JSON text in ``value``."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def console(df: DataFrame) -> StreamingQuery:
    return df.writeStream.format("console").start()


def table_writer(path: str, columns: list[str] | None = None) -> BatchWriter:
    """Rows to parquet, one folder per batch; ``columns`` fixes what is stored and in what order."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns) if columns else batch
        rows.write.mode("overwrite").parquet(f"{path}/{batch_folder(batch, batch_id)}")

    return write


def json_writer(path: str) -> BatchWriter:
    """Rows as packed JSON text, one folder per batch: what a topic between two jobs would carry."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = as_json(batch).write.mode("overwrite").option("compression", "gzip")
        rows.text(f"{path}/{batch_folder(batch, batch_id)}")

    return write


def stats_writer(path: str, columns: list[str]) -> BatchWriter:
    """Statistics rows to parquet below ``dt`` folders, so a report on a day reads that day only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_day(batch.select(*columns))
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("dt").parquet(f"{path}/{batch_folder(batch, batch_id)}")

    return write


def by_batch(plan: Callable[[DataFrame], DataFrame], write: BatchWriter, partitions: str, coalesce: bool = True) -> BatchWriter:
    """Each batch through ``plan``, a plan over tables, then to ``write``. It shuffles to ``partitions``, as
    a table would, not to the few state partitions of its stream. ``coalesce``: whether small partitions are
    put together; not where few bytes become many rows."""
    settings = {"spark.sql.shuffle.partitions": partitions} | ({} if coalesce else {"spark.sql.adaptive.coalescePartitions.enabled": False})

    def run(batch: DataFrame, batch_id: int) -> None:
        with _settings(batch.sparkSession, settings):
            write(plan(batch), batch_id)

    return run


def jdbc_writer(url: str, table: str, columns: list[str], **options: str) -> BatchWriter:
    """Rows to a database table by position, each batch whole (a replay may repeat it)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*columns)
        rows.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).options(
            **options
        ).save()

    return write


def fan_out(outputs: Mapping[str, Callable[[DataFrame], DataFrame]], path: str) -> BatchWriter:
    """Split each batch into named outputs; the batch is computed once and written per output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = batch_folder(batch, batch_id)
        batch.persist()
        try:
            for name, select in outputs.items():
                select(batch).write.mode("overwrite").parquet(f"{path}/{name}/{folder}")
        finally:
            batch.unpersist()

    return write


class KeyedTable:
    """Keyed rows as a plain partitioned table; a merge rewrites the partitions that its changes touch.

    Rows lie by ``part`` (a column, if given) and a bucket of their keys' hash. A merge is written whole
    to a second folder and copied from there by dynamic partition overwrite. If that is interrupted, the
    next merge copies it again before it does anything else, so partitions are never half written for
    long and none is lost. A replayed batch is merged again, which changes nothing, as a change never
    replaces a row of the same or a higher ``seq``; checkpoints and batch numbers do not matter. One
    writer at a time; readers between two partitions see the one before and the other after a merge.
    """

    BUCKET = "__bucket"

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], seq: str = "seq", buckets: int = 16, part: str | None = None
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.seq, self.buckets = keys, seq, buckets
        self.split = [part, self.BUCKET] if part else [self.BUCKET]

    def _stored(self, name: str) -> DataFrame | None:
        """The rows of a folder; None if it is not there or holds nothing."""
        try:
            found = self.spark.read.parquet(f"{self.path}/{name}").schema
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        # Folder names are text, whatever they look like.
        kinds = [T.StructField(f.name, T.StringType()) if f.name in self.split[:-1] else f for f in found]
        return self.spark.read.schema(T.StructType(kinds)).parquet(f"{self.path}/{name}")

    def read(self) -> DataFrame | None:
        """All rows; read it again for every batch to stay fresh."""
        rows = self._stored("rows")
        return None if rows is None else rows.drop(self.BUCKET)

    def _write(self, rows: DataFrame, name: str, mode: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(*self.split).parquet(f"{self.path}/{name}")

    def _finish(self) -> None:
        """Copy what is pending, then leave nothing pending."""
        pending = self._stored("pending")
        if pending is None or pending.isEmpty():
            return
        self._write(pending, "rows", "dynamic")
        self.spark.createDataFrame([], pending.schema).write.mode("overwrite").parquet(f"{self.path}/pending")

    def merge(self, changes: DataFrame) -> None:
        self._finish()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        newest = upsert.latest(changes, self.keys, self.seq).withColumn(self.BUCKET, bucket).persist()
        try:
            stored = self._stored("rows")
            if stored is not None:
                touched = newest.select(*[F.col(c).alias(f"{c}_") for c in self.split]).distinct()
                same = [stored[c].eqNullSafe(touched[f"{c}_"]) for c in self.split]
                stored = stored.join(touched, same, "left_semi").select(*newest.columns)
            self._write(upsert.upsert(stored, newest, self.keys, self.seq), "pending", "static")
        finally:
            newest.unpersist()
        self._finish()


def route_writer(
    load_rules: Callable[[], DataFrame], path: str, dims: KeyedTable, create: Callable[[Row], None] | None = None,
    versioned: bool = False,
) -> BatchWriter:
    """Route a batch of changes by the rules of the moment (``versioned``: of the moment of each change):
    facts, rejects, and dimension rows merged into one keyed table (``sink_table``, ``id``).

    ``create`` is called for every keyed-table rule that this writer has not met before its first rows
    are written (see ``catalog_table``). Rules are few: those in force are looked through at the driver.
    """
    met: set[Row] = set()

    def write(batch: DataFrame, batch_id: int) -> None:
        rules = load_rules()
        if create:
            for rule in routing.table_rules(rules).collect():
                if rule not in met:
                    create(rule)
                    met.add(rule)
        folder = batch_folder(batch, batch_id)
        routed = (routing.route_at if versioned else routing.route)(batch, rules).persist()
        try:
            routing.facts(routed).write.mode("overwrite").partitionBy("topic").parquet(f"{path}/facts/{folder}")
            routing.rejected(routed).write.mode("overwrite").parquet(f"{path}/rejects/{folder}")
            dims.merge(upsert.blank_nulls(routing.dimension_changes(routed)))
        finally:
            routed.unpersist()

    return write


def dimension(store: KeyedTable, sink_table: str, columns: list[str]) -> DataFrame:
    """One dimension of the keyed store as a table of text columns."""
    rows = store.read()
    if rows is None:
        schema = ", ".join(f"{c} STRING" for c in columns)
        return store.spark.createDataFrame([], schema)
    return rows.filter(F.col("sink_table") == sink_table).select(
        *[F.col("after")[c].alias(c) for c in columns]
    )


def create_table(spark: SparkSession, path: str, sink_columns: str, sink_pk: str | None = None) -> None:
    """Make the empty table a rule asks for; an existing one is left alone."""
    schema = routing.table_schema(sink_columns, sink_pk)
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def catalog_table(spark: SparkSession, path: str, database: str = "default") -> Callable[[Row], None]:
    """For ``route_writer``: a rule's table as a table of the catalog below ``path``, made if it is not there.

    Its columns are text, the key is not null; what the rule says in ``sink_extend`` (``name=value``
    pairs, comma separated; a name alone is set to true) becomes its table properties.
    """

    def create(rule: Row) -> None:
        quoted = lambda name: "`" + name.replace("`", "``") + "`"
        text = lambda value: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        schema = routing.table_schema(rule.sink_columns, rule.sink_pk)
        columns = ", ".join(f"{quoted(f.name)} STRING{'' if f.nullable else ' NOT NULL'}" for f in schema)
        given = dict((*pair.split("=", 1), "true")[:2] for pair in (rule.sink_extend or "").split(",") if pair.strip())
        said = ", ".join(f"{text(name.strip())} = {text(value.strip())}" for name, value in given.items())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {quoted(database)}.{quoted(rule.sink_table)} ({columns}) USING parquet "
            + (f"TBLPROPERTIES ({said}) " if said else "")
            + f"LOCATION {text(f'{path}/{rule.sink_table}')}"
        )

    return create
