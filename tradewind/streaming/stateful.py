"""Streaming forms of the visitor operators: keyed state for the new-visitor repair, windows for bounces.

Keyed state needs the RocksDB state store. Times travel as epoch milliseconds: pandas timestamps would be
shifted by the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tradewind.functions.times import at_ms
from tradewind.operators.visits import is_entry

SLICES_PER_WINDOW = 6
_HEAD = "mid STRING, seq BIGINT, ts BIGINT, is_new STRING, value STRING"
CANDIDATE = "?"
HELD = 20_000
_HEAD_COLUMNS = ["mid", "seq", "ts", "is_new", "value"]


class NewFlagRepair(StatefulProcessor):
    """Remembers per visitor of a bucket that they were seen as new; optional expiry bounds the state.

    Of the candidates (``is_new`` as ``CANDIDATE``) the earliest of a visitor not met before comes out as
    new, the others as not. Visitors are looked up one by one, but the rows go through in chunks.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("visitors", "mid STRING", "first_ts BIGINT", self.ttl_ms)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for mid in initialState["mid"]:
            self.seen.updateValue(_visitor(mid), (-1,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known: dict[tuple, bool] = {}
        held = None  # the earliest row so far of each visitor not met before
        for chunk in rows:
            chunk = chunk[_HEAD_COLUMNS]
            for visitor in map(_visitor, chunk["mid"].unique()):
                if visitor not in known:
                    known[visitor] = self.seen.containsKey(visitor)
            old = chunk["mid"].map(lambda mid: known[_visitor(mid)]).astype(bool)
            if held is not None:
                chunk = pd.concat([held, chunk], ignore_index=True)
                old = pd.concat([pd.Series(False, index=range(len(held))), old], ignore_index=True)
            order = chunk[~old].sort_values(["ts", "seq"], kind="stable")
            first = order.index[~order["mid"].duplicated()]
            held, chunk = chunk.loc[first], chunk.drop(index=first)
            if len(chunk):
                yield chunk.assign(is_new="0")
        if held is not None and len(held):
            for mid, ts in zip(held["mid"], held["ts"], strict=True):
                self.seen.updateValue(_visitor(mid), (None if pd.isna(ts) else int(ts),))
            yield held.assign(is_new="1")

    def close(self) -> None:
        pass


def _visitor(mid: str | None) -> tuple[str]:
    """The state's key of a visitor; rows without one are a visitor, too."""
    return ("",) if mid is None or mid != mid else (f"={mid}",)


def _earliest_per_task(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the marked rows that a task has, at most ``HELD`` visitors at a time, the earliest of each visitor
    as a candidate, all others as not new."""
    held = None

    def flagged(rows: pa.Table, flag: str) -> list[pa.RecordBatch]:
        at = rows.schema.get_field_index("is_new")
        return rows.set_column(at, rows.schema.field(at), pa.array([flag] * len(rows), pa.string())).to_batches()

    for batch in chunks:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        keys = rows.select(["mid", "ts", "seq"]).to_pandas().sort_values(["ts", "seq"], kind="stable")
        first = np.zeros(len(rows), dtype=bool)
        first[keys.index[~keys["mid"].duplicated()]] = True
        yield from flagged(rows.filter(pa.array(~first)), "0")
        held = rows.filter(pa.array(first)).combine_chunks()
        if len(held) > HELD:
            yield from flagged(held, CANDIDATE)
            held = None
    if held is not None:
        yield from flagged(held, CANDIDATE)


def repair_new_flag_stream(
    heads: DataFrame, ttl_ms: int | None = None, seen: DataFrame | None = None, buckets: int = 1024
) -> DataFrame:
    """Streaming new-visitor repair over (seq, value, mid, is_new, ts) rows.

    Only rows marked new are looked at. Each task first tells the earliest of a visitor among its rows
    from the others, which are done with before anything is shuffled, so a hot visitor sends one candidate
    a task; the candidates go to the state of their visitors, which lies in ``buckets`` maps. Inside a
    micro-batch the earliest row of a visitor is the first, across batches arrival order decides. ``seen``
    holds the visitors of earlier runs (``visits.seen_visitors``), none of whose rows is the first; it is
    taken over when the checkpoint is new.
    """
    rows = heads.select(*[F.col(c).cast(kind).alias(c) for c, kind in (field.split() for field in _HEAD.split(", "))])
    bucket = F.pmod(F.xxhash64("mid"), F.lit(buckets)).alias("bucket")
    marked = rows.filter(F.col("is_new") == "1").mapInArrow(_earliest_per_task, _HEAD)
    others = rows.filter(~F.col("is_new").eqNullSafe("1"))
    initial = None if seen is None else seen.select("mid").distinct().select("mid", bucket).groupBy("bucket")
    candidates = marked.filter(F.col("is_new") == CANDIDATE).select("*", bucket).groupBy("bucket")
    decided = candidates.transformWithStateInPandas(
        NewFlagRepair(ttl_ms), outputStructType=_HEAD, outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None", initialState=initial,
    )
    done = marked.filter(F.col("is_new") != CANDIDATE)
    return others.unionByName(done).unionByName(decided)


class LateMarker(StatefulProcessor):
    """Tells rows behind the watermark from the others; keeps nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for chunk in rows:
            yield pd.DataFrame({"content": chunk["content"], "late": chunk["at"] < watermark})

    def close(self) -> None:
        pass


def mark_late(rows: DataFrame, ms: str = "ts", delay: str = "1 second", spread: int = 64) -> DataFrame:
    """The rows with ``late``: whether their time (epoch milliseconds) is behind the watermark, or missing.

    Windows drop such rows silently. The event-time column itself does not go through the processor,
    because Spark would drop them there, too; the rows are dealt by their content, so no key is hot.
    """
    timed = rows.withColumn("__time", at_ms(ms)).withWatermark("__time", delay)
    content = F.to_json(F.struct(*rows.columns))
    sent = timed.select(
        content.alias("content"), F.coalesce(F.col(ms), F.lit(-(1 << 63))).alias("at"),
        F.pmod(F.xxhash64(content), F.lit(spread)).alias("deal"),
    )
    marked = sent.groupBy("deal").transformWithStateInPandas(
        LateMarker(), outputStructType="content STRING, late BOOLEAN", outputMode="Append", timeMode="EventTime"
    )
    row = F.from_json("content", rows.schema).alias("row")
    return marked.select(row, "late").select("row.*", "late")


def bounces_stream(
    pages: DataFrame,
    within_ms: int = 10_000,
    slice_ms: int | None = None,
    delay: str = "1 second",
) -> DataFrame:
    """Streaming bounce detection, same rule and columns as the batch form.

    Rows may come in any order within the watermark delay. A visitor's events are gathered per time
    slice, as a sliding window that reaches ``within_ms`` into the next slice, and decided all at once
    when the watermark has passed its end: an ordinary windowed aggregate, without a Python process.
    A slice holds (ts, seq, entry) of its events; only entry pages bring their content along.
    """
    slice_ms = slice_ms or SLICES_PER_WINDOW * within_ms
    timed = pages.filter("ts IS NOT NULL").withColumn("event_time", at_ms("ts")).withWatermark("event_time", delay)
    entry = is_entry()
    content = F.when(entry, F.to_json(F.struct(*pages.columns)))
    event = F.struct("ts", "seq", entry.alias("entry"), content.alias("content"))
    slices = F.window("event_time", f"{slice_ms + within_ms} milliseconds", f"{slice_ms} milliseconds")
    groups = timed.groupBy("mid", slices.alias("slice")).agg(F.sort_array(F.collect_list(event)).alias("events"))

    def with_next(e: Column, i: Column) -> Column:
        following = F.get("events", i + 1)
        soon = F.coalesce(following["ts"] - e["ts"] < within_ms, F.lit(False))
        left = soon & ~F.coalesce(following["entry"], F.lit(True))
        own = e["ts"] < F.unix_millis("slice.start") + slice_ms
        kind = F.when(soon, "match").otherwise("timeout")
        return F.struct(e["content"].alias("content"), kind.alias("kind"), (own & e["entry"] & ~left).alias("kept"))

    found = groups.select(F.explode(F.filter(F.transform("events", with_next), lambda d: d["kept"])).alias("found"))
    page = F.from_json("found.content", pages.schema).alias("page")
    return found.select(page, "found.kind").select("page.*", "kind")
