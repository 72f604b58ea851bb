"""First-event and next-event logic per visitor, batch form.

None of these may hand a whole visitor to one task: a robot or an empty device id can own a third
of the log. First events are reduced before the shuffle; next events are looked up inside short
(visitor, time cell) groups, which know only the first event of the cell after them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.times import day_text, is_blank

CELLS = 16


def is_entry() -> Column:
    """A page nobody came from inside the app: the start of a session."""
    return is_blank("last_page_id")


def _position(order: tuple[str, str]) -> Column:
    """Two whole numbers as one decimal that sorts like them, nulls first; a plain minimum can be hashed."""
    least = -(1 << 63)
    time, tie = (f"CAST(coalesce({c}, {least}) AS DECIMAL(19,0))" for c in order)
    return F.expr(f"CAST({time} * {10**19}BD AS DECIMAL(38,0)) + {tie}")


def repair_new_flag(
    df: DataFrame, visitor: str = "mid", flag: str = "is_new", order: tuple[str, str] = ("ts", "seq"),
    seen: DataFrame | None = None,
) -> DataFrame:
    """Keep ``'1'`` on a visitor's first ``'1'`` row and set it to ``'0'`` on the later ones.

    ``order`` (whole numbers) must identify a row within its visitor; ``seen`` holds the visitors of
    earlier runs, of whom no row is the first (see ``seen_visitors``). Rows with another flag are not
    moved. The earliest position per visitor is a partially aggregated minimum; it is joined back on
    visitor *and* position, so the rows of a hot visitor spread over all partitions.
    """
    is_one = F.coalesce(F.col(flag) == "1", F.lit(False))
    ones = df.filter(is_one).withColumn("__at", _position(order))
    first = ones.groupBy(F.col(visitor).alias("__visitor")).agg(F.min("__at").alias("__first"))
    if seen is not None:
        known = seen.select(F.col(visitor).alias("__seen"))
        first = first.join(known, F.col("__visitor").eqNullSafe(F.col("__seen")), "left_anti")
    same = ones[visitor].eqNullSafe(first["__visitor"]) & (ones["__at"] == first["__first"])
    marked = ones.join(first, same, "left").withColumn(flag, F.when(F.col("__first").isNull(), "0").otherwise("1"))
    return df.filter(~is_one).unionByName(marked.select(*df.columns))


def seen_visitors(df: DataFrame, visitor: str = "mid", flag: str = "is_new", seen: DataFrame | None = None) -> DataFrame:
    """The visitors to hand to the next run: those of ``seen`` and all that came as new."""
    own = df.filter(F.col(flag) == "1").select(visitor)
    return (own if seen is None else own.unionByName(seen.select(visitor))).distinct()


def daily_unique(
    pages: DataFrame,
    visitor: str = "mid",
    order: tuple[str, ...] = ("ts", "seq"),
    entry: Column | None = None,
) -> DataFrame:
    """First entry page per visitor and calendar day, with the day as ``dt``.

    ``row_number() = 1`` runs as a group limit before the shuffle: each task sends at most one row
    per visitor and day.
    """
    entries = pages.filter(is_entry() if entry is None else entry).withColumn("dt", day_text("ts"))
    w = Window.partitionBy(visitor, "dt").orderBy(*order)
    return entries.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def slice_of(ts: str, slice_ms: int) -> Column:
    """Number of the time slice an epoch-millisecond time falls into."""
    start = F.col(ts) - F.pmod(F.col(ts), F.lit(slice_ms))
    return F.call_function("div", start, F.lit(slice_ms))


def without_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Events that have no place in a visitor's sequence, for a reject output; no bounce comes of them."""
    return df.filter(F.col(ts).isNull())


def cells(
    pages: DataFrame, cell_ms: int, visitor: str = "mid", ts: str = "ts", tie: str = "seq", entry: Column | None = None
) -> DataFrame:
    """The rows as events of (visitor, cell) groups; only entry pages keep their content.

    A missing visitor is a key like any other, so the key is text that is never null.
    """
    events = pages.filter(F.col(ts).isNotNull()).withColumn("__entry", is_entry() if entry is None else entry)
    return events.select(
        F.coalesce(F.concat(F.lit("="), F.col(visitor).cast("string")), F.lit("")).alias("__visitor"),
        slice_of(ts, cell_ms).alias("__cell"),
        F.col(ts).alias("__ts"),
        F.col(tie).alias("__tie"),
        "__entry",
        *[F.when(F.col("__entry"), F.col(c)).alias(c) for c in pages.columns],
    )


def following_events(events: DataFrame, per_block: int = CELLS) -> DataFrame:
    """``__visitor, __cell, __after``: the first event (ts, entry) of the visitor's next cell that has any.

    A cell is summed up by its first event. A block of ``per_block`` cells sees its own firsts and those
    of the block after it, of which there are twice ``per_block`` at most, however many events the cells
    hold. If the following block is empty too, there is no event near enough.
    """
    at = F.struct("__ts", "__tie")
    firsts = events.groupBy("__visitor", "__cell").agg(
        F.min("__ts").alias("ts"), F.min_by("__entry", at).alias("entry")
    )
    block = slice_of("__cell", per_block)
    seen = firsts.select("*", F.explode(F.array(block, block - 1)).alias("block"))
    w = Window.partitionBy("__visitor", "block").orderBy("__cell")
    near = seen.withColumn("__after", F.lead(F.struct("ts", "entry")).over(w))
    return near.filter(block == F.col("block")).select("__visitor", "__cell", "__after")


def bounces(
    pages: DataFrame,
    within_ms: int = 10_000,
    slice_ms: int | None = None,
    visitor: str = "mid",
    ts: str = "ts",
    tie: str = "seq",
    entry: Column | None = None,
) -> DataFrame:
    """Entry pages that were not followed up, with ``kind`` telling why.

    An entry is dropped only if the visitor's very next event is a non-entry less than ``within_ms``
    later. ``match``: the next event is another entry within that time. ``timeout``: nothing came
    within it. ``slice_ms`` (``within_ms`` unless given) is the length of a block of cells.
    """
    slice_ms = slice_ms or within_ms
    if slice_ms < within_ms:
        raise ValueError("a slice must be at least as long as the window it decides about")
    cell_ms = max(1, -(-slice_ms // CELLS))
    events = cells(pages, cell_ms, visitor, ts, tie, entry)
    ahead = following_events(events.select("__visitor", "__cell", "__ts", "__tie", "__entry"))
    joined = events.join(ahead, ["__visitor", "__cell"], "left")
    w = Window.partitionBy("__visitor", "__cell").orderBy("__ts", "__tie")
    here = F.lead(F.struct(F.col("__ts").alias("ts"), F.col("__entry").alias("entry"))).over(w)
    decided = joined.withColumn("__next", F.coalesce(here, "__after")).filter("__entry")
    soon = F.coalesce(F.col("__next.ts") - F.col("__ts") < within_ms, F.lit(False))
    kept = decided.filter(~(soon & ~F.coalesce("__next.entry", F.lit(True))))
    return kept.select(*pages.columns, F.when(soon, "match").otherwise("timeout").alias("kind"))
