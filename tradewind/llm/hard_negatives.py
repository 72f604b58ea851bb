"""Hard negatives of anchors: a secondary sort by packed keys, read as a stream.

Scores are integer inner products, higher ones come first, ties by the smaller id. Steps:

1. rows are dealt into blocks by their id, anchors into smaller ones, and every block of anchors meets
   every block of rows: the anchors are a stated query set, and each pair of blocks is one matrix product;
2. a pair of blocks hands on, for each anchor, its first positives there; the first ones of all blocks
   are the positives of the anchor;
3. with their scores known, a pair of blocks hands on the negatives that are among the first ones of a
   positive's window in this block. Whatever is among the first of a window over all rows is among the
   first in its own block, so nothing is lost;
4. positives and negatives are packed into keys of (anchor, descending score, positives before negatives,
   id) and go through ``repartitionAndSortWithinPartitions`` by anchor. The iterator behind it opens a
   window at each positive, fills the open windows with the negatives that come by, and forgets them at
   the next anchor: no anchor's rows are ever held.

Work for an anchor does not depend on how many rows share a label, a vector or a score.

Rows without id, label or usable vector take no part. Of rows that share an id, the one with the smallest
label, then vector, counts. Vectors of different lengths have no score. Components are limited to 2^26
after scaling (see ``vectors``); if the products of a block can pass 2^53, whole-number arithmetic is used.
A window of a negative score is empty, as 80% of it lies above it. An empty table gives no rows, an
anchor without positives or negatives none of its own. There are no texts here; vectors of any length go
as whole blocks of ``ROWS`` rows.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.storage import stored
from tradewind.llm.vectors import whole_vectors

ROWS, ANCHORS = 4096, 256
POSITIVES = NEGATIVES = 5
LEAST_SHARE = 80
_BLOCK = "dim int, block long, ids binary, labels binary, vectors binary, opened binary"
_KEY = struct.Struct(">QQBQ")


def _packed(positives: int):
    def run(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        vectors = np.array(group.column("v").to_pylist(), np.int32).reshape(len(ids), -1)
        opened = np.full((len(ids), positives), -1, np.int64)  # no window opens below zero
        for i, scores in enumerate(group.column("opened").to_pylist()):
            opened[i, : len(scores)] = scores
        parts = {
            "ids": ids.astype(np.int64), "labels": group.column("label").to_numpy().astype(np.int64),
            "vectors": vectors, "opened": opened,
        }
        first = {name: group.column(name).slice(0, 1) for name in ("dim", "block")}
        return pa.table(first | {k: pa.array([x[order].tobytes()], pa.binary()) for k, x in parts.items()})

    return run


def _blocks(rows: DataFrame, size: int, positives: int) -> tuple[DataFrame, int]:
    """The rows (``vec_id, label, v, opened``) in blocks of about ``size``, and how many blocks there are."""
    count = max(1, -(-rows.count() // size))
    dealt = rows.withColumns({"dim": F.size("v"), "block": F.pmod(F.xxhash64("vec_id"), F.lit(count))})
    return dealt.groupBy("dim", "block").applyInArrow(_packed(positives), _BLOCK), count


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all of ``b``."""
    largest = [float(np.abs(x).max(initial=0)) for x in (a, b)]
    if largest[0] * largest[1] * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def leading(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``most`` highest allowed scores, ties by the smaller column."""
    floor = np.iinfo(np.int64).min
    masked = np.where(allowed, scores, floor)
    if masked.shape[1] > most:
        least = np.partition(masked, -most, axis=1)[:, -most]
        allowed = allowed & (masked >= least[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < most], column[rank < most]


def first_positives(most: int):
    """For each anchor of a pair of blocks its first rows of the same label."""

    def choose(pair: dict, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        same = pair["a_labels"][:, None] == pair["labels"][None, :]
        return leading(scores, same & (pair["a_ids"][:, None] != pair["ids"][None, :]), most)

    return choose


def window_negatives(most: int, share: int):
    """For each anchor the first rows of another label in each of its windows, once each."""

    def choose(pair: dict, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        other = pair["a_labels"][:, None] != pair["labels"][None, :]
        chosen = np.zeros(scores.shape, bool)
        for top in pair["a_opened"].T:
            inside = (100 * scores >= share * top[:, None]) & (scores <= top[:, None]) & (top[:, None] >= 0)
            chosen[leading(scores, other & inside, most)] = True
        return np.nonzero(chosen)

    return choose


def _met(anchors: DataFrame, rows: DataFrame, blocks: int, choose: Callable) -> DataFrame:
    """``anchor, id, score`` of what ``choose`` takes from each pair of blocks.

    The anchors travel to the blocks of rows, which stay in their place; a batch holds few pairs, as
    Arrow batches are cut by bytes.
    """
    kinds = {"ids": np.int64, "labels": np.int64, "vectors": np.int32, "opened": np.int64}
    sent = anchors.select(
        "dim", *[F.col(c).alias(f"a_{c}") for c in kinds], F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    pairs = sent.withColumn("block", F.col("block").cast("long")).join(
        rows.select("dim", "block", "ids", "labels", "vectors"), ["dim", "block"]
    )
    schema = pa.schema([(name, pa.int64()) for name in ("anchor", "id", "score")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cells = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                pair = {
                    name: np.frombuffer(cells[name], kinds[name.removeprefix("a_")])
                    for name in cells if name not in ("dim", "block")
                }
                count = len(pair["a_ids"])
                pair["a_opened"] = pair["a_opened"].reshape(count, -1)
                scores = products(
                    pair["a_vectors"].reshape(count, -1), pair["vectors"].reshape(len(pair["ids"]), -1)
                )
                a, b = choose(pair, scores)
                found = pair["a_ids"][a], pair["ids"][b], scores[a, b]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], schema=schema)

    return pairs.repartition(blocks, "dim", "block").mapInArrow(run, "anchor long, id long, score long")


def pack_key(anchor: int, score: int, negative: bool, row: int) -> bytes:
    """A key whose byte order is: anchor, falling score, positives first, id."""
    return _KEY.pack(anchor + (1 << 63), (1 << 63) - 1 - score, negative, row + (1 << 63))


def unpack_key(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, row = _KEY.unpack(key)
    return anchor - (1 << 63), (1 << 63) - 1 - score, bool(negative), row - (1 << 63)


def mined(keys: Iterable[tuple[bytes, None]], positives: int, negatives: int, share: int) -> Iterator[tuple]:
    """The negatives of every window, from keys in order; holds the open windows of one anchor."""
    current, opened = None, 0
    windows: list[list[int]] = []
    for key, _ in keys:
        anchor, score, negative, row = unpack_key(key)
        if anchor != current:
            current, opened, windows = anchor, 0, []
        if not negative:
            if opened < positives:
                opened += 1
                windows.append([row, score, 0])
            continue
        # Scores fall, so a window that this score has left, or that is full, takes no more.
        windows = [w for w in windows if w[2] < negatives and 100 * score >= share * w[1]]
        for w in windows:
            w[2] += 1
            yield anchor, w[0], w[2], row, w[1], score


def mine(
    table: DataFrame, is_anchor: Column | None = None, label: Column | None = None, positives: int = POSITIVES,
    negatives: int = NEGATIVES, least_share: int = LEAST_SHARE, rows_a_block: int = ROWS, anchors_a_block: int = ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``table`` has ``vec_id, embedding, label``; ``is_anchor`` says which rows are anchors (all unless
    given), ``label`` replaces the label. Both may use ``vec_id`` and ``label``. Jobs run while the
    result is built: blocks and positives are written to the shared folder.
    """
    spark = table.sparkSession
    rows = whole_vectors(table).withColumn("label", F.col("label") if label is None else label)
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL")
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    unopened = F.array().cast("array<long>")
    rows = stored(one.select("vec_id", "row.label", "row.v", unopened.alias("opened")), "negatives_rows")
    blocks, count = _blocks(rows, rows_a_block, positives)
    blocks = stored(blocks, "negatives_blocks")
    asked = rows.filter(F.lit(True) if is_anchor is None else is_anchor)
    anchors, _ = _blocks(asked, anchors_a_block, positives)

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = _met(anchors, blocks, count, first_positives(positives))
    near = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= positives)
    near = stored(near.select("anchor", "id", "score"), "negatives_positives")
    opened = near.groupBy("anchor").agg(F.collect_set("score").alias("opened"))  # at most ``positives`` scores
    asked = asked.drop("opened").join(opened.withColumnRenamed("anchor", "vec_id"), "vec_id")
    anchors, _ = _blocks(asked.select("vec_id", "label", "v", "opened"), anchors_a_block, positives)
    far = _met(anchors, blocks, count, window_negatives(negatives, least_share))

    keyed = near.withColumn("negative", F.lit(False)).unionByName(far.withColumn("negative", F.lit(True)))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.rdd.map(lambda r: (pack_key(r.anchor, r.score, r.negative, r.id), None))
    ordered = ordered.repartitionAndSortWithinPartitions(partitions, lambda key: crc32(key[:8]))
    found = ordered.mapPartitions(lambda keys: mined(keys, positives, negatives, least_share))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame(found, schema, verifySchema=False)
