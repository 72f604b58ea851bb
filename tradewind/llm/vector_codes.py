"""Vectors as short codes: integer k-means per part, with bounds that adapt (Drake and Hamerly).

A vector of whole numbers is cut into ``PARTS`` equal parts; each part position has a codebook of at most
``ENTRIES`` entries, which starts as the parts of the rows with the smallest ids. Steps:

1. the first assignment looks at every entry. Beside the code it stores, for each part, the ``b`` closest
   other entries with lower bounds of their distances, and one outer bound for all entries that are not
   among them;
2. entries move to the floor of their parts' mean: tasks add up their parts, Spark adds up the tasks. What
   reaches the driver is the size of the codebooks, whatever the table;
3. the next assignment lowers each bound by how far its entry moved, the outer one by the largest move,
   and orders them: bound j holds for everything from rank j on. The distance to a part's own entry is
   computed in whole numbers. If it is below the first bound the code stands; if it is below bound j, the
   entries before j are compared in whole numbers; beyond the outer bound all of them are. Bounds are
   rounded down by more than floating point can err, so an equal distance is never taken for a larger one
   and ties always go to the lower index;
4. how many bounds the parts needed is counted, and ``b`` of the next round is the least number that was
   enough for all but one in a thousand, an eighth of the entries at least.

Each round's state is a table in the shared folder, so a lost executor repeats tasks of one round only. No
step groups by a value of the data except the last sum per label, which is added up before it is shuffled.

Rows without a usable vector (null, or null or non-finite components) are dropped. The first kept id gives
the length that is coded; a vector of another length, and all of them if it is not a multiple of
``PARTS``, has a null code and error. Rows without an id are coded but start no entry. Rows that share an
id start one entry each. With fewer rows than ``ENTRIES`` the codebooks are shorter. Components are limited
to 2^26 after scaling (see ``vectors``). An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.storage import stored
from tradewind.llm.vectors import whole_vectors

PARTS, ENTRIES, ROUNDS = 16, 64, 2
_SLACK = 1e-6  # single-precision bounds err by less
_FAR = 1e30  # the bound of no entry at all
_AT_ONCE = 2048


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of ``x`` (n, w) to ``entries``: (k, w), or (n, j, w) of their own."""
    out = 0
    for d in range(x.shape[1]):
        out = out + (x[:, d, None] - entries[..., d]) ** 2
    return np.broadcast_to(out, (len(x), entries.shape[-2]))


class State:
    """Codes of the parts at one position, with ``b`` near entries and ``b + 1`` lower bounds each."""

    def __init__(self, code: np.ndarray, near: np.ndarray, lower: np.ndarray):
        self.code, self.near, self.lower = code, near, lower

    @classmethod
    def full(cls, x: np.ndarray, entries: np.ndarray, b: int) -> State:
        """All entries are looked at."""
        distance = squares(x, entries)
        order = np.argsort(distance, axis=1, kind="stable")  # ties to the lower index
        b = min(b, len(entries) - 1)
        lower = np.full((len(x), b + 1), _FAR)
        some = order[:, 1 : b + 2]
        lower[:, : some.shape[1]] = np.sqrt(np.take_along_axis(distance, some, 1)) * (1 - _SLACK)
        return cls(order[:, 0], order[:, 1 : b + 1], lower.astype(np.float32))

    def cut(self, b: int) -> State:
        """Fewer bounds: bound ``b`` holds for all that come after it, too."""
        b = min(b, self.near.shape[1])
        return State(self.code, self.near[:, :b], self.lower[:, : b + 1])

    def moved(self, x: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Codes by entries that moved from ``old`` to ``new``; returns how many bounds each part needed."""
        b = self.near.shape[1]
        shift = np.sqrt(((new - old) ** 2).sum(axis=1)) * (1 + _SLACK)
        lower = self.lower.astype(np.float64)
        lower[:, :b] -= shift[self.near]
        lower[:, b] -= shift.max()
        lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
        lower -= _SLACK * np.abs(lower)
        own = squares(x, new[self.code][:, None, :])
        upper = np.sqrt(own) * (1 + _SLACK)
        depth = (upper >= lower).sum(axis=1)
        code, near = self.code.copy(), self.near.copy()
        for j in range(1, b + 1):  # the entries of the first j ranks and the own one, in whole numbers
            at = np.flatnonzero(depth == j)
            if len(at):
                asked = np.column_stack([code[at], near[at, :j]])
                distance = squares(x[at], new[asked])
                order = np.lexsort((asked, distance), axis=1)
                asked, distance = (np.take_along_axis(y, order, 1) for y in (asked, distance))
                code[at], near[at, :j] = asked[:, 0], asked[:, 1:]
                lower[at, :j] = np.sqrt(distance[:, 1:]) * (1 - _SLACK)
        lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1].astype(np.float32)
        lower -= np.float32(_SLACK) * np.abs(lower)
        beyond = np.flatnonzero(depth == b + 1)
        if len(beyond):
            anew = State.full(x[beyond], new, b)
            code[beyond], near[beyond], lower[beyond] = anew.code, anew.near, anew.lower
        self.code, self.near, self.lower = code, near, lower
        return depth


def _cells(batch: pa.RecordBatch, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, -1)


def _binary(rows: np.ndarray) -> pa.Array:
    raw, width = np.ascontiguousarray(rows), rows.dtype.itemsize * int(np.prod(rows.shape[1:]))
    ends = pa.array(np.arange(len(raw) + 1) * width, pa.int32())
    return pa.BinaryArray.from_buffers(pa.binary(), len(raw), [None, ends.buffers()[1], pa.py_buffer(raw)])


_STATE = "vec_id long, label long, v binary, code binary, near binary, lower binary, depth binary, error long"


def _assigned(books: np.ndarray, before: np.ndarray | None, width_before: int, b: int):
    """A round of assignments over state rows; without ``before`` the first one."""
    parts, k = books.shape[:2]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _AT_ONCE):
                batch = whole.slice(start, _AT_ONCE)
                x = _cells(batch, "v", np.int32).astype(np.int64).reshape(batch.num_rows, parts, -1)
                if before is not None:
                    code = _cells(batch, "code", np.uint8)
                    near = _cells(batch, "near", np.uint8).reshape(len(x), parts, width_before)
                    lower = _cells(batch, "lower", np.float32).reshape(len(x), parts, width_before + 1)
                states, depths = [], []
                error = np.zeros(len(x), np.int64)
                for p in range(parts):
                    if before is None:
                        state, depth = State.full(x[:, p], books[p], b), np.full(len(x), 255)
                    else:
                        state = State(code[:, p].astype(np.int64), near[:, p].astype(np.int64), lower[:, p]).cut(b)
                        depth = state.moved(x[:, p], before[p], books[p])
                    states.append(state)
                    depths.append(depth)
                    error += squares(x[:, p], books[p][state.code][:, None, :])[:, 0]
                columns = {
                    "vec_id": batch.column("vec_id"), "label": batch.column("label"), "v": batch.column("v"),
                    "code": _binary(np.stack([s.code for s in states], 1).astype(np.uint8)),
                    "near": _binary(np.stack([s.near for s in states], 1).astype(np.uint8)),
                    "lower": _binary(np.stack([s.lower for s in states], 1).astype(np.float32)),
                    "depth": _binary(np.stack(depths, 1).astype(np.uint8)),
                    "error": pa.array(error),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _sums(parts: int, k: int):
    """Per task: the sums and counts of every entry (``position`` from 0), and how many parts needed how
    many bounds (``position`` -1)."""
    schema = pa.schema([(n, pa.int64()) for n in ("position", "entry", "at", "total")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, depths = None, np.zeros(256, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _cells(batch, "v", np.int32).astype(np.int64).reshape(batch.num_rows, parts, -1)
            code = _cells(batch, "code", np.uint8)
            if total is None:
                total = np.zeros((parts, k, x.shape[2] + 1), np.int64)
            for p in range(parts):
                np.add.at(total[p], code[:, p], np.column_stack([x[:, p], np.ones(len(x), np.int64)]))
            depths += np.bincount(_cells(batch, "depth", np.uint8).ravel(), minlength=256)
        if total is not None:
            found = [np.column_stack([*np.nonzero(total), total[np.nonzero(total)]])]
            used = np.flatnonzero(depths)
            found.append(np.column_stack([np.full(len(used), -1), used, np.zeros(len(used), np.int64), depths[used]]))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(found).T], schema=schema)

    return run


def _means(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
    """The entries after a move (unused ones stay), and the number of parts by bounds needed."""
    parts, k, width = books.shape
    rows = state.select("v", "code", "depth").mapInArrow(_sums(parts, k), "position long, entry long, at long, total long")
    total = np.zeros((parts, k, width + 1), np.int64)
    depths: dict[int, int] = {}
    for row in rows.groupBy("position", "entry", "at").agg(F.sum("total").alias("total")).collect():
        if row.position < 0:
            depths[row.entry] = row.total
        else:
            total[row.position, row.entry, row.at] = row.total
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books), depths


def next_width(depths: dict[int, int], b: int, entries: int) -> int:
    """The least number of bounds that would have been enough for all but one part in a thousand (parts
    beyond the outer bound left aside), an eighth of the entries at least."""
    allowed = sum(depths.values()) // 1000
    for fewer in range(max(1, entries // 8), b):
        if sum(n for d, n in depths.items() if fewer < d <= b) <= allowed:
            return fewer
    return b


def _books(kept: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    first = kept.filter("vec_id IS NOT NULL").orderBy("vec_id", "v").limit(entries).select("v").collect()
    if not first or len(first[0].v) % parts or not first[0].v:
        return None
    same = [row.v for row in first if len(row.v) == len(first[0].v)]
    return np.array(same, np.int64).reshape(len(same), parts, -1).transpose(1, 0, 2)


def books_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every kept row (``code`` binary, a byte per part), and the
    codebooks (part, entry, component). Jobs run while it is built: one table per round."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index has one byte")
    kept = stored(whole_vectors(table), "codes_rows")
    books = _books(kept, parts, entries)
    nothing = {"code": F.lit(None).cast("binary"), "error": F.lit(None).cast("long")}
    if books is None:
        return kept.drop("v").withColumns(nothing), np.zeros((parts, 0, 0), np.int64)
    length = parts * books.shape[2]
    state = kept.filter(F.size("v") == length).mapInArrow(_as_bytes, "vec_id long, label long, v binary")
    k = books.shape[1]
    b, width, before = max(1, k // 4), 0, None
    for turn in range(rounds + 1):
        state = stored(state.mapInArrow(_assigned(books, before, width, b), _STATE), "codes_state")
        width = min(b, k - 1)
        if turn < rounds:
            before = books
            books, depths = _means(state, books)
            if turn:
                b = next_width(depths, width, k)
    others = kept.filter(F.size("v") != length).drop("v").withColumns(nothing)
    return state.select("vec_id", "label", "code", "error").unionByName(others), books


def _as_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("v")
        values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int32).reshape(batch.num_rows, -1)
        yield pa.RecordBatch.from_pydict(
            {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "v": _binary(values)}
        )


def code_report(table: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: codes as hex, errors added up per label."""
    coded, books = compress(table)
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    # Sums per label come from one row per task and label; null is a label of its own.
    by_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    by_label = by_label.select(F.col("label").alias("of_label"), "label_error")
    whole = coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")))
    return whole.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error",
        F.col("label_error").try_cast("long").alias("label_error"), F.lit(digest).alias("codebooks_sha256"),
    )
