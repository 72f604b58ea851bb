"""Packing of tokenised documents into sequences of bounded length, best fit decreasing.

Each document is turned into ids once: a distinct word goes through the tokenizer once per worker, the
ids of a text are put together from those of its words (the tokenizer drops white space and never
merges across it), and an end id closes the document. Only a document longer than a sequence is cut.

The pieces (a few numbers each) are dealt evenly over groups of about ``group_pieces``; a task packs
one group: longest piece first, into the open sequence with the least room that suffices. A segment
tree over the possible remaining capacities finds that room in logarithmic time. What a group wastes
is at most its few last sequences, whatever the number of groups.

Null texts are empty documents of the end id alone; null and repeated ``doc_id`` keep their rows; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.storage import stored
from tradewind.llm.texts import Numbers, joined, ranges, slices, utf8
from tradewind.llm.token_counts import encoded

WORDS_HELD = 1_000_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


class WordIds:
    """Ids of words, each tokenised once; word 0 is the end of a document."""

    def __init__(self, path: str, end_id: int):
        self.path, self.end_id = path, end_id
        self.clear()

    def clear(self) -> None:
        self.known = Numbers()
        self.known[b"\n"] = 0  # never a word
        self.flat = np.array([self.end_id], np.uint32)
        self.starts = np.array([0, 1], np.int64)

    def look_up(self) -> None:
        fresh, self.known.fresh = self.known.fresh, []
        if not fresh:
            return
        # A comma or full stop after a letter is a token of its own, and case makes no difference, so
        # what goes through the tokenizer is the rest of the word; added tokens stay as they are.
        cores = Numbers()
        ends_of_words = cores.of([b",", b"."])
        lines = b"\n".join(fresh) + b"\n"
        chars = np.frombuffer(lines if b"<" in lines else lines.lower(), np.uint8)
        ends = np.flatnonzero(chars == 10)
        last, before = chars[ends - 1], chars[np.maximum(ends - 2, 0)]
        cut = ((last == ord(",")) | (last == ord("."))) & (before >= ord("a")) & (before <= ord("z"))
        core = cores.of(np.delete(chars, ends[cut] - 1).tobytes().split(b"\n")[:-1])
        tail = np.where(cut, ends_of_words[(last == ord(".")).astype(int)], -1)
        pool, starts = encoded(self.path, [w.decode() for w in cores])
        parts = np.column_stack([core, tail]).astype(np.int64).reshape(-1)
        lengths = np.where(parts < 0, 0, np.diff(starts)[parts])
        self.flat = np.concatenate([self.flat, pool[ranges(starts[parts], lengths)]])
        ends = np.cumsum(lengths.reshape(-1, 2).sum(axis=1))
        self.starts = np.concatenate([self.starts, ends + self.starts[-1]])

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text begins."""
        if len(self.known) > WORDS_HELD:
            self.clear()
        words, starts = joined([self.known.of([*x.split(), b"\n"]) for x in texts], np.int32)
        self.look_up()
        lengths = np.diff(self.starts)[words]
        ids = self.flat[ranges(self.starts[words], lengths)]
        return ids, np.concatenate([[0], np.cumsum(lengths)])[starts]


@lru_cache(maxsize=1)
def word_ids(path: str, end_id: int) -> WordIds:
    return WordIds(path, end_id)


def _pieces(path: str, end_id: int, most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path, end_id)
        for batch in slices(batches):
            ids, starts = words.of(utf8(batch))
            n = np.diff(starts)
            pieces = -(-n // most)
            row = np.repeat(np.arange(len(n)), pieces)
            piece = ranges(np.zeros(len(n), np.int64), pieces)
            start = piece * most
            length = np.minimum(most, n[row] - start)
            at = starts[row] + start
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


class Capacities:
    """Open bins by remaining capacity, under a segment tree that knows which capacities occur."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, name: int) -> None:
        self.bins[capacity].append(name)
        node = capacity + self.leaves
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The bin with the least capacity of at least ``need``: (capacity, bin), taken out."""
        tree, node = self.tree, need + self.leaves
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        while node:
            tree[node] -= 1
            node >>= 1
        return capacity, self.bins[capacity].pop()


def best_fit(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it of every length, longest first, each into the tightest bin."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins, used = Capacities(most), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = open_bins.take(need)
        if found is None:
            found, used = (most, used), used + 1
        capacity, bins[i] = found
        offsets[i] = most - capacity
        if capacity > need:
            open_bins.add(capacity - need, int(bins[i]))
    return bins, offsets


def _packed(most: int):
    def run(group: pa.Table) -> pa.Table:
        number = group.column("pack_group")[0].as_py()
        bins, offsets = best_fit(group.column("length").to_numpy(), most)
        return group.drop_columns(["pack_group"]).append_column(
            "sequence_id", pa.array(bins + (number << 40))
        ).append_column("offset", pa.array(offsets))

    return run


def pack(
    docs: DataFrame, path: str, most: int = 4096, end_id: int = 1, group_pieces: int = 1 << 15
) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence, and the CRC of its ids."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stored(texts.mapInArrow(_pieces(path, end_id, most), PIECES), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    return pieces.withColumn("pack_group", number).groupBy("pack_group").applyInArrow(_packed(most), PACKED)
