"""Documents that hold benchmark items, also edited ones: n-gram seeds, then Smith-Waterman alignment.

Texts are read as words: A-Z in lower case, ASCII marks as breaks.
1. Seeds. All n-grams of ``seed_words`` words of an item are looked up in all documents, so a copy is
   met at every stretch of ``seed_words`` words that its edits left, however common the phrase and
   whatever other documents hold. A copy without such a stretch is not met.
2. Windows. Around a hit lies all the text that an alignment through it can reach with enough score. A
   window that shares too few words with the item, counted as often as both have them, cannot reach it
   in any order of them and is left out; chance hits of common phrases end here.
3. Windows of a document that overlap are one region, which is aligned with the item by Smith-Waterman
   over words (match 2, mismatch -1, gap -1). The document is contaminated if the score is at least
   ``least_share`` of a full match of the item, or of ``long_words`` words of an item longer than that.

The items are taken in blocks of at most ``block_words`` words, which is what a task holds of them
besides its slice of documents; the documents are never shuffled. Hits and windows are looked at in
portions, so that a task's memory does not grow with how common a phrase is.

Null and empty texts match nothing, nor do items of fewer than ``seed_words`` words. Repeated items
and documents are found each by itself; null ids stay null. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.texts import Numbers, joined, mixed, ranges, slices, utf8

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
FILTER_BITS = 22
ALIGNED_AT_ONCE = 256
HITS_AT_ONCE = 1 << 19
WORDS_AT_ONCE = 1 << 20
FOUND = "doc_id long, item_id long, score long, share double, first_word long, end_word long"

_MARKS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_OTHER = np.uint64(0xD1B54A32D192ED03)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_MARKS).split()


def _hashed(known: Numbers) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))


def grams_of(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, from the hashes of the words."""
    n = max(0, len(h) - size + 1)
    value = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            value = mixed(value * _OTHER + h[i : i + n])
    return value


class Grams:
    """A sorted set of n-gram hashes behind a bitmap that most look-ups stop at."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bitmap = np.zeros(1 << FILTER_BITS, bool)
        self.bitmap[self.values >> np.uint64(64 - FILTER_BITS)] = True

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``grams`` of members, and which members they are."""
        at = np.flatnonzero(self.bitmap[grams >> np.uint64(64 - FILTER_BITS)])
        if not len(at) or not len(self.values):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        place = np.minimum(np.searchsorted(self.values, grams[at]), len(self.values) - 1)
        same = self.values[place] == grams[at]
        return at[same], place[same]


def slice_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text begins."""
    known = Numbers()
    ids, starts = joined([known.of(words_of(text)) for text in texts], np.int32)
    return _hashed(known)[ids], starts


def inside(at: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of each position, and whether ``size`` words from there are within it."""
    row = np.searchsorted(starts, at, side="right") - 1
    return row, at + size <= starts[row + 1]


def align(item: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments of an item with each text: scores and where in the text they begin and end."""
    n = max(map(len, texts))
    words = np.zeros((len(texts), n), np.uint64)
    inside_text = np.zeros((len(texts), n), bool)
    for i, text in enumerate(texts):
        words[i, : len(text)], inside_text[i, : len(text)] = text, True
    steps = np.broadcast_to(np.arange(n + 1, dtype=np.int32), (len(texts), n + 1))
    row, origin = np.zeros((len(texts), n + 1), np.int32), steps.copy()
    score, begin, end = (np.zeros(len(texts), np.int32) for _ in range(3))
    lines = np.arange(len(texts))
    for word in item:
        cross = row[:, :-1] + np.where((words == word) & inside_text, np.int32(MATCH), np.int32(MISMATCH))
        above = row[:, 1:] + GAP
        new, start = np.zeros_like(row), steps.copy()
        new[:, 1:] = np.maximum(cross, above)
        start[:, 1:] = np.where(cross >= above, origin[:, :-1], origin[:, 1:])
        dead = new <= 0
        new[dead], start[dead] = 0, steps[dead]
        # Gaps within the row: the best of all places to the left, less their distance.
        lifted = new - GAP * steps
        reach = np.maximum.accumulate(lifted, axis=1)
        leader = np.maximum.accumulate(np.where(lifted == reach, steps, 0), axis=1)
        row, origin = reach + GAP * steps, np.take_along_axis(start, leader, axis=1)
        top = row.argmax(axis=1)
        best = row[lines, top]
        better = best > score
        score[better], begin[better], end[better] = best[better], origin[lines, top][better], top[better]
    return score, begin, end


class Block:
    """A block of items as it travels to the tasks: word hashes and the places of all n-grams."""

    def __init__(self, ids: list, words: list[np.ndarray], size: int):
        self.ids, self.words, self.size = ids, words, size
        flat, starts = joined([grams_of(w, size) for w in words], np.uint64)
        item = np.repeat(np.arange(len(words)), np.diff(starts))
        order = np.argsort(flat, kind="stable")
        values = flat[order]
        self.grams = Grams(values)
        self.first = np.searchsorted(values, self.grams.values)
        self.after = np.searchsorted(values, self.grams.values, side="right")
        self.item, self.position = item[order], (np.arange(len(flat)) - starts[item])[order]


def _blocks(items: DataFrame, size: int, block_words: int) -> Iterator[Block]:
    ids, words, held = [], [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        h, _ = slice_words([(row["text"] or "").encode()])
        if len(h) < size:
            continue
        ids.append(row["item_id"])
        words.append(h)
        held += len(h)
        if held >= block_words:
            yield Block(ids, words, size)
            ids, words, held = [], [], 0
    if ids:
        yield Block(ids, words, size)


def _portions(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of entries whose sizes add up to about ``most``, one entry at least."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        before = int(ends[first - 1]) if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield slice(first, stop)
        first = stop


def common_words(item: np.ndarray, h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """How many words each window of ``h`` shares with the item, each as often as both have it."""
    own, times = np.unique(item, return_counts=True)
    out = np.zeros(len(lo), np.int64)
    for part in _portions(np.maximum(hi - lo, len(own)), WORDS_AT_ONCE):
        n = hi[part] - lo[part]
        words = h[ranges(lo[part], n)]
        place = np.minimum(np.searchsorted(own, words), len(own) - 1)
        known = own[place] == words
        cells = (np.repeat(np.arange(len(n)), n) * len(own) + place)[known]
        held = np.bincount(cells, minlength=len(n) * len(own)).reshape(len(n), len(own))
        out[part] = np.minimum(held, times).sum(axis=1)
    return out


def _regions(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int, int]]:
    """(document, from, to) of windows of one item, the overlapping ones of a document as one."""
    out: list[tuple[int, int, int]] = []
    for r, a, b in sorted(zip(row.tolist(), lo.tolist(), hi.tolist(), strict=True)):
        if out and out[-1][0] == r and a <= out[-1][2]:
            out[-1] = (r, out[-1][1], max(b, out[-1][2]))
        else:
            out.append((r, a, b))
    return out


def _findings(block: Block, least_share: float, long_words: int):
    lengths = np.array([len(w) for w in block.words], np.int64)
    full = MATCH * np.minimum(lengths, long_words)
    # No alignment with enough score has more words without a partner than this.
    most_gaps = np.ceil(MATCH * lengths - least_share * full).astype(np.int64)

    def regions(h: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Items and the regions of the documents that can hold them."""
        at, place = block.grams.find(grams_of(h, block.size))
        row, whole = inside(at, starts, block.size)
        at, place, row = at[whole], place[whole], row[whole]
        # An n-gram can belong to several items, or to several places of one.
        times = block.after[place] - block.first[place]
        for part in _portions(times, HITS_AT_ONCE):
            hit = ranges(block.first[place[part]], times[part])
            r, item, position = np.repeat(row[part], times[part]), block.item[hit], block.position[hit]
            diagonal = np.repeat(at[part], times[part]) - position
            # What comes before the hit has to earn its own gaps, and what comes after it.
            before = np.minimum(most_gaps[item], MATCH * position)
            behind = np.minimum(most_gaps[item], MATCH * (lengths[item] - block.size - position))
            lo = np.maximum(starts[r], diagonal - before)
            hi = np.minimum(starts[r + 1], diagonal + lengths[item] + behind)
            order = np.argsort(item, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(item[order])) + 1) if len(order) else []:
                i = int(item[own[0]])
                own = own[MATCH * common_words(block.words[i], h, lo[own], hi[own]) / full[i] >= least_share]
                if len(own):
                    yield i, _regions(r[own], lo[own], hi[own])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            h, starts = slice_words(utf8(batch))
            best: dict[tuple[int, int], tuple] = {}
            for i, spans in regions(h, starts):
                spans.sort(key=lambda s: s[2] - s[1])
                widths = np.array([hi - lo for _, lo, hi in spans])
                for part in _portions(np.maximum(widths, WORDS_AT_ONCE // ALIGNED_AT_ONCE), WORDS_AT_ONCE):
                    group = spans[part]
                    found = align(block.words[i], [h[lo:hi] for _, lo, hi in group])
                    for (r, lo, _), score, begin, end in zip(group, *(x.tolist() for x in found), strict=True):
                        share = min(1.0, score / int(full[i]))
                        if share >= least_share and score > best.get((r, i), (0,))[0]:
                            before = lo - int(starts[r])
                            best[r, i] = (score, share, before + begin, before + end)
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[r], block.ids[i], *values) for (r, i), values in sorted(best.items())]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column) for column in zip(*rows, strict=True)],
                    schema=pa.schema(
                        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.int64()), ("share", pa.float64()),
                         ("first_word", pa.int64()), ("end_word", pa.int64())]
                    ),
                )

    return run


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    least_share: float = 0.5,
    long_words: int = 50,
    seed_words: int = SEED_WORDS,
    block_words: int = 2_000_000,
) -> DataFrame:
    """One row per contaminated document and item: score, share of a full match, place in the document's words."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = docs.sparkSession.createDataFrame([], FOUND)
    for block in _blocks(items, seed_words, block_words):
        found = found.unionByName(texts.mapInArrow(_findings(block, least_share, long_words), FOUND))
    return found


def clean(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The documents that hold no item, with all their columns; those without a ``doc_id`` stay."""
    found = contaminations(docs, items, **settings).select(F.col("doc_id").alias("__found")).distinct()
    return docs.join(found, F.col("doc_id") == F.col("__found"), "left_anti")
