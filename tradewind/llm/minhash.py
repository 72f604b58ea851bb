"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification, components.

A document's set is the set of its distinct shingles of ``shingle`` words (a whole shorter text is
one shingle), compared as 64-bit hashes; two documents are linked if the Jaccard similarity of their
sets is at least ``similar_percent`` per cent, compared in whole numbers.

Steps:
1. each text becomes its set's size and digest and the keys of its bands (of ``bands * rows`` minima).
   Documents of equal sets are one class from here on, so thousands of copies are one member;
2. members that share a band are candidates. A pair at the threshold shares none of the 40 bands of 5
   rows with probability 1.2e-7. Only the texts of such members are read again, for signature and set;
3. the signatures of a pair are compared in batches of 32 minima: with m of n equal, the posterior
   probability (uniform prior) that the similarity reaches the threshold is a binomial tail, and the
   pair is dropped as soon as that is below ``miss``;
4. survivors are verified on their full sets;
5. no round lists the pairs of a large group. First every member meets one other, the hub of most of
   its bands: of a band's members the one that shares most bands with others, which is near the middle
   of its group. Then the members of each band that are in different components by then meet in blocks
   of at most ``BLOCK``: all but those of the band's largest component with each other and with the
   blocks of that component. A meeting is one small piece of work, whatever the size of the band, and
   gives no more links than it has members;
6. components of the links, spread over the classes.

Empty and null texts have the empty set and are linked with nothing. A null ``doc_id`` is never
linked, its component is null and it is not kept. Repeated rows come out repeated; of rows that share
a ``doc_id`` but not the text each has the component of its own text. An empty table gives no rows.
``deduplicated`` returns all columns of the documents it keeps.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.links import components, joined_by
from tradewind.llm.storage import stored
from tradewind.llm.texts import Numbers, joined, mixed, slices, utf8

BANDS, ROWS = 40, 5
BATCH = 32
CACHED = 1 << 15
BLOCK = 512
FIRST_MINIMA = 64
MEMBERS_AT_ONCE = 1 << 13
MISS = 1e-9
_MET = "band long, lo int, hi int, block int, id long, component long, n long"
_MET_NAMES = ["band", "lo", "hi", "block", "id", "component", "n"]
_FIRST = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1B54A32D192ED03)


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and where each text begins."""
    known = Numbers()
    words = [known.of(text.lower().split()) for text in texts]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), dtype=np.uint64, count=len(known))
    sets = []
    with np.errstate(over="ignore"):
        for ids in words:
            h = hashes[ids]
            n = max(1, len(h) - size + 1) if len(h) else 0
            width = min(size, len(h))
            value = np.full(n, np.uint64(width))
            for i in range(width):
                value = mixed(value * _OTHER + h[i : i + n])
            sets.append(np.unique(value))
    return joined(sets, np.uint64)


def signatures(values: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """One row of ``count`` 32-bit minima per set; every set must have a member."""
    out = np.empty((len(starts) - 1, count), np.uint32)
    keys = mixed(np.arange(1, count + 1, dtype=np.uint64) * _FIRST)
    with np.errstate(over="ignore"):
        move, times = (keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32) | np.uint32(1)
        first = 0
        while first < len(out):  # pieces that stay in the processor's cache
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + CACHED, side="right")) - 1)
            own = (values[starts[first] : starts[last]] >> np.uint64(32)).astype(np.uint32)
            begins = starts[first:last] - starts[first]
            for j in range(count):
                moved = (own ^ move[j]) * times[j]
                moved ^= moved >> np.uint32(15)
                out[first:last, j] = np.minimum.reduceat(moved, begins)
            first = last
    return out


def least_equal(n: int, similarity: float, miss: float) -> int:
    """The fewest equal minima among ``n`` that leave similarity >= ``similarity`` a posterior of ``miss``.

    With a uniform prior the posterior of the similarity is Beta(m + 1, n - m + 1), whose tail above s
    is P(Binomial(n + 1, s) <= m).
    """
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


def survives(a: np.ndarray, b: np.ndarray, similarity: float, miss: float) -> np.ndarray:
    """Compare signatures (pairs by minima) batch by batch; pairs below the bound stop there."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int64)
    for start in range(0, a.shape[1], BATCH):
        stop = min(start + BATCH, a.shape[1])
        equal[alive] += (a[alive, start:stop] == b[alive, start:stop]).sum(axis=1)
        alive = alive[equal[alive] >= least_equal(stop, similarity, miss)]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit keys (signatures by bands) of the minima of each band and the number of the band."""
    minima = minima.reshape(-1, bands, rows).astype(np.uint64)
    key = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64)), minima.shape[:2])
    with np.errstate(over="ignore"):
        for i in range(rows):
            key = mixed(key * _OTHER + minima[:, :, i])
    return key


def _banded(shingle: int, bands: int, rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, starts = shingle_sets(utf8(batch), shingle)
            sizes = np.diff(starts)
            full = sizes > 0
            minima = signatures(values, np.append(starts[:-1][full], len(values)), bands * rows)
            digests = [
                xxhash.xxh3_128_digest(values[a:b]) if b > a else None
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)
            ]
            ends = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
            keys = band_keys(minima, bands, rows).reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(ends, keys),
                ],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return run


def _sets(shingle: int, count: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values, starts = shingle_sets(utf8(batch), shingle)
            full = np.flatnonzero(np.diff(starts))
            batch, starts = batch.take(pa.array(full)), np.append(starts[:-1][full], len(values))
            minima = signatures(values, starts, count)
            own = [values[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in ("id", "hub", "is_hub")],
                    pa.array([x.tobytes() for x in minima], pa.binary()),
                    pa.array(own, pa.binary()),
                ],
                names=["id", "hub", "is_hub", "signature", "own"],
            )

    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common members of each left with each right set."""
    known = np.unique(np.concatenate(left))
    values, starts = joined(right, np.uint64)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    there = known[place] == values
    of_right = np.zeros((len(right), len(known)), np.float32)
    of_right[np.repeat(np.arange(len(right)), np.diff(starts))[there], place[there]] = 1
    of_left = np.zeros((len(left), len(known)), np.float32)
    for i, own in enumerate(left):
        of_left[i, np.searchsorted(known, own)] = 1
    return np.rint(of_left @ of_right.T).astype(np.int64)


def similar(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which left sets are similar to which right ones, exactly."""
    out = np.zeros((len(left), len(right)), bool)
    n_right = np.array([len(x) for x in right])
    at = 0
    while at < len(left):  # a few at a time: the table below has a column for each of their members
        stop, total = at, 0
        while stop < len(left) and (stop == at or total + len(left[stop]) <= MEMBERS_AT_ONCE):
            total += len(left[stop])
            stop += 1
        common = _common(left[at:stop], right)
        n_left = np.array([len(x) for x in left[at:stop]])
        out[at:stop] = 100 * common >= percent * (n_left[:, None] + n_right - common)
        at = stop
    return out


def _pruned_and_verified(percent: int, miss: float):
    """Both tests, for pairs that come with signatures and sets."""

    @F.pandas_udf("boolean")
    def test(a: pd.Series, b: pd.Series, a_set: pd.Series, b_set: pd.Series) -> pd.Series:
        out = np.zeros(len(a), bool)
        if len(a):
            left, right = (np.frombuffer(b"".join(x), np.uint32).reshape(len(x), -1) for x in (a, b))
            for i in np.flatnonzero(survives(left, right, percent / 100, miss)):
                x, y = (np.frombuffer(s.iloc[i], np.uint64) for s in (a_set, b_set))
                out[i] = similar([x], [y], percent)[0, 0]
        return pd.Series(out)

    return test


def meetings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each meeting (band, lo, hi), from rows sorted by it."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        keys = np.column_stack([rows.column(name).to_numpy() for name in ("band", "lo", "hi")])
        starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()]
        for start, stop in zip(starts[:-1], starts[1:], strict=True):
            yield rows.slice(start, stop - start)
        held = rows.slice(starts[-1])
    if held is not None and held.num_rows:
        yield held


def _sides(rows: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Who meets whom: the rows of either side and which pairs of them are open (of unlike components)."""
    lo, hi = rows.column("lo")[0].as_py(), rows.column("hi")[0].as_py()
    block = rows.column("block").to_numpy()
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    component, n = rows.column("component").to_numpy(), rows.column("n").to_numpy()
    least, most = (f(n[left][:, None], n[right][None, :]) for f in (np.minimum, np.maximum))
    is_open = (component[left][:, None] != component[right][None, :]) & (100 * least >= percent * most)
    if lo == hi:
        is_open &= left[:, None] < right[None, :]
    return left, right, is_open


def surviving(a: np.ndarray, b: np.ndarray, is_open: np.ndarray, similarity: float, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of ``a`` and of ``b`` (signatures) have an open pair that no batch of minima rules out."""
    i, j = np.flatnonzero(is_open.any(axis=1)), np.flatnonzero(is_open.any(axis=0))
    is_open, equal = is_open[np.ix_(i, j)], np.zeros((len(i), len(j)), np.uint16)
    for start in range(0, a.shape[1], BATCH):
        stop = min(start + BATCH, a.shape[1])
        for k in range(start, stop):
            equal += a[i, k][:, None] == b[j, k][None, :]
        is_open &= equal >= least_equal(stop, similarity, miss)
        x, y = is_open.any(axis=1), is_open.any(axis=0)
        i, j, is_open, equal = i[x], j[y], is_open[np.ix_(x, y)], equal[np.ix_(x, y)]
        if not len(i):
            break
    return i, j


def _survivors(column: str, percent: int, miss: float):
    """The rows of a meeting of which a pair survives."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in meetings(batches):
            left, right, is_open = _sides(rows, percent)
            signs = np.frombuffer(b"".join(rows.column(column).to_pylist()), np.uint32).reshape(rows.num_rows, -1)
            i, j = surviving(signs[left], signs[right], is_open, percent / 100, miss)
            if len(i):
                kept = np.union1d(left[i], right[j])
                yield from rows.select(_MET_NAMES).take(pa.array(kept)).combine_chunks().to_batches()

    return run


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of ``n`` nodes that each one reaches by the links ``a``, ``b``."""
    label = np.arange(n)
    while True:
        low, moved = np.minimum(label[a], label[b]), label.copy()
        np.minimum.at(moved, a, low)
        np.minimum.at(moved, b, low)
        moved = moved[moved]
        if (moved == label).all():
            return label
        label = moved


def _verified(percent: int):
    """Links between the members of a meeting that are similar, no more than it has members."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in meetings(batches):
            left, right, is_open = _sides(rows, percent)
            sets = [np.frombuffer(x, np.uint64) for x in rows.column("own").to_pylist()]
            found = is_open & similar([sets[x] for x in left], [sets[x] for x in right], percent)
            i, j = np.nonzero(found)
            if len(i):
                label = spanning(rows.num_rows, left[i], right[j])
                linked = np.flatnonzero(label != np.arange(len(label)))
                ids = rows.column("id").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[label[linked]]), pa.array(ids[linked])], names=["a", "b"])

    return run


class NearDuplicates:
    """The steps over one table of documents; ``labelled()`` is the result."""

    def __init__(
        self, docs: DataFrame, shingle: int, percent: int = 80, bands: int = BANDS, rows: int = ROWS, miss: float = MISS
    ):
        self.percent, self.miss, self.shingle, self.count = percent, miss, shingle, bands * rows
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.documents = stored(
            self.texts.mapInArrow(
                _banded(shingle, bands, rows), "doc_id long, n_shingles long, digest binary, bands array<long>"
            ),
            "documents",
        )
        #: One member per set: the smallest doc_id.
        self.members = stored(
            self.documents.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
            .groupBy("digest")
            .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
            "members",
        )
        keys = self.members.select("id", "n", F.explode("bands").alias("band"))
        sizes = keys.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        #: Members of bands with several members.
        self.shared = stored(keys.join(sizes, "band"), "shared")

    def _active(self) -> DataFrame:
        """Signature and set of the members that share a band, with the hub of most of their bands."""
        degrees = self.shared.groupBy("id").agg(F.sum("size").alias("degree"))
        middle = F.max(F.struct("degree", (-F.col("id")).alias("minus_id")))
        hubs = self.shared.join(degrees, "id").groupBy("band").agg(middle.alias("middle"))
        hubs = hubs.select("band", (-F.col("middle.minus_id")).alias("hub"))
        votes = self.shared.select("id", "band").join(hubs, "band").groupBy("id", "hub").agg(F.count(F.lit(1)).alias("votes"))
        rank = F.when(F.col("hub") != F.col("id"), F.struct("votes", (-F.col("hub")).alias("minus_hub")))
        chosen = votes.groupBy("id").agg(F.max(rank).alias("best")).select("id", (-F.col("best.minus_hub")).alias("hub"))
        hubs = chosen.select(F.col("hub").alias("id")).distinct().withColumn("is_hub", F.lit(True))
        active = chosen.join(hubs, "id", "left").withColumn("is_hub", F.col("is_hub").isNotNull())
        texts = self.texts.join(active, F.col("doc_id") == F.col("id")).select("id", "hub", "is_hub", "text")
        schema = "id long, hub long, is_hub boolean, signature binary, own binary"
        return stored(texts.mapInArrow(_sets(self.shingle, self.count), schema), "active")

    def _with_hub(self, active: DataFrame) -> DataFrame:
        """Links of members with the one hub chosen for them."""
        hubs = active.filter("is_hub").select(
            F.col("id").alias("a"), F.col("signature").alias("a_signature"), F.col("own").alias("a_own")
        )
        test = _pruned_and_verified(self.percent, self.miss)
        pairs = active.filter("hub IS NOT NULL").join(hubs, F.col("hub") == F.col("a"))
        return pairs.filter(test("a_signature", "signature", "a_own", "own")).select("a", F.col("id").alias("b"))

    def _to_meet(self, known: DataFrame) -> DataFrame:
        """A row per member and meeting, of all bands that hold several components."""
        cells = self.shared.select("id", "n", "band").join(known, "id")
        counts = cells.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"))
        bands = counts.groupBy("band").agg(F.max(F.struct("size", "component")).alias("most"), F.sum("size").alias("all"))
        bands = bands.filter("all > most.size").select(
            "band",
            F.col("most.component").alias("largest"),
            F.ceil((F.col("all") - F.col("most.size")) / BLOCK).cast("int").alias("others"),
            F.ceil(F.col("most.size") / BLOCK).cast("int").alias("inside"),
        )
        # Blocks 0 to others - 1, then those of the largest component, which do not meet each other.
        is_inside = F.col("component") == F.col("largest")
        dealt = F.xxhash64("id")
        block = F.when(is_inside, F.col("others") + F.pmod(dealt, "inside")).otherwise(F.pmod(dealt, "others")).cast("int")
        last = F.when(is_inside, F.col("others")).otherwise(F.col("others") + F.col("inside")) - 1
        met = cells.join(bands, "band").withColumn("block", block)
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
        lo, hi = F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
        return met.select("band", lo, hi, "block", "id", "component", "n")

    def _meeting(self, to_meet: DataFrame, active: DataFrame, column: str, shown: Column) -> DataFrame:
        """The rows with a column of their members, sorted by meeting."""
        key = ["band", "lo", "hi"]
        return to_meet.join(active.select("id", shown.alias(column)), "id").repartition(*key).sortWithinPartitions(*key)

    def _met(self, active: DataFrame, known: DataFrame) -> DataFrame:
        """Links between members of one band that are in different components so far."""
        to_meet = stored(self._to_meet(known), "to_meet")
        # Most pairs end at the first minima, so those travel first.
        for column, shown in (("first", F.substring("signature", 1, 4 * FIRST_MINIMA)), ("signature", F.col("signature"))):
            test = _survivors(column, self.percent, self.miss)
            to_meet = stored(self._meeting(to_meet, active, column, shown).mapInArrow(test, _MET), "surviving")
        met = self._meeting(to_meet, active, "own", F.col("own"))
        return stored(met.mapInArrow(_verified(self.percent), "a long, b long"), "met_links")

    def linked(self) -> DataFrame:
        """``id, component`` of the members that share a band with any other."""
        active = self._active()
        hubs = components(self._with_hub(active))
        known = active.select("id").distinct().join(hubs, "id", "left")
        known = stored(known.select("id", F.coalesce("component", "id").alias("component")), "known")
        return joined_by(known, self._met(active, known))

    def labelled(self) -> DataFrame:
        """``doc_id, n_shingles, component_id, kept`` of every document."""
        classes = (
            self.members.select("digest", "id")
            .join(self.linked(), "id", "left")
            .select("digest", F.coalesce("component", "id").alias("component_id"))
        )
        whole = self.documents.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        return whole.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
        )


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``; ``component_id`` is the smallest doc_id reachable."""
    return NearDuplicates(docs, shingle, percent).labelled()


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest ``doc_id``.

    Documents without a ``doc_id`` stay. Of rows that repeat a kept ``doc_id`` one stays.
    """
    kept = near_duplicates(docs, shingle, percent).filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    known = docs.join(kept, F.col("doc_id") == F.col("__kept"), "left_semi").dropDuplicates(["doc_id"])
    return known.unionByName(docs.filter("doc_id IS NULL"))
