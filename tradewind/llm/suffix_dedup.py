"""Passages that a smaller document has, removed: sampled suffixes in logarithmic families of levels.

Every string of ``LENGTH`` bytes that also starts in a document with a smaller ``doc_id`` is removed, with
all that overlaps it. Texts are UTF-8 bytes. Comparing every suffix with every other one would move each
text ``LENGTH`` times, so suffixes are taken where the text itself says so: at the smallest hash of
``SEED`` bytes in every string of ``LENGTH`` bytes. Equal strings choose equal places, so all that can be
equal meets under one seed. Steps:

1. documents go into slices of some megabytes, compressed, in a table bucketed by slice: every later pass
   reads it in place, only what is said about a slice travels to it;
2. a slice lists its stretches: the runs of strings with one seed, as (seed, digest of the whole stretch)
   with the smallest document of the slice, and a check of the bytes up to the middle before and behind the
   seed. These lists go to parts of the seed space. There they make the batches of a family of levels
   (``suffix_levels``): scanned against the levels, merged geometrically. An answer per stretch goes back:
   held whole by a smaller document, alone, or one that may have a string in common with another. A common
   string reaches over the middle on one side of the seed at least, so a stretch whose checks no other
   stretch of its seed has is alone, however many share the seed;
3. only the last kind is looked at byte by byte, once per distinct stretch: all its suffixes, cut to
   ``LENGTH`` bytes, go through a family of levels again, batch by batch a sorted suffix array, and come
   back with a mark per string that a smaller document has;
4. the slice removes what its marks cover.

Seeds with many different stretches (a passage that a third of all documents share, with other text
around it) are cut up: a slice with over ``CROWD`` stretches of a seed, or a part that finds over
``CROWDED`` of them, has its strings sent one by one, dealt by the string and not by the seed, once per
slice. No part of the work grows with the number of documents that share anything: a slice sends each
stretch or string once. Stretches are equal by seed and 64-bit digest (110 bits), what is partly equal by
its bytes.

Rows whose text is null count as empty; texts under ``LENGTH`` bytes lose nothing. Rows with a null
``doc_id`` have no order: they lose nothing and take nothing away. Rows that share a ``doc_id`` are one
document as far as order goes: they take nothing from each other. Very long texts are one slice, worked
through in pieces of 256 KB. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.storage import stored
from tradewind.llm.suffix_levels import Levels, fixed, grouped
from tradewind.llm.texts import mixed, ranges, slices, utf8
from tradewind.session import shared_dir

LENGTH, SEED = 50, 16
SLICE_BYTES = 2 << 20
CROWD, CROWDED = 8, 4096
ALONE, HELD, SHARED, CROWDS = range(4)
_PLACE = np.uint64(20)  # bits of a place in a piece; the other 44 are those of a seed
_PLACES = np.uint64((1 << 20) - 1)
_PIECE = (1 << 18) - 256
_BYTES_A_PART, _BYTES_A_STRING_PART = 16 << 20, 8 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)

_SLICE = "slice long, bytes long, ids binary, lengths binary, text binary"
_LIST = "part long, slice long, seeds binary, digests binary, sides binary, docs binary, crowds binary"
_STRINGS = "part long, slice long, crowded boolean, lengths binary, docs binary, text binary"
_ANSWER = "slice long, kind int, part long, marks binary"


def _sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, number = TaskContext.get().partitionId(), 0
    pack = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, most_bytes=SLICE_BYTES):
        texts = utf8(batch)
        ids = batch.column("doc_id").to_numpy().astype(np.int64)
        lengths = np.array([len(x) for x in texts], np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "slice": [task << 32 | number], "bytes": [int(lengths.sum())], "ids": [ids.tobytes()], "lengths": [lengths.tobytes()],
                "text": [pack.compress(b"".join(texts))],
            }
        )
        number += 1


def stretches(text: np.ndarray, lengths: np.ndarray, length: int = LENGTH, seed: int = SEED, sided: bool = False):
    """Runs of strings with one seed: its hash, the run's digest, first string, number of strings, document, sides.

    ``sides``: a check (16 bits) of the seed with the bytes that half of its strings have before it, another one
    with those that the other half have behind it; 0 where the run does not reach that far, or if not ``sided``.
    """
    ends = np.cumsum(lengths)
    starts, window = ends - lengths, length - seed + 1
    powers = np.cumprod(np.full(min(len(text), _PIECE + length) + 1, _BASE))
    unpowers = np.cumprod(np.full(len(powers), _UNBASE))
    found: list[tuple] = []
    for at in range(0, max(0, len(text) - length + 1), _PIECE):
        piece = text[at : at + _PIECE + length - 1]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_LETTERS[piece] * powers[: len(piece)], out=sums[1:])
        hashes = mixed((sums[seed:] - sums[:-seed]) * unpowers[: len(piece) - seed + 1])
        least = hashes >> _PLACE << _PLACE | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while 2 * span <= window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        strings = len(piece) - length + 1
        least = np.minimum(least[:strings], least[window - span : window - span + strings])
        # Strings never cross documents.
        low, high = np.clip(starts - at, 0, strings), np.clip(ends - length + 1 - at, 0, strings)
        some = np.flatnonzero(high > low)
        low, high = low[some], high[some]
        new = np.zeros(strings, bool)
        new[1:] = least[1:] != least[:-1]
        new[low] = True
        inside = np.zeros(strings + 1, np.int8)
        np.add.at(inside, low, 1)
        np.add.at(inside, high, -1)
        run = np.flatnonzero(new & (np.cumsum(inside[:-1]) > 0))
        if not len(run):
            continue
        doc = np.searchsorted(low, run, side="right") - 1
        stop = np.minimum(np.append(run[1:], strings), high[doc])
        count = (stop - run).astype(np.int64)
        digest = mixed((sums[stop + length - 1] - sums[run]) * unpowers[run] + count.astype(np.uint64))
        # The smallest of many hashes are all small; mixed again, they spread over the seed space.
        place = (least[run] & _PLACES).astype(np.int64)
        sides = np.zeros((len(run), 2), np.uint16)
        half = (length - seed) // 2
        for side, begin, end in ((0, place - half, place + seed), (1, place, place + length - half + 1)) if sided else ():
            whole = np.flatnonzero((begin >= run) & (end < stop + length))
            check = mixed((sums[end[whole]] - sums[begin[whole]]) * unpowers[begin[whole]])
            sides[whole, side] = check >> np.uint64(48) | np.uint64(1)
        found.append((mixed(least[run] >> _PLACE) >> _PLACE, digest, run + at, count, some[doc], sides))
    if not found:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, np.empty((0, 2), np.uint16)
    return tuple(np.concatenate(column) for column in zip(*found))


def part_of(seeds: np.ndarray, parts: int) -> np.ndarray:
    """The part of the seed space, rising with the seed."""
    return ((seeds >> np.uint64(12)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


class Slice:
    """A slice's documents and its distinct stretches, in the order in which answers about them come back."""

    def __init__(self, row: dict, sided: bool = False):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.text = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8)
        seeds, digests, start, count, doc, sides = stretches(self.text, self.lengths, sided=sided)
        order = np.lexsort((self.ids[doc], digests, seeds))
        self.seeds, self.digests, self.start, self.count, self.doc, self.sides = (
            x[order] for x in (seeds, digests, start, count, doc, sides)
        )
        changed = self.seeds[1:] != self.seeds[:-1]
        first = np.ones(len(seeds), bool)
        first[1:] = changed | (self.digests[1:] != self.digests[:-1])
        self.first = np.flatnonzero(first)
        self.group = np.cumsum(first) - 1  # the distinct stretch of each run
        self.lowest = self.ids[self.doc[self.first]]  # the smallest document in the slice that holds it
        own = np.append(True, self.seeds[self.first][1:] != self.seeds[self.first][:-1])[: len(self.first)]
        kind = np.cumsum(own) - 1
        self.crowd = np.bincount(kind, minlength=1)[kind] > CROWD if len(kind) else np.zeros(0, bool)

    def status(self, answers: list[dict]) -> np.ndarray:
        """What came back about each distinct stretch."""
        marks = [a["marks"] for a in sorted(answers, key=lambda a: a["part"]) if a["kind"] == 0]
        status = np.full(len(self.first), CROWDS, np.uint8)
        status[~self.crowd] = np.frombuffer(b"".join(marks), np.uint8)
        return status

    def shared(self, status: np.ndarray) -> np.ndarray:
        """The distinct stretches to look at byte by byte."""
        return np.flatnonzero(status == SHARED)

    def strings(self, status: np.ndarray):
        """The distinct strings of crowds, their smallest documents, and each occurrence: place, document, string."""
        at = np.flatnonzero(status[self.group] == CROWDS)
        place = ranges(self.start[at], self.count[at])
        doc = np.repeat(self.doc[at], self.count[at])
        if not len(place):
            return np.empty(0, f"S{LENGTH}"), np.empty(0, np.int64), place, doc, place
        windows = np.lib.stride_tricks.sliding_window_view(self.text, LENGTH)
        keys, lowest, string = grouped(fixed(windows[place]), self.ids[doc])
        return keys, lowest, place, doc, string


def _deltas(seeds: np.ndarray) -> bytes:
    """Rising numbers by their steps, four bytes each where they fit."""
    steps = np.diff(seeds, prepend=np.uint64(0))
    if len(steps) and int(steps[1:].max(initial=0)) < 1 << 32:
        return seeds[:1].tobytes() + steps[1:].astype(np.uint32).tobytes()
    return seeds.tobytes()


def _undeltas(raw: bytes, count: int) -> np.ndarray:
    if len(raw) == 8 * count:
        return np.frombuffer(raw, np.uint64)
    steps = np.append(np.frombuffer(raw[:8], np.uint64), np.frombuffer(raw[8:], np.uint32).astype(np.uint64))
    return np.cumsum(steps)


def _docs(docs: np.ndarray) -> bytes:
    """Numbers above the smallest of them, in two, four or eight bytes each."""
    low = docs.min(initial=np.iinfo(np.int64).max)
    above = (docs - low).astype(np.uint64)
    kind = next(k for k in (np.uint16, np.uint32, np.uint64) if int(above.max(initial=0)) <= np.iinfo(k).max)
    return np.int64(low).tobytes() + above.astype(kind).tobytes()


def _undocs(raw: bytes, count: int) -> np.ndarray:
    kind = {2: np.uint16, 4: np.uint32, 8: np.uint64}[(len(raw) - 8) // max(1, count) or 2]
    return np.frombuffer(raw[:8], np.int64) + np.frombuffer(raw[8:], kind).astype(np.int64)


def _listed(parts: int):
    """The distinct stretches of a slice, a sorted list per part of the seed space."""

    def run(table: pa.Table) -> pa.Table:
        row = table.to_pylist()[0]
        own = Slice(row, sided=True)
        part = part_of(own.seeds[own.first], parts)
        rows = []
        for p in np.unique(part):
            at = slice(*np.searchsorted(part, [p, p + 1]))
            crowd = own.crowd[at]
            first, docs = own.first[at], own.lowest[at]
            seeds, digests, sides = own.seeds[first], own.digests[first], own.sides[first]
            listed = ~crowd
            rows.append(
                {
                    "part": int(p), "slice": row["slice"], "seeds": _deltas(seeds[listed]),
                    "digests": digests[listed].tobytes(), "sides": sides[listed].tobytes(), "docs": _docs(docs[listed]),
                    "crowds": np.unique(seeds[crowd]).tobytes(),
                }
            )
        return pa.Table.from_pylist(rows, _arrow(_LIST))

    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(","))])


def _answered(table: pa.Table) -> pa.Table:
    """What a part of the seed space says about the stretches of each slice."""
    batches, levels, crowds, checks = [], Levels(), [], []
    for row in sorted(table.to_pylist(), key=lambda r: r["slice"]):
        digests = np.frombuffer(row["digests"], np.uint64)
        crowds.append(np.frombuffer(row["crowds"], np.uint64))
        checks.append(np.frombuffer(row["sides"], np.uint16).reshape(-1, 2))
        seeds, docs = _undeltas(row["seeds"], len(digests)), _undocs(row["docs"], len(digests))
        pairs = np.column_stack([seeds, digests]).astype(">u8")
        keys = fixed(pairs.view(np.uint8).reshape(len(pairs), 16))
        batches.append((row["slice"], seeds, docs))
        levels.put(keys, docs)
    part, rows = table.column("part")[0].as_py(), []
    known, smallest, places = np.empty(0, "S16"), np.empty(0, np.int64), np.empty(0, np.int64)
    if any(len(docs) for _, _, docs in batches):
        (known, smallest), places = levels.whole(), levels.places()
    sides = np.zeros((len(known), 2), np.uint16)
    sides[places] = np.concatenate(checks)
    seeds_of = known.view(">u8").reshape(-1, 2)[:, 0].astype(np.uint64)
    names, name, stretches_of = np.unique(seeds_of, return_inverse=True, return_counts=True)
    crowded = np.isin(names, np.concatenate(crowds)) | (stretches_of > CROWDED)
    said = np.where(crowded[name], CROWDS, ALONE).astype(np.uint8)
    several = np.flatnonzero(~crowded[name] & (stretches_of[name] > 1))
    said[several[_sided(name[several], sides[several])]] = SHARED
    at = 0
    for number, _, docs in batches:
        place = places[at : at + len(docs)]
        marks, held = said[place], docs > smallest[place]
        at += len(docs)
        marks = np.where(held & (marks != CROWDS), np.uint8(HELD), marks)
        rows.append({"slice": number, "kind": 0, "part": part, "marks": marks.tobytes()})
    return pa.Table.from_pylist(rows, _arrow(_ANSWER))


def _sided(name: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Which of the distinct stretches, with the numbers of their seeds, have a side in common with another one."""
    found = np.zeros(len(name), bool)
    for side in range(2):
        reach = np.flatnonzero(sides[:, side])
        own = name[reach].astype(np.uint64) << np.uint64(16) | sides[reach, side].astype(np.uint64)
        _, group, members = np.unique(own, return_inverse=True, return_counts=True)
        found[reach] |= members[group] > 1
    return found


def _spelt(parts: int):
    """What has to be compared by its bytes: shared stretches by seed, the strings of crowds one by one."""

    def run(slices_of: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for row in slices_of.to_pylist():
            own = Slice(row)
            status = own.status(answers.to_pylist())
            shared = own.shared(status)
            first = own.first[shared]
            part = part_of(own.seeds[first], parts)
            for p in np.unique(part):
                at = first[slice(*np.searchsorted(part, [p, p + 1]))]
                lengths = own.count[at] + LENGTH - 1
                text = own.text[ranges(own.start[at], lengths)]
                rows.append(_spelling(int(p), row["slice"], False, lengths, own.ids[own.doc[at]], text))
            keys, docs = own.strings(status)[:2]
            part = _dealt(keys, parts)
            for p in np.unique(part):
                at = np.flatnonzero(part == p)
                lengths = np.full(len(at), LENGTH, np.int64)
                text = keys[at].view(np.uint8)
                rows.append(_spelling(int(p), row["slice"], True, lengths, docs[at], text))
        return pa.Table.from_pylist(rows, _arrow(_STRINGS))

    return run


def _spelling(part: int, number: int, crowded: bool, lengths: np.ndarray, docs: np.ndarray, text: np.ndarray) -> dict:
    return {
        "part": part, "slice": number, "crowded": crowded, "lengths": lengths.astype(np.uint8).tobytes(),
        "docs": _docs(docs), "text": zstandard.ZstdCompressor(level=1).compress(text.tobytes()),
    }


def _dealt(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each string, by a hash of its bytes."""
    if not len(keys):
        return np.empty(0, np.int64)
    powers = np.cumprod(np.full(LENGTH, _BASE))
    raw = keys.view(np.uint8).reshape(len(keys), LENGTH)
    hashes = mixed((_LETTERS[raw] * powers).sum(axis=1, dtype=np.uint64))
    return (hashes % np.uint64(parts)).astype(np.int64)


def _marked(table: pa.Table) -> pa.Table:
    """Per slice a mark for each string of this part: whether a smaller document has it."""
    levels, batches = Levels(), []
    for row in sorted(table.to_pylist(), key=lambda r: (r["slice"], r["crowded"])):
        lengths = np.frombuffer(row["lengths"], np.uint8).astype(np.int64)
        text = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), np.uint8)
        count = lengths - LENGTH + 1
        start = np.cumsum(lengths) - lengths
        windows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
        keys = fixed(windows[ranges(start, count)])
        docs = np.repeat(_undocs(row["docs"], len(lengths)), count)
        levels.put(keys, docs)
        batches.append((row["slice"], row["crowded"], docs))
    part, rows = table.column("part")[0].as_py(), []
    lowest, at = levels.lowest(), 0
    for number, crowded, docs in batches:
        marks = docs > lowest[at : at + len(docs)]
        at += len(docs)
        rows.append({"slice": number, "kind": 2 if crowded else 1, "part": part, "marks": np.packbits(marks).tobytes()})
    return pa.Table.from_pylist(rows, _arrow(_ANSWER))


def _bits(answers: list[dict], kind: int, part: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Marks of the strings of things that went to ``part`` with ``count`` strings each, in their order."""
    out = np.zeros(int(count.sum()), bool)
    starts = np.cumsum(count) - count
    by_part = {a["part"]: a["marks"] for a in answers if a["kind"] == kind}
    for p in np.unique(part):
        at = np.flatnonzero(part == p)
        places = ranges(starts[at], count[at])
        out[places] = np.unpackbits(np.frombuffer(by_part[int(p)], np.uint8), count=len(places)).astype(bool)
    return out


def _removed(parts: int):
    """Each document of a slice with what is left of it and the spans that went."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("kept", pa.binary()), ("spans", span)])

    def run(slices_of: pa.Table, answers: pa.Table) -> pa.Table:
        answers_of, out = answers.to_pylist(), []
        for row in slices_of.to_pylist():
            own = Slice(row)
            gone = _covered(own, answers_of, parts)
            ends = np.cumsum(own.lengths)
            for doc, end, length in zip(own.ids.tolist(), ends.tolist(), own.lengths.tolist()):
                cut = gone[end - length : end]
                spans = []
                if cut.any():
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], cut.view(np.int8), [0]])))
                    spans = [{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()]
                kept = own.text[end - length : end]
                out.append({"doc_id": doc, "n_bytes": length, "kept": (kept[~cut] if spans else kept).tobytes(), "spans": spans})
        return pa.Table.from_pylist(out, schema)

    return run


def _covered(own: Slice, answers: list[dict], parts: int) -> np.ndarray:
    """Which bytes of a slice go."""
    status = own.status(answers)
    doc_ids = own.ids[own.doc]
    later = doc_ids > own.lowest[own.group]
    whole = (status[own.group] != CROWDS) & (later | (status[own.group] == HELD))
    begin, count = [own.start[whole]], [own.count[whole]]
    # Stretches looked at: the marks of a stretch hold for its places in the smallest document.
    shared = own.shared(status)
    if len(shared):
        sizes = own.count[own.first[shared]]
        part = part_of(own.seeds[own.first[shared]], parts)
        marks = _bits(answers, 1, part, sizes)
        offset = np.full(len(own.first), -1, np.int64)
        offset[shared] = np.cumsum(sizes) - sizes
        at = np.flatnonzero((offset[own.group] >= 0) & ~later)
        marked = marks[ranges(offset[own.group[at]], own.count[at])]
        begin.append(ranges(own.start[at], own.count[at])[marked])
        count.append(np.ones(int(marked.sum()), np.int64))
    keys, lowest, place, doc, string = own.strings(status)
    if len(keys):
        marks = _bits(answers, 2, _dealt(keys, parts), np.ones(len(keys), np.int64))
        marked = marks[string] | (own.ids[doc] > lowest[string])
        begin.append(place[marked])
        count.append(np.ones(int(marked.sum()), np.int64))
    starts, counts = np.concatenate(begin), np.concatenate(count)
    depth = np.bincount(starts, minlength=len(own.text) + 1).astype(np.int32)
    depth -= np.bincount(starts + counts + LENGTH - 1, minlength=len(own.text) + 1).astype(np.int32)
    return np.cumsum(depth)[:-1] > 0


def removed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, kept, spans`` of every document: ``kept`` is binary, as a span may cut a
    character; ``spans`` are byte ranges (start, end) of the text. Jobs run while it is built."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = spark.conf.get("spark.sql.shuffle.partitions")
    name = f"suffix_slices_{uuid4().hex}"
    sliced = rows.filter("doc_id IS NOT NULL").mapInArrow(_sliced, _SLICE)
    path = f"{shared_dir(spark)}/{name}"
    sliced.write.bucketBy(int(buckets), "slice").option("path", path).option("compression", "none").saveAsTable(name)
    try:
        table = spark.table(name)
        total = table.agg(F.sum("bytes")).first()[0] or 0
        parts, string_parts = (1 + total // size for size in (_BYTES_A_PART, _BYTES_A_STRING_PART))
        lists = table.groupBy("slice").applyInArrow(_listed(parts), _LIST)
        said = stored(lists.repartition(parts, "part").groupBy("part").applyInArrow(_answered, _ANSWER), "suffix_stretches")
        asked = table.groupBy("slice").cogroup(said.groupBy("slice"))
        spelt = asked.applyInArrow(_spelt(string_parts), _STRINGS)
        marks = stored(spelt.repartition(string_parts, "part").groupBy("part").applyInArrow(_marked, _ANSWER), "suffix_marks")
        answers = said.unionByName(marks).groupBy("slice")
        schema = "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>"
        left = stored(table.groupBy("slice").cogroup(answers).applyInArrow(_removed(string_parts), schema), "suffix_kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    unordered = rows.filter("doc_id IS NULL").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("kept"), F.array().cast(left.schema["spans"].dataType).alias("spans"),
    )
    return left.unionByName(unordered)


def removal_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed(docs).select(
        "doc_id", "n_bytes", lost.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
