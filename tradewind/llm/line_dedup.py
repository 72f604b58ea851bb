"""Removal of lines that many documents repeat, by two Bloom filters and an exact check.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. Keys of at least
``least_chars`` code points that at least ``least_docs`` documents hold lose their lines everywhere
except in the largest ``doc_id`` that holds them.

Steps:
1. each task hashes the keys of its documents (once per document) and sends the hashes, without
   text, to the partition that owns the part of the hash space. A hash that a task meets in several
   documents goes there once, as seen twice, and its documents are suspects already, so a key that
   every document holds adds one row per task only;
2. each owner runs its hashes through two Bloom filters, one for hashes seen once, one for hashes
   seen twice, and names the documents whose hashes the second one knows: all repeats and a few
   false positives, no repeat is missed;
3. only suspected lines travel as text, by key: counted exactly, largest document chosen;
4. the documents get the hashes of what they lose by a join on ``doc_id``.
The documents are dealt by ``doc_id`` once; both joins use that one exchange.

Nulls and empty texts are one empty line. A null ``doc_id`` is a document lower than any other. Every
row is a document of its own for the count; rows that share a ``doc_id`` lose or keep a key together.
An empty table gives no rows. Other columns of the documents come back unchanged (``rewrite``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.texts import mixed, slices, utf8

BITS_PER_HASH = 16
PROBES = 4
BLOCK = 1 << 16
#: Kinds of rows sent to the filters.
ONCE, TWICE, SUSPECT = 0, 1, 2


def key_of(line: bytes, least_chars: int) -> bytes | None:
    """The key of a line, None if it is too short to count."""
    key = line.strip().lower()  # of bytes: ASCII white space and letters only
    if len(key) < least_chars or (not key.isascii() and len(key.decode()) < least_chars):
        return None
    return key


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def hash_of(key: bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(key))


def _sent_hashes(least_chars: int):
    """Rows (part of the hash space, hash, doc_id, kind); parts are taken modulo later."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            first: dict[int, int] = {}
            several: set[int] = set()
            hashes, docs, kinds = [], [], []
            for doc, text in zip(ids, utf8(batch), strict=True):
                keys = {k for line in text.split(b"\n") if (k := key_of(line, least_chars)) is not None}
                for h in map(hash_of, keys):
                    if h not in first:
                        first[h] = doc
                        continue
                    if h not in several:
                        several.add(h)
                        hashes += [h, h]
                        docs += [first[h], None]
                        kinds += [SUSPECT, TWICE]
                    hashes.append(h)
                    docs.append(doc)
                    kinds.append(SUSPECT)
            once = [h for h in first if h not in several]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes + once, pa.int64()),
                    pa.array(docs + [first[h] for h in once], pa.int64()),
                    pa.array(kinds + [ONCE] * len(once), pa.int8()),
                ],
                names=["hash", "doc_id", "kind"],
            )

    return run


def _digests(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests of keys, as two columns of 64 bits."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


class Bloom:
    """A Bloom filter over 64-bit hashes, as an array of bits."""

    def __init__(self, expected: int):
        bits = 1 << max(10, (expected * BITS_PER_HASH - 1).bit_length())
        self.mask, self.cells = np.uint64(bits - 1), np.zeros(bits, bool)

    def _at(self, hashes: np.ndarray) -> list[np.ndarray]:
        with np.errstate(over="ignore"):
            step = mixed(hashes) | np.uint64(1)
            return [(hashes + np.uint64(i) * step) & self.mask for i in range(PROBES)]

    def add(self, hashes: np.ndarray) -> None:
        for at in self._at(hashes):
            self.cells[at] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in self._at(hashes):
            found &= self.cells[at]
        return found


def seen_twice(hashes: np.ndarray, surely: np.ndarray) -> Bloom:
    """Run hashes through the filters in blocks; ``surely`` marks those known as repeated already."""
    once, twice = Bloom(len(hashes)), Bloom(len(hashes))
    for start in range(0, len(hashes), BLOCK):
        block, at, count = np.unique(hashes[start : start + BLOCK], return_inverse=True, return_counts=True)
        sure = np.bincount(at, weights=surely[start : start + BLOCK], minlength=len(block)) > 0
        twice.add(block[once.has(block) | (count > 1) | sure])
        once.add(block)
    return twice


def _suspects(group: pa.Table) -> pa.Table:
    kind = group.column("kind").to_numpy()
    hashes = group.column("hash").to_numpy().view(np.uint64)
    asked = kind != SUSPECT
    twice = seen_twice(hashes[asked], kind[asked] == TWICE)
    keep = (kind == SUSPECT) | ((kind == ONCE) & twice.has(hashes))
    return group.select(["doc_id", "hash"]).filter(pa.array(keep))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _suspected_lines(least_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            docs, keys, key_hashes = [], [], []
            for doc, text, hashes in zip(ids, utf8(batch), batch.column("__hashes").to_pylist(), strict=True):
                wanted = set(hashes)
                found = {
                    k: h
                    for line in text.split(b"\n")
                    if (k := key_of(line, least_chars)) is not None and (h := hash_of(k)) in wanted
                }
                docs += [doc] * len(found)
                keys += found
                key_hashes += found.values()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array(keys, pa.binary()).cast(pa.string()),
                    pa.array(key_hashes, pa.int64()),
                    *(pa.array(x) for x in _digests(keys)),
                ],
                names=["doc_id", "key", "hash", "high", "low"],
            )

    return run


def losses(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """The hashes of the keys a document loses: ``lost_doc, lost``, one row per document that loses."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.select("doc_id", "text").mapInArrow(
        _sent_hashes(least_chars), "hash long, doc_id long, kind byte"
    )
    # Suspects only pass through: they are spread by document, not by hash.
    spread = F.when(F.col("kind") == SUSPECT, F.xxhash64("doc_id", "hash")).otherwise(F.xxhash64("hash"))
    suspects = (
        sent.withColumn("part", F.pmod(spread, F.lit(parts)))
        .groupBy("part")
        .applyInArrow(_suspects, "doc_id long, hash long")
        .groupBy(F.col("doc_id").alias("__suspect_doc"))
        .agg(F.collect_list("hash").alias("__hashes"))
    )
    # All columns stay, so that this is the exchange of the documents that the caller joins with, too.
    lines = (
        docs.join(suspects, _same(docs["doc_id"], suspects["__suspect_doc"]))
        .mapInArrow(_suspected_lines(least_chars), "doc_id long, key string, hash long, high long, low long")
    )
    repeated = (
        lines.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.max("doc_id").alias("last_doc"),
            F.max("high").alias("high"),
            F.max("low").alias("low"),
        )
        .filter(F.col("n_docs") >= least_docs)
    )
    # Counted by text, joined by its 128-bit digest: the text moves once, and a hot key can be split.
    lost = (
        lines.select("doc_id", "hash", "high", "low")
        .join(repeated.select("high", "low", "last_doc"), ["high", "low"])
        .filter(~_same(F.col("doc_id"), F.col("last_doc")))
    )
    return lost.groupBy(F.col("doc_id").alias("lost_doc")).agg(F.collect_set("hash").alias("lost"))


def kept_lines(text: bytes, lost: set[int], least_chars: int) -> tuple[list[bytes], int]:
    """The lines that stay, and how many there were."""
    lines = text.split(b"\n")
    if not lost:
        return lines, len(lines)
    stay = []
    for line in lines:
        key = key_of(line, least_chars)
        if key is None or hash_of(key) not in lost:
            stay.append(line)
    return stay, len(lines)


Finish = Callable[[pa.RecordBatch, list[list[bytes]], list[int]], pa.RecordBatch]


def _rewritten(least_chars: int, finish: Finish, lost_column: str = "lost"):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            done = [
                kept_lines(text, set(lost or ()), least_chars)
                for text, lost in zip(utf8(batch), batch.column(lost_column).to_pylist(), strict=True)
            ]
            yield finish(batch, [x for x, _ in done], [n for _, n in done])

    return run


def _joined(docs: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    lost = losses(docs, least_chars, least_docs)
    return docs.join(lost, _same(docs["doc_id"], lost["lost_doc"]), "left").drop("lost_doc")


def line_report(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def finish(batch, kept, n_lines):
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_lines, pa.int64()),
                pa.array([n - len(x) for n, x in zip(n_lines, kept, strict=True)], pa.int64()),
                pa.array([hashlib.sha256(b"\n".join(x)).hexdigest() for x in kept]),
            ],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    return _joined(docs, least_chars, least_docs).mapInArrow(
        _rewritten(least_chars, finish), "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )


def rewrite(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """The documents with their repeated lines taken out of ``text``; a null text stays null.

    Only ``doc_id`` and ``text`` go through the steps; all columns come back under their names.
    """
    names = docs.columns
    plain = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in plain.schema])

    def finish(batch, kept, _):
        nulls = batch.column("text").is_valid().to_pylist()
        text = [b"\n".join(x) if valid else None for x, valid in zip(kept, nulls, strict=True)]
        columns = [batch.column(name) for name in names]
        columns[names.index("text")] = pa.array(text, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(columns, names=names)

    lost = losses(plain, least_chars, least_docs)
    # The names of the steps must not meet those of the documents.
    lost = lost.select(F.col("lost_doc").alias("__lost_doc"), F.col("lost").alias("__lost"))
    whole = plain.join(lost, _same(plain["doc_id"], lost["__lost_doc"]), "left").select(
        *[plain[name] for name in names], F.col("__lost")
    )
    return whole.mapInArrow(_rewritten(least_chars, finish, "__lost"), schema)
