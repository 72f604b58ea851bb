"""Helpers that run inside tasks, on Arrow batches of documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most_bytes: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds about ``most_bytes`` of text, one document at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


class Numbers(dict):
    """Words to numbers in order of arrival; ``fresh`` holds the words not yet looked at."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, word):
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))


def joined(parts: list[np.ndarray], dtype=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """All parts in a row, and where each begins (one more entry than parts)."""
    starts = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in parts], out=starts[1:])
    return (np.concatenate(parts) if parts else np.empty(0, dtype)), starts


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
