"""Licence texts in documents: MinHash bands over overlapping windows, then exact containment.

Texts are read as words (A-Z in lower case, ASCII marks as breaks); the unit is the shingle of
``SHINGLE`` words. A template's windows have 1, 2, 4, 8 or 16 shingles, the largest of these that fits
it; all its windows are indexed by 16 bands of 2 minima. Documents are cut into overlapping windows of
the same sizes, ``size / 4`` shingles apart. A window with half the shingles of a template window is
retrieved with probability 1 - (1 - 1/4)^16 = 0.99, one with four fifths all but certainly (1 - 9e-8),
and a template of many shingles has many windows to be found by. Windows without any shingle of any
template cannot collide and get no signature, which leaves out nearly all of a text. A document that is
shorter than the windows of a size can still hold most of a template of it (a notice without its last
words); the templates of that size that it has any shingle of are all retrieved.

Retrieved templates are verified exactly: the share of the template's distinct shingles that occur in
the document's stretch of the template's length (and half of it again on each side, between the
window's neighbours) must be ``least_share``. Stretches of one template that overlap are one match, at
its best. Templates that hold another one are reported beside it.

The index is built from the templates alone (a parameter of at most ``MOST_TEMPLATE_WORDS`` words) and
travels to the tasks; documents are never shuffled. Null and empty texts have no match; repeated rows
match each by itself; a null ``doc_id`` stays null; an empty table gives no rows. Templates of fewer
than ``SHINGLE`` words are matched as the one shingle they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.decontaminate import Grams, grams_of, inside, slice_words
from tradewind.llm.license_texts import TEMPLATES
from tradewind.llm.minhash import band_keys, signatures
from tradewind.llm.texts import ranges, slices, utf8

SHINGLE = 5
BANDS, ROWS = 16, 2
SIZES = (1, 2, 4, 8, 16)
MOST_TEMPLATE_WORDS = 1_000_000
FOUND = "doc_id long, license string, share double, first_word long, end_word long, start long, end long"
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def windows(n: int, size: int, step: int) -> np.ndarray:
    """Where windows of ``size`` among ``n`` shingles begin, the last one included."""
    return np.unique(np.append(np.arange(0, n - size + 1, step), n - size)) if n >= size else np.empty(0, np.int64)


def window_keys(grams: np.ndarray, begins: np.ndarray, size: int) -> np.ndarray:
    """Band keys of the windows, one row each."""
    values = grams[(begins[:, None] + np.arange(size)).reshape(-1)]
    starts = np.arange(len(begins) + 1, dtype=np.int64) * size
    return band_keys(signatures(values, starts, BANDS * ROWS), BANDS, ROWS)


class Index:
    """Band keys and shingle sets of all templates."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.grams: list[np.ndarray] = []
        words = 0
        keys: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.shingle = []
        sizes = []
        for number, text in enumerate(templates.values()):
            h, _ = slice_words([text.encode()])
            words += len(h)
            width = min(SHINGLE, len(h))
            grams = grams_of(h, width) if width else np.empty(0, np.uint64)
            self.grams.append(grams)
            self.shingle.append(width)
            sizes.append(0)
            if width < SHINGLE:
                continue
            size = sizes[-1] = max(s for s in SIZES if s <= len(grams))
            begins = windows(len(grams), size, 1)
            found = window_keys(grams, begins, size).reshape(-1)
            keys.setdefault(size, []).append((found, np.full(len(found), number)))
        if words > MOST_TEMPLATE_WORDS:
            raise ValueError(f"the templates have more than {MOST_TEMPLATE_WORDS} words")
        #: Per window size: sorted band keys and the template of each.
        self.keys = {}
        for size, parts in keys.items():
            key, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(key, kind="stable")
            self.keys[size] = key[order], owner[order]
        flat = np.concatenate([*self.grams, np.empty(0, np.uint64)])
        self.members = Grams(flat)
        #: Per shingle, in the order of ``members``: where its templates begin and end in ``owners``.
        order = np.argsort(flat, kind="stable")
        self.owners = np.repeat(np.arange(len(self.grams)), [len(g) for g in self.grams])[order]
        self.first = np.searchsorted(flat[order], self.members.values)
        self.after = np.searchsorted(flat[order], self.members.values, side="right")
        #: Window size of each template, 0 for those that are one short shingle.
        self.sizes = np.array(sizes, np.int64)
        self.short = [(i, g) for i, g in enumerate(self.grams) if 0 < self.shingle[i] < SHINGLE]

    def retrieved(self, grams: np.ndarray, hits: np.ndarray, members: np.ndarray) -> set[tuple[int, int]]:
        """(template, position) of the windows that collide with one of a template.

        ``hits`` are the places of shingles of any template and ``members`` which ones they are.
        """
        found: set[tuple[int, int]] = set()
        if len(grams) < max(SIZES):
            # Fewer shingles than a window: whatever template of that size has one of them.
            held = np.unique(members)
            near = np.unique(self.owners[ranges(self.first[held], self.after[held] - self.first[held])])
            found.update((int(t), 0) for t in near[self.sizes[near] > len(grams)])
        for size, (keys, owner) in self.keys.items():
            if len(grams) < size:
                continue
            step = max(1, size // 4)
            # Windows at multiples of the step (and the last) that hold a hit.
            last = hits // step
            near = np.unique(np.concatenate([last - k for k in range(-(-size // step))]) * step)
            near = near[(near >= 0) & (near <= len(grams) - size)]
            begins = np.unique(np.append(near, len(grams) - size))
            window = window_keys(grams, begins, size)
            flat = window.reshape(-1)
            lo, hi = np.searchsorted(keys, flat), np.searchsorted(keys, flat, side="right")
            for i in np.flatnonzero(hi > lo).tolist():
                at = int(begins[i // BANDS])
                found.update((int(t), at) for t in owner[lo[i] : hi[i]])
        return found

    def verified(self, grams: np.ndarray, found: set[tuple[int, int]], least_share: float) -> list[tuple]:
        """(template, share, first shingle, last shingle + 1) of stretches that hold enough of it."""
        out = []
        for t in {t for t, _ in found}:
            own = self.grams[t]
            wanted, n = np.unique(own), len(own)
            stretches: list[list[int]] = []
            for at in sorted(p for x, p in found if x == t):
                lo, hi = max(0, at - n - n // 2), min(len(grams), at + 2 * n + n // 2)
                if stretches and lo <= stretches[-1][1]:
                    stretches[-1][1] = hi
                else:
                    stretches.append([lo, hi])
            for lo, hi in stretches:
                out += _best_runs(t, grams[lo:hi], wanted, n, lo, least_share)
        return sorted(out, key=lambda x: (x[2], x[0]))


def _best_runs(t: int, grams: np.ndarray, wanted: np.ndarray, n: int, lo: int, least_share: float) -> list[tuple]:
    """Disjoint runs of about the template's length that hold most of it, best first."""
    place = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
    hit = np.flatnonzero(wanted[place] == grams)
    runs = []
    reach = n + n // 2
    for i, first in enumerate(hit.tolist()):
        part = hit[i : int(np.searchsorted(hit, first + reach))]
        distinct, at = np.unique(place[part], return_index=True)
        share = len(distinct) / len(wanted)
        if share >= least_share:
            runs.append((share, -first, int(part[at.max()]) + 1))
    taken: list[tuple] = []
    for share, minus_first, end in sorted(runs, reverse=True):
        first = -minus_first
        if all(end <= a or first >= b for _, _, a, b in taken):
            taken.append((t, share, first, end))
    return [(t, share, lo + a, lo + b) for t, share, a, b in taken]


def _search(index: Index, least_share: float):
    fields = pa.schema(
        [("doc_id", pa.int64()), ("license", pa.string()), ("share", pa.float64()), ("first_word", pa.int64()),
         ("end_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
    )

    def matches(h: np.ndarray) -> list[tuple[str, float, int, int]]:
        """(licence, share, first word, word after the last) in a text's word hashes."""
        found = []
        grams = grams_of(h, SHINGLE)
        hits, members = index.members.find(grams)
        if len(hits):
            candidates = index.retrieved(grams, hits, members)
            for t, share, a, b in index.verified(grams, candidates, least_share):
                found.append((index.names[t], share, a, b + SHINGLE - 1))
        for t, own in index.short:
            width = index.shingle[t]
            at = np.flatnonzero(grams_of(h, width) == own[0])
            found += [(index.names[t], 1.0, int(a), int(a) + width) for a in at]
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, ids = utf8(batch), batch.column("doc_id").to_pylist()
            h, starts = slice_words(texts)
            # Which texts have any shingle of a template, all at once.
            at, _ = index.members.find(grams_of(h, SHINGLE))
            row, whole = inside(at, starts, SHINGLE)
            hit = set(row[whole].tolist()) if not index.short else range(len(texts))
            rows = []
            for r in sorted(hit):
                own = matches(h[starts[r] : starts[r + 1]])
                if own:
                    spans = [m.span() for m in _WORD.finditer(texts[r])]
                    chars = np.cumsum(np.concatenate([[0], (np.frombuffer(texts[r], np.uint8) & 0xC0) != 0x80]))
                    for name, share, a, b in own:
                        rows.append((ids[r], name, share, a, b, int(chars[spans[a][0]]), int(chars[spans[b - 1][1]])))
            if rows:
                columns = [pa.array(x, type=f.type) for x, f in zip(zip(*rows, strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return run


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least_share: float = 0.8) -> DataFrame:
    """One row per document and licence found: share of its shingles, place in words and in code points."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_search(Index(TEMPLATES if templates is None else templates), least_share), FOUND)
