"""Language of a document by rank-order profiles of its letters' n-grams.

A text is lower-cased, everything but letters becomes a word break, and the n-grams of one to three
characters within the broken text are counted (breaks count as a character, a break alone does not).
A profile is the list of the ``ranks`` most frequent n-grams, most frequent first. The distance of a
document to a language is the sum, over the document's profile, of how far each n-gram's place is from
its place in the language's profile; an n-gram the language does not list is out of place by
``ranks``. The language with the least distance wins, the smallest name among equals.

Counting for the profiles covers all training texts: tasks count per slice, Spark adds up, a window
ranks. Profiles are ``ranks`` rows per language (labels are few: they are checked against
``most_languages``) and travel to the tasks; every document is then placed on its own.

Null texts and texts without letters are ``und`` with score 0, as is every document if nothing can be
learnt. Repeated rows, null ids and other columns make no difference; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tradewind.llm.texts import slices

RANKS = 400
UNKNOWN = "und"
#: Bits of a code point in an n-gram's number; three of them fit 63 bits.
_BITS = 21
_BREAK = 32


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> np.ndarray:
    """Numbers of all n-grams of one to three characters."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[chars]
    if not letter.any():
        return np.empty(0, np.int64)
    chars = np.where(letter, chars, _BREAK).astype(np.int64)
    # One break between words, one at each end.
    chars = np.concatenate([[_BREAK], chars, [_BREAK]])
    chars = chars[np.concatenate([[True], (chars[1:] != _BREAK) | (chars[:-1] != _BREAK)])]
    one = chars[chars != _BREAK]
    two = (chars[:-1] << _BITS) + chars[1:]
    three = (two[:-1] << _BITS) + chars[2:]
    return np.concatenate([one, two, three])


def profile(text: str, ranks: int) -> np.ndarray:
    """The most frequent n-grams in order; equal counts by number."""
    grams, counts = np.unique(ngrams(text), return_counts=True)
    if len(grams) > ranks:
        # All that can be among the first, the tie at the end included.
        least = -np.partition(-counts, ranks - 1)[ranks - 1]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:ranks]


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most_bytes=2 << 20):
        by_language: dict[str, list[np.ndarray]] = {}
        for text, language in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            by_language.setdefault(language, []).append(ngrams(text or ""))
        for language, parts in by_language.items():
            grams, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(grams), pa.string()), pa.array(grams), pa.array(counts.astype(np.int64))],
                names=["lang", "gram", "n"],
            )


class Profiles:
    """Rank-order profiles of languages, and the distances of documents to them."""

    def __init__(self, rows: list[tuple[str, int, int]], ranks: int):
        """``rows``: (language, n-gram, place)."""
        self.ranks = ranks
        self.languages = sorted({row[0] for row in rows})
        self.tables = []
        for language in self.languages:
            own = sorted((gram, place) for name, gram, place in rows if name == language)
            self.tables.append((np.array([g for g, _ in own]), np.array([p for _, p in own])))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language with the least distance, and 1 - distance / largest possible distance."""
        grams = profile(text or "", self.ranks)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        places = np.arange(len(grams))
        best, least = UNKNOWN, None
        for language, (listed, own) in zip(self.languages, self.tables, strict=True):
            at = np.minimum(np.searchsorted(listed, grams), len(listed) - 1)
            away = np.where(listed[at] == grams, np.abs(own[at] - places), self.ranks)
            distance = int(away.sum())
            if least is None or distance < least:
                best, least = language, distance
        return best, 1 - least / (self.ranks * len(grams))


def learn(docs: DataFrame, ranks: int = RANKS, most_languages: int = 1000) -> Profiles:
    """Profiles of the labels in ``lang`` from all rows that have one."""
    counted = (
        docs.filter("lang IS NOT NULL")
        .select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    ranked = counted.withColumn("place", F.row_number().over(order) - 1).filter(F.col("place") < ranks)
    rows = ranked.select("lang", "gram", "place").limit(ranks * most_languages + 1).collect()
    if len(rows) > ranks * most_languages:
        raise ValueError(f"more than {most_languages} languages")
    return Profiles([tuple(row) for row in rows], ranks)


def identify(docs: DataFrame, profiles: Profiles, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs`` and then the language and its score, under the given names."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [profiles.nearest(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                names=[*batch.schema.names, pred, score],
            )

    schema = T.StructType([*docs.schema, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """The fold no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_documents(docs: DataFrame, ranks: int = RANKS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; learnt from the documents outside the held-out fold.

    A document without a ``doc_id`` is in no fold: nothing is learnt from it, and it is not held out.
    """
    fold = held_out(F.col("doc_id"))
    profiles = learn(docs.filter(F.col("doc_id").isNotNull() & ~fold), ranks)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = identify(plain, profiles)
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score")


def known_languages(docs: DataFrame, least_score: float = 0.05, ranks: int = RANKS) -> DataFrame:
    """The documents that have a language, with their own columns.

    Those without letters go, and those so far from every profile that hardly any of their n-grams is
    in place (score under ``least_score``).
    """
    fold = held_out(F.col("doc_id"))
    profiles = learn(docs.filter(F.col("doc_id").isNotNull() & ~fold), ranks)
    names, types = docs.columns, docs.schema
    found = identify(docs.withColumn("text", F.col("text").cast("string")), profiles, "__pred", "__score")
    kept = found.filter((F.col("__pred") != UNKNOWN) & (F.col("__score") >= least_score))
    return kept.select(*[F.col(name).cast(types[name].dataType).alias(name) for name in names])
