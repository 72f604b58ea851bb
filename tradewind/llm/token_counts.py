"""Token counts of whole texts: every distinct pre-token goes through the tokenizer once.

A pre-token here is a word with the one space before it, the rest of a run without white space, or a
run of white space. The tokenizer never merges across such a boundary, so the pieces of a text are
the pieces of its pre-tokens. Added tokens of the vocabulary that stand in a text cut it first, as in
the library.

Steps, all co-partitioned by the hash of the pre-token:
1. each task turns a slice of documents into its distinct pre-tokens with the rows and frequencies of
   the documents that hold them, dealt into buckets by hash and packed into one row per bucket;
2. a bucket counts the pieces of each of its distinct pre-tokens once, joins the counts to the
   frequencies and adds up what its pre-tokens give each document;
3. the sums of a slice come together from all buckets.
No ids are kept and the documents are read once. A pre-token has one entry per slice, however many
documents hold it, so no bucket grows with a frequent one.

Nulls count as empty texts (0 bytes, 0 tokens), also a null ``doc_id`` keeps its row; repeated rows
are documents of their own; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.texts import Numbers, joined, slices

# The white space of Unicode.
WHITE = "\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A word of Latin letters ends where white space or one of these marks follows; the tokenizer cuts there too.
_WORD = f" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]++(?=[{WHITE}.,;:!?])"
_UNIT = re.compile(f"{_WORD}| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
SLICE_BYTES = 24 << 20
WORDS_A_CALL = 500

_PACKED = (
    "bucket int, slice long, units binary, lengths binary, n_docs binary, rows binary, counts binary, "
    "doc_ids array<long>, n_bytes array<long>"
)
_PARTIAL = "slice long, rows binary, counts binary, doc_ids array<long>, n_bytes array<long>"
_COUNTED = "doc_id long, n_bytes long, n_tokens long"


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def added_tokens(path: str) -> re.Pattern | None:
    """A pattern of the tokens that are matched in the raw text, before anything else."""
    found = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("(" + "|".join(map(re.escape, sorted(found, key=len, reverse=True))) + ")") if found else None


def units(text: str, added: re.Pattern | None) -> list[str]:
    """The pre-tokens of a text in order; together they are the text."""
    if added is None or not added.search(text):
        return _UNIT.findall(text)
    return [
        unit
        for i, part in enumerate(added.split(text))
        for unit in ([part] if i % 2 else _UNIT.findall(part))
    ]


def encoded(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and where each begins.

    Many texts go through the tokenizer in one, with an added token between them: it cuts wherever it
    stands and is easily found again. Where texts hold added tokens themselves, they go one by one.
    """
    model = tokenizer(path)
    marks = model.get_added_tokens_decoder()
    parts, lengths = [np.empty(0, np.uint32)], [0]
    for at in range(0, len(texts), WORDS_A_CALL):
        group, cuts = texts[at : at + WORDS_A_CALL], None
        for mark, token in list(marks.items())[:1]:
            found = model.encode_batch_fast([token.content.join(group)], add_special_tokens=False)[0]
            ids = np.array(found.ids, np.uint32)
            cuts = np.flatnonzero(ids == mark)
        if cuts is not None and len(cuts) == len(group) - 1:
            parts.append(ids[ids != mark])
            lengths += (np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1).tolist()
        else:
            for one in model.encode_batch_fast(group, add_special_tokens=False):
                parts.append(np.array(one.ids, np.uint32))
                lengths.append(len(one.ids))
    return np.concatenate(parts), np.cumsum(lengths)


def _record(schema: str, **columns) -> pa.RecordBatch:
    """A batch of the named columns, null where a column of the schema is not given."""
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = pa.schema([(part.split()[0], types[part.split()[1]]) for part in schema.split(", ")])
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in fields]
    return pa.RecordBatch.from_arrays(arrays, schema=fields)


def _frequencies(path: str, buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added, task = added_tokens(path), TaskContext.get().partitionId()
        for number, batch in enumerate(slices(batches, most_bytes=SLICE_BYTES)):
            name = (task << 32) + number
            known = Numbers()
            texts = [x or "" for x in batch.column("text").to_pylist()]
            ids, starts = joined([known.of(units(x, added)) for x in texts], np.int32)
            row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(starts))
            sizes = [len(x.encode()) for x in texts]
            n_docs = len(texts)
            del texts
            # Numbers of pre-tokens in the order of their buckets.
            names = [x.encode() for x in known]
            bucket = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            pairs, counts = np.unique(place[ids] * n_docs + row, return_counts=True)
            of_unit = np.searchsorted(pairs // n_docs, np.arange(len(order) + 1))
            rows = (pairs % n_docs).astype(np.int32)
            own, first = np.unique(bucket[order], return_index=True)
            cells = []
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
                part = [names[i] for i in order[a:b].tolist()]
                x, y = of_unit[a], of_unit[b]
                lengths = np.fromiter(map(len, part), np.int32, len(part))
                held = np.diff(of_unit[a : b + 1]).astype(np.int32)
                cells.append((b"".join(part), lengths, held, rows[x:y], counts[x:y].astype(np.int32)))
            columns = dict(zip(("units", "lengths", "n_docs", "rows", "counts"), zip(*cells, strict=True), strict=True))
            if cells:
                columns = {k: [bytes(memoryview(x)) for x in v] for k, v in columns.items()}
                yield _record(_PACKED, bucket=own.astype(np.int32), slice=[name] * len(cells), **columns)
            # The documents themselves, in any bucket.
            yield _record(
                _PACKED, bucket=[name % buckets], slice=[name], doc_ids=[batch.column("doc_id").to_pylist()], n_bytes=[sizes]
            )

    return run


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    return joined([np.frombuffer(x, np.int32) for x in column.to_pylist()], np.int32)


def _counted_once(path: str):
    """A bucket: pieces of each distinct pre-token, joined to the frequencies of all slices."""

    def run(bucket: pa.Table) -> pa.Table:
        heads = bucket.filter(bucket.column("units").is_null())
        out = [_record(_PARTIAL, **{k: heads.column(k).to_pylist() for k in ("slice", "doc_ids", "n_bytes")})]
        bucket = bucket.filter(bucket.column("units").is_valid())
        if bucket.num_rows:
            lengths, starts = _numbers(bucket.column("lengths"))
            ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            data = pa.py_buffer(b"".join(bucket.column("units").to_pylist()))
            strings = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(ends), data).dictionary_encode()
            _, pieces = encoded(path, strings.dictionary.to_pylist())
            n_pieces = np.diff(pieces)[strings.indices.to_numpy()]
            rows, row_starts = _numbers(bucket.column("rows"))
            counts, _ = _numbers(bucket.column("counts"))
            n_docs, _ = _numbers(bucket.column("n_docs"))
            weights = counts * np.repeat(n_pieces, n_docs)
            sums = []
            for a, b in zip(row_starts[:-1], row_starts[1:], strict=True):
                of_doc = np.bincount(rows[a:b], weights=weights[a:b]).astype(np.int64)
                there = np.flatnonzero(of_doc)
                sums.append((there.astype(np.int32).tobytes(), of_doc[there].tobytes()))
            out.append(
                _record(_PARTIAL, slice=bucket.column("slice").to_pylist(), rows=[x for x, _ in sums], counts=[x for _, x in sums])
            )
        return pa.Table.from_batches(out)

    return run


def _whole(part: pa.Table) -> pa.Table:
    """A slice: its documents and the sums of all buckets."""
    heads = part.filter(part.column("doc_ids").is_valid())
    ids, n_bytes = heads.column("doc_ids")[0].values, heads.column("n_bytes")[0].values
    rest = part.filter(part.column("rows").is_valid())
    totals = np.zeros(len(ids), np.int64)
    for rows, counts in zip(rest.column("rows").to_pylist(), rest.column("counts").to_pylist(), strict=True):
        totals[np.frombuffer(rows, np.int32)] += np.frombuffer(counts, np.int64)
    return pa.Table.from_arrays([ids, n_bytes, pa.array(totals)], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document, by the vocabulary at ``path``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        texts.mapInArrow(_frequencies(path, buckets), _PACKED)
        .groupBy("bucket")
        .applyInArrow(_counted_once(path), _PARTIAL)
        .groupBy("slice")
        .applyInArrow(_whole, _COUNTED)
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
