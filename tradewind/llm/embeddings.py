"""Near-duplicate vectors of a label: navigable small-world graphs per shard, verified cosines, components.

Steps:
1. equal vectors of a label are one class from here on, represented by the smallest ``vec_id``, so
   thousands of copies are one node with a weight;
2. the classes of a label are dealt into shards of about ``shard_size`` and each shard builds its
   graph. The graph is audited against brute force on a sample of the shard: the beam is doubled until
   it finds ``least_recall`` of the links and of the ten nearest;
3. every shard's vectors query every shard of their label (each pair of shards once, links hold both
   ways). A beam full of links is widened until it is not, so large groups come out whole;
4. what is found is verified by cosine in double precision. A pair of shards gives each vector its
   number of links and one link towards the smallest of its group there, not all pairs;
5. link numbers are added up, the links are united to components.

Vectors that are null, zero or hold null or non-finite numbers, or have no label, link with nothing,
nor do rows without a ``vec_id`` (component null, not kept). Vectors of different lengths never link.
Repeated rows count as vectors of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.hnsw import Graph
from tradewind.llm.links import components
from tradewind.llm.storage import stored

SHARD_SIZE = 4096
BEAM = 32
AUDITED = 128
LEAST_RECALL = 0.98
QUERIES_AT_ONCE = 256
_SLACK = 1e-4  # single precision finds, double precision decides
_SHARD = "label long, dim int, shard int, ids binary, sizes binary, vectors binary, beam int, recall double"


def _unit(raw: np.ndarray) -> np.ndarray:
    wide = raw.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def audited_beam(graph: Graph, least: float, least_recall: float) -> tuple[int, float]:
    """The narrowest beam that passes the audit, and the recall it reached."""
    vectors = graph.vectors
    sample = np.unique(np.linspace(0, len(vectors) - 1, min(AUDITED, len(vectors))).astype(int))
    exact = vectors[sample] @ vectors.T
    tenth = np.sort(exact, axis=1)[:, -min(10, len(vectors))]
    beam = BEAM
    while True:
        links = sum(len(row) for row, _ in graph.within(vectors[sample], least, beam))
        _, sims = graph.nearest(vectors[sample], min(beam, len(vectors)))
        near = (sims[:, :10] >= tenth[:, None] - 1e-6).mean() if len(vectors) >= 10 else 1.0
        recall = min(links / max(1, int((exact >= least).sum())), near)
        if recall >= least_recall or beam >= len(vectors):
            return beam, float(recall)
        beam *= 2


def _built(least: float, least_recall: float):
    def run(group: pa.Table) -> pa.Table:
        raw = np.array(group.column("vector").to_pylist(), np.float32)
        beam, recall = audited_beam(Graph(_unit(raw)), least - _SLACK, least_recall)
        first = {name: group.column(name).slice(0, 1) for name in ("label", "dim", "shard")}
        return pa.table(
            first
            | {
                "ids": pa.array([group.column("id").to_numpy().tobytes()], pa.binary()),
                "sizes": pa.array([group.column("size").to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array([raw.tobytes()], pa.binary()),
                "beam": pa.array([beam], pa.int32()),
                "recall": pa.array([recall], pa.float64()),
            }
        )

    return run


def linked(left: np.ndarray, right: np.ndarray, graph: Graph, beam: int, least: float, same: bool) -> np.ndarray:
    """Which rows of ``left`` are linked with which of ``right`` (the vectors of the graph), as found and verified."""
    out = np.zeros((len(left), len(right)), bool)
    a, b = left.astype(np.float64), right.astype(np.float64)
    a_norm, b_norm = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    queries = _unit(left)
    for first in range(0, len(left), QUERIES_AT_ONCE):
        for row, found in graph.within(queries[first : first + QUERIES_AT_ONCE], least - _SLACK, beam):
            row = row + first
            for at in range(0, len(row), 1 << 16):
                r, x = row[at : at + (1 << 16)], found[at : at + (1 << 16)]
                out[r, x] = np.einsum("id,id->i", a[r], b[x]) >= least * a_norm[r] * b_norm[x]
    if same:
        out |= out.T
        np.fill_diagonal(out, False)
    return out


def groups_of(found: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """(smallest id, id) of every node that a link joins, over the two sides' ids."""
    out = []
    waiting = found.any(axis=1)
    while waiting.any():
        rows = np.zeros(len(left), bool)
        rows[waiting.argmax()] = True
        columns = np.zeros(len(right), bool)
        edge = rows
        while edge.any():
            new_columns = found[edge].any(axis=0) & ~columns
            columns |= new_columns
            edge = found[:, new_columns].any(axis=1) & ~rows
            if same:
                edge |= new_columns & ~rows
            rows |= edge
        waiting &= ~rows
        members = np.unique(np.concatenate([left[rows], right[columns]]))
        out += [(int(members[0]), int(m)) for m in members[1:]]
    return out


def _searched(least: float):
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[bytes, Graph] | None = None
        for batch in batches:
            for pair in batch.to_pylist():
                dim = pair["dim"]
                a_ids, a_sizes, b_ids, b_sizes = (
                    np.frombuffer(pair[name], np.int64) for name in ("a_ids", "a_sizes", "b_ids", "b_sizes")
                )
                a, b = (np.frombuffer(pair[name], np.float32) for name in ("a_vectors", "b_vectors"))
                a, b, same = a.reshape(-1, dim), b.reshape(-1, dim), pair["a_shard"] == pair["b_shard"]
                name = xxhash.xxh3_128_digest(pair["b_vectors"])
                if kept is None or kept[0] != name:
                    kept = (name, Graph(_unit(b)))
                found = linked(a, b, kept[1], pair["b_beam"], least, same)
                ids, links = a_ids, found @ b_sizes
                if not same:
                    ids, links = np.concatenate([a_ids, b_ids]), np.concatenate([links, found.T @ a_sizes])
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.nulls(len(some), pa.int64())], schema=schema
                )
                edges = np.array(groups_of(found, a_ids, b_ids, same), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(edges[:, 1]), pa.nulls(len(edges), pa.int64()), pa.array(edges[:, 0])], schema=schema
                )

    return run


def near_duplicates(
    table: DataFrame, least: float = 0.98, shard_size: int = SHARD_SIZE, least_recall: float = LEAST_RECALL
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding, label``."""
    vector = F.col("embedding").cast("array<float>")
    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vector.alias("vector")
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")).cast("float"))
    ) & F.exists("vector", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    rows = rows.withColumn("key", F.when(usable, F.sha2(F.to_json("vector"), 256)))
    classes = stored(
        rows.filter("key IS NOT NULL")
        .groupBy("label", "key")
        .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("vector").alias("vector"))
        .withColumn("dim", F.size("vector")),
        "classes",
    )
    counts = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    dealt = classes.join(counts, ["label", "dim"]).withColumn(
        "shard", F.pmod(F.xxhash64("id", "key"), F.ceil(F.col("n") / shard_size)).cast("int")
    )
    shards = stored(
        dealt.select("label", "dim", "shard", "id", "size", "vector")
        .groupBy("label", "dim", "shard")
        .applyInArrow(_built(least, least_recall), _SHARD),
        "shards",
    )
    sides = ("shard", "ids", "sizes", "vectors", "beam")
    a, b = (shards.select("label", "dim", *[F.col(c).alias(f"{side}_{c}") for c in sides]) for side in "ab")
    pairs = a.join(b, ["label", "dim"]).filter("a_shard <= b_shard").repartition("label", "dim", "a_shard", "b_shard")
    found = stored(pairs.mapInArrow(_searched(least), "id long, links long, root long"), "vector_links")
    links = found.filter("links IS NOT NULL").groupBy("id").agg(F.sum("links").alias("links"))
    united = components(found.filter("root IS NOT NULL").select(F.col("root").alias("a"), F.col("id").alias("b")))
    own = (
        classes.select("label", "key", "id", "size")
        .join(links, "id", "left")
        .join(united, "id", "left")
        .select(
            F.col("label").alias("of_label"), F.col("key").alias("of_key"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    same_class = (F.col("label") == F.col("of_label")) & (F.col("key") == F.col("of_key"))
    whole = rows.select("vec_id", "label", "key").join(own, same_class, "left")
    return whole.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
