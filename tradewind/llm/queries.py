"""Registered queries of the corpus operators, and their equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    decontaminate,
    embeddings,
    hard_negatives,
    language_id,
    licenses,
    line_dedup,
    minhash,
    packing,
    quality,
    secrets,
    suffix_dedup,
    token_counts,
    vector_codes,
)
from tradewind.llm.storage import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh vector is labelled as if it were of the next class."""
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


QUERIES: dict[str, Query] = {
    **{name: f for name, f in list(globals().items()) if name.startswith("op")},
    "pipeline": corpus_pipeline.run,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_WHOLE = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)"
_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _assign(k: int) -> str:
    """Every part with the closest entry of the k-th codebooks."""
    return f"""
dist{k} AS (SELECT vec_id, label, c.part, entry, x,
    list_sum(list_transform(list_zip(x, e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM cut c JOIN book{k} b ON b.part = c.part),
near{k} AS (SELECT * FROM dist{k} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)"""


def _round(k: int) -> str:
    """An assignment and the entries after it: componentwise means rounded down, unused entries as they were."""
    return f"""{_assign(k)},
mean{k} AS (SELECT part, entry, list(m ORDER BY pos) AS e FROM
    (SELECT part, entry, pos, floor(sum(c)::DOUBLE / count(*))::BIGINT AS m FROM
        (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS pos FROM near{k}) GROUP BY part, entry, pos)
    GROUP BY part, entry),
book{k + 1} AS (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{k} b
    LEFT JOIN mean{k} m ON m.part = b.part AND m.entry = b.entry)"""


SQL: dict[str, str] = {
    "op7_embedding_near_dedup": """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
linked AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
           WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT a AS id, b AS other FROM linked
          UNION SELECT r.id, l.b FROM reach r JOIN linked l ON r.other = l.a),
lowest AS (SELECT id, min(other) AS other FROM reach GROUP BY id),
counted AS (SELECT a AS id, count(*) AS n_links FROM linked GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id,
       least(vec_id, coalesce(other, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN lowest ON vec_id = lowest.id LEFT JOIN counted ON vec_id = counted.id""",
    "op1_line_dedup": f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM cut),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS key FROM numbered),
repeated AS (SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
             GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, pos, line, last_doc IS NOT NULL AND doc_id <> last_doc AS lost
           FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op6_minhash_near_dedup": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w
                             ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
         FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS an, any_value(b.n) AS bn, count(*) AS n_common
           FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
           AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80 GROUP BY 1, 2),
linked AS (SELECT a, b FROM common WHERE 100 * n_common >= 80 * (an + bn - n_common)),
reach AS (SELECT a AS id, b AS other FROM linked UNION SELECT b, a FROM linked
          UNION SELECT r.id, l.o FROM reach r
          JOIN (SELECT a AS i, b AS o FROM linked UNION ALL SELECT b, a FROM linked) l ON r.other = l.i),
lowest AS (SELECT id, min(other) AS other FROM reach GROUP BY id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
       least(doc_id, coalesce(other, doc_id)) = doc_id AS kept
FROM sets LEFT JOIN lowest ON doc_id = id""",
    "op13_hard_negatives": f"""
WITH usable AS (SELECT vec_id, {_WHOLE} AS v,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM embeddings
    WHERE label IS NOT NULL AND {_USABLE}),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2]))::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5""",
    "op11_vector_codes": f"""
WITH kept AS (SELECT vec_id, label, {_WHOLE} AS v FROM embeddings WHERE {_USABLE}),
cut AS (SELECT vec_id, label, part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS x
    FROM kept, (SELECT unnest(range(16)) AS part)),
book0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS e FROM cut
    QUALIFY entry < 64),
{_round(0)}, {_round(1)}, {_assign(2)},
wrong AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM near2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(list_aggregate(e, 'string_agg', ','), ',' ORDER BY part, entry)) FROM book2)
        AS codebooks_sha256
FROM wrong""",
    "op12_suffix_dedup": """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t, strlen(coalesce(text, '')) AS n FROM documents),
starts AS (SELECT doc_id, unnest(range(n - 49)) AS pos, t FROM bytes),
strings AS (SELECT doc_id, pos, substr(t, 2 * pos + 1, 100) AS s FROM starts),
lowest AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM strings JOIN lowest USING (s) WHERE first < doc_id),
runs AS (SELECT doc_id, count(*) AS n FROM gone g ANTI JOIN gone b ON b.doc_id = g.doc_id AND b.pos = g.pos - 1 GROUP BY ALL),
each AS (SELECT doc_id, t, unnest(range(n)) AS pos FROM bytes),
kept AS (SELECT e.doc_id, string_agg(substr(t, 2 * e.pos + 1, 2), '' ORDER BY e.pos) AS t FROM each e
    ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos GROUP BY e.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT b.doc_id, b.n AS n_bytes, coalesce(lost.n, 0) AS n_removed, coalesce(runs.n, 0) AS n_spans,
    sha256(unhex(coalesce(k.t, ''))) AS kept_sha256
FROM bytes b LEFT JOIN kept k USING (doc_id) LEFT JOIN lost USING (doc_id) LEFT JOIN runs USING (doc_id)""",
}
