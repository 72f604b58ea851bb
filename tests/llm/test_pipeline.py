import zlib

import corpus_pipeline
import numpy as np
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_minhash import brute as brute_near
from tradewind.llm import queries
from tradewind.llm.storage import table
from tradewind.llm.token_counts import tokenizer

SF_DIR = "/root/testdata/sf0.001"


def test_run_equals_brute_force_stages(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
    lines = [(i, t) for i, _, _, t in brute_lines([d for d in docs if any(map(str.isalpha, d[1]))])]
    kept = {i for i, _, _, k in brute_near(lines, 5) if k}
    clean = {i: t for i, t in lines if i in kept and not any(x in t for x in items)}
    path = queries.public_tokenizers.path("word_bpe_49k.json")
    want = set()
    for i, t in clean.items():
        ids = np.array([*tokenizer(path).encode(t, add_special_tokens=False).ids, 1], "<u4")
        for k in range(-(-len(ids) // 4096)):
            part = ids[k * 4096 : (k + 1) * 4096]
            want.add((i, k, k * 4096, len(part), zlib.crc32(part.tobytes())))
    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_stages_keep_the_columns_and_edge_rows(spark, documents):
    docs = documents([(1, "A text that stays."), (2, None), (3, ""), (None, "Another text that stays."), (1, "A text that stays.")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_all_queries_are_registered():
    from __spark_entry__ import queries as registered

    names = set(registered())
    assert {name for name in queries.QUERIES} <= names
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")} == set(range(1, 14))
