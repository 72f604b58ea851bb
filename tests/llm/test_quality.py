import itertools

import numpy as np

from tradewind.llm import quality

SF = "/root/testdata/sf0.1"


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(2)
    chain = quality.Chain(np.zeros(2), np.ones(2), draw.normal(size=2), draw.normal(size=(2, 2)))
    starts = np.array([0, 1, 5, 8])
    x = draw.normal(size=(8, 2))
    good, expected = chain.marginals(x, starts)
    moves = np.zeros((2, 2))
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        total, ones = 0.0, np.zeros(b - a)
        pairs = np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=int(b - a)):
            s = sum(x[a + k] @ chain.weights for k in range(b - a) if states[k])
            s += sum(chain.moves[p, q] for p, q in itertools.pairwise(states))
            total += np.exp(s)
            ones += np.exp(s) * np.array(states)
            for p, q in itertools.pairwise(states):
                pairs[p, q] += np.exp(s)
        np.testing.assert_allclose(good[a:b], ones / total)
        moves += pairs / total
    np.testing.assert_allclose(expected, moves)


def test_features_of_lines_do_not_mix_texts():
    texts = [b"", b"One two two\n\nTHREE!!", "é".encode(), b"\n"]
    own, starts = quality.line_features(texts)
    assert starts.tolist() == [0, 1, 4, 5, 7]
    for i, text in enumerate(texts):
        alone, _ = quality.line_features([text])
        np.testing.assert_array_equal(own[starts[i] : starts[i + 1]], alone)
    assert own[1, 9] == np.float32(1 / 3) and own[3, 3] > 0.5 and not own[0, 1:8].any()


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    labels_seen = labels.join(docs.select("doc_id"), "doc_id", "left_semi")
    found = quality.score_documents(docs, labels).join(labels_seen, "doc_id").filter("held_out")
    cells = {(r.quality, r.predicted): r["count"] for r in found.groupBy("quality", "predicted").count().collect()}
    good, bad = (sum(n for (q, _), n in cells.items() if q == k) for k in (1, 0))
    assert cells[1, 1] / good > 0.97 and cells[0, 0] / bad > 0.95


def test_edges(documents, spark):
    good = "A plain sentence with words of every kind in it.\n" * 3
    table = [(i, good if i % 3 else "SPAM!! ### SPAM!! ###\n" * 5) for i in range(200)]
    table += [(500, None), (501, ""), (502, "x" * 100_000), (503, "\n" * 5000), (None, good), (1, good)]
    docs = documents(table)
    labels = spark.createDataFrame(
        [(i, int(bool(i % 3))) for i in range(200)] + [(None, 1), (1, None), (900, 0), (1, 1)], "doc_id long, quality int"
    )
    found = quality.score_documents(docs, labels).collect()
    assert len(found) == len(table) and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == int(r.score >= 0.7) == int(bool(r.doc_id % 3)) for r in found if r.doc_id is not None and r.doc_id < 200)
    assert quality.score_documents(documents([]), labels).count() == 0
    assert {r.score for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    one_kind = quality.score_documents(docs, labels.filter("quality = 1"))
    assert {r.score for r in one_kind.collect()} == {1.0}


def test_long_documents_do_not_end_the_sample(documents, spark):
    table = [(i, "A plain sentence with words.\n" * 300 if i % 2 else "### SPAM!! ###\n" * 5) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality.learn(documents(table), labels, most_lines=250)
    assert isinstance(model, quality.Chain)
    good, bad = model.document_scores([table[1][1].encode(), table[0][1].encode()])
    assert good > 0.7 > 0.3 > bad


def test_share_of_lines():
    draw = np.random.default_rng(5)
    for most in (10, 100, 1000):
        lengths = draw.integers(1, 60, 10)
        share = quality.line_share(lengths, most)
        assert np.minimum(lengths, share).sum() <= most
        assert share >= lengths.max() or np.minimum(lengths, share + 1).sum() > most
