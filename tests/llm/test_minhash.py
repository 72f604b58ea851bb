import numpy as np
import pytest

from tradewind.llm import minhash
from tradewind.llm.links import components

SPACE = " \t\n\r\x0b\x0c"


def words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in SPACE:
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]


def shingles(text, size):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def brute(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            both = len(sets[a] & sets[b])
            if i is not None and j is not None and sets[a] and sets[b]:
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
    return [(i, len(s), None if i is None else find(i), i is not None and find(i) == i) for (i, _), s in zip(rows, sets, strict=True)]


def near_copies(seed, copies, length, edits):
    draw = np.random.default_rng(seed)
    base = [f"w{x}" for x in draw.integers(0, 100_000, length)]
    out = []
    for _ in range(copies):
        own = base.copy()
        for at in draw.integers(0, length, int(draw.integers(0, edits + 1))):
            own[at] = f"e{draw.integers(0, 100_000)}"
        out.append(" ".join(own))
    return out


EDGES = [
    (900, None), (901, ""), (902, "  \n "), (903, "one"), (904, "ONE"), (905, "one two"), (906, "one\ttwo"), (907, "Two one"),
    (None, "one two"), (908, "\xa0one two"), (909, "a b " * 4000), (910, "A B " * 3000), (911, "ÀÉ two three"), (912, "àé two three"),
]


@pytest.mark.parametrize("size", [2, 5])
def test_equals_brute_force(documents, rows, size):
    texts = near_copies(1, 60, 60, 9) + near_copies(2, 25, 200, 20) + near_copies(3, 20, 30, 3)
    table = [(i * 2 % 105, t) for i, t in enumerate(texts)] + [*EDGES]
    got = rows(minhash.near_duplicates(documents(table), shingle=size))
    assert got == sorted(brute(table, size), key=repr)


def test_bands_of_many_blocks(documents, rows, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 5)
    table = list(enumerate(near_copies(5, 70, 60, 9)))
    got = rows(minhash.near_duplicates(documents(table), shingle=2))
    assert got == sorted(brute(table, 2), key=repr)


def test_spanning_joins_all_that_links_reach():
    draw = np.random.default_rng(6)
    a, b = draw.integers(0, 200, (2, 120))
    label = minhash.spanning(200, a, b)
    assert (label[a] == label[b]).all() and (label[label] == label).all()
    assert minhash.spanning(61, np.arange(60), np.arange(1, 61)).max() == 0


def test_copies_and_repeated_rows(documents, rows):
    table = [(i, "the same text in every one of these rows") for i in range(50)] + [(7, "the same text in every one of these rows")]
    got = rows(minhash.near_duplicates(documents(table), shingle=2))
    assert {(c, k) for i, _, c, k in got if i} == {(0, False)} and got[0][2:] == (0, True)


def test_stage_keeps_one_of_each(documents):
    table = [(i, t) for i, t in enumerate(near_copies(4, 30, 300, 4))] + [(100, "alone"), (101, None), (102, ""), (None, "x")]
    docs = documents(table)
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c, k in brute(table, 5) if k} | {None}
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, want))


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([])).count() == 0


def test_bayes_bound_prunes_and_misses_nothing():
    assert minhash.least_equal(32, 0.8, 1e-9) < minhash.least_equal(200, 0.8, 1e-9)
    draw = np.random.default_rng(0)
    a = draw.integers(0, 1 << 32, (20_000, 200), dtype=np.uint32)
    for share, least, most in ((0.8, 1.0, 1.0), (0.3, 0.0, 0.001)):
        same = draw.random(a.shape) < share
        b = np.where(same, a, a + 1)
        assert least <= minhash.survives(a, b, 0.8, 1e-9).mean() <= most


def test_minima_agree_as_often_as_sets_are_similar():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 1 << 63, 1200, dtype=np.uint64)
    both, starts = minhash.joined([np.sort(values[:1000]), np.sort(values[200:])])
    found = minhash.signatures(both, starts, 2000)
    assert abs((found[0] == found[1]).mean() - 800 / 1200) < 0.04


def test_components_of_a_chain_and_a_star(spark, rows):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 201), (201, 200)]
    found = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []
