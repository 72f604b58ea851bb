import numpy as np
import pytest

from tradewind.llm import decontaminate

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
WORDS = ITEM.split()


def slow_align(item, text):
    best, h = 0, [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a == b else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_the_table():
    draw = np.random.default_rng(7)
    for _ in range(30):
        item = draw.integers(1, 6, draw.integers(1, 15)).astype(np.uint64)
        texts = [draw.integers(1, 6, n).astype(np.uint64) for n in draw.integers(1, 25, 4)]
        score, begin, end = decontaminate.align(item, texts)
        for i, text in enumerate(texts):
            assert score[i] == slow_align(item.tolist(), text.tolist())
            assert slow_align(item.tolist(), text[begin[i] : end[i]].tolist()) == score[i]


def test_finds_copies_and_edits_and_leaves_the_rest(documents, spark, rows):
    filler = " ".join(f"word{i}" for i in range(400))
    edited = WORDS.copy()
    edited[6], edited[13] = "changed", "other"
    docs = documents(
        [
            (1, f"{filler} {ITEM} {filler}"), (2, f"{filler}\n{ITEM.upper().replace(' ', ', ')}!"),
            (3, f"{filler} {' '.join(edited)} {filler}"), (4, " ".join(WORDS[:8] + ["inserted", "words"] + WORDS[8:])),
            (5, filler), (6, f"{filler} {' '.join(WORDS[:5])} {filler}"), (7, None), (8, ""), (None, ITEM), (1, f"x {ITEM}"),
            (9, f"{ITEM} {filler} {ITEM}"), (10, " ".join(reversed(WORDS))),
        ]
    )
    items = spark.createDataFrame(
        [(100, ITEM), (101, None), (102, ""), (103, "two words"), (None, "some other text that no document of these has")],
        "item_id long, text string",
    )
    found = decontaminate.contaminations(docs, items)
    assert rows(found, "doc_id", "item_id") == sorted([(i, 100) for i in (1, 1, 2, 3, 4, 9, None)], key=repr)
    one = found.filter("doc_id = 2").first()
    assert (one.first_word, one.end_word, one.share) == (400, 420, 1.0)
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {5, 6, 7, 8, 10, None}


def test_common_item_is_still_found(documents, spark):
    docs = documents([(i, f"own{i} text{i} here{i} {ITEM}") for i in range(300)])
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.contaminations(docs, items, block_words=5).count() == 300


@pytest.mark.parametrize("block_words", [30, 2_000_000])
def test_sample_items_equal_plain_search(spark, block_words):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    docs, items = read("documents"), read("benchmark")
    if block_words == 30:
        items = items.limit(3)
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminations(docs, items, block_words=block_words).collect()}
    texts = docs.select("doc_id", "text").collect()
    exact = {(d.doc_id, i.item_id) for i in items.collect() for d in texts if i.text in d.text}
    assert exact <= found


def edited_copies(item, draw):
    """Copies with a word changed, put in or left out (or several put in) in every 4 to 6 words."""
    for every in (4, 5, 6):
        for kind in ("change", "insert", "leave out", "insert three", "any"):
            for offset in (1, every - 1):
                out = []
                for i, word in enumerate(item):
                    edit = kind if kind != "any" else draw.choice(["change", "insert", "leave out"])
                    if i % every != offset:
                        out.append(word)
                    elif edit != "leave out":
                        out += [f"new{draw.integers(10**9)}" for _ in range(3 if edit == "insert three" else 1)]
                        out += [word] if edit != "change" else []
                yield out


@pytest.mark.parametrize("intact", [False, True])
def test_densely_edited_copies_equal_plain_alignment(documents, spark, intact):
    draw = np.random.default_rng(11)
    items = {n: [f"item{n}word{i}" for i in range(n)] for n in (17, 25, 40)}
    # Other documents that hold the items must not hide the edited copies.
    texts = [item for item in items.values() for _ in range(2)] if intact else []
    texts += [copy for item in items.values() for copy in edited_copies(item, draw)]
    filler = [f"word{i}" for i in range(60)]
    docs = documents([(i, " ".join([*filler[: i % 50], *text, *filler])) for i, text in enumerate(texts)])
    table = spark.createDataFrame([(n, " ".join(item)) for n, item in items.items()], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminations(docs, table).collect()}
    want = {}
    for i, text in enumerate(texts):
        for n, item in items.items():
            score = slow_align(item, text)
            if score >= 0.5 * 2 * n:
                want[i, n] = score
    assert found == want and len(want) > 60


def test_common_phrases_bring_no_findings(documents, spark):
    docs = documents([(i, " ".join([*WORDS[8:11], *[f"own{i}word{k}" for k in range(30)]] * 20)) for i in range(40)])
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.contaminations(docs, items).count() == 0


def test_empty_tables(documents, spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.contaminations(documents([]), items).count() == 0
    assert decontaminate.contaminations(documents([(1, ITEM)]), items.limit(0)).count() == 0
