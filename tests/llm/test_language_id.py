from collections import Counter, defaultdict
from zlib import crc32

import pytest

from tradewind.llm import language_id

SF_DIR = "/root/testdata/sf0.001"


def grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    padded = " " + " ".join(words) + " "
    if words:
        for n in (1, 2, 3):
            out.update(g for g in (padded[i : i + n] for i in range(len(padded) - n + 1)) if g != " ")
    return out


def number(gram):
    value = 0
    for c in gram:
        value = (value << 21) + ord(c)
    return value


def ranked(counts, most):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], number(x[0])))][:most]


def brute(rows, ranks):
    learnt = defaultdict(Counter)
    for i, text, lang in rows:
        if i is not None and lang is not None and crc32(str(i).encode()) % 4 != 2:
            learnt[lang] += grams(text or "")
    places = {lang: {g: p for p, g in enumerate(ranked(c, ranks))} for lang, c in learnt.items() if c}
    out = []
    for i, text, _ in rows:
        own = ranked(grams(text or ""), ranks)
        held = i is not None and crc32(str(i).encode()) % 4 == 2
        if not own or not places:
            out.append((i, held, "und", 0.0))
            continue
        far = {
            lang: sum(abs(listed[g] - p) if g in listed else ranks for p, g in enumerate(own)) for lang, listed in places.items()
        }
        best = min(sorted(far), key=far.get)
        out.append((i, held, best, 1 - far[best] / (ranks * len(own))))
    return out


ROWS = [
    (1, "The quick brown fox and the lazy dog.", "en"), (3, "Der schnelle Fuchs und der faule Hund!", "de"),
    (4, "the   THE, tHe", None), (5, "", "en"), (6, None, "de"), (7, "1234 --- !!", "en"), (8, "日本語 ß Ω", "xx"),
    (9, "the dog\n" * 3000, "en"), (None, "und der Hund", "de"), (1, "The quick brown fox and the lazy dog.", "en"),
]


@pytest.mark.parametrize("ranks", [5, 400])
def test_equals_brute_force(documents, rows, ranks):
    docs = documents([(i, t) for i, t, _ in ROWS], lang=[x for _, _, x in ROWS])
    got = rows(language_id.identify_documents(docs, ranks))
    assert got == sorted(brute(ROWS, ranks), key=repr)


def test_sample_documents_equal_brute_force(spark, rows):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], language_id.RANKS)
    assert rows(language_id.identify_documents(docs)) == sorted(want, key=repr)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify_documents(docs).filter("held_out").join(docs, "doc_id")
    right, all_rows = found.filter("lang = lang_pred").count(), found.count()
    assert all_rows > 200 and right / all_rows > 0.97


def test_stage_drops_what_has_no_language(documents, rows):
    docs = documents([(i, t) for i, t, _ in ROWS], lang=[x for _, _, x in ROWS])
    kept = language_id.known_languages(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 8, 9, None}


def test_empty_table(documents):
    assert language_id.identify_documents(documents([])).count() == 0
    assert language_id.identify_documents(documents([(2, "abc")])).first().lang_pred == "und"
