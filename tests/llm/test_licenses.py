import re
from collections import Counter

import pytest

from tradewind.llm import licenses
from tradewind.llm.license_texts import TEMPLATES


def words(text):
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", lower)


def contained(template, text):
    """Largest share of the template's shingles in any stretch of one and a half times its length."""
    t, w = words(template), words(text)
    own = {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    reach = len(t) - 4 + (len(t) - 4) // 2
    return max((len(own & set(grams[i : i + reach])) / len(own) for i in range(len(grams))), default=0)


FILLER = " ".join(f"word{i}" for i in range(300))


@pytest.mark.parametrize("name", ["MIT", "Apache-2.0", "GPL", "MIT short", "CC-BY-NC-4.0 short"])
def test_finds_whole_and_edited_texts(documents, name):
    text = TEMPLATES[name]
    cut = text.split()
    edited = " ".join(cut[: len(cut) // 2] + ["edited"] + cut[len(cut) // 2 + 1 :])
    far = " ".join(w if i % 4 else f"other{i}" for i, w in enumerate(cut))
    table = [(1, text), (2, f"{FILLER}\n{text.upper()}\n{FILLER}"), (3, f"é {FILLER} {edited}"), (4, f"{FILLER} {far}"), (5, FILLER)]
    found = licenses.scan(documents(table)).filter(f"license = '{name}'").collect()
    want = {i for i, t in table if contained(text, t) >= 0.8}
    assert {r.doc_id for r in found} == want >= {1, 2}
    for r in found:
        body = dict(table)[r.doc_id]
        assert r.share == pytest.approx(contained(text, body))
        assert words(body[r.start : r.end]) == words(body)[r.first_word : r.end_word]


def test_sample_documents_equal_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    found = {(r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(docs)).collect()}
    want = {(d.doc_id, name) for d in docs if re.search("licen", d.text, re.I) for name, t in TEMPLATES.items() if contained(t, d.text) >= 0.8}
    assert found == want and want


def test_cut_texts_as_whole_documents(documents):
    own = {f"of {n}": " ".join(f"t{n}w{i}" for i in range(n + 4)) for n in (1, 3, 4, 7, 8, 9, 15, 16, 17, 18, 31)}
    templates = {**TEMPLATES, **own}
    table = []
    for name, text in templates.items():
        cut = text.split()
        for lost in range(min(8, len(cut))):
            for short in (cut[: len(cut) - lost], cut[lost:], cut[lost // 2 : len(cut) - (lost + 1) // 2]):
                table += [(len(table), " ".join(short)), (len(table) + 1, f"so {' '.join(short)} too")]
    found = {(r.doc_id, r.license): r.share for r in licenses.scan(documents(table), templates).collect()}
    want = {}
    for i, text in table:
        for name, template in templates.items():
            share = contained(template, text)
            if share >= 0.8:
                want[i, name] = pytest.approx(share)
    assert found == want
    names = {name for i, name in want if len(words(dict(table)[i])) < len(words(templates[name]))}
    assert {"BSD short", "GPL-2.0 short", "GPL-3.0 short", "of 8", "of 16", "of 17", "of 18"} <= names


def test_repeats_nulls_and_own_templates(documents):
    text = TEMPLATES["MIT short"]
    docs = documents([(1, f"{text} {FILLER} {text}"), (None, text), (2, None), (3, ""), (4, "!!"), (1, f"{text} {FILLER} {text}")])
    assert Counter(r.doc_id for r in licenses.scan(docs).collect()) == {1: 4, None: 1}
    own = {"short": "do what", "none": "", "seven": "one two three four five six seven"}
    docs = documents([(1, "Do what you want, do WHAT!"), (2, "one two three four five six seven")])
    found = [(r.doc_id, r.license) for r in licenses.scan(docs, own).collect()]
    assert sorted(found) == [(1, "short"), (1, "short"), (2, "seven")]


def test_empty_table(documents):
    assert licenses.scan(documents([])).count() == 0
