import hashlib
from collections import defaultdict

import numpy as np

from tradewind.llm import line_dedup

LINE = "this line is long enough"
OTHER = "ÄÖÜ äöü ßßß ééé èèè ñ"  # 21 code points
SPACE = " \t\n\r\x0b\x0c"


def brute(rows, least_docs=3):
    def key(line):
        k = line.strip(SPACE).translate({c: c + 32 for c in range(65, 91)})
        return k if len(k) >= 20 else None

    holders = defaultdict(list)
    for i, text in rows:
        for k in {key(line) for line in (text or "").split("\n")} - {None}:
            holders[k].append(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        order = lambda d: -1 if d is None else d
        stay = [
            x for x in lines
            if (k := key(x)) is None or len(holders[k]) < least_docs or i == max(holders[k], key=order)
        ]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


ROWS = [
    (1, f"{LINE}\nown line of the first one here\n{LINE}"),
    (2, f"  {LINE.upper()}\t\n{OTHER}"),
    (3, f"{LINE}\n{OTHER}\nshort"),
    (4, f"{OTHER} \nshort\n\n"),
    (5, "short\nshort"),
    (6, None),
    (7, ""),
    (8, " " + LINE),  # not ASCII white space: another key
    (None, LINE),
    (9, f"{LINE}\n" * 300 + "end"),
    (9, f"{LINE}\n" * 300 + "end"),
    (10, "only two documents have this\r"),
    (11, "only two documents have this"),
]


def test_report_equals_brute_force(documents, rows):
    got = rows(line_dedup.line_report(documents(ROWS)))
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(ROWS)]
    assert got == sorted(want, key=repr)


def test_rewrite_keeps_columns_and_nulls(documents, rows):
    docs = documents(ROWS)
    out = line_dedup.rewrite(docs)
    assert out.columns == docs.columns
    texts = dict(ROWS)
    want = [(i, t if texts[i] is not None else None) for i, _, _, t in brute(ROWS)]
    assert rows(out, "doc_id", "text") == sorted(want, key=repr)


def test_empty_table(documents):
    assert line_dedup.line_report(documents([])).count() == 0


def test_filters_miss_no_repeat():
    draw = np.random.default_rng(3)
    hashes = draw.integers(0, 1 << 63, 200_000, dtype=np.uint64)
    hashes[100_000:150_000] = hashes[:50_000]
    twice = line_dedup.seen_twice(hashes, np.zeros(len(hashes), bool))
    assert twice.has(hashes[:50_000]).all()
    single = hashes[50_000:100_000]
    assert twice.has(single).mean() < 0.02
