import hashlib
import re

from tradewind.llm import secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
KINDS = ["assign", "access", "hex", "live"]


def base(text):
    text = text or ""
    out = [(m.start(), "assign", m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), "access", m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [(m.start(), "hex", m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]))))


def brute(rows):
    owners = {}
    for _, text, source in rows:
        for s in base(text):
            owners.setdefault(s[3], set()).add(source)
    out = []
    for i, text, _ in rows:
        own = base(text)
        spans = {(a, k, b) for a, k, b, _ in own}
        live = {(b - len(v), "live", b) for _, _, b, v in own if len(owners[v]) == 1 and len(set(v)) > 1}
        counts = [sum(k == kind for _, k, _, _ in own) for kind in KINDS[:3]]
        out.append((i, *counts, hashlib.sha256(joined(spans).encode()).hexdigest(), joined(spans | live)))
    return out


KEY = "AKIA" + "Q7" * 8
HEX = "0123456789abcdef" * 2
ROWS = [
    (1, f'PassWord = "{HEX}"', "a"), (2, f"api_key:{KEY} and {KEY}", "a"), (3, f"api_key:{KEY}", "b"), (4, f"x {KEY} y", "c"),
    (5, "password=token: abcdefgh secret=short", "a"), (6, "token=secret=abcdefg", None), (7, None, "a"), (8, "", "a"),
    (9, f"é🙂 {HEX}{HEX}g{HEX} secret= é", "b"), (10, "secret=xxxxxxxxxx token='yyyyyy'", "b"), (None, f"{HEX}0", "z"),
    (11, "AKIAAKIA" + "A" * 11 + "b AKIA" + "B" * 16, "d"), (12, ("token=abcdef%d " % 7) * 2000, "d"), (1, f'PassWord = "{HEX}"', "a"),
    (13, "tokenſ=abcdefgh api_Key = abcdefgh passwd\t=abcdefgh", "a"), (14, "0" * 23 + "g" + "0" * 24, "a"),
]


def test_equals_brute_force(documents, rows):
    docs = documents([(i, t) for i, t, _ in ROWS], source=[s for _, _, s in ROWS])
    got = rows(secrets.scan(docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert got == sorted(brute(ROWS), key=repr)


def test_widely_held_values_are_examples(documents):
    docs = documents([(i, t) for i, t, _ in ROWS], source=[s for _, _, s in ROWS])
    found = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert (found[3].n_live, found[3].n_example, found[3].owners, found[3].repositories) == (0, 2, [3, 3], [3, 3])
    assert (found[10].n_live, found[10].n_example) == (0, 2)


def test_sample_documents_equal_brute_force(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text, r.source) for r in docs.collect()])
    got = rows(secrets.scan(docs), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    assert got == sorted(want, key=repr)


def test_plan_is_native(documents):
    plan = secrets.scan(documents([]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(documents):
    assert secrets.scan(documents([])).count() == 0
