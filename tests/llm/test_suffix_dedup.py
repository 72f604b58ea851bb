"""Removed passages against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tradewind.llm import suffix_dedup as sd
from tradewind.llm.suffix_levels import Levels, fixed

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(rows, length=50):
    texts = [(i, (t or "").encode()) for i, t in rows]
    lowest = {}
    for i, t in texts:
        for at in range(len(t) - length + 1 if i is not None else 0):
            s = t[at : at + length]
            lowest[s] = min(lowest.get(s, i), i)
    out = []
    for i, t in texts:
        gone = [False] * (len(t) + 1)
        for at in range(len(t) - length + 1 if i is not None else 0):
            if lowest[t[at : at + length]] < i:
                gone[at : at + length] = [True] * length
        spans = sum(b and not a for a, b in zip([False, *gone], gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 8))) for _ in range(n))


@pytest.fixture
def small(monkeypatch):
    """Slices, parts and pieces so small that a few documents fill many; nested functions carry them to the tasks."""
    for name, value in {"SLICE_BYTES": 4000, "_BYTES_A_PART": 8000, "_BYTES_A_STRING_PART": 8000}.items():
        monkeypatch.setattr(sd, name, value)


def passages(seed, n):
    """Documents with shared passages around the length that counts, copies, and copies with edits."""
    rng = random.Random(seed)
    shared = [words(rng, 60)[:size] for size in (30, 49, 50, 51, 70, 120, 300) for _ in range(2)]
    out = []
    for i in range(n):
        parts = [words(rng, rng.randrange(0, 30))]
        parts += [rng.choice(shared) + words(rng, rng.randrange(0, 12)) for _ in range(rng.randrange(0, 4))]
        if out and rng.random() < 0.3:
            copy = list(rng.choice(out)[1] or "")
            if copy and rng.random() < 0.6:
                copy[rng.randrange(len(copy))] = "X"
            parts = ["".join(copy)]
        out.append((i * 7 % n - 5, "".join(parts)))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_dictionary(spark, documents, rows, small, seed):
    data = passages(seed, 120)
    assert rows(sd.removal_report(documents(data)), *COLUMNS) == brute(data)


def test_odd_texts(spark, documents, rows):
    line = "a line of some length that many documents hold, with é and 語 in it"
    data = [
        (1, None), (2, ""), (3, "short"), (4, line), (4, line), (5, line), (None, line), (6, line * 4), (7, "\0" * 200),
        (8, "\0" * 130), (9, "ab" * 300), (10, "ab" * 100), (-1, line[:50]), (11, "x" * 49), (12, "x" * 49),
    ]
    assert rows(sd.removal_report(documents(data)), *COLUMNS) == brute(data)


def test_one_passage_with_other_text_around_it_everywhere(spark, documents, rows, small):
    """Its seeds have more stretches than a slice lists, so the strings travel one by one."""
    rng = random.Random(9)
    passage = words(rng, 20)
    data = [(i, words(rng, 9) + passage + words(rng, 9)) for i in range(150)]
    own = sd.Slice(next(_slices(data)))
    assert own.crowd.any()
    assert rows(sd.removal_report(documents(data)), *COLUMNS) == brute(data)


def test_a_text_over_many_pieces(spark, documents, rows):
    rng = random.Random(10)
    long = words(rng, 150_000)
    data = [(1, long), (2, words(rng, 40) + long[100_000:700_000] + words(rng, 40)), (3, long[5:])]
    assert len(long) > 2 * sd._PIECE
    assert rows(sd.removal_report(documents(data)), *COLUMNS) == brute(data)


def test_spans_and_kept_bytes(spark, documents):
    text = "".join(chr(97 + i * i % 23) for i in range(90))
    row = sd.removed(documents([(1, text), (2, "before" + text + "after")])).filter("doc_id = 2").first()
    assert [tuple(s) for s in row.spans] == [(6, 96)] and bytes(row.kept) == b"beforeafter"


def test_empty_table(spark, documents):
    assert sd.removal_report(documents([])).count() == 0


def _slices(data):
    import zstandard

    raw = [t.encode() for _, t in data]
    yield {
        "ids": np.array([i for i, _ in data], np.int64).tobytes(),
        "lengths": np.array([len(t) for t in raw], np.int64).tobytes(),
        "text": zstandard.ZstdCompressor().compress(b"".join(raw)),
    }


def test_every_string_is_in_one_stretch():
    rng = random.Random(11)
    data = [(i, words(rng, rng.randrange(0, 200))) for i in range(20)] + [(99, "aaaa" * 50)]
    own = sd.Slice(next(_slices(data)))
    seen = np.zeros(len(own.text), int)
    for start, count in zip(own.start, own.count):
        seen[start : start + count] += 1
    ends = np.cumsum(own.lengths)
    wanted = np.concatenate([np.arange(n) <= n - sd.LENGTH for n in own.lengths]).astype(int)
    assert (seen == wanted).all() and ends[-1] == len(seen)


def test_levels_grow_geometrically():
    rng = np.random.default_rng(12)
    levels, put = Levels(batch=64), []
    for _ in range(60):
        keys, docs = fixed(rng.integers(0, 2, (rng.integers(0, 50), 9))), None
        docs = rng.integers(0, 1000, len(keys))
        levels.put(keys, docs)
        put.append((keys, docs))
        sizes = [len(k) for k, _ in levels.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))
        for keys, _ in levels.levels:
            assert (keys[1:] > keys[:-1]).all()
    lowest = {}
    for keys, docs in put:
        for key, doc in zip(keys.tolist(), docs.tolist()):
            lowest[key] = min(lowest.get(key, doc), doc)
    assert levels.lowest().tolist() == [lowest[k] for keys, _ in put for k in keys.tolist()]


def test_numbers_travel_whole():
    for docs in ([], [5], [-(1 << 63), (1 << 63) - 1], [7, 7 + (1 << 20)], [3, 9]):
        assert sd._undocs(sd._docs(np.array(docs, np.int64)), len(docs)).tolist() == docs
    for seeds in ([], [9], [1, 1, 5], [0, 1 << 43], [4, 4 + (1 << 31)]):
        assert sd._undeltas(sd._deltas(np.array(seeds, np.uint64)), len(seeds)).tolist() == seeds


def _said(data):
    """Each slice of two documents with what the only part of the seed space says about its distinct stretches."""
    slices = [{**next(_slices(data[i : i + 2])), "slice": i} for i in range(0, len(data), 2)]
    listed = [sd._listed(1)(pa.Table.from_pylist([s], sd._arrow(sd._SLICE))) for s in slices]
    answers = sd._answered(pa.concat_tables(listed)).to_pylist()
    return [(sd.Slice(s), [a for a in answers if a["slice"] == s["slice"]]) for s in slices]


@pytest.mark.parametrize("common", [20, 33, 49, 50, 51, 64])
def test_stretches_that_share_a_seed_only_are_alone(common):
    """what has less than a string in common with others around a shared seed is hardly ever spelt out; what has
    a string in common always is, or is held."""
    rng = random.Random(common)
    noise = lambda n: "".join(chr(rng.randrange(33, 127)) for _ in range(n))
    phrases = [noise(common) for _ in range(30)]
    data = [(i, "".join(noise(rng.randrange(40, 60)) + p for p in phrases) + noise(60)) for i in range(6)]
    strings = {}
    for i, text in data:
        for at in range(len(text) - sd.LENGTH + 1):
            strings.setdefault(text[at : at + sd.LENGTH], set()).add(i)
    status = [(own, own.status(answers)) for own, answers in _said(data)]
    spelt = sum(len(own.shared(said)) for own, said in status)
    if common == 20:
        assert spelt == 0
        names = np.concatenate([own.seeds[own.first] for own, _ in status])
        assert len(np.unique(names)) < len(names)
    for own, said in status:
        for group, start, count in zip(own.group, own.start, own.count):
            text = bytes(own.text[start : start + count + sd.LENGTH - 1]).decode()
            others = any(len(strings[text[at : at + sd.LENGTH]]) > 1 for at in range(count))
            assert not others or said[group] in (sd.SHARED, sd.HELD, sd.CROWDS) or common >= 50 and all(
                len(strings[text[at : at + sd.LENGTH]]) > 1 for at in range(count)
            )


@pytest.mark.parametrize("seed", range(2))
def test_common_text_around_the_length_with_other_text_beside_it(spark, documents, rows, small, seed):
    """common text that reaches over one side of its seed only, over both, or not far enough."""
    rng = random.Random(20 + seed)
    phrases = [words(rng, 40)[: rng.randrange(30, 75)] for _ in range(25)]
    data = [(i, "".join(words(rng, rng.randrange(5, 15)) + rng.choice(phrases) for _ in range(6))) for i in range(60)]
    assert rows(sd.removal_report(documents(data)), *COLUMNS) == brute(data)
