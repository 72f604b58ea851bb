import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradewind.llm import packing, token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    "Hello world, it's   fine.\n\n  Don't you  think?", "", None, " ", "\n \n x", "a<|endoftext|>  b", "  <|endoftext|>\n\n",
    "  nbsp em　wide\x85next line", "é é ẞß İı Σς ﬁ ǅ", "日本語 テスト 한국어", "x" * 5000, "word " * 3000,
    "tab\tand\r\nlines\x0b\x0c\x1c\x1d", "...,,;;!? (a).b,c. d.", "I'LL we'Ll you'd 'S", "<|startoftext|><|ENDOFTEXT|> <| x",
    "a.́b ,̧ z.", "🙂🙂 👩‍👩‍👧 x.", "1,234.5 ½ ²", "word " * 3000,
]


def ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(documents):
    return documents([*enumerate(TEXTS), (None, "no id"), (3, " ")])


def test_counts_equal_the_library(docs, rows):
    texts = [*enumerate(TEXTS), (None, "no id"), (3, " ")]
    want = [(i, len((t or "").encode()), len(x := ids(BYTES, t)), len(x) > 1024) for i, t in texts]
    assert rows(token_counts.count_tokens(docs, BYTES)) == sorted(want, key=repr)


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet=st.sampled_from(list("aZé.,'! \n\t  \x1c1²日́<|>")), max_size=40))
def test_units_and_words_put_together_give_the_text(text):
    added = token_counts.added_tokens(BYTES)
    parts = token_counts.units(text, added)
    assert "".join(parts) == text
    one = token_counts.tokenizer(BYTES)
    whole = one.encode(text, add_special_tokens=False).ids
    assert [i for p in parts for i in one.encode(p, add_special_tokens=False).ids] == whole
    found, _ = packing.WordIds(WORDS, 1).of([text.encode()])
    assert found.tolist() == [*token_counts.tokenizer(WORDS).encode(text, add_special_tokens=False).ids, 1]


def test_empty_tables(documents):
    assert token_counts.count_tokens(documents([]), BYTES).count() == 0
    assert packing.pack(documents([]), WORDS).count() == 0


@pytest.mark.parametrize(("most", "group"), [(4096, 1 << 15), (64, 10)])
def test_packing_is_whole_and_gapless(docs, most, group):
    placed = packing.pack(docs, WORDS, most=most, group_pieces=group).collect()
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for r in placed:
        of_doc[r.doc_id].append(r)
        of_sequence[r.sequence_id].append((r.offset, r.length))
    for i, text in [*enumerate(TEXTS), (None, "no id")]:
        all_ids = np.array([*ids(WORDS, text), 1], "<u4")
        copies = 2 if i == 3 else 1
        want = sorted(
            (k, k * most, len(x := all_ids[k * most : (k + 1) * most]), zlib.crc32(x.tobytes()))
            for k in range(-(-len(all_ids) // most))
        )
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in of_doc[i]) == sorted(want * copies)
    for places in of_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= most


def test_best_fit_takes_the_tightest_bin():
    def slow(lengths, most):
        rooms, out = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fit = [r for r in rooms if r >= lengths[i]]
            room = min(fit) if fit else most
            if fit:
                rooms.remove(room)
            rooms.append(room - lengths[i])
            out[i] = most - room
        return len(rooms), out

    draw = np.random.default_rng(5)
    for most in (10, 64, 100):
        lengths = draw.integers(1, most + 1, 300)
        bins, offsets = packing.best_fit(lengths, most)
        n, places = slow(lengths.tolist(), most)
        assert len(set(bins.tolist())) == n
        assert sorted(offsets.tolist()) == sorted(places.values())


def test_few_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    placed = packing.pack(docs, WORDS).collect()
    total = sum(r.length for r in placed)
    assert len({r.sequence_id for r in placed}) <= -(-total // 4096) * 1.01 + 1
