import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from benelake.llm import packed, text

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab Zé\n\t.1日", max_size=40)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([7, 1 << 20]))
def test_words_are_those_of_the_pattern(rows, segment):
    old, text.SEGMENT = text.SEGMENT, segment
    try:
        data, offsets = text.utf8(pa.array(rows, pa.string()))
        for table, pattern, fold in ((text.SPACED, r"[^\x20\x09-\x0D]+", None), (text.ALNUM, "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.LOWER)):
            words = text.Words(data, offsets, table, fold)
            seen = {}
            for i, row in enumerate(rows):
                plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" and fold is not None else c for c in row or "")
                own = range(words.rows[i], words.rows[i + 1])
                got = [data[words.starts[k] : words.ends[k]].tobytes().decode() for k in own]
                assert [g.translate({ord("Z"): "z"}) if fold is not None else g for g in got] == re.findall(pattern, plain)
                for k, w in zip(own, re.findall(pattern, plain), strict=True):
                    assert seen.setdefault(w, words.hashes[k]) == words.hashes[k]
            assert len(set(map(int, seen.values()))) == len(seen)
    finally:
        text.SEGMENT = old


def test_word_runs_hash_alike_wherever_they_stand():
    data, offsets = text.utf8(pa.array(["x a b c", "a b c d", "a b"]))
    words = text.Words(data, offsets, text.SPACED)
    codes, first = text.ngrams(words, 3)
    assert first.tolist() == [0, 1, 4, 5]
    assert codes[1] == codes[2] and len(set(codes.tolist())) == 3


def test_a_row_longer_than_a_block_comes_alone():
    assert list(text.row_blocks(np.array([0, 5, 30, 31, 32]), 10)) == [(0, 1), (1, 2), (2, 4)]


@pytest.mark.parametrize("values", [[], [0], [5, 5, 7, 2**40]])
def test_packed_arrays_come_back(values):
    a = np.array(values, np.uint64)
    assert packed.unpack(packed.pack(a, True)).tolist() == values
    assert packed.unpack(packed.pack(a[::-1])).tolist() == values[::-1]
