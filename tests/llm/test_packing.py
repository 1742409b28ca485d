import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from benelake.llm.packing import pack_documents, pack_histogram
from benelake.llm.queries import tokenizer_path

FILE = "byte_bpe_50k.json"


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=40))
def test_plan_uses_exactly_the_histogram(counts):
    histogram = np.zeros(65, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    used = np.zeros(65, np.int64)
    sequences = 0
    for pattern, n in pack_histogram(histogram, 64):
        assert n > 0 and 0 < sum(pattern) <= 64
        sequences += n
        np.add.at(used, list(pattern), n)
    assert (used == histogram).all()
    total = int((histogram * np.arange(65)).sum())
    assert -(-total // 64) <= sequences <= max(1, histogram.sum())


def test_plan_is_close_to_the_bound():
    histogram = np.zeros(1025, np.int64)
    np.add.at(histogram, np.random.default_rng(3).integers(1, 1025, 20000), 1)
    sequences = sum(n for _, n in pack_histogram(histogram))
    assert sequences <= 1.01 * -(-int((histogram * np.arange(1025)).sum()) // 1024)


@pytest.mark.parametrize("most", [16, 1024])
def test_pieces_are_the_documents_ids(docs, most):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(FILE))
    rows = [(1, None), (2, ""), (3, "one two  three, it's\n\n é日本 <|endoftext|> x"), (4, "word " * 900), (5, "one two"), (5, "one two"), (None, "no id")]
    rows += [(i, "some words here " * (i % 23)) for i in range(10, 80)]
    got = pack_documents(docs(rows), tokenizer_path(FILE), end=2, most=most, with_ids=True).collect()
    by_text = {}
    for r in got:
        assert zlib.crc32(np.array(r["ids"], np.uint32).tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= most
        by_text.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_text[i], key=lambda r: (r["piece"], r["sequence_id"]))
        pieces = pieces[::2] if i == 5 else pieces  # two equal rows
        assert [x for r in pieces for x in r["ids"]] == ids
        assert [r["piece"] for r in pieces] == list(range(-(-len(ids) // most)))
        assert all(r["length"] == most for r in pieces[1:])
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= most


def test_empty_table(docs):
    assert pack_documents(docs([]), tokenizer_path(FILE), end=2).collect() == []
