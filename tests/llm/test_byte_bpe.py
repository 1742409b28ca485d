import hashlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from benelake.llm import byte_bpe, scans, text
from benelake.llm.queries import op13_byte_bpe, tokenizer_path

RANKS = tokenizer_path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def encoded(rows):
    data, offsets = text.utf8(pa.array(rows))
    ids, at = byte_bpe.encode_block(data, offsets, RANKS, byte_bpe._classes(byte_bpe.class_table()))
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


PARTS = ["'", "'s", "'ll", "'re", "s", "l", "r", "ve", "e", "d", "Q", " ", "  ", "\n", "\t", " ", "　", "\x85", "7", "९", "½", "é", "é", "中", "!", "?", "\U0001f642", "\x00", "<|endoftext|>"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), max_size=8))
def test_same_ids_as_the_library(library, rows):
    assert encoded(rows) == [library.encode_ordinary(r) for r in rows]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(library, rows):
    assert encoded(rows) == [library.encode_ordinary(r) for r in rows]


def test_every_codepoint(library):
    rows = ["a" + chr(c) + " b" + chr(c) + "'s" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 7 == 0]
    assert encoded(rows) == [library.encode_ordinary(r) for r in rows]


def test_long_rows_are_cut_where_no_token_crosses(library, monkeypatch):
    rows = ["it's a cut  here; and 'there' \n" * 60, "", "x" * 700, "word " * 100 + "9" * 300 + " end"]
    monkeypatch.setattr(byte_bpe, "PORTION", 100)
    data, offsets = text.utf8(pa.array(rows))
    assert len(byte_bpe.portions(data, offsets, 100)) > 20
    assert encoded(rows) == [library.encode_ordinary(r) for r in rows]


@pytest.mark.parametrize("size", [3, byte_bpe.SHORT, byte_bpe.SHORT + 1, 900])
def test_merges_short_and_long(library, size):
    r = np.random.default_rng(size)
    for _ in range(20):
        word = "".join(r.choice(list("aeinorst"), size))
        assert byte_bpe.merge(word.encode(), byte_bpe.read_ranks(RANKS)) == library.encode_ordinary(word)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=400))
def test_scan_of_functions_equals_the_loop(symbols):
    step = lambda s, x: (2 * s + x) % 3 if x % 3 else s
    machine = scans.Automaton(range(3), range(3), step)
    state, want = 0, []
    for x in symbols:
        state = step(0 if x >= 3 else state, x % 3)
        want.append(state)
    assert machine.states(np.array(symbols)).tolist() == want


def test_table(spark, docs, library):
    rows = [(1, "It's 10  o'clock."), (2, None), (3, ""), (1, "It's 10  o'clock."), (None, "\n\n café "), (4, "ab " * 400_000)]
    got = byte_bpe.encode_texts(docs([(i, t, 5, "kept") for i, t in rows], "doc_id long, text string, IDS int, text_ string"), RANKS)
    assert got.columns == ["doc_id", "text", "text_", "ids", "token_ends", "n_tokens"]
    out = byte_bpe.decode_ids(got.withColumn("third", byte_bpe.token_bytes(F.col("text"), F.col("token_ends"), 2)), RANKS).collect()
    assert len(out) == len(rows)
    by_text = {r.text: r for r in out}
    for r, ids in zip(got.collect(), [library.encode_ordinary(t or "") for _, t in rows], strict=True):
        assert (r.ids, r.n_tokens, r.text_) == (ids, len(ids), "kept")
        ends = np.cumsum([len(library.decode_single_token_bytes(i)) for i in ids]).tolist()
        assert r.token_ends == ends
    assert all(bytes(r.decoded) == (t or "").encode() for t, r in by_text.items())
    assert bytes(by_text["It's 10  o'clock."].third) == b" 10"
    assert by_text[""].third is None
    empty = byte_bpe.decode_ids(byte_bpe.encode_texts(docs([]), RANKS), RANKS)
    assert empty.collect() == []


def test_unknown_id_raises(spark, docs):
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode_ids(docs([(1, [50256])], "doc_id long, ids array<int>"), RANKS).collect()


def test_query(spark, library):
    got = {r.doc_id: r for r in op13_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(rows)
    for d in rows:
        ids = np.array(library.encode_ordinary(d.text or ""), "<u4")
        want = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest())
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_sha256, got[d.doc_id].decoded_sha256) == want
