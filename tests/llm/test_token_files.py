import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from benelake.llm import range_coder
from benelake.llm.queries import tokenizer_path
from benelake.llm.token_files import read_file, read_token_files, write_token_files

FILE = "word_bpe_49k.json"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=300), st.sampled_from([1, 7, 2048]), st.sampled_from([1, 250, 10_000_000]))
def test_round_trip(values, block, factor):
    ids = np.array(values, np.uint32) * np.uint32(factor)
    wide = bool(len(ids)) and int(ids.max()) >= 1 << 16
    lengths, codes, sums = range_coder.encode(ids, block)
    assert sum(lengths) == len(ids)
    assert [x for b in range_coder.decode(lengths, codes, sums, wide) for x in b.tolist()] == ids.tolist()


def test_blocks_are_independent_and_checked():
    ids = np.random.default_rng(1).integers(0, 49000, 9000).astype(np.uint32)
    lengths, codes, sums = range_coder.encode(ids)
    (third,) = range_coder.decode(lengths[2:3], codes[2:3], sums[2:3])
    assert third.tolist() == ids[4096:6144].tolist()
    bad = bytearray(codes[1])
    bad[100] ^= 4
    with pytest.raises(ValueError, match="damaged"):
        range_coder.decode(lengths, [codes[0], bytes(bad), *codes[2:]], sums)


def test_repeating_ids_shrink():
    ids = np.tile(np.arange(40, dtype=np.uint32) * 999, 500)
    _, codes, _ = range_coder.encode(ids)
    assert sum(map(len, codes)) < len(ids) / 8


def test_files_hold_the_ids_in_order(docs, spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(FILE))
    rows = [(5, None), (2, ""), (9, "One two, it's  three\n\n"), (-4, "é ñ 日本 " * 50), (7, "w " * 20000), (3, "same"), (3, "same"), (None, "no id")]
    folder, manifest = write_token_files(docs(rows), tokenizer_path(FILE), end=2)
    got = read_token_files(spark, folder, manifest, with_ids=True).collect()
    at = 0
    expected = []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        expected.append((i, at, len(ids), zlib.crc32(np.array(ids, np.uint32).tobytes()), ids))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected
    assert manifest.agg({"n_ids": "sum"}).first()[0] == at


def test_damage_is_found(docs, spark):
    folder, _ = write_token_files(docs([(1, "some text to write " * 30)]), tokenizer_path(FILE), end=2)
    data = max((bytes(r["content"]) for r in spark.read.format("binaryFile").load(folder).collect()), key=len)
    assert read_file(data)[0].to_pylist() == [1]
    for broken in (data[:-1], b"", data[:20] + bytes([data[20] ^ 1]) + data[21:]):
        with pytest.raises(ValueError):
            read_file(broken)


def test_empty_table(docs, spark):
    folder, manifest = write_token_files(docs([]), tokenizer_path(FILE), end=2)
    assert read_token_files(spark, folder, manifest).collect() == []
