import hashlib
import json
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from benelake.llm import alignment, text
from benelake.llm.alignment import Fragment, Tokens, align_tokenizers
from benelake.llm.queries import op12_cross_tokenizer_alignment, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Tokens of both libraries with their bytes, of one whole text."""
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    names = {i: t for t, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}
    letters = alignment._byte_letters()
    model = sentencepiece.SentencePieceProcessor(model_file=B)

    def of(t):
        a = library.encode(" " + t, add_special_tokens=False).ids if t else []
        b = model.encode(t) if t else []
        bytes_a = [bytes(letters[c] for c in names[i]) for i in a]
        bytes_b = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if any(b"".join(x) != (" " + (t or "")).encode() for x in (bytes_a, bytes_b)):
            return [], []
        return [list(zip(ids, np.cumsum([0, *map(len, x)])[:-1].tolist(), np.cumsum(list(map(len, x))).tolist(), strict=True)) for ids, x in ((a, bytes_a), (b, bytes_b))]

    return of


def brute_force(rows, plain):
    found, held = [], Counter()
    for t in rows:
        a, b = plain(t)
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for i, _, x in side if low < x <= e) for side in (a, b)))
            low = e
        links = [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]
        held.update(set(links))
        found.append((len(a), len(b), ";".join(groups), links))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    return [(n_a, n_b, len(g.split(";")) if g else 0, len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if g else "", g) for n_a, n_b, g, links in found]


PARTS = ["word", "Preposterously", "it's", "  ", " ", "\n", "\t", "é", "é", "中文", "<|endoftext|>", "<s>", "<0x41>", "▁", "3.14", "\U0001f642", " ", "xyz,", "x" * 40, "the"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=20).map("".join), min_size=1, max_size=6))
def test_blocks(plain, rows):
    want = brute_force(rows, plain)
    block = alignment._aligned(*text.utf8(pa.array(rows)), A, B)
    assert [(*c, t.decode()) for c, t in zip(block.counts.tolist(), block.texts, strict=True)] == [(*w[:4], w[7]) for w in want]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), st.lists(st.integers(1, 200), max_size=6), st.randoms())
def test_fragments_compose_in_any_order(plain, row, cuts, random):
    a, b = plain(row)
    if not a:
        return
    tokens = Tokens(*[np.array([x[i] for x in side]) for side in (a, b) for i in (0, 2)])
    whole = alignment.START * Fragment.of(tokens)
    edges = [0, *sorted(cuts), 10**9]
    parts = [Fragment.of(tokens.part(i, j)) for i, j in zip(edges[:-1], edges[1:], strict=True)]
    while len(parts) > 1:  # any two neighbours, in any order
        i = random.randrange(len(parts) - 1)
        parts[i : i + 2] = [Fragment.unpack(parts[i].pack()) * parts[i + 1]]
    got = alignment.START * parts[0]
    assert (got.text, got.counts.tolist(), got.pairs.tolist(), got.times.tolist()) == (whole.text, whole.counts.tolist(), whole.pairs.tolist(), whole.times.tolist())
    assert not len(got.after.a) and got.text.decode()[:-1] == brute_force([row], plain)[0][7]
    assert (parts[0] * Fragment(broken=True)).broken


def test_ranges_of_a_long_text_compose():
    data, _ = alignment._with_blank(*text.utf8(pa.array(["zymurgical antediluvian quixotry, " * 40 + "y" * 300 + " then the end " * 9])))
    ranges = alignment.borders(data, 50)
    assert len(ranges) > 20 and [r[0] for r in ranges[1:]] == [r[1] for r in ranges[:-1]] and ranges[-1][1] == len(data)
    parts = []
    for low, high, start, stop in ranges:
        tokens, good = alignment._tokens(data[start:stop], np.array([0, stop - start]), A, B)
        assert good.all()
        tokens = Tokens(tokens.a, tokens.a_ends + start, tokens.b, tokens.b_ends + start)
        parts.append(Fragment.of(tokens.part(low, high)))
    assert sum(len(p.open.a) != 0 and len(p.after.a) != 0 for p in parts) > 3  # borders inside groups
    whole = alignment.START * Fragment.of(alignment._tokens(data, np.array([0, len(data)]), A, B)[0])
    got = alignment.START * reduce(lambda f, g: f * g, parts)
    assert (got.text, got.pairs.tolist(), got.times.tolist()) == (whole.text, whole.pairs.tolist(), whole.times.tolist())


@pytest.mark.parametrize("chunk", [40, alignment.CHUNK])
def test_table(spark, docs, plain, chunk, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 3)
    texts = ["the cat's hat", None, "", "the cat's hat", "a▁b", "the end of the story; " * 30, "z" * 200, "the end of▁ the story; " * 30, "  two  blanks ", "<|endoftext|> the"]
    rows = [(i % 7, t, "x", i) for i, t in enumerate(texts)]
    frame = docs(rows, "doc_id long, text string, N_A string, block int").repartition(3)
    got = align_tokenizers(frame, A, B, groups=True, chunk=chunk)
    assert set(got.columns) == {"doc_id", "block", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"}
    found = {r.block: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.groups) for r in got.collect()}
    assert [found[i] for i in range(len(texts))] == brute_force(texts, plain)


def test_empty_table(docs):
    assert align_tokenizers(docs([]), A, B).collect() == []


def test_query(spark, plain):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r.text or "") < 3000]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in align_tokenizers(frame, A, B).collect()}
    for r, want in zip(rows, brute_force([r.text for r in rows], plain), strict=True):
        g = got[r.doc_id]
        assert (g.n_a, g.n_b, g.n_groups, g.n_links, g.n_best, g.count_sum, g.groups_sha256) == want[:7]
    whole = op12_cross_tokenizer_alignment(spark, "/root/testdata/sf0.001")
    assert whole.count() == 200 and whole.where("n_links > 0").count() > 150
